"""Spark jobs that turn landed web pages and payloads into clean records."""

from harvestry.session import build_session

__all__ = ["build_session"]
