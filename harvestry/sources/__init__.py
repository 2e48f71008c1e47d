"""Readers for landed data and writers for results."""
