"""Registered queries: every operator run on the given tables, with its SQL twin."""
