"""Rule tables: a new site is a new spec, not new code."""
