"""Column-level helpers: text, dates, keys and event parsing."""
