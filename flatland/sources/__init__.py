"""Readers: delimited files, archives, headers, raw line counts, specs."""
