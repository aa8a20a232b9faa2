"""Readers: tables, delimited text, fixed-width feeds, dated sets, EBCDIC records."""
