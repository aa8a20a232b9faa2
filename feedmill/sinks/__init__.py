"""Writers: tables, delimited and fixed-width feeds, control files, databases."""
