"""Step lists and the registered queries."""
