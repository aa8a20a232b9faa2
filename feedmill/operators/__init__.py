"""Operators over frames: rows, columns, joins, totals, validation, reconciliation."""
