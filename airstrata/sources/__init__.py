"""Readers, the table store and the adapter that feeds the given tables in."""
