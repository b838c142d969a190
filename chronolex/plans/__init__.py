"""Queries over the test tables, each beside its SQL form."""
