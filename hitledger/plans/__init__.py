"""Whole flows: landing files into the table, and the report on top of it."""
