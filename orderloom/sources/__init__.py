"""Readers: database tables, files, catalog tables, delimited text, control tables."""
