"""Readers for landed files, the stored tables, and the star-schema mapping."""
