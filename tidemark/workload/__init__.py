"""Queries over the star-schema tables, with the SQL that states their results."""
