"""Queries over the shared test tables, each next to the SQL it is checked against."""
