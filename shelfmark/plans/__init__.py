"""Registered queries over the test tables, each with the SQL stating the same result."""
