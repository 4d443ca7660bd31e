"""Queries over the test tables, each with the SQL its result is compared with."""
