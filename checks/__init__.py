"""Queries of the package on the given test tables, each with the SQL that must agree with it."""
