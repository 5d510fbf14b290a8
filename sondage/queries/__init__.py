"""Registered queries with the SQL that gives the same result on the same tables."""
