"""Registered queries over the test tables, each with an equivalent SQL statement where one exists."""
