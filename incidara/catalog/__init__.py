"""Registered queries over the test tables, with SQL to check them against."""
