"""Relational operators over listings and properties; every column name is a parameter."""
