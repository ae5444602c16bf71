"""Queries registered for checking, and the SQL each is checked against."""
