"""Spark jobs over an open company registry: new companies, weekly counts, cuts."""
