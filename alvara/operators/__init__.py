"""Operators over registry tables and over the weekly aggregate."""
