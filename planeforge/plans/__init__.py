"""Registered queries and the plain SQL each is checked against."""
