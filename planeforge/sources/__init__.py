"""Readers: tables, bridges, mesh, volume, text and registry files."""
