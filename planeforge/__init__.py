"""Oblique-plane sampling and gallery building as Spark jobs."""
