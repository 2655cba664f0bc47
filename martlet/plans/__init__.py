"""Declarative source specs, mart views / SQL table functions, pipeline
phases and the catalogue of queries over the driver tables."""
