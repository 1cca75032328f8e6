"""Operators for training-data pipelines. Nothing else in the library imports
this package; its queries are listed in :mod:`cadence.llm.registry`."""
