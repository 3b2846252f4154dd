"""Relational operators of the pipeline; each is a ``DataFrame -> DataFrame`` function."""
