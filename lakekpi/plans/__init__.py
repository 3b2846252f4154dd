"""Composed jobs (silver, gold, load, one batch, backfill, late rebuild), sinks and SQL views."""
