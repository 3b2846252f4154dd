"""Scans and listings: fixtures over the driver tables, CSV batches, file listings, partition readers, probes."""
