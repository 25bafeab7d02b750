"""Whole jobs: dictionary assembly, deltas, selection, gate, shards, enrichment."""
