"""Readers and writers of files, snapshots and bundles."""
