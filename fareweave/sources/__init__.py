"""Readers and writers: driver tables, fixture views, files, JSON responses."""
