"""Structured Streaming twins of the daily snapshot and alert jobs."""
