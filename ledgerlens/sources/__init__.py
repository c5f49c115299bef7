"""Readers and writers: driver-table adapters, raw event files, stage tables."""
