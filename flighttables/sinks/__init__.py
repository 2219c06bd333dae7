"""Sinks: partitioned topic tables."""
