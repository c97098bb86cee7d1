"""Minute-level, multi-venue perpetual-futures analytics as Spark DataFrame jobs."""
