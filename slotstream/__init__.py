"""Slot-stream analytics on Spark: tables and streams of a slot-based event log."""
