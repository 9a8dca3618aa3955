"""Sinks: slot-replacing tables with retention, landing, compaction, dumps, publishing."""
