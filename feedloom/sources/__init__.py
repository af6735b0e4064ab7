"""Sources and sinks: dated JSONL feeds and day-partitioned raw tables."""
