"""Training-data operators on document tables (dedup, scans, scoring, mixing, tokens)."""
