"""strata.streaming."""
