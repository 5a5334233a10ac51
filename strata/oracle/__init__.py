"""strata.oracle."""
