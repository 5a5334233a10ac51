"""strata.plans."""
