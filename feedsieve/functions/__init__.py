"""Column-level building blocks: rule predicates and report text."""
