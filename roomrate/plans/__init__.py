"""Composed plans (PL1-PL5) and the registry of named queries."""
