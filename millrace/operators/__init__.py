"""Relational, ordered, changelog and pattern operators."""
