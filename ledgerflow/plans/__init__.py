"""Composed plans: the registered queries, their SQL oracles, and the period runner."""
