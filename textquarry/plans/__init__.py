"""Registered queries."""
from textquarry.plans import records, relational, texts  # noqa: F401
