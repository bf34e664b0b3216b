"""Registered queries with their SQL counterparts."""

from __future__ import annotations

import importlib

MODULES = ["taxonomy", "measures", "layers", "complete", "model", "vectors", "batches", "profile"]


def all_pairs() -> dict:
    """Name to (query, SQL or None) over all topics."""
    pairs: dict = {}
    for name in MODULES:
        found = importlib.import_module(f"checks.{name}").PAIRS
        assert not set(found) & set(pairs), "two queries share a name"
        pairs.update(found)
    return pairs
