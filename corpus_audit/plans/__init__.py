"""Registered queries, one module per operator family."""

from importlib import import_module

FAMILIES = ["content", "links", "structure", "text", "catalog", "evidence", "model", "gates"]


def load_all() -> None:
    for family in FAMILIES:
        import_module(f"corpus_audit.plans.{family}")
