"""Registered queries, one module per section of the operator inventory."""

from importlib import import_module

from schedlytics.registry import QUERIES, Query

SECTIONS = ("sources", "time", "scalar", "joined", "grouped", "windowed", "listed", "pipelines", "validated")


def load() -> dict[str, Query]:
    for section in SECTIONS:
        import_module(f"schedlytics.queries.{section}")
    return QUERIES
