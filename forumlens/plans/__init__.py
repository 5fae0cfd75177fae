"""Registered queries and their SQL twins, grouped by area."""

from importlib import import_module

AREAS = ["ingest", "texts", "retrieving", "talks", "topicmodel", "network", "streams"]


def load_all() -> None:
    for area in AREAS:
        import_module(f"forumlens.plans.{area}")
