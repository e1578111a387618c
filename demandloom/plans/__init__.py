"""Registered queries, grouped by subject."""

from importlib import import_module

MODULES = ("q_clean", "q_features", "q_reports", "q_eval", "q_models")


def load_queries() -> None:
    for name in MODULES:
        import_module(f"demandloom.plans.{name}")
