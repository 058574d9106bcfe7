"""Pipelines of the analyses, each registering its named queries."""

from importlib import import_module

_MODULES = ("daily_metrics", "parcels", "reviews", "review_text", "labels", "billing",
            "inspection", "tagging", "ledger",
            "training", "context")


def load_all():
    for m in _MODULES:
        import_module(f"{__name__}.{m}")
    from .catalog import ORACLES, QUERIES
    return QUERIES, ORACLES
