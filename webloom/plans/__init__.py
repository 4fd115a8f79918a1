"""All registered queries; importing this package fills the registry."""

import importlib

from webloom.plans.registry import ORACLES, QUERIES

for _name in (
    "functions", "io", "urls", "joins", "stats", "ranking", "sets", "pages",
    "textops", "qa", "kb", "records", "network", "music", "streams",
):
    importlib.import_module(f"webloom.plans.{_name}_queries")

__all__ = ["ORACLES", "QUERIES"]
