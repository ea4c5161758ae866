"""Named queries over the Parquet tables; importing the package registers all of them."""

import importlib

from lodestone.plans.registry import ORACLES, QUERIES

for _module in (
    "basics", "joins", "aggregates", "windows", "scalars", "reports", "streams", "udfs", "features", "texts", "metrics", "models", "recommendations", "training", "files",
):
    importlib.import_module(f"lodestone.plans.{_module}")

__all__ = ["ORACLES", "QUERIES"]
