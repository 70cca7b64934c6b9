"""Functions of this package travel to executors by value, so a cluster needs no installed copy."""

from __future__ import annotations

import sys
import types


def ship() -> None:
    from pyspark import cloudpickle
    cloudpickle.register_pickle_by_value(sys.modules[__name__.split(".")[0]])


def worker_cache(name: str) -> dict:
    """A dict that lives as long as the Python worker, across tasks (shipped functions' globals do not)."""
    m = sys.modules.setdefault("_panelforge_worker", types.ModuleType("_panelforge_worker"))
    return m.__dict__.setdefault(name, {})
