"""Functions that tasks run travel with their code, so that executors need no copy of the package."""

from __future__ import annotations

import sys

from pyspark import cloudpickle


def ship(module: str) -> None:
    """Send the functions of ``module`` by value."""
    cloudpickle.register_pickle_by_value(sys.modules[module])
