"""The table of registered queries."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession

from listloom.catalog.views import driver_model
from listloom.model import Model

Query = Callable[[SparkSession, str], DataFrame]

REGISTRY: dict[str, Query] = {}


def query(build: Callable[[Model], DataFrame]) -> Callable[[Model], DataFrame]:
    """Register a function of the model under its own name."""
    REGISTRY[build.__name__] = lambda spark, folder: build(driver_model(spark, folder))
    return build
