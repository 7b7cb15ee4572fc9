"""Registry of named queries and, where SQL can express them, their SQL twins."""

from __future__ import annotations

from collections.abc import Callable
from functools import cached_property

from pyspark.sql import DataFrame, SparkSession

from shelfpair.catalog.views import view, with_views

QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {}
ORACLES: dict[str, str] = {}


class Tables:
    """The views of one data folder."""

    def __init__(self, spark: SparkSession, folder: str):
        self.spark, self.folder = spark, folder

    def _view(self, name: str) -> DataFrame:
        return view(self.spark, self.folder, name)

    products = cached_property(lambda self: self._view("products"))
    pairs = cached_property(lambda self: self._view("product_equivalence"))
    incoming = cached_property(lambda self: self._view("incoming_pairs"))
    labels = cached_property(lambda self: self._view("product_essences"))
    pair_responses = cached_property(lambda self: self._view("pair_responses"))
    essence_responses = cached_property(lambda self: self._view("essence_responses"))
    predictions = cached_property(lambda self: self._view("model_predictions"))
    vectors = cached_property(lambda self: self._view("product_vectors"))


def query(name: str, sql: str | None = None, views: str = "products", ctes: str = ""):
    """Register ``fn(tables)``; ``sql`` is its twin over the named views and extra CTEs."""

    def register(fn: Callable[[Tables], DataFrame]):
        QUERIES[name] = lambda spark, folder: fn(Tables(spark, folder))
        if sql is not None:
            ORACLES[name] = with_views(views.split(), sql, ctes)
        return fn

    return register
