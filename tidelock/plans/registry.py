"""Queries by name, each with the SQL that DuckDB answers alike."""

from __future__ import annotations

from collections.abc import Callable
from functools import partial

from pyspark.sql import DataFrame, SparkSession

from ..sources.fixtures import duck_text, relation

Query = Callable[[SparkSession, str], DataFrame]


class Inputs:
    """Driver tables and fixtures of one call, by attribute."""

    def __init__(self, spark: SparkSession, sf_dir: str):
        self.spark, self.sf_dir = spark, sf_dir

    def __getattr__(self, name: str) -> DataFrame:
        return relation(self.spark, self.sf_dir, name)


class Catalogue:
    def __init__(self):
        self.queries: dict[str, Query] = {}
        self.oracles: dict[str, str] = {}

    def add(self, name: str, sql: str | None = None):
        """Registers a function of Inputs; sql may name fixtures by @."""

        def register(f: Callable[[Inputs], DataFrame]):
            self.queries[name] = partial(_call, f)
            if sql is not None:
                self.oracles[name] = duck_text(sql)
            return f

        return register


def _call(f: Callable[[Inputs], DataFrame], spark: SparkSession, sf_dir: str) -> DataFrame:
    return f(Inputs(spark, sf_dir))
