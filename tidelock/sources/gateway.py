"""Opening a source that may not be up yet, and ad-hoc SQL over it."""

from __future__ import annotations

import re
import time
from collections.abc import Callable
from typing import TypeVar

from pyspark.sql import DataFrame, Row, SparkSession

from .settings import Settings

Opened = TypeVar("Opened")


class SourceUnavailable(RuntimeError):
    """A budget is spent; the last error is its cause."""


def connect(open_: Callable[[], Opened], unreachable: float, refused: float, pause: float = 1.0, clock: Callable[[], float] = time.monotonic, sleep: Callable[[float], None] = time.sleep) -> Opened:
    """Calls until it opens.  A source that can't be reached has one budget of seconds, one that answers and refuses
    another, which starts with the first refusal; all other errors go to the caller at once."""
    budgets = ((PermissionError, refused, "refused"), ((ConnectionError, TimeoutError, FileNotFoundError), unreachable, "not reachable"))
    began: dict[str, float] = {}
    while True:
        try:
            return open_()
        except (PermissionError, ConnectionError, TimeoutError, FileNotFoundError) as e:
            seconds, why = next((s, w) for kinds, s, w in budgets if isinstance(e, kinds))
            if clock() - began.setdefault(why, clock()) + pause > seconds:
                raise SourceUnavailable(f"{why} for {seconds:g} s: {e}") from e
            sleep(pause)


def split_batches(script: str) -> list[str]:
    """The batches of a script: lines with GO alone part them, empty ones go."""
    parts = re.split(r"(?im)^[ \t]*go[ \t]*;?[ \t]*$", script)
    return [p.strip() for p in parts if p.strip()]


class Gateway:
    """SQL over the tables of a folder, which are views by their names."""

    def __init__(self, spark: SparkSession, settings: Settings, names: list[str]):
        self.spark, self.settings = spark, settings
        for name in names:
            connect(lambda name=name: self._table(name), settings.unreachable_seconds, settings.refused_seconds).createOrReplaceTempView(name)

    def _table(self, name: str) -> DataFrame:
        path = f"{self.settings.source}/{name}.parquet"
        hadoop = self.spark.sparkContext._jvm.org.apache.hadoop.fs.Path(path)
        if not hadoop.getFileSystem(self.spark.sparkContext._jsc.hadoopConfiguration()).exists(hadoop):
            raise FileNotFoundError(path)
        return self.spark.read.parquet(path)

    def frame(self, sql: str, **args) -> DataFrame:
        return self.spark.sql(sql, args=args or None)

    def query(self, sql: str, **args) -> list[Row]:
        """All rows; for answers that are known to be small."""
        return self.frame(sql, **args).collect()

    def scalar(self, sql: str, **args):
        """The first column of the first row; None without one."""
        row = self.frame(sql, **args).first()
        return None if row is None else row[0]

    def execute(self, sql: str, **args) -> int:
        """How many rows a statement gives."""
        return self.frame(sql, **args).count()

    def execute_script(self, script: str) -> list[DataFrame]:
        """A result for each batch of a script."""
        return [self.frame(b) for b in split_batches(script)]

    def columns(self, name: str) -> dict[str, str]:
        """Column types of a table, as the catalogue has them."""
        return {f.name: f.dataType.simpleString() for f in self.spark.table(name).schema}

    def require(self, *names: str) -> None:
        """One error that names all tables that are missing."""
        if missing := [n for n in names if not self.spark.catalog.tableExists(n)]:
            raise LookupError(f"the source has no {', '.join(sorted(missing))}")
