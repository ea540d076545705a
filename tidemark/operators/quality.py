"""Checks that guard a stage, and null profiles."""

from __future__ import annotations

import logging
from collections.abc import Collection, Iterable
from dataclasses import dataclass
from typing import Any

from pyspark.sql import Column, DataFrame, Observation
from pyspark.sql import functions as F
from pyspark.sql.types import StructType

from tidemark import settings as S

log = logging.getLogger(__name__)


def require_columns(df: DataFrame, required: StructType | Collection[str]) -> bool:
    """Raise ValueError unless the frame has all columns of a schema or a collection of names."""
    if isinstance(required, str):
        raise TypeError(f"a collection of names is needed, not the text {required!r}")
    absent = set(required.names if isinstance(required, StructType) else required).difference(df.columns)
    if absent:
        raise ValueError(f"columns {sorted(absent)} are not among {df.columns}")
    return True


def require_rows(df: DataFrame, context: str = "") -> bool:
    """Raise ValueError on an empty frame; stops reading at the first row found."""
    if df.isEmpty():
        raise ValueError(f"{context or 'frame'} has no rows")
    return True


def _share(nulls: Column, rows: Column) -> Column:
    return F.when(rows > 0, nulls / rows).otherwise(F.lit(0.0))


def null_rate(df: DataFrame, column: str, max_fraction: float = S.MAX_NULL_FRACTION) -> DataFrame:
    """Null count and share of a column and whether the share is within bounds; one row."""
    counted = df.agg(F.count("*").alias("rows"), F.count_if(F.col(column).isNull()).alias("nulls"))
    share = _share(F.col("nulls"), F.col("rows"))
    return counted.select(
        F.lit(column).alias("column"),
        F.col("nulls").alias("null_count"),
        F.round(share, 4).alias("null_fraction"),
        (share <= max_fraction).alias("passed"),
    )


def profile(df: DataFrame) -> DataFrame:
    """Rows, columns, and nulls of every column: one pass, one row per column."""
    nulls = [F.count_if(F.col(f"`{c}`").isNull()).alias(f"n{i}") for i, c in enumerate(df.columns)]
    counted = df.agg(F.count("*").alias("row_count"), *nulls)
    per_column = F.array(
        *[
            F.struct(F.lit(c).alias("column"), F.col(f"n{i}").alias("null_count"))
            for i, c in enumerate(df.columns)
        ]
    )
    return counted.select("row_count", F.inline(per_column)).select(
        "row_count",
        F.lit(len(df.columns)).alias("column_count"),
        "column",
        "null_count",
        F.round(_share(F.col("null_count"), F.col("row_count")), 4).alias("null_fraction"),
    )


@dataclass
class Watch:
    """A frame whose rows are counted by whatever first consumes them, and what is expected of the counts.

    The counts belong to the job that writes or collects `frame`: they add no job, no pass and no shuffle. They
    must be taken where the job's last stage runs, so hand `frame` itself to the write; rows that a retried task
    repeats are then counted once.
    """

    frame: DataFrame
    observed: Observation
    columns: tuple[str, ...]
    context: str = ""
    null_checks: tuple[str, ...] = ()
    max_fraction: float = S.MAX_NULL_FRACTION
    needs_rows: bool = True

    @property
    def rows(self) -> int:
        """How many rows passed. Waits for the job that consumes the frame."""
        return self.observed.get["rows"]

    def facts(self) -> list[dict[str, Any]]:
        """A line for each column: its nulls, their share, and whether that is within bounds."""
        told = self.observed.get
        shares = [(c, told[f"n{i}"], told[f"n{i}"] / told["rows"] if told["rows"] else 0.0) for i, c in enumerate(self.columns)]
        return [
            {"column": c, "row_count": told["rows"], "null_count": n, "null_fraction": round(share, 4), "passed": share <= self.max_fraction}
            for c, n, share in shares
        ]

    def report(self) -> DataFrame:
        """The facts as a table."""
        layout = "column string, row_count bigint, null_count bigint, null_fraction double, passed boolean"
        return self.frame.sparkSession.createDataFrame([tuple(f.values()) for f in self.facts()], layout)

    def settle(self) -> None:
        """Raise ValueError if no row passed; warn of null shares out of bounds."""
        if self.needs_rows and not self.rows:
            raise ValueError(f"{self.context or 'frame'} has no rows")
        for fact in self.facts():
            if fact["column"] in self.null_checks and not fact["passed"]:
                log.warning("%s: %.1f%% of %s is null", self.context, 100 * fact["null_fraction"], fact["column"])
        log.info("%s: %d rows, %d columns", self.context, self.rows, len(self.columns))


def watch(
    df: DataFrame,
    required: StructType | Collection[str] = (),
    context: str = "",
    null_checks: Iterable[str] = (),
    max_fraction: float = S.MAX_NULL_FRACTION,
    needs_rows: bool = True,
) -> Watch:
    """Check columns now; rows and null shares once the watch's frame has been consumed."""
    require_columns(df, required)
    observed = Observation()
    nulls = [F.count_if(F.col(f"`{c}`").isNull()).alias(f"n{i}") for i, c in enumerate(df.columns)]
    counted = df.observe(observed, F.count(F.lit(1)).alias("rows"), *nulls)
    return Watch(counted, observed, tuple(df.columns), context, tuple(null_checks), max_fraction, needs_rows)


def check(
    df: DataFrame,
    required: StructType | Collection[str],
    context: str = "",
    null_checks: Iterable[str] = (),
    max_fraction: float = S.MAX_NULL_FRACTION,
) -> DataFrame:
    """Columns, rows and null shares of a frame that isn't about to be written, in a pass of its own.

    Missing columns and an empty frame raise; null shares out of bounds only warn. Returns the frame
    unchanged. What is written goes through `watch`, whose counts come with the write.
    """
    seen = watch(df, required, context, null_checks, max_fraction)
    seen.frame.write.format("noop").mode("overwrite").save()
    seen.settle()
    return df
