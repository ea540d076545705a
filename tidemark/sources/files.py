"""File sources and sinks: JSON Lines, CSV and Parquet layouts."""

from __future__ import annotations

import logging
from collections.abc import Sequence
from datetime import datetime

from pyspark.errors import AnalysisException
from pyspark.sql import Column, DataFrame, Observation, SparkSession
from pyspark.sql import functions as F

from tidemark import schemas
from tidemark.operators.normalize import by_source, to_posts, unify

log = logging.getLogger(__name__)

RAW_SCHEMAS = {
    "twitter": schemas.RAW_TWEET,
    "reddit": schemas.RAW_FORUM,
    "news": schemas.RAW_NEWS,
}
DATE_COLUMNS = ("source", "year", "month", "day")


def path_exists(spark: SparkSession, path: str) -> bool:
    """Whether a path or glob holds anything, on whichever file system it names. Lists, reads nothing."""
    try:
        spark.read.text(path)
    except AnalysisException as error:
        if error.getCondition() != "PATH_NOT_FOUND":
            raise
        return False
    return True


def read_jsonl(spark: SparkSession, paths: Sequence[str] | str, ddl: str, strict: bool = True) -> DataFrame:
    """JSON Lines with a declared schema. Blank lines are skipped.

    A malformed line fails the load; with `strict=False` it is kept, as a row that holds only
    its text in `_corrupt_record`.
    """
    reader = spark.read
    if strict:
        return reader.schema(ddl).option("mode", "FAILFAST").json(paths)
    kept = f"{ddl}, _corrupt_record string"
    return reader.schema(kept).option("mode", "PERMISSIVE").json(paths)


class BadLines:
    """The malformed lines of a lenient load: counted by the job that consumes the posts, diverted on demand."""

    def __init__(self) -> None:
        self._reads: dict[str, tuple[DataFrame, Observation]] = {}

    def pass_by(self, raw: DataFrame, source: str) -> DataFrame:
        """The rows of well-formed lines; the others are counted on the way."""
        counted, seen = self._counted(raw)
        self._reads[source] = (raw, seen)
        return counted.filter(F.col("_corrupt_record").isNull()).drop("_corrupt_record")

    @staticmethod
    def _counted(raw: DataFrame) -> tuple[DataFrame, Observation]:
        """Whether a line is malformed hangs on the columns that are parsed, so every one goes into the counts."""
        seen = Observation()
        bad = F.count_if(F.col("_corrupt_record").isNotNull()).alias("bad")
        return raw.observe(seen, bad, F.max(F.xxhash64(*[F.col(f"`{c}`") for c in raw.columns])).alias("parsed")), seen

    def counts(self) -> dict[str, int]:
        """Malformed lines of each source. Waits for the job that consumes the posts."""
        return {source: seen.get["bad"] for source, (_, seen) in self._reads.items()}

    def divert(self, path: str) -> int:
        """Write (file, line, source) of the malformed lines, each source that has some in a folder of its own.

        Only those sources are read once more. Returns how many lines there are; for none, nothing is written.
        """
        counts = self.counts()
        for source, (raw, _) in self._reads.items():
            if counts[source]:
                counted, _ = self._counted(raw)
                bad = counted.filter(F.col("_corrupt_record").isNotNull())
                rows = bad.select(F.col("_metadata.file_path").alias("file"), F.col("_corrupt_record").alias("line"))
                rows.write.mode("overwrite").parquet(f"{path}/source={source}")
        return sum(counts.values())


def load_raw_posts(
    spark: SparkSession, paths: Sequence[str], strict: bool = True, bad_lines: BadLines | None = None,
    pattern: str = "*.{json,jsonl}",
) -> DataFrame:
    """All raw post folders as unified posts.

    Folders that are missing or hold no file of the pattern are skipped; none left is an error.
    All folders of a source are one read, so a year of daily folders plans no more than three scans.
    With `strict=False` a malformed line becomes a post without text and is dropped like every such
    post. With `bad_lines` no line fails the load either: malformed ones are counted there, in passing,
    and can be diverted to a folder once the posts have been consumed.
    """
    patterns = {path: f"{path.rstrip('/')}/{pattern}" for path in paths}
    held = [path for path, pattern in patterns.items() if path_exists(spark, pattern)]
    if skipped := sorted(patterns.keys() - set(held)):
        log.warning("no raw files in %s, skipped", ", ".join(skipped))
    if not held:
        raise RuntimeError("none of the raw paths holds data")
    frames = []
    for source, folders in by_source(held).items():
        raw = read_jsonl(spark, [patterns[path] for path in folders], RAW_SCHEMAS[source], strict and bad_lines is None)
        if bad_lines is not None:
            raw = bad_lines.pass_by(raw, source)
        frames.append(to_posts(raw, source))
    return unify(frames)


def write_jsonl(df: DataFrame, path: str, mode: str = "overwrite") -> None:
    """One object per line, null fields written out, one file per task."""
    df.write.mode(mode).option("ignoreNullFields", False).json(path)


def read_parquet(spark: SparkSession, *paths: str) -> DataFrame:
    return spark.read.parquet(*paths)


def write_parquet(
    df: DataFrame, path: str, mode: str = "append", partition_by: Sequence[str] = ()
) -> None:
    writer = df.write.mode(mode)
    (writer.partitionBy(*partition_by) if partition_by else writer).parquet(path)


def date_parts(timestamp: Column) -> dict[str, Column]:
    """The year, month and day columns of the date layout."""
    return {
        "year": F.date_format(timestamp, "yyyy"),
        "month": F.date_format(timestamp, "MM"),
        "day": F.date_format(timestamp, "dd"),
    }


def dated_path(root: str, source: str, at: datetime) -> str:
    """Folder of one source and day in the date layout."""
    return f"{root.rstrip('/')}/source={source}/year={at:%Y}/month={at:%m}/day={at:%d}"


def write_dated(
    df: DataFrame, root: str, timestamp: str = "timestamp", mode: str = "append"
) -> None:
    """Write by source and day, so that a read for some days opens only their folders.

    Rows are first brought together by folder; Spark splits folders that are large and joins small
    ones by their size, so a source that holds a third of the data is written by many tasks.
    """
    dated = df.withColumns(date_parts(F.col(timestamp)))
    dated.hint("rebalance", *DATE_COLUMNS).write.mode(mode).partitionBy(*DATE_COLUMNS).parquet(root)


def read_dated(spark: SparkSession, root: str, source: str | None = None, day: datetime | None = None) -> DataFrame:
    """Read the date layout; source and day become partition filters."""
    with_types = spark.read.option("basePath", root)
    df = with_types.parquet(root)
    if source is not None:
        df = df.filter(F.col("source") == source)
    if day is not None:
        df = df.filter(
            (F.col("year") == day.year) & (F.col("month") == day.month) & (F.col("day") == day.day)
        )
    return df


def write_snapshot(df: DataFrame, root: str, dt: str) -> None:
    """Write one day's snapshot under `dt=`, replacing that day only."""
    (
        df.withColumn("dt", F.lit(dt))
        .write.mode("overwrite")
        .option("partitionOverwriteMode", "dynamic")
        .partitionBy("dt")
        .parquet(root)
    )


def write_csv(df: DataFrame, path: str, mode: str = "overwrite") -> None:
    df.write.mode(mode).option("header", True).csv(path)


def read_csv(spark: SparkSession, path: str, ddl: str | None = None, multiline: bool = False) -> DataFrame:
    """CSV with a header; types are inferred (an extra pass) unless a schema is given.

    Values that hold line breaks need `multiline`; each file is then read by one task.
    """
    reader = spark.read.option("header", True).option("multiLine", multiline)
    return reader.schema(ddl).csv(path) if ddl else reader.option("inferSchema", True).csv(path)


def read_folder(spark: SparkSession, root: str) -> DataFrame:
    """Every Parquet file below a folder, with the union of their columns."""
    reader = spark.read.option("recursiveFileLookup", True).option("mergeSchema", True)
    return reader.parquet(root)


def read_folder_or_none(spark: SparkSession, root: str) -> DataFrame | None:
    try:
        return read_folder(spark, root)
    except AnalysisException:
        return None


def export_csv(df: DataFrame, path: str) -> None:
    """The shown rows as CSV with a header."""
    write_csv(df, path)


def export_json(df: DataFrame, path: str) -> None:
    """The shown rows as JSON records with ISO timestamps."""
    iso = "yyyy-MM-dd'T'HH:mm:ss.SSS'Z'"
    df.write.mode("overwrite").option("timestampFormat", iso).option("ignoreNullFields", False).json(path)
