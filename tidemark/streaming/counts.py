"""Keyword counts over a stream of posts."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tidemark.functions.times import slide_seconds, window_seconds
from tidemark.operators.keywords import keyword_events

POST_DDL = "id string, text string, timestamp timestamp, source string, engagement int, lang string"


def read_posts(spark: SparkSession, path: str, ddl: str = POST_DDL, files_per_batch: int | None = None) -> DataFrame:
    """A folder of Parquet post files as a stream; the schema is declared, never inferred."""
    reader = spark.readStream.schema(ddl)
    if files_per_batch is not None:
        reader = reader.option("maxFilesPerTrigger", files_per_batch)
    return reader.parquet(path)


def stream_window_frequency(
    posts: DataFrame, label: str = "1h", lateness: str = "1 day", slide_fraction: float = 1.0
) -> DataFrame:
    """Windowed counts of a post stream. A mention later than the lateness is dropped and the
    state of its window released; state is one row per open window and keyword."""
    on_time = keyword_events(posts.withWatermark("timestamp", lateness), ("timestamp",))
    length, slide = (f"{n} seconds" for n in (window_seconds(label), slide_seconds(label, slide_fraction)))
    counted = on_time.groupBy("keyword", F.window("timestamp", length, slide)).count()
    return counted.select(
        "keyword", F.col("window.start").alias("window_start"), F.col("window.end").alias("window_end"),
        F.col("count").alias("frequency"), F.lit(label).alias("window"),
    )


def run_available(counts: DataFrame, path: str, checkpoint: str, closed_only: bool = False) -> list[dict]:
    """Process what is there and stop; each batch writes the counts it changed.

    A batch overwrites its own folder only, so a batch repeated after a failure leaves the same
    table. With `closed_only` a window is written once, by the batch after which the watermark has passed
    its end, and its state is released then; windows still open at the end stay in the checkpoint for
    the next run. Returns the progress of each batch: its number, watermark, rows dropped as late, rows held
    in state. (Late rows are counted after they were combined by task, window and keyword.)
    """

    def write(changed: DataFrame, batch: int) -> None:
        changed.write.mode("overwrite").parquet(f"{path}/batch={batch}")

    run = (
        counts.writeStream.outputMode("append" if closed_only else "update")
        .foreachBatch(write)
        .option("checkpointLocation", checkpoint)
        .trigger(availableNow=True)
        .start()
    )
    run.awaitTermination()
    return [_told(progress) for progress in run.recentProgress]


def _told(progress) -> dict:
    states = progress.stateOperators
    return {
        "batch": progress.batchId,
        "watermark": progress.eventTime.get("watermark"),
        "late": sum(s.numRowsDroppedByWatermark for s in states),
        "open": sum(s.numRowsTotal for s in states),
    }


def closed_counts(spark: SparkSession, path: str) -> DataFrame:
    """The counts of all windows that `run_available(..., closed_only=True)` has closed: each stands there once."""
    return spark.read.parquet(path).drop("batch")


def current_counts(spark: SparkSession, path: str, compacted: str | None = None) -> DataFrame:
    """The newest count of every window and keyword, (keyword, window_start, window_end, window, frequency).

    With a compacted table only the batches after it are opened.
    """
    return _newest(spark.read.parquet(path), compacted)


def compact(spark: SparkSession, path: str, target: str, compacted: str | None = None) -> int:
    """Write the current counts to `target`, a new folder, under the number of their last batch; returns it.

    Batches up to that number, and the table compacted before, are no longer needed by readers of `target`.
    Stream and compaction may run side by side: a batch that arrives meanwhile has a higher number.
    """
    last = _last_batch(spark.read.parquet(path))
    # The listing of a new read may hold later batches, which must stay with the stream
    rows = spark.read.parquet(path).filter(F.col("batch") <= last)
    _newest(rows, compacted).write.mode("overwrite").parquet(f"{target}/batch={last}")
    return last


def _newest(rows: DataFrame, compacted: str | None) -> DataFrame:
    if compacted is not None:
        base = rows.sparkSession.read.parquet(compacted)
        rows = rows.filter(F.col("batch") > _last_batch(base)).unionByName(base)
    keys = ["keyword", "window_start", "window_end", "window"]
    return rows.groupBy(*keys).agg(F.max_by("frequency", "batch").alias("frequency"))


def _last_batch(rows: DataFrame) -> int:
    return rows.agg(F.max("batch")).first()[0]
