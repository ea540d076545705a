"""The bounded, repeatable sample on which models are fitted."""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from tidemark.llm.common import fresh

#: Hashes are spread over so many values.
SPAN = float(1 << 63)


def drawn(rows: DataFrame, label: str, by: list[str], each: int, classes: int) -> DataFrame:
    """For each label at most `each` rows: those with the smallest hashes of `by`, rows that agree in both once.

    Only the `classes` labels with the most distinct rows take part (ties by label), so there are each * classes
    rows at most, whatever the table holds. Copies count once: a text that fills a third of the table is one row of
    the sample, and a label whose rows are all copies still has one. Which rows are drawn depends on their values
    alone, not on how the table is partitioned. Rows with a null label are not drawn.

    The counts come first and give each label a bound on its hashes under which a little more than `each` rows lie,
    so what is ranked is small for every label.
    """
    at = fresh(rows, "_drawn_at")
    size = fresh(rows, "_drawn_of")
    rank = fresh(rows, "_drawn_rank")
    marked = rows.filter(F.col(label).isNotNull()).withColumn(at, F.shiftrightunsigned(F.xxhash64(F.lit(17), *by), 1))
    sizes = marked.select(label, at).distinct().groupBy(label).agg(F.count(F.lit(1)).alias(size))
    sizes = sizes.orderBy(F.desc(size), label).limit(classes)
    enough = each + 8 * each**0.5 + 16
    near = marked.join(sizes, label).filter(F.col(at) < F.least(F.lit(1.0), F.lit(enough) / F.col(size)) * SPAN)
    ranked = near.dropDuplicates([label, at]).withColumn(rank, F.row_number().over(Window.partitionBy(label).orderBy(at)))
    return ranked.filter(F.col(rank) <= each).drop(at, size, rank)
