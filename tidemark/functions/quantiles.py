"""Exact quantiles of whole columns without gathering or sorting their values."""

from __future__ import annotations

import math
from collections.abc import Iterable

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from tidemark.functions.numbers import finite
from tidemark.session import materialize, scratch

#: Bins that a pass counts in each open span.
BINS = 1 << 12
#: Size of the sketch that gives the first spans, and how far in probability these reach: over three of its errors.
SKETCH = 2048
REACH = 0.004


def _bin(value: Column, low: float, high: float) -> Column:
    """Bin of a value between two bounds. Halved first, so the width cannot overflow."""
    if low == high:
        return F.lit(0).cast("bigint")
    share = (value / 2 - low / 2) / (high / 2 - low / 2)
    return F.least(F.floor(share * BINS), F.lit(BINS - 1))


def _merged(spans: Iterable[tuple[float, float]]) -> list[tuple[float, float]]:
    """The same values as disjoint spans in order; a span that ends before it begins holds none."""
    out: list[tuple[float, float]] = []
    for low, high in sorted(s for s in spans if s[0] <= s[1]):
        if out and low <= out[-1][1]:
            out[-1] = (out[-1][0], max(out[-1][1], high))
        else:
            out.append((low, high))
    return out


def _counted(df: DataFrame, spans: dict[str, list[tuple[float, float]]]) -> DataFrame:
    """(slot, region, v, n): one read. Slots number the columns. Region 2i + 1 is span i, whose values are counted
    one by one; region 2i lies below it and is one count. What lies above the last span needs no row."""
    entries = []
    for slot, (column, found) in enumerate(spans.items()):
        value, region = finite(F.col(column)), None
        for i, (low, high) in enumerate(found):
            region = (F if region is None else region).when(value < low, F.lit(2 * i)).when(value <= high, F.lit(2 * i + 1))
        if region is not None:
            inside = F.when(region % 2 == 1, value)
            entry = F.struct(F.lit(slot).alias("slot"), region.alias("region"), inside.alias("v"))
            entries.append(F.when(region.isNotNull(), entry))
    rows = df.select(F.inline(F.array_compact(F.array(*entries))))
    return rows.groupBy("slot", "region", "v").agg(F.count(F.lit(1)).alias("n"))


def _narrow(counted: DataFrame, spans: dict[tuple, tuple]) -> dict[tuple, tuple]:
    """One pass over the counts: every open (slot, region, rank) shrinks to the bin that holds its rank.

    A span is (low, high, below): its value bounds and how many values of its region lie under them.
    """
    shared = sorted({(*key[:2], *span) for key, span in spans.items()})
    numbers = {key: i for i, key in enumerate(shared)}
    entries = []
    for (slot, region, low, high, _), number in numbers.items():
        mine = (F.col("slot") == slot) & (F.col("region") == region) & F.col("v").between(low, high)
        entries.append(F.when(mine, F.struct(F.lit(number).alias("span"), _bin(F.col("v"), low, high).alias("bin"), "v", "n")))
    bins = (
        counted.select(F.inline(F.array_compact(F.array(*entries))))
        .groupBy("span", "bin")
        .agg(F.sum("n").alias("n"), F.min("v").alias("low"), F.max("v").alias("high"))
    )
    upto = F.sum("n").over(Window.partitionBy("span").orderBy("bin"))
    ranked = bins.withColumn("before", upto - F.col("n"))  # at most BINS rows per span
    picks, order = [], list(spans)
    for i, key in enumerate(order):
        at = F.lit(key[2] - spans[key][2])
        hit = (F.col("span") == numbers[(*key[:2], *spans[key])]) & (at >= F.col("before")) & (at < F.col("before") + F.col("n"))
        picks.append(F.when(hit, F.lit(i)))
    found = (
        ranked.select("low", "high", "before", F.explode(F.array_compact(F.array(*picks))).alias("pick"))
        .collect()  # one row per open rank
    )
    return {order[r["pick"]]: (r["low"], r["high"], spans[order[r["pick"]]][2] + r["before"]) for r in found}


def _settle(df: DataFrame, spans: dict[str, list[tuple]], bounds: dict[str, tuple], ranks: dict[str, set[int]]) -> tuple[dict, dict]:
    """Values of the ranks that lie in spans of their column, and for each other one the gap that holds it."""
    values: dict[tuple[str, int], float] = {}
    missed: dict[tuple[str, int], tuple[float, float]] = {}
    names = list(spans)
    with scratch():
        counted = materialize(_counted(df, spans), "quantile-counts") if any(spans.values()) else None
        sums = counted.groupBy("slot", "region").agg(F.sum("n").alias("n")).collect() if counted else []  # a row per region
        sizes = {(r["slot"], r["region"]): r["n"] for r in sums}
        open_: dict[tuple[int, int, int], tuple] = {}
        for slot, column in enumerate(names):
            found = spans[column]
            for rank in ranks[column]:
                below = 0
                for region in range(2 * len(found)):
                    size = sizes.get((slot, region), 0)
                    if rank < below + size:
                        break
                    below += size
                else:
                    region = 2 * len(found)
                if region % 2:
                    open_[(slot, region, rank - below)] = (*found[region // 2], 0)
                    values[(column, rank)] = (slot, region, rank - below)  # its key, until it is known
                else:
                    i = region // 2
                    low = found[i - 1][1] if i else bounds[column][0]
                    missed[(column, rank)] = (low, found[i][0] if i < len(found) else bounds[column][1])
        known: dict[tuple[int, int, int], float] = {}
        while open_:
            open_ = _narrow(counted, open_)
            known.update({key: span[0] for key, span in open_.items() if span[0] == span[1]})
            open_ = {key: span for key, span in open_.items() if span[0] != span[1]}
    return {at: known[key] for at, key in values.items()}, missed


def exact_quantiles(
    df: DataFrame, columns: Iterable[str], probabilities: Iterable[float]
) -> dict[str, list[float | None]]:
    """Linearly interpolated quantiles of the finite values of several columns.

    Two reads of the input. The first merges a KLL sketch per column, which brackets every rank. The second
    counts what lies between the brackets, and each value inside them by itself: a narrow table with under a
    hundredth of the values per probability, which is written once. A histogram descent over that table finds
    the ranks, so memory is bounded by its bins. Only if a sketch missed a rank is the input read again, between
    the neighbouring brackets. Smallest and largest values need no bracket. A column without finite values has None.
    """
    columns, probabilities = list(dict.fromkeys(columns)), list(probabilities)
    near = [min(max(p + side * REACH, 0.0), 1.0) for p in probabilities for side in (-1, 1)]
    facts, reads = [], []
    for i, c in enumerate(columns):
        v = finite(F.col(c))
        facts += [F.count(v).alias(f"n{i}"), F.min(v).alias(f"low{i}"), F.max(v).alias(f"high{i}"), F.kll_sketch_agg_double(v, SKETCH).alias(f"s{i}")]
        bracket = F.when(F.col(f"n{i}") > 0, F.kll_sketch_get_quantile_double(f"s{i}", F.array(*map(F.lit, near))))
        reads += [f"n{i}", f"low{i}", f"high{i}", bracket.alias(f"near{i}")]
    row = df.agg(*facts).select(*reads).first() if columns and probabilities else None

    wanted, found = {}, {}
    spans, bounds, ranks = {}, {}, {}
    for i, c in enumerate(columns if row else ()):
        n = row[f"n{i}"]
        if not n:
            continue
        bounds[c] = (row[f"low{i}"], row[f"high{i}"])
        found |= {(c, 0): bounds[c][0], (c, n - 1): bounds[c][1]}
        brackets = []
        for j, p in enumerate(probabilities):
            at = p * (n - 1)
            wanted[(c, p)] = (math.floor(at), math.ceil(at), at - math.floor(at))
            left = {rank for rank in wanted[(c, p)][:2] if (c, rank) not in found}
            if left:
                ranks.setdefault(c, set()).update(left)
                brackets.append(tuple(row[f"near{i}"][2 * j : 2 * j + 2]))
        if brackets:
            spans[c] = _merged(brackets)

    while ranks:
        settled, missed = _settle(df, spans, bounds, ranks)
        found |= settled
        ranks = {c: {rank for name, rank in missed if name == c} for c in {name for name, _ in missed}}
        spans = {c: _merged(gap for (name, _), gap in missed.items() if name == c) for c in ranks}

    def value(c: str, p: float) -> float | None:
        if (c, p) not in wanted:
            return None
        lower, upper, part = wanted[(c, p)]
        return found[(c, lower)] + (found[(c, upper)] - found[(c, lower)]) * part

    return {c: [value(c, p) for p in probabilities] for c in columns}
