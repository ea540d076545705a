"""Quality rules: a decision list of threshold conjunctions, learnt by sequential covering.

Rules for bad documents are grown one at a time on two thirds of a labelled sample: the condition with
the highest information gain is added until no good document is covered. The other third prunes the
rule's last conditions while that raises its share of bad over good. A rule that holds its ground there
joins the list, what it covers leaves the sample, and the next one is grown. The list is emitted as one
ordered Spark conditional (CASE WHEN ... END) and judges every row inside the JVM.
"""

from __future__ import annotations

from dataclasses import dataclass

import numpy as np
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tidemark.llm.sampling import SPAN
from tidemark.llm.textstats import ratios, text_statistics
from tidemark.session import materialize

#: Labelled rows that teach, about; those with the smallest hashes of their statistics.
SAMPLE_ROWS = 20_000
#: Defaults of what bounds a list: rules, conditions of a rule, thresholds that are tried for each feature.
MAX_RULES = 16
MAX_CONDITIONS = 5
CUTS = 48
MIN_PRECISION = 0.9
MIN_COVERED = 5

MIN_WORDS = 10
MAX_REPEAT_PERCENT = 20


@dataclass(frozen=True)
class Condition:
    feature: str
    above: bool
    cut: float

    def holds(self, values: np.ndarray) -> np.ndarray:
        return values > self.cut if self.above else values <= self.cut

    def column(self, columns: dict[str, Column]) -> Column:
        return columns[self.feature] > self.cut if self.above else columns[self.feature] <= self.cut

    def __str__(self) -> str:
        return f"{self.feature} {'>' if self.above else '<='} {self.cut:.6g}"


@dataclass(frozen=True)
class Rule:
    conditions: tuple[Condition, ...]
    precision: float

    def __str__(self) -> str:
        return " and ".join(map(str, self.conditions))


def covered(conditions, x: dict[str, np.ndarray], n: int) -> np.ndarray:
    keep = np.ones(n, bool)
    for condition in conditions:
        keep &= condition.holds(x[condition.feature])
    return keep


def _best(x: dict[str, np.ndarray], bad: np.ndarray, inside: np.ndarray, tried: int) -> tuple[float, Condition | None]:
    """The condition with the highest gain among the rows inside."""
    p0, n0 = int((inside & bad).sum()), int((inside & ~bad).sum())
    before = np.log2(p0 / (p0 + n0))
    found: tuple[float, Condition | None] = (1e-9, None)
    for name in sorted(x):
        values = x[name][inside]
        marks = bad[inside]
        # Thresholds between neighbouring quantiles of the bad rows and of all rows inside
        ranks = np.linspace(0, 1, tried)
        edges = np.unique(np.concatenate([np.quantile(values, ranks), np.quantile(values[marks], ranks)]))
        cuts = (edges[:-1] + edges[1:]) / 2
        if not len(cuts):
            continue
        order = np.argsort(values, kind="stable")
        at = np.searchsorted(values[order], cuts, "right")
        below_p = np.concatenate([[0], np.cumsum(marks[order])])[at]
        for above, p, total in ((False, below_p, at), (True, p0 - below_p, len(values) - at)):
            with np.errstate(divide="ignore", invalid="ignore"):
                gain = np.where(p > 0, p * (np.log2(p / total) - before), -1.0)
            k = int(np.argmax(gain))
            if gain[k] > found[0]:
                found = (float(gain[k]), Condition(name, above, float(cuts[k])))
    return found


def learn(
    x: dict[str, np.ndarray], bad: np.ndarray, part: np.ndarray,
    most_rules: int = MAX_RULES, most_conditions: int = MAX_CONDITIONS, cuts: int = CUTS,
) -> list[Rule]:
    """An ordered list of rules for the bad rows. part: true for the rows that prune.

    At most `most_rules` rules of at most `most_conditions` conditions, their thresholds among `cuts` quantiles of
    the rows in question and `cuts` of the bad ones.

    Without bad rows, or without good ones, there is nothing to tell apart and the list is empty.
    """
    rules: list[Rule] = []
    left = np.ones(len(bad), bool)
    while len(rules) < most_rules:
        grow, prune = left & ~part, left & part
        if (grow & bad).sum() < MIN_COVERED or not (left & ~bad).any():
            break
        conditions: list[Condition] = []
        inside = grow.copy()
        while len(conditions) < most_conditions and (inside & ~bad).any():
            _, best = _best(x, bad, inside, cuts)
            if best is None:
                break
            conditions.append(best)
            inside &= best.holds(x[best.feature])
        if not conditions:
            break

        def worth(some: list[Condition], rows: np.ndarray = prune) -> float:
            hit = covered(some, x, len(bad)) & rows
            p, n = (hit & bad).sum(), (hit & ~bad).sum()
            return (p - n) / (p + n) if p + n else -1.0

        kept = max((conditions[:k] for k in range(len(conditions), 0, -1)), key=worth)
        hit = covered(kept, x, len(bad)) & left
        p, n = int((hit & bad).sum()), int((hit & ~bad).sum())
        if p < MIN_COVERED or p / (p + n) < MIN_PRECISION or worth(kept) <= 0:
            break
        rules.append(Rule(tuple(kept), p / (p + n)))
        left &= ~hit
    return rules


def base_failed(s: str = "s") -> Column:
    """Fewer than ten words, or over a fifth of the words inside repeated windows."""
    return (F.col(f"{s}.n_words") < MIN_WORDS) | (
        100 * F.col(f"{s}.n_repeat_words") > MAX_REPEAT_PERCENT * F.col(f"{s}.n_words")
    )


def decision(rules: list[Rule], columns: dict[str, Column]) -> Column:
    """The number of the first rule that a row meets, from 1; 0 for none."""
    case = None
    for number, rule in enumerate(rules, 1):
        met = F.lit(True)
        for condition in rule.conditions:
            met &= condition.column(columns)
        case = F.when(met, F.lit(number)) if case is None else case.when(met, F.lit(number))
    return F.lit(0) if case is None else case.otherwise(F.lit(0))


def statistics(docs: DataFrame) -> DataFrame:
    """(doc_id, s) of each document; null texts have no word, other columns are not read."""
    return docs.select(F.col("doc_id").cast("long").alias("doc_id"), text_statistics("text").alias("s"))


def train(
    stats: DataFrame, labels: DataFrame, rows: int = SAMPLE_ROWS,
    most_rules: int = MAX_RULES, most_conditions: int = MAX_CONDITIONS, cuts: int = CUTS,
) -> list[Rule]:
    """Rules from the labelled documents that the base rules pass, from about `rows` of them; see `learn` for the
    other bounds.

    Documents with equal statistics and labels teach once. They are counted first, so that only rows below a bound
    on their hashes, about `rows` in all, leave the tasks. A doc_id with several labels is bad if any says so; null
    ids and labels don't teach.
    """
    marks = labels.filter("doc_id IS NOT NULL AND quality IS NOT NULL")
    marks = marks.groupBy(F.col("doc_id").cast("long").alias("doc_id")).agg(F.min("quality").alias("quality"))
    names = list(ratios())
    taught = stats.filter(~base_failed()).join(marks, "doc_id")
    taught = taught.select(*[c.alias(n) for n, c in ratios().items()], (F.col("quality") == 0).alias("bad")).distinct()
    taught = materialize(taught.withColumn("at", F.shiftrightunsigned(F.xxhash64(*names), 1)), "rules-taught")
    bound = min(1.0, rows / max(taught.count(), 1)) * SPAN
    sample = taught.filter(F.col("at") <= F.lit(bound)).toPandas().sort_values(["at", *names, "bad"], ignore_index=True)
    if sample.empty:
        return []
    x = {n: sample[n].to_numpy(float) for n in names}
    prunes = (sample["at"].to_numpy() // 7 % 3) == 0
    return learn(x, sample["bad"].to_numpy(bool), prunes, most_rules, most_conditions, cuts)


def judge(stats: DataFrame, rules: list[Rule]) -> DataFrame:
    """stats with base_failed, rule (0: none met) and kept. An empty text has no words and fails the base."""
    judged = stats.withColumn("base_failed", base_failed()).withColumn("rule", decision(rules, ratios()))
    return judged.withColumn("kept", ~F.col("base_failed") & (F.col("rule") == 0))
