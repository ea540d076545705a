"""Queries of the trend board over a trend table."""

from __future__ import annotations

from collections.abc import Sequence
from datetime import date, datetime
from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tidemark import settings as S
from tidemark.functions.text import is_token

# Stand-in columns for tables that lack the board's own.
STAND_INS = (
    ("timestamp", "window_start"),
    ("growth_rate", "growth_rate_24h"),
    ("z_score", "z_score_24h"),
    ("frequency", "freq_24h"),
)
ALERT_Z = 3.0


def _plain(label: str = "trend_label") -> Column:
    return F.lower(F.trim(F.col(label)))


def prepare(df: DataFrame, stand_ins: Sequence[tuple[str, str]] = STAND_INS) -> DataFrame:
    """A stored table with the board's columns: absent ones from their stand-ins, labels plain,
    text times parsed (unreadable ones null)."""
    have = set(df.columns)
    df = df.withColumns({new: F.col(old) for new, old in stand_ins if new not in have and old in have})
    for label in ("trend_label", "trend_class"):
        if label in df.columns:
            df = df.withColumn(label, _plain(label))
    for time in ("timestamp", "predicted_at"):
        if time in df.columns:
            kind = dict(df.dtypes)[time]
            parsed = F.try_to_timestamp(time) if kind == "string" else F.col(time).cast("timestamp")
            df = df.withColumn(time, parsed)
    return df


def combine(frames: Sequence[DataFrame]) -> DataFrame:
    """Stored tables of different columns as one, gaps null, then prepared.

    Times are parsed before the union, where one table may hold text and another timestamps; columns
    stand in for others only where no table has those.
    """
    parsed = [prepare(df, ()) for df in frames]
    return prepare(reduce(lambda a, b: a.unionByName(b, allowMissingColumns=True), parsed))


def newest(board: DataFrame, time: str = "timestamp") -> Column:
    """The latest time of a table, as a scalar subquery."""
    return board.select(F.max(time)).scalar()


def lookback(board: DataFrame, hours: int, as_of: datetime | Column | None = None) -> DataFrame:
    """Rows of the last hours before `as_of`, by default before the newest row."""
    if as_of is None:
        as_of = newest(board)
    elif isinstance(as_of, datetime):
        as_of = F.lit(as_of)
    return board.filter(F.col("timestamp") >= as_of - F.make_interval(hours=F.lit(hours)))


def replay_day(board: DataFrame, day: date) -> DataFrame:
    """Rows of one calendar day."""
    start = F.lit(datetime(day.year, day.month, day.day))
    time = F.col("timestamp")
    return board.filter((time >= start) & (time < start + F.expr("INTERVAL 1 DAY")))


def search(board: DataFrame, query: str) -> DataFrame:
    """Keywords that hold the query, whatever the case; the query is plain text."""
    return board.filter(F.lower("keyword").contains(query.lower()))


def choose(
    board: DataFrame,
    labels: Sequence[str] | None = None,
    min_frequency: int = 5,
    min_growth: float = 0.0,
    sources: Sequence[str] | None = (S.ALL_SOURCES,),
) -> DataFrame:
    """The board's label, frequency, growth and source filters.

    A null label counts as stable, a null growth drops out, no source means the rows over all.
    """
    keep = (F.col("frequency") >= min_frequency) & (F.col("growth_rate") >= min_growth)
    if labels:
        keep = keep & F.lower(F.coalesce("trend_label", F.lit("stable"))).isin(
            [x.lower() for x in labels]
        )
    return board.filter(keep & F.col("source").isin(list(sources or (S.ALL_SOURCES,))))


def surprise(board: DataFrame, seed: int = 0) -> DataFrame:
    """Every row of one keyword drawn among viral and emerging ones, or all if there are none.

    The draw is the smallest seeded hash, so it is one combined aggregate rather than a sort.
    """
    hot = F.col("trend_label").isin("emerging", "viral")
    order = F.struct(
        F.when(hot, F.lit(0)).otherwise(F.lit(1)), F.md5(F.concat("keyword", F.lit(f":{seed}"))), "keyword"
    )
    drawn = board.select(F.min_by("keyword", order)).scalar()
    return board.filter(F.col("keyword") == drawn)


def watchlist_alerts(board: DataFrame, watchlist: Sequence[str], z: float = ALERT_Z) -> DataFrame:
    return board.filter(F.col("keyword").isin(list(watchlist)) & (F.col("z_score") > z))


def _tie_break(board: DataFrame) -> list[str]:
    known = ("keyword", "timestamp", "window", "source")
    return [c for c in known if c in board.columns]


def ranking(board: DataFrame, top_n: int = 20) -> DataFrame:
    """Most mentioned first, then highest score."""
    order = [F.desc("frequency"), F.desc("z_score"), *_tie_break(board)]
    return board.orderBy(*order).limit(top_n)


def metrics(board: DataFrame) -> DataFrame:
    """The four cards: keywords, viral rows, emerging rows, anomalies."""
    label = F.lower("trend_label")
    return board.agg(
        F.count_distinct("keyword").alias("total_keywords"),
        F.count_if(label == "viral").alias("viral"),
        F.count_if(label == "emerging").alias("emerging"),
        F.coalesce(F.sum("is_anomaly"), F.lit(0)).alias("anomalies"),
    )


def anomaly_alerts(board: DataFrame, top_n: int = 6) -> DataFrame:
    flagged = board.filter(F.col("is_anomaly") == 1)
    return flagged.orderBy(F.desc("z_score"), *_tie_break(board)).limit(top_n)


def top_by_max_frequency(board: DataFrame, top_n: int = 20) -> DataFrame:
    peaks = board.groupBy("keyword").agg(F.max("frequency").alias("max_frequency"))
    return peaks.orderBy(F.desc("max_frequency"), "keyword").limit(top_n)


def growth_leaderboard(board: DataFrame, top_n: int = 18) -> DataFrame:
    """The fastest growing rows, slowest of them first, with the sign of their growth."""
    known = board.select("keyword", "growth_rate", *[c for c in _tie_break(board) if c != "keyword"])
    known = known.dropna(subset=["keyword", "growth_rate"])
    top = known.orderBy(F.desc("growth_rate"), *_tie_break(board)).limit(top_n)
    sign = F.when(F.col("growth_rate") >= 0, F.lit("up")).otherwise(F.lit("down"))
    return top.withColumn("direction", sign).orderBy("growth_rate", *_tie_break(board))


def label_distribution(board: DataFrame) -> DataFrame:
    """Rows per label and their share; null labels are left out.

    The total is summed over the counted labels, whose exchange Spark reuses: the board is read
    once.
    """
    counts = (
        board.filter(F.col("trend_label").isNotNull())
        .groupBy("trend_label")
        .agg(F.count("*").alias("rows"))
    )
    total = counts.select(F.sum("rows")).scalar()
    return counts.withColumn("share", F.round(F.col("rows") / total, 6))


def timeline(board: DataFrame, keyword: str) -> DataFrame:
    """Time line of a keyword, anomalous points marked."""
    own = board.filter(F.col("keyword") == keyword)
    point = F.when(F.col("is_anomaly") == 1, F.col("frequency"))
    return own.select(*_tie_break(board), "frequency", point.alias("anomaly_frequency")).orderBy(
        "timestamp", *_tie_break(board)
    )


def bubbles(board: DataFrame, top_n: int = 30) -> DataFrame:
    """Complete rows with the highest frequency, with a mark size from their score."""
    shown = ["keyword", "growth_rate", "frequency", "z_score", "trend_label"]
    full = prepare(board).dropna(subset=shown)
    size = F.greatest(F.abs("z_score"), F.lit(0.5)) * 5 + 5
    top = full.orderBy(F.desc("frequency"), *_tie_break(full)).limit(top_n)
    return top.select(*shown, size.alias("bubble_size"))


def compare(board: DataFrame, first: str, second: str) -> DataFrame:
    """Both series in time order."""
    pair = board.filter(F.col("keyword").isin(first, second))
    return pair.orderBy("keyword", "timestamp", *_tie_break(board))


def compare_latest(board: DataFrame, first: str, second: str) -> DataFrame:
    """Latest frequency and growth of both; equal times go to the last window and source."""
    pair = board.filter(F.col("keyword").isin(first, second))
    at = F.struct(*[c for c in ("timestamp", "window", "source") if c in board.columns])
    return pair.groupBy("keyword").agg(
        F.max_by("frequency", at).alias("latest_frequency"),
        F.max_by("growth_rate", at).alias("latest_growth"),
    )


# Order and wording of the summary sentence.
SUMMARY = (
    ("viral", "exploding right now"),
    ("emerging", "gaining steady momentum"),
    ("stable", "consistent activity"),
    ("declining", "losing steam"),
)


# Title and explanation of each label for a single keyword.
EXPLAINED = {
    "viral": ("🔥 Viral", "Exploding right now — sharp spike in mentions"),
    "emerging": ("📈 Emerging", "Gaining momentum — steady growth building up"),
    "stable": ("➡️ Stable", "Consistent attention — steady baseline activity"),
    "declining": ("📉 Declining", "Losing steam — conversation is fading"),
}


def summary_text(board: DataFrame) -> DataFrame:
    """The snapshot in a sentence, with the counts it is made of."""
    counts = board.agg(
        F.count_distinct("keyword").alias("keywords"),
        *[F.count_if(F.lower("trend_label") == name).alias(name) for name, _ in SUMMARY],
        F.coalesce(F.sum("is_anomaly"), F.lit(0)).alias("anomalies"),
        F.count("*").alias("rows"),
    )

    def part(name: str, text: str) -> Column:
        n = F.col(name)
        noun = F.when(n > 1, F.lit(" trends")).otherwise(F.lit(" trend"))
        return F.when(n > 0, F.concat(n.cast("string"), F.lit(f" {name}"), noun, F.lit(f" - {text}")))

    told = F.concat_ws(
        " ",
        F.concat(F.lit("Tracking "), F.col("keywords").cast("string"), F.lit(" keywords in this snapshot.")),
        *[part(*entry) for entry in SUMMARY],
        F.when(
            F.col("anomalies") > 0,
            F.concat(
                F.col("anomalies").cast("string"),
                F.lit(" anomalies detected - unusual spikes worth investigating"),
            ),
        ),
    )
    empty = F.lit("No data available to summarize.")
    return counts.select(
        F.when(F.col("rows") > 0, told).otherwise(empty).alias("summary"),
        "keywords", *[name for name, _ in SUMMARY], "anomalies",
    )


def keyword_summary_text(board: DataFrame, keyword: str) -> DataFrame:
    """One keyword's latest row in words: label, what it means, counts; growth is a percentage of the
    stored fraction."""
    at = F.struct(*[c for c in ("timestamp", "window", "source") if c in board.columns])
    wanted = ("trend_label", "frequency", "growth_rate", "z_score", "is_anomaly")
    last = board.filter(F.col("keyword") == keyword).agg(
        F.max_by(F.struct(*wanted), at).alias("last"), F.count("*").alias("rows")
    )
    row = {c: F.col(f"last.{c}") for c in wanted}
    label = F.lower(row["trend_label"])
    known = [(label == name, title, text) for name, (title, text) in EXPLAINED.items()]
    titled = F.coalesce(*[F.when(fits, F.lit(title)) for fits, title, _ in known], label, F.lit("unknown"))
    told = F.concat_ws(
        " ",
        F.concat(F.lit(f"{keyword} is currently "), titled, F.lit(".")),
        F.coalesce(*[F.when(fits, F.lit(text)) for fits, _, text in known], F.lit("Unknown trend pattern")),
        F.concat(
            F.lit("Current frequency: "), row["frequency"].cast("string"), F.lit(" mentions | Growth: "),
            signed_percent(F.coalesce(row["growth_rate"], F.lit(0.0))),
        ),
        F.when(
            row["is_anomaly"] == 1,
            F.concat(F.lit("Alert: unusual spike (Z-score: "), F.format_string("%.2f", row["z_score"]), F.lit(")")),
        ),
    )
    missing = F.lit(f"No data found for '{keyword}'.")
    return last.select(
        F.lit(keyword).alias("keyword"),
        F.when(F.col("rows") > 0, told).otherwise(missing).alias("summary"),
    )


def related_by_label(board: DataFrame, keyword: str, k: int = 6) -> DataFrame:
    """Up to k other keywords that share the keyword's latest label, most mentioned first."""
    at = F.struct(*[c for c in ("timestamp", "window", "source") if c in board.columns])
    own = board.filter(F.col("keyword") == keyword).select(F.max_by("trend_label", at)).scalar()
    others = board.filter((F.col("keyword") != keyword) & (F.col("trend_label") == own))
    peaks = others.groupBy("keyword", "trend_label").agg(F.max("frequency").alias("frequency"))
    return peaks.orderBy(F.desc("frequency"), "keyword").limit(k)


def related_in_texts(words_per_doc: DataFrame, keyword: str, k: int = 6) -> DataFrame:
    """The k keywords found in most documents together with the given one, from one row per
    document with its `words`.

    A row tells by itself whether it holds the keyword, so there is no join and no pair of words
    is ever built: the only exchange carries counts per word.
    """
    holding = words_per_doc.filter(F.array_contains("words", keyword))
    others = holding.select(F.explode(F.array_distinct("words")).alias("keyword"))
    counts = (
        others.filter((F.col("keyword") != keyword) & is_token(F.col("keyword")))
        .groupBy("keyword")
        .agg(F.count("*").alias("documents"))
    )
    return counts.orderBy(F.desc("documents"), "keyword").limit(k)


def related_by_documents(doc_keywords: DataFrame, keyword: str, k: int = 6) -> DataFrame:
    """The same from (id, keyword) rows: documents of the one keyword joined to their words."""
    holders = doc_keywords.filter(F.col("keyword") == keyword).select("id").distinct()
    others = doc_keywords.join(holders, "id", "left_semi").filter(F.col("keyword") != keyword)
    counts = others.groupBy("keyword").agg(F.count_distinct("id").alias("documents"))
    return counts.orderBy(F.desc("documents"), "keyword").limit(k)


def distinct_labels(board: DataFrame) -> DataFrame:
    return board.filter(F.col("trend_label").isNotNull()).select(_plain().alias("trend_label")).distinct()


def latest_per_keyword(board: DataFrame) -> DataFrame:
    """Each keyword's newest row. Combined before the shuffle, so a keyword with very many rows leaves each task
    as one; the rows hold text, so Spark sorts them by keyword on both sides."""
    rest = [c for c in board.columns if c != "keyword"]
    at = F.struct(*[c for c in ("timestamp", "window", "source") if c in board.columns])
    last = board.groupBy("keyword").agg(F.max_by(F.struct(*rest), at).alias("last"))
    return last.select("keyword", *[F.col(f"last.`{c}`").alias(c) for c in rest])


def signed_percent(fraction: Column) -> Column:
    """A fraction as a signed percentage with one decimal."""
    scaled = F.round(fraction * 100, 1)
    sign = F.when(scaled >= 0, F.lit("+")).otherwise(F.lit(""))
    shown = F.concat(sign, F.format_string("%.1f", scaled), F.lit("%"))
    return F.when(scaled.isNotNull(), shown)


def display(board: DataFrame) -> DataFrame:
    """Ranking rows as shown: signed percent growth, two-decimal score, Yes/No anomaly."""
    dash, z = F.lit("-"), F.round("z_score", 2)
    return board.select(
        "keyword",
        "trend_label",
        "frequency",
        F.coalesce(signed_percent(F.col("growth_rate")), dash).alias("growth"),
        F.when(z.isNotNull(), F.format_string("%.2f", z)).otherwise(dash).alias("z"),
        F.when(F.col("is_anomaly") == 1, F.lit("Yes")).otherwise(F.lit("No")).alias("anomaly"),
    )


def facets(board: DataFrame, columns: Sequence[str]) -> DataFrame:
    """Choices of the filter controls: distinct non-null values per column, in one pass."""
    entries = F.array(
        *[F.struct(F.lit(c).alias("facet"), F.col(c).cast("string").alias("value")) for c in columns]
    )
    rows = board.select(F.inline(entries)).filter(F.col("value").isNotNull())
    return rows.distinct().orderBy("facet", "value")


def limits(board: DataFrame) -> DataFrame:
    """Upper ends of the frequency and growth sliders."""
    return board.agg(
        F.max("frequency").alias("max_frequency"), F.max("growth_rate").alias("max_growth")
    )


def dataset_status(datasets: dict[str, tuple[DataFrame, str]]) -> DataFrame:
    """Latest time and row count per stored dataset, given as name -> (table, time column)."""
    parts = [
        df.agg(F.max(time).alias("latest"), F.count("*").alias("rows")).select(
            F.lit(name).alias("dataset"), "latest", "rows"
        )
        for name, (df, time) in datasets.items()
    ]
    return reduce(DataFrame.unionByName, parts)
