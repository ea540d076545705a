"""User-supplied trend and forecast tables."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tidemark.functions.numbers import loose_double, loose_flag
from tidemark.operators.quality import require_columns

# Spellings of labels users write.
LABEL_SYNONYMS = {
    "trending": "viral",
    "hot": "viral",
    "growing": "emerging",
    "rising": "emerging",
    "normal": "stable",
    "flat": "stable",
    "dropping": "declining",
    "falling": "declining",
    "nan": "stable",
    "": "stable",
}
NUMERIC = ("frequency", "growth_rate", "z_score")


def tidy_names(df: DataFrame) -> DataFrame:
    return df.toDF(*[c.lower().strip() for c in df.columns])


def clean_numbers(df: DataFrame) -> DataFrame:
    """Written numbers to doubles and the anomaly flag to an int, unreadable ones to 0."""
    cleaned = {c: loose_double(F.col(c)) for c in NUMERIC if c in df.columns}
    if "is_anomaly" in df.columns:
        cleaned["is_anomaly"] = loose_flag(F.col("is_anomaly"))
    return df.withColumns(cleaned)


def fill_defaults(df: DataFrame, loaded_at: Column) -> DataFrame:
    """Add the optional columns that are absent; unreadable times become the load time."""
    defaults = {
        "growth_rate": F.lit(0.0),
        "z_score": F.lit(0.0),
        "is_anomaly": F.lit(0),
        "trend_label": F.lit("stable"),
    }
    added = {c: v for c, v in defaults.items() if c not in df.columns}
    if "timestamp" in df.columns:
        text = F.col("timestamp").cast("string")
        parsed = F.coalesce(F.try_to_timestamp(text), loaded_at)
    else:
        parsed = loaded_at
    return df.withColumns({**added, "timestamp": parsed})


def label(raw: Column) -> Column:
    """Lower-case label with synonyms resolved; null is stable."""
    plain = F.trim(F.lower(F.coalesce(raw.cast("string"), F.lit("stable"))))
    pairs = [F.lit(x) for pair in LABEL_SYNONYMS.items() for x in pair]
    return F.coalesce(F.try_element_at(F.create_map(*pairs), plain), plain)


def map_labels(df: DataFrame) -> DataFrame:
    return df.withColumn("trend_label", label(F.col("trend_label")))


def load_trends(df: DataFrame, loaded_at: Column) -> DataFrame:
    """An uploaded trend table, ready for the board. `keyword` and `frequency` are required."""
    named = tidy_names(df)
    require_columns(named, ["keyword", "frequency"])
    return map_labels(fill_defaults(clean_numbers(named), loaded_at))


def manual_keywords(texts: DataFrame, column: str, entered_at: Column) -> DataFrame:
    """One trend row per non-blank line of the entered texts."""
    lines = texts.select(F.explode(F.split(column, "\n")).alias("line"))
    keyword = F.regexp_replace("line", r"^\s+|\s+$", "")
    return lines.select(keyword.alias("keyword")).filter(F.col("keyword") != "").select(
        "keyword",
        F.lit(1).alias("frequency"),
        F.lit(0.0).alias("growth_rate"),
        F.lit(0.0).alias("z_score"),
        F.lit(0).alias("is_anomaly"),
        F.lit("stable").alias("trend_label"),
        entered_at.alias("timestamp"),
    )


def load_predictions(df: DataFrame, loaded_at: Column) -> DataFrame:
    """An uploaded forecast table with absent columns filled in."""
    named = tidy_names(df)
    require_columns(named, ["keyword", "predicted_freq"])
    predicted = F.col("predicted_freq")
    defaults = {
        "predicted_at": loaded_at,
        "forecast_period": F.lit("24h"),
        "trend_class": F.lit("stable"),
        "confidence": F.lit(0.5),
        "lower_bound": predicted * 0.8,
        "upper_bound": predicted * 1.2,
    }
    return named.withColumns({c: v for c, v in defaults.items() if c not in named.columns})
