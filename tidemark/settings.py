"""Defaults of the engine, as plain values that every operator takes as parameters."""

from __future__ import annotations

# Windows, thresholds and word lists the results depend on.
WINDOWS = ("1h", "6h", "24h", "7d")
ALL_SOURCES = "__all__"
EPSILON = 1.0
ANOMALY_Z = 2.5
VIRAL_Z = 3.0
VIRAL_WINDOW = "1h"
EMERGING_Z = 2.0
DECLINING_GROWTH = -0.5
MIN_TOKEN_LENGTH = 3
TOP_KEYWORDS = 500
TOP_FORECAST_KEYWORDS = 20
FORECAST_HOURS = 24
FORECAST_HISTORY = 12
MIN_DOC_FREQ = 2
TFIDF_DIMENSIONS = 2 ** 18
MAX_NULL_FRACTION = 0.3

STOPWORDS = (
    "a", "an", "and", "are", "as", "at", "be", "but", "by", "for", "from", "has", "have",
    "if", "in", "is", "it", "its", "of", "on", "or", "that", "the", "their", "this", "to",
    "was", "were", "will", "with",
)
EXTRA_STOPWORDS = ("http", "https", "amp", "rt", "via")

ANOMALY_FEATURES = (
    "freq_1h", "freq_6h", "growth_rate_1h", "growth_rate_24h", "z_score_1h",
)

# Scores are rounded before they meet a threshold, so a label never hangs on the last bits
# of a mean or deviation (which depend on the order in which partitions are merged).
SCORE_DIGITS = 9
FLAT_SIGMA = 1e-12
