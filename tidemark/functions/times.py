"""Window labels and lenient timestamp parsing."""

from __future__ import annotations

from datetime import timedelta

from pyspark.sql import Column
from pyspark.sql import functions as F

# Unit letters of a window label, and the written forms of a post's time.
UNITS = {"s": "seconds", "m": "minutes", "h": "hours", "d": "days"}
TIME_FORMS = ("yyyy-MM-dd'T'HH:mm:ssX", "yyyy-MM-dd'T'HH:mm:ssXXX", "yyyy-MM-dd HH:mm:ss")

ISO_OUT = "yyyy-MM-dd'T'HH:mm:ss'Z'"


def window_seconds(label: str) -> int:
    """Length of a window label, a whole number above 0 and a unit letter such as `6h`, in seconds."""
    number, unit = label.strip().lower()[:-1], UNITS.get(label.strip().lower()[-1:])
    if unit is None or not (number.isascii() and number.isdigit()) or int(number) == 0:
        raise ValueError(f"{label!r} is no window label: a number above 0, then one of {', '.join(UNITS)}")
    return timedelta(**{unit: int(number)}) // timedelta(seconds=1)


def slide_seconds(label: str, fraction: float = 1.0) -> int:
    """Whole seconds between window starts, a share of the length; shares below a second count as one."""
    return max(1, int(window_seconds(label) * fraction))


def bucket_start(epoch_seconds: Column, seconds: int) -> Column:
    """Start of the epoch-aligned bucket of a bigint time, also before 1970."""
    return epoch_seconds - F.pmod(epoch_seconds, F.lit(seconds))


def parse_timestamp(raw: Column) -> Column:
    """ISO with zone, `yyyy-MM-dd HH:mm:ss` or epoch seconds as text; anything else is null."""
    written = [F.try_to_timestamp(raw, F.lit(form)) for form in TIME_FORMS]
    return F.coalesce(*written, F.timestamp_seconds(F.trim(raw).try_cast("bigint")))


def parse_feed_date(raw: Column, to_utc: bool = False) -> Column:
    """Feed dates to `yyyy-MM-ddTHH:mm:ssZ` text.

    RFC 2822 dates and bare `yyyy-MM-dd` days are rewritten, other text passes unchanged, null
    and empty text become empty. By default the wall-clock fields of the date are kept and its
    offset is dropped; `to_utc` converts RFC 2822 and ISO dates with an offset to UTC instead.
    """
    # Weekday names are optional and have no parser pattern: drop them first.
    bare = F.regexp_replace(raw, r"^[A-Za-z]{3},\s*", "")
    day = F.try_to_timestamp(raw, F.lit("yyyy-MM-dd"))
    if to_utc:
        moments = [
            F.try_to_timestamp(bare, F.lit("d MMM yyyy HH:mm:ss xx")),
            F.try_to_timestamp(bare, F.lit("d MMM yyyy HH:mm:ss z")),
            F.try_to_timestamp(raw, F.lit("yyyy-MM-dd'T'HH:mm:ssX")),
            F.try_to_timestamp(raw, F.lit("yyyy-MM-dd'T'HH:mm:ssXXX")),
            day,
        ]
    else:
        wall = F.regexp_extract(bare, r"^(\d{1,2} [A-Za-z]{3} \d{4} \d{2}:\d{2}:\d{2}) \S+$", 1)
        moments = [F.try_to_timestamp(wall, F.lit("d MMM yyyy HH:mm:ss")), day]
    return F.when(raw.isNull() | (raw == ""), F.lit("")).otherwise(
        F.coalesce(F.date_format(F.coalesce(*moments), ISO_OUT), raw)
    )
