"""Lenient ISO-8601 parsing: a bad text gives NULL, never an error and never today's date."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

ISO_SHAPE = (
    r"^\d{4}-\d{2}-\d{2}"
    r"(T\d{2}:\d{2}(:\d{2}(\.\d+)?)?(Z|[+-]\d{2}:?\d{2})?)?$"
)
# The cast wants seconds before a zone; ISO does not.
MINUTES_THEN_ZONE = r"(T\d{2}:\d{2})(Z|[+-]\d{2}:?\d{2})$"
DATE_ONLY = r"^(\d{4}-\d{2}-\d{2})$"
NO_ZONE = r"(T\d{2}:\d{2}(:\d{2}(\.\d+)?)?)$"


def parse_iso8601(text: Column) -> Column:
    """Timestamp in milliseconds from a calendar date or date-time text, else NULL.

    The cast alone also takes ``2026-08-12 10:00`` and bare times, hence the shape test. Week and
    ordinal dates give NULL. A text without a zone is in UTC, whatever the session's zone.
    """
    zoned = F.regexp_replace(F.regexp_replace(text, DATE_ONLY, "$1T00:00:00Z"), NO_ZONE, "$1Z")
    full = F.regexp_replace(zoned, MINUTES_THEN_ZONE, "$1:00$2")
    return F.when(text.rlike(ISO_SHAPE), F.date_trunc("millisecond", full.try_cast("timestamp")))
