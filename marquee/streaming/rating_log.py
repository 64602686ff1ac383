"""Stateless streams: log lines to rating messages to ratings."""

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from marquee.functions import scalars as S


def rating_messages(lines: DataFrame) -> DataFrame:
    """``value`` of every log line that carries a rating, reduced to the rating message."""
    return lines.filter(S.has_rating("value")).select(S.rating_payload("value").alias("value"))


def parse_messages(messages: DataFrame) -> DataFrame:
    """Ratings of the messages that parse."""
    return messages.select(S.message_fields("value").alias("r")).filter("r is not null").select("r.*")


def bad_messages(messages: DataFrame) -> DataFrame:
    """Messages that do not parse, for a quarantine table."""
    return messages.filter(S.message_fields("value").isNull())


def ratings_from_log(lines: DataFrame) -> DataFrame:
    return parse_messages(rating_messages(lines))


def without_replays(events: DataFrame, key, event_time, delay) -> DataFrame:
    """Drops events whose ``key`` was already seen within ``delay``, for sources that replay."""
    return events.withWatermark(event_time, delay).dropDuplicatesWithinWatermark([key])
