"""Batch forms of the write requests: rating clicks, tags, preferences."""

from pyspark.sql import DataFrame

from marquee.functions import scalars as S
from marquee.operators.merges import applied_clicks, upsert_ratings
from marquee.session import written
from marquee.sources.tables import TableStore


def scored_clicks(clicks: DataFrame, unit=None) -> DataFrame:
    """Star clicks (uid, mid, stars, timestamp) as ratings; ``unit`` is that of the time."""
    return clicks.select(
        "uid", "mid", S.stars_to_score("stars").alias("score"),
        S.as_epoch_seconds("timestamp", unit).alias("timestamp"),
    )


def ingest_ratings(clicks: DataFrame, ratings: DataFrame):
    """(new rating table, history rows, log lines) after a batch of star clicks."""
    scored = scored_clicks(clicks)
    lines = scored.select(S.rating_log_line("uid", "mid", "score", "timestamp").alias("value"))
    return upsert_ratings(ratings, scored), scored, lines


def store_ratings(store: TableStore, scored: DataFrame):
    """Applies scored clicks (uid, mid, score, timestamp) to Rating and keeps their times in RatingClicks.

    Only the buckets of the clicks' users are read and replaced; the same clicks again change nothing. The
    clicks are stored first: until Rating follows, the live job counts them by the events it has.
    """
    scored = written(scored, "scored-clicks")
    store.update("RatingClicks", scored, lambda known: applied_clicks(known, scored))
    return store.update("Rating", scored, lambda known: upsert_ratings(known, scored))
