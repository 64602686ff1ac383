"""Streams, run to the end of what is there and read back as tables."""

from pyspark.sql import functions as F

from marquee.checks import check
from marquee.checks.similar import content_index
from marquee.checks.sql import query
from marquee.operators.online import HISTORY_READ
from marquee.operators.statistics import spread_recs
from marquee.session import scratch
from marquee.sources import sample, streams
from marquee.streaming import history, rating_log
from marquee.streaming.live import LiveLists

CHUNKS = 3


def _event_stream(spark, folder):
    """The events table as a stream, and the movie key of an event."""
    events = sample.table(spark, folder, "events")
    n = sample.table(spark, folder, "part").count()
    stream = streams.table_folder_source(spark, folder, events.schema, glob="events.parquet")
    return stream, (F.col("event_id") % n).cast("int")


def _drain(spark, rows, label):
    """Run an append stream into a folder and read the folder."""
    path = scratch(spark, label)
    streams.run_available(streams.folder_sink(rows, f"{path}/out", f"{path}/checkpoint"))
    return spark.read.schema(rows.schema).parquet(f"{path}/out")


@check("stream_log_filter", query(
    "SELECT trim(split_part(value, 'MOVIE_RATING_PREFIX:', 2)) AS value FROM log_lines WHERE contains(value, 'MOVIE_RATING_PREFIX:')"
))
def stream_log_filter(spark, folder):
    events, mid = _event_stream(spark, folder)
    return _drain(spark, rating_log.rating_messages(sample.as_log_lines(events, mid)), "messages")


@check("stream_ratings", query("SELECT uid, mid, score, \"timestamp\" FROM stream_ratings"))
def stream_ratings(spark, folder):
    events, mid = _event_stream(spark, folder)
    return _drain(spark, rating_log.ratings_from_log(sample.as_log_lines(events, mid)), "ratings")


@check("stream_log_files", query(
    "SELECT 'logProcessor' AS key, trim(split_part(value, 'MOVIE_RATING_PREFIX:', 2)) AS value FROM log_lines WHERE contains(value, 'MOVIE_RATING_PREFIX:')"
))
def stream_log_files(spark, folder):
    """Log files that appear in a folder, filtered to keyed messages."""
    logs = scratch(spark, "log-files")
    sample.log_lines(spark, folder).select("value").write.text(logs)
    lines = streams.log_folder_source(spark, logs)
    return _drain(spark, streams.keyed(rating_log.rating_messages(lines)), "messages")


def log_arrivals(spark, folder):
    """Writes the log to a folder chunk by chunk in event order; yields after each chunk."""
    logs = scratch(spark, "log-files")
    lines = sample.log_lines(spark, folder)
    last = lines.agg(F.max("event_id")).first()[0]
    step = last // CHUNKS + 1

    def arrivals():
        for at in range(CHUNKS):
            chunk = lines.filter((F.col("event_id") >= at * step) & (F.col("event_id") < (at + 1) * step))
            chunk.select("value").write.mode("append").text(logs)
            yield at

    return logs, arrivals


def run_live(spark, folder, index=None):
    """The real-time job over a log that arrives in chunks; returns its handler."""
    index = index or content_index(spark, folder)
    root = scratch(spark, "live")
    handler = LiveLists(spark, root, lambda: index)
    logs, arrivals = log_arrivals(spark, folder)
    for _ in arrivals():
        ratings = rating_log.ratings_from_log(streams.log_folder_source(spark, logs))
        streams.run_available(handler.writer(ratings, f"{root}/checkpoint"))
    return handler


@check("stream_recs", query("SELECT uid, rank, mid, score FROM stream_ranked"))
def stream_recs(spark, folder):
    return spread_recs(run_live(spark, folder).latest(), "uid")


@check("stream_recs_latest", query(
    "SELECT r.uid, CAST(count(s.mid) AS INT) AS n FROM stream_last r LEFT JOIN stream_ranked s ON s.uid = r.uid GROUP BY r.uid"
))
def stream_recs_latest(spark, folder):
    """One row per user, users with an empty list included."""
    return run_live(spark, folder).latest().select("uid", F.size("recs").alias("n"))


@check("stream_recent_ratings", query("SELECT uid, position, mid, score FROM stream_recent"))
def stream_recent_ratings(spark, folder):
    """Recent ratings as streaming state; the newest version of each user is read back."""
    path = scratch(spark, "recent")
    logs, arrivals = log_arrivals(spark, folder)

    def keep(rows, batch_id):
        rows.write.mode("overwrite").parquet(f"{path}/out/batch_id={batch_id}")

    for _ in arrivals():
        ratings = rating_log.ratings_from_log(streams.log_folder_source(spark, logs))
        recent = history.recent_ratings_stream(ratings)
        writer = recent.writeStream.outputMode("update").foreachBatch(keep)
        streams.run_available(writer.option("checkpointLocation", f"{path}/checkpoint"))
    rows = spark.read.schema(f"{history.OUTPUT}, batch_id long").parquet(f"{path}/out")
    newest = rows.groupBy("uid").agg(F.max("version").alias("version"))
    return rows.join(newest, ["uid", "version"]).filter(F.col("position") <= HISTORY_READ).select(
        "uid", "position", "mid", "score"
    )


