"""Batch updates of stored tables: upserts, appends, deletes.

Each takes the current table and a table of changes and returns the new table. Changes are
reduced to one row per key first; the current table is the streamed side of a left join,
which Spark can split when one key is hot.
"""

from pyspark.sql import DataFrame
from pyspark.sql import functions as F


def last_per_key(rows: DataFrame, keys, order, values) -> DataFrame:
    """One row per key: ``values`` of the row with the greatest ``order`` columns."""
    order = [F.col(o) if isinstance(o, str) else o for o in order]
    return rows.groupBy(*keys).agg(
        F.max_by(F.struct(*values), F.struct(*order, *values)).alias("last")
    ).select(*keys, "last.*")


def upsert_ratings(ratings: DataFrame, updates: DataFrame) -> DataFrame:
    """Ratings after ``updates``: a known (uid, mid) takes the new score and keeps its timestamp."""
    keys = ["uid", "mid"]
    last = last_per_key(updates, keys, ["timestamp"], ["score", "timestamp"])
    changed = ratings.join(
        last.select(*keys, F.col("score").alias("new_score")), keys, "left"
    ).select(*keys, F.coalesce("new_score", "score").alias("score"), "timestamp")
    # Only keys of the updates are made distinct, so a small batch needs no shuffle of the table.
    known = ratings.select(*keys).join(last.select(*keys), keys, "left_semi").distinct()
    inserted = last.join(known, keys, "left_anti")
    return changed.unionByName(inserted.select(*changed.columns))


def applied_clicks(clicks: DataFrame, updates: DataFrame) -> DataFrame:
    """The newest click (uid, mid, timestamp) that ``upsert_ratings`` has applied to each rating, after ``updates``."""
    columns = ["uid", "mid", "timestamp"]
    both = clicks.select(*columns).unionByName(updates.select(*columns))
    return both.groupBy("uid", "mid").agg(F.max("timestamp").alias("timestamp"))


def append_tags(documents: DataFrame, new_tags: DataFrame, order) -> DataFrame:
    """Search documents after ``new_tags``: each tag is appended to the ``tags`` text in order.

    ``order`` names the columns that order the events of a movie; the first is an epoch. The
    texts are built per hour and then chained, so the events of one movie are gathered in
    many tasks and only finished pieces meet in the row that holds the document.
    """
    pieces = new_tags.withColumn("hour", F.floor(F.col(order[0]) / 3600)).groupBy("mid", "hour").agg(
        F.array_sort(F.collect_list(F.struct(*order, "tag"))).alias("events")
    ).select("mid", "hour", F.array_join(F.col("events.tag"), "|").alias("piece"))
    added = pieces.groupBy("mid").agg(
        F.array_sort(F.collect_list(F.struct("hour", "piece"))).alias("pieces")
    ).select("mid", F.array_join(F.col("pieces.piece"), "|").alias("added"))
    # concat_ws skips nulls: a document without tags starts with the first new one.
    return documents.join(added, "mid", "left").withColumn(
        "tags",
        F.when(F.col("added").isNull(), F.col("tags")).otherwise(F.concat_ws("|", "tags", "added")),
    ).drop("added")


def delete_by_key(rows: DataFrame, doomed: DataFrame, keys) -> DataFrame:
    """Rows whose key is not in ``doomed``."""
    return rows.join(doomed.select(*keys).distinct(), list(keys), "left_anti")


def update_preferences(users: DataFrame, prefs: DataFrame) -> DataFrame:
    """Users after ``prefs`` (username, genres, timestamp).

    The comma-separated genres of a user's requests are appended in time order, and the
    ``first`` flag is cleared.
    """
    asked = prefs.groupBy("username").agg(
        F.array_sort(F.collect_list(F.struct("timestamp", "genres"))).alias("asked")
    ).select(
        "username",
        F.flatten(F.transform("asked", lambda a: F.split(a.genres, ","))).alias("wanted"),
    )
    told = F.col("wanted").isNotNull()
    return users.join(asked, "username", "left").select(
        "uid", "username",
        F.when(told, F.lit(False)).otherwise(F.col("first")).alias("first"),
        "timestamp",
        F.when(told, F.concat("prefGenres", "wanted")).otherwise(F.col("prefGenres")).alias("prefGenres"),
    )


def exists_flag(rows: DataFrame, known: DataFrame, keys) -> DataFrame:
    """``rows`` with a column telling whether the key occurs in ``known``."""
    marked = known.select(*keys).distinct().withColumn("hit", F.lit(True))
    return rows.join(marked, list(keys), "left").withColumn(
        "found", F.coalesce("hit", F.lit(False))
    ).drop("hit")
