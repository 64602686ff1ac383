"""Real-time list of a user after a rating: candidates, recent ratings, priority scores."""

from pyspark.sql import DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from marquee.functions.scalars import rounded
from marquee.operators.similarity import SimilarItems, unseen_neighbours

HISTORY_KEPT = 40
HISTORY_READ = 20
CANDIDATES = 20
MIN_SIMILARITY = 0.7
LIKED = 3.0
# Makes every 32-bit mid non-negative.
MID_OFFSET = 1 << 31


def recent_ratings(ratings: DataFrame, n=HISTORY_READ) -> DataFrame:
    """(uid, position, mid, score): newest ``n`` ratings of each user, a re-rated movie repeats.

    Rows equal in time, movie and score are interchangeable.
    """
    order = [F.desc(c) for c in ("timestamp", "mid", "score")]
    return (
        ratings.withColumn("position", F.row_number().over(W.partitionBy("uid").orderBy(*order)))
        .filter(F.col("position") <= n)
        .select("uid", "position", "mid", "score")
    )


def last_events(ratings: DataFrame) -> DataFrame:
    """(uid, mid): newest rating of each user, ties to the greater mid.

    Time and mid travel as one long, whose maximum is a hash aggregate without sorting.
    """
    packed = F.shiftleft(F.col("timestamp").cast("long"), 32) + F.col("mid") + F.lit(MID_OFFSET)
    newest = ratings.groupBy("uid").agg(F.max(packed).alias("newest"))
    mid = F.col("newest").bitwiseAND(F.lit((1 << 32) - 1)) - F.lit(MID_OFFSET)
    return newest.select("uid", mid.cast("int").alias("mid"))


def priority_scores(
    index: SimilarItems, candidates: DataFrame, recent: DataFrame, mode="counted",
    min_similarity=MIN_SIMILARITY,
) -> DataFrame:
    """(uid, mid, score): priority of each candidate of a user.

    ``candidates`` holds (uid, candidate, candidate_pid), ``recent`` the recent ratings. The score
    is the mean of similarity x rating over the recent ratings more similar than
    ``min_similarity``, plus log10 of the number of liked ones (at least 1), minus log10 of the number
    of the others (at least 1). With ``mode="legacy"`` the last term counts 1 plus the liked ones
    newer than the oldest disliked one. Candidates without a similar recent rating are dropped.
    """
    recent = recent.join(
        index.members.select("mid", F.col("pid").alias("recent_pid")), "mid"
    ).select("uid", "position", F.col("mid").alias("recent"), "score", "recent_pid")
    similarity = index.pairs.select(
        F.col("pid").alias("candidate_pid"), F.col("other").alias("recent_pid"),
        F.col("score").alias("similarity"),
    )
    matched = (
        candidates.select("uid", "candidate", "candidate_pid").distinct()
        .join(recent, "uid")
        .filter(F.col("candidate") != F.col("recent"))
        .join(similarity, ["candidate_pid", "recent_pid"])
        .filter(F.col("similarity") > min_similarity)
    )
    liked = F.col("score") > LIKED
    sums = [
        F.avg(F.col("similarity") * F.col("score")).alias("base"),
        F.count_if(liked).alias("up"),
        F.count_if(~liked).alias("down"),
    ]
    if mode == "legacy":
        # At most HISTORY_READ positions per group.
        sums.append(F.collect_list(F.when(liked, F.col("position"))).alias("liked_at"))
        sums.append(F.max(F.when(~liked, F.col("position"))).alias("last_down"))
    totals = matched.groupBy("uid", "candidate").agg(*sums)
    if mode == "legacy":
        newer = F.size(F.filter("liked_at", lambda p: p < F.col("last_down")))
        down = F.when(F.col("last_down").isNull(), F.lit(1)).otherwise(newer + 1)
    else:
        down = F.greatest("down", F.lit(1))
    score = F.col("base") + F.log10(F.greatest("up", F.lit(1))) - F.log10(down)
    return totals.select("uid", F.col("candidate").alias("mid"), rounded(score).alias("score"))


def user_lists(events: DataFrame, scores: DataFrame) -> DataFrame:
    """(uid, recs) for every user of ``events``; a user without scores gets an empty list."""
    item = F.struct((-F.col("score")).alias("k"), "mid", "score")
    lists = scores.groupBy("uid").agg(F.array_sort(F.collect_list(item)).alias("items"))
    recs = F.transform("items", lambda r: F.struct(r.mid.alias("mid"), r.score.alias("score")))
    nothing = F.array().cast("array<struct<mid:int,score:double>>")
    return events.select("uid").distinct().join(lists, "uid", "left").select(
        "uid", F.coalesce(recs, nothing).alias("recs")
    )


def live_lists(index: SimilarItems, events, seen, recent, mode="counted", n=CANDIDATES) -> DataFrame:
    """(uid, recs) after one event (uid, mid) per user."""
    candidates = unseen_neighbours(index, events, seen, n)
    return user_lists(events, priority_scores(index, candidates, recent, mode))


def latest_lists(results: DataFrame, key="uid", batch="batch_id", keep_batch=False) -> DataFrame:
    """The row of the newest batch per key: the read side of an append-only upsert."""
    number = [F.max(batch).alias(batch)] if keep_batch else []
    return results.groupBy(key).agg(F.max_by("recs", batch).alias("recs"), *number)
