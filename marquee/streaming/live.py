"""The real-time job: every micro-batch of ratings refreshes the lists of its users."""

from pyspark.sql import DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from marquee import schemas
from marquee.operators.online import HISTORY_READ, last_events, latest_lists, live_lists, recent_ratings
from marquee.sources.tables import TableStore, bucket_of

TRIGGER = "2 seconds"
HISTORY = "uid int, mid int, score double, timestamp int, bucket int, batch_id long"
EVENT = ["uid", "mid", "timestamp"]
LISTS = "uid int, recs array<struct<mid:int,score:double>>, batch_id long"


def once(events: DataFrame) -> DataFrame:
    """One rating per event; of different scores the greatest."""
    return events.groupBy(*EVENT).agg(F.max("score").alias("score")).select(*schemas.RATING.names)


class LiveLists:
    """Writes, per micro-batch, the batch's ratings and the new list of each of its users.

    Both tables are folders with one subfolder per batch that a replay overwrites, so processing
    a batch twice changes nothing. ``load_index`` and ``load_ratings`` are called for each batch:
    a similarity table or rating table that was replaced in between takes effect. The history is
    laid out in ``buckets`` of users; a batch reads those of its own users. More buckets suit a longer
    history with smaller batches. With ``load_buckets`` the functions ``load_ratings`` and ``load_clicks`` get the
    numbers of the batch's buckets, or None for all, and may leave out the rows of others. ``load_clicks`` gives the clicks that the ingest has applied to the stored ratings
    (uid, mid, timestamp), which tell that a stored rating and an event are one. Every ``compact_every`` batches the older batches are merged, so that
    the number of folders and files stays bounded however long the job runs.
    """

    def __init__(self, spark, root, load_index, load_ratings=None, mode="counted", buckets=16, compact_every=500,
                 load_clicks=None, load_buckets=False):
        self.spark = spark
        self.root = root.rstrip("/")
        self.load_index = load_index
        self.load_ratings = load_ratings
        self.load_clicks = load_clicks
        self.load_buckets = load_buckets
        self.mode = mode
        self.buckets = buckets
        self.compact_every = compact_every
        # Version n of a merged table holds the batches below n. A reader may still use the one before.
        self.merged = TableStore(spark, f"{self.root}/merged", keep=2)

    @property
    def history_path(self):
        return f"{self.root}/history"

    @property
    def lists_path(self):
        return f"{self.root}/lists"

    def _batches(self, name, path, schema) -> DataFrame:
        """All rows written so far: the merged batches and the later ones."""
        rows = self.spark.read.schema(schema).parquet(path)
        done = self.merged.versions(name)
        if not done:
            return rows
        later = rows.filter(F.col("batch_id") >= done[-1])
        return later.unionByName(self.merged.read(name, rows.schema))

    def compact(self, below):
        """Merges all batches below ``below``, which must be finished; repeating it changes nothing.

        Batch folders that an earlier merge covers go. A merge that dies is not seen by readers.
        """
        done = self.merged.versions("history")
        if below not in done:
            rows = self._batches("history", self.history_path, HISTORY).filter(F.col("batch_id") < below)
            # A bucket of any size is split over tasks.
            self.merged.overwrite("history", rows.hint("rebalance", "bucket"), ("bucket",), version=below)
        if below not in self.merged.versions("lists"):
            rows = self._batches("lists", self.lists_path, LISTS).filter(F.col("batch_id") < below)
            self.merged.overwrite("lists", latest_lists(rows, keep_batch=True), version=below)
        earlier = [v for v in done if v < below]
        if earlier:
            for path in (self.history_path, self.lists_path):
                for old in self.merged.names(path):
                    number = old.partition("batch_id=")[2]
                    if number and int(number) < earlier[-1]:
                        self.merged.remove(f"{path}/{old}")

    def history(self, before=None, buckets=None, users=None) -> DataFrame:
        """Ratings written so far, plus the stored ratings when there are any.

        ``buckets`` limits the files that are read to those of some user buckets, ``users`` (uid) the
        rows. An event is known by user, movie and the time of its click, and counts once, however often
        it arrives and whether or not the rating ingest has stored it meanwhile: a stored rating that took its
        score from a click is that click, whatever time the table keeps for it.
        """
        of_users = lambda rows: rows if users is None else rows.join(users, "uid", "left_semi")
        rows = self._batches("history", self.history_path, HISTORY)
        if before is not None:
            rows = rows.filter(F.col("batch_id") <= before)
        if buckets is not None:
            rows = rows.filter(F.col("bucket").isin(buckets))
        rows = once(of_users(rows))
        if self.load_ratings is None:
            return rows
        wanted = (buckets,) if self.load_buckets else ()
        stored = of_users(self.load_ratings(*wanted).select(*schemas.RATING.names))
        if self.load_clicks is not None:
            clicks = of_users(self.load_clicks(*wanted)).select(
                "uid", "mid", F.col("timestamp").alias("clicked"), F.lit(True).alias("hit"))
            # One left join and no union: the ratings, the largest table, are read once. What was clicked is cut as in ``once``.
            place = F.row_number().over(W.partitionBy(*EVENT, "hit").orderBy(F.desc("score")))
            stored = stored.join(clicks, ["uid", "mid"], "left").withColumn(
                "timestamp", F.when(F.col("hit"), F.col("clicked")).otherwise(F.col("timestamp"))
            ).withColumn("place", place).filter(F.col("hit").isNull() | (F.col("place") == 1)).select(*schemas.RATING.names)
        return rows.unionByName(stored.join(rows, EVENT, "left_anti"))

    def _held(self, rows, name, batch_id):
        """``rows`` as a table of this batch, which has the files that its rows need whatever the tasks that made it."""
        path = f"{self.root}/held/{name}-{batch_id}"
        rows.write.mode("overwrite").parquet(path)
        return self.spark.read.schema(rows.schema).parquet(path)

    def __call__(self, ratings: DataFrame, batch_id: int):
        """Handler for ``foreachBatch``: the batch joins the history before lists are computed."""
        if batch_id and batch_id % self.compact_every == 0:
            self.compact(batch_id)
        mine = f"{self.history_path}/batch_id={batch_id}"
        ratings.withColumn("bucket", bucket_of("uid", self.buckets)).write.mode("overwrite").partitionBy("bucket").parquet(mine)
        # Read back in the caller's session: the session of a stream runs without adaptive plans.
        batch = self.spark.read.schema(HISTORY).parquet(mine)
        # At most ``buckets`` numbers.
        touched = [r["bucket"] for r in batch.select("bucket").distinct().collect()]
        try:
            # Of known size: Spark need not shuffle the stored ratings to find those of a small batch.
            events = self._held(last_events(batch), "events", batch_id)
            # Read from the history once and used three times.
            known = self._held(self.history(batch_id, touched, events.select("uid")), "known", batch_id)
            lists = live_lists(
                self.load_index(), events, known.select("uid", "mid"),
                recent_ratings(known, HISTORY_READ), self.mode,
            )
            lists.write.mode("overwrite").parquet(f"{self.lists_path}/batch_id={batch_id}")
        finally:
            for name in ("events", "known"):
                self.merged.remove(f"{self.root}/held/{name}-{batch_id}")

    def latest(self) -> DataFrame:
        """(uid, recs): the newest list of each user."""
        return latest_lists(self._batches("lists", self.lists_path, LISTS))

    def writer(self, ratings: DataFrame, checkpoint, trigger=TRIGGER):
        return (
            ratings.writeStream.foreachBatch(self)
            .option("checkpointLocation", checkpoint)
            .trigger(processingTime=trigger)
        )
