"""Mixing sources to target weights under a time-varying curriculum.

Each source has a weight that runs linearly from ``start`` to ``end`` over the training. Its integral,
the mean, decides how many words the source gives in all; targets that exceed ``repeats`` times the
source are cut there and the excess is shared out again. A document's place in its source, counted in
words, is a cumulative demand; inverting the integral of the schedule gives the training position at
which that demand is reached, and documents are range-sorted by it.
"""

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from marquee.llm.frames import words_of
from marquee.session import written

SCHEDULE = ((6.0, 4.0), (2.0, 2.0), (0.5, 1.5))


def targets(sizes: DataFrame, schedule=SCHEDULE, share=1.5, repeats=2) -> DataFrame:
    """One row per source with ``source_size``, ``target``, ``start`` and ``end``.

    Sources in order of code points, null last, take the schedule's rows in turn. The window over all
    sources holds one row per source, not per document.
    """
    sources = written(sizes.groupBy("source").agg(F.sum("size").alias("source_size")), "sources")
    turn = F.row_number().over(Window.orderBy(F.col("source").asc_nulls_last())) - 1
    pick = lambda k: F.get(F.array(*[F.lit(float(s[k])) for s in schedule]), turn % len(schedule))
    sources = sources.select("source", "source_size", pick(0).alias("start"), pick(1).alias("end"))
    sources = sources.withColumn("weight", (F.col("start") + F.col("end")) / 2)
    # Targets stop in order of the level, words per weight, at which a source is used up. The level
    # that shares out what is left is right at the first source that it does not use up.
    sources = sources.withColumn("full", F.col("source_size") * repeats / F.col("weight"))
    order = Window.orderBy("full", F.col("source").asc_nulls_last())
    every = Window.partitionBy()
    before = F.coalesce(F.sum("source_size").over(order.rowsBetween(Window.unboundedPreceding, -1)), F.lit(0))
    rest = F.sum("weight").over(order.rowsBetween(Window.currentRow, Window.unboundedFollowing))
    level = (F.sum("source_size").over(every) * F.lit(share) - before * repeats) / rest
    sources = sources.withColumns({"level": level, "place": F.row_number().over(order)})
    enough = F.when(F.col("level") <= F.col("full"), F.struct("place", "level"))
    reached = F.coalesce(F.min(enough).over(every)["level"], F.lit(float("inf")))
    return sources.withColumn("reached", reached).select(
        "source", F.col("source_size"), "start", "end",
        F.least(F.col("source_size") * F.lit(float(repeats)), F.col("reached") * F.col("weight")).alias("target"),
    )


def _prefix(sizes: DataFrame) -> DataFrame:
    """Adds ``before``: the words of a source before a document, in order of a hash of its id.

    Two levels: sums by source and hash prefix, and a window inside each prefix, so that a source of
    any share of the rows is dealt over thousands of tasks.
    """
    rows = sizes.withColumn("order", F.md5(F.coalesce(F.col("doc_id").cast("string"), F.lit(""))))
    rows = rows.withColumn("part", F.substring("order", 1, 3))
    parts = rows.groupBy("source", "part").agg(F.sum("size").alias("words"))
    earlier = Window.partitionBy("source").orderBy("part").rowsBetween(Window.unboundedPreceding, -1)
    parts = written(parts.withColumn("offset", F.coalesce(F.sum("words").over(earlier), F.lit(0))), "parts")
    inside = Window.partitionBy("source", "part").orderBy("order", "doc_id", "size").rowsBetween(Window.unboundedPreceding, -1)
    rows = rows.withColumn("inside", F.coalesce(F.sum("size").over(inside), F.lit(0)))
    match = rows["source"].eqNullSafe(parts["source"]) & (rows["part"] == parts["part"])
    return rows.join(parts.select("source", "part", "offset"), match, "left").drop(parts["source"], parts["part"]).withColumn(
        "before", F.col("offset") + F.col("inside")).drop("order", "part", "inside", "offset")


def position(demand):
    """Training time, 0 to 1, at which a share ``demand`` of a source's words has been asked for."""
    start, end = F.col("start"), F.col("end")
    bent = (F.sqrt(start * start + (end - start) * (start + end) * demand) - start) / (end - start)
    return F.when(start == end, demand).otherwise(bent)


def sized(documents: DataFrame) -> DataFrame:
    """``documents`` with ``size``: the number of words of the text, 0 for a null one."""
    return documents.withColumn("size", F.size(words_of("text")).cast("long"))


def mix(sizes: DataFrame, schedule=SCHEDULE, share=1.5, repeats=2) -> DataFrame:
    """All rows with ``source_size``, ``target``, ``before``, ``passes``, ``taken`` and ``position``.

    ``sizes`` has ``doc_id``, ``source`` and ``size``, and best no text: its rows are shuffled. All
    documents of a source are read ``passes`` times whole, and once more up to the target: ``taken``
    counts a document's words in the mix and differs from a multiple of ``size`` for one document per
    source at most. ``position`` is that of its first words, null if none are taken. Equal rows share
    their places in any order, so reruns agree. A null source is a source; null ids come first.
    Columns of the input that are named like a result or an intermediate column are replaced.
    """
    own = ["source_size", "target", "before", "passes", "taken", "position", "start", "end",
           "order", "part", "inside", "offset"]
    sizes = written(sizes.drop(*own), "sizes")
    goal = written(targets(sizes.select("source", "size"), schedule, share, repeats), "targets")
    rows = _prefix(sizes)
    rows = rows.join(goal, rows["source"].eqNullSafe(goal["source"]), "left").drop(goal["source"])
    whole = F.col("source_size") > 0
    passes = F.when(whole, F.floor(F.col("target") / F.col("source_size"))).otherwise(0)
    rows = rows.withColumn("passes", passes.cast("long"))
    left = F.floor(F.col("target") - F.col("passes") * F.col("source_size"))
    part = F.least(F.col("before") + F.col("size"), left) - F.least(F.col("before"), left)
    rows = rows.withColumn("taken", (F.col("passes") * F.col("size") + part).cast("long"))
    return rows.withColumn("position", F.when(F.col("taken") > 0, position(F.col("before") / F.col("target"))))


def ordered(sizes: DataFrame, **options) -> DataFrame:
    """``mix``, range-sorted by training position; documents that are not taken come first."""
    return written(mix(sizes, **options), "mix").orderBy("position", "doc_id")


def training_rows(documents: DataFrame, **options) -> DataFrame:
    """The mix as rows of ``documents`` in training order: a document once for each pass that reads it.

    A document that the last pass only begins is kept whole. The mix is planned on sizes alone; texts
    join it by 96 hash bits of the whole row, each different row once.
    """
    columns = documents.columns
    keyed = sized(documents.select(
        F.struct(*columns).alias("row"), F.xxhash64(*columns).alias("u1"), F.hash(*columns).alias("u2"),
        "doc_id", "source", "text",
    ))
    mixed = mix(keyed.select("u1", "u2", "doc_id", "source", "size"), **options).filter("taken > 0")
    times = F.sequence(F.lit(0), F.ceil(F.col("taken") / F.col("size")).cast("int") - 1)
    rows = mixed.withColumn("pass", F.explode(times))
    demand = (F.col("before") + F.col("pass") * F.col("source_size")) / F.col("target")
    rows = written(rows.select("u1", "u2", "doc_id", position(demand).alias("position")), "passes")
    texts = keyed.groupBy("u1", "u2").agg(F.first("row").alias("row"))
    return rows.join(texts, ["u1", "u2"]).orderBy("position", "doc_id").select("row.*")
