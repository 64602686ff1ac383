"""The logical inputs (ratings, movies, tags, users, log lines) from a folder of sales tables.

Orders joined to their lines stand for ratings, parts for movies, events for tags and for
the web log, customers for users.
"""

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from marquee.functions.scalars import epoch_seconds, rating_log_line

# Genre names of the sample movies: six exact ones, and three that hit words of the title.
SAMPLE_GENRES = ("Economy", "Large", "Medium", "Promo", "Small", "Standard", "Blue", "Ring", "Gear")
PREFERENCES = SAMPLE_GENRES[:6]


def table(spark: SparkSession, folder, name) -> DataFrame:
    return spark.read.parquet(f"{folder}/{name}.parquet")


def ratings(spark, folder) -> DataFrame:
    orders = table(spark, folder, "orders").select("o_orderkey", "o_custkey")
    lines = table(spark, folder, "lineitem")
    return lines.join(orders, F.col("l_orderkey") == F.col("o_orderkey")).select(
        F.col("o_custkey").cast("int").alias("uid"),
        F.col("l_partkey").cast("int").alias("mid"),
        (F.ceil(F.col("l_quantity") / 5).cast("double") / 2).alias("score"),
        epoch_seconds("l_shipdate").cast("int").alias("timestamp"),
    )


def movies(spark, folder) -> DataFrame:
    kind = F.concat(F.upper(F.substring("p_type", 1, 1)), F.lower(F.expr("substring(p_type, 2)")))
    return table(spark, folder, "part").select(
        F.col("p_partkey").cast("int").alias("mid"),
        F.col("p_name").alias("name"),
        F.concat_ws(" ", "p_brand", F.lower("p_type"), "p_name").alias("descri"),
        F.concat(F.col("p_size").cast("string"), F.lit(" minutes")).alias("timelong"),
        F.concat((F.lit(1990) + F.col("p_partkey") % 30).cast("string"), F.lit("-01-01")).alias("issue"),
        F.lit("1977").alias("shoot"),
        F.lit("English").alias("language"),
        F.concat_ws("|", kind, F.translate("p_name", " ", "|")).alias("genres"),
        F.concat_ws("|", F.lit("Cast"), F.col("p_brand")).alias("actors"),
        F.col("p_brand").alias("directors"),
    )


def _mid_of_event(spark, folder):
    parts = table(spark, folder, "part").agg(F.count("*").alias("n"))
    return (F.col("event_id") % parts.scalar()).cast("int")


def tags(spark, folder) -> DataFrame:
    return table(spark, folder, "events").select(
        F.col("user_id").cast("int").alias("uid"),
        _mid_of_event(spark, folder).alias("mid"),
        F.col("event_type").alias("tag"),
        epoch_seconds("ts").cast("int").alias("timestamp"),
    )


def users(spark, folder) -> DataFrame:
    """Customers of one market segment have no preferred genre; the others have one or two."""
    names = F.array(*[F.lit(p) for p in PREFERENCES])
    one = F.element_at(names, (F.col("c_custkey") % 6 + 1).cast("int"))
    two = F.element_at(names, (F.col("c_custkey") % 5 + 1).cast("int"))
    return table(spark, folder, "customer").select(
        F.col("c_custkey").cast("int").alias("uid"),
        F.col("c_name").alias("username"),
        (F.col("c_custkey") % 2 == 0).alias("first"),
        (F.col("c_custkey") * 1000).alias("timestamp"),
        F.when(F.col("c_mktsegment") == "MACHINERY", F.array().cast("array<string>"))
        .otherwise(F.array_distinct(F.array(one, two)))
        .alias("prefGenres"),
    )


def log_lines(spark, folder) -> DataFrame:
    """The web log: purchase events are ratings, every other event is noise."""
    return as_log_lines(table(spark, folder, "events"), _mid_of_event(spark, folder))


def as_log_lines(events: DataFrame, mid) -> DataFrame:
    score = (1 + F.col("event_id") % 10).cast("double") / 2
    rating = F.concat(
        F.lit("2024-01-01 INFO --- [exec] web.ratings : "),
        rating_log_line("user_id", mid, score, epoch_seconds("ts")),
    )
    noise = F.concat(F.lit("2024-01-01 INFO --- [exec] "), F.col("event_type"))
    return events.select(
        "event_id", F.when(F.col("event_type") == "purchase", rating).otherwise(noise).alias("value")
    )
