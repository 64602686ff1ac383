"""Popularity, monthly and per-genre statistics, and the ranked reports read from them."""

from pyspark.sql import DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from marquee import schemas
from marquee.functions import scalars as S


def rate_more_movies(ratings: DataFrame) -> DataFrame:
    """Ratings per movie."""
    return ratings.groupBy("mid").agg(F.count("mid").alias("count"))


def rate_more_recently(ratings: DataFrame) -> DataFrame:
    """Ratings per movie and month; the stored table has no order, see ``by_month``."""
    return (
        ratings.select("mid", S.yearmonth("timestamp").alias("yearmonth"))
        .groupBy("yearmonth", "mid")
        .agg(F.count("mid").alias("count"))
        .select("mid", "count", "yearmonth")
    )


def by_month(monthly: DataFrame) -> DataFrame:
    """Newest month first, most rated first."""
    return monthly.orderBy(F.desc("yearmonth"), F.desc("count"), "mid")


def average_movies(ratings: DataFrame) -> DataFrame:
    """Average score per movie."""
    return ratings.groupBy("mid").agg(F.avg("score").alias("avg"))


def genre_movie_match(movies: DataFrame, genres=schemas.DEFAULT_GENRES) -> DataFrame:
    """(genre, mid) for every genre name that occurs in a movie's genres.

    The genre names are a fixed parameter, so the match is an array filter inside the scan of
    the movies and needs no join.
    """
    keep = [c for c in movies.columns if c not in ("genres", "genre")]
    return movies.select(F.explode(S.matched_genres("genres", genres)).alias("genre"), *keep)


def genres_top_long(movies, averages, genres=schemas.DEFAULT_GENRES, n=10) -> DataFrame:
    """(genres, rank, mid, score): the ``n`` best rated movies of each genre.

    The rank filter runs before the shuffle as well, so a genre that holds most of the
    movies sends ``n`` rows per task.
    """
    matched = genre_movie_match(movies.select("mid", "genres"), genres)
    scored = matched.join(averages.select("mid", F.round("avg", 6).alias("score")), "mid")
    order = W.partitionBy("genre").orderBy(F.desc("score"), "mid")
    return (
        scored.withColumn("rank", F.row_number().over(order))
        .filter(F.col("rank") <= n)
        .select(F.col("genre").alias("genres"), "rank", "mid", "score")
    )


def genres_top_movies(movies, averages, genres=schemas.DEFAULT_GENRES, n=10) -> DataFrame:
    """(genres, recs): one row per genre, at most ``n`` recs in rank order."""
    return gather_recs(genres_top_long(movies, averages, genres, n), "genres")


def gather_recs(ranked: DataFrame, key) -> DataFrame:
    """(key, rank, mid, score) rows, few per key (a column or several), to (key, recs)."""
    items = F.array_sort(F.collect_list(F.struct("rank", "mid", "score")))
    return ranked.groupBy(key).agg(
        F.transform(items, lambda r: F.struct(r.mid.alias("mid"), r.score.alias("score"))).alias("recs")
    )


def spread_recs(recs: DataFrame, key, n=None) -> DataFrame:
    """(key, recs) to (key, rank, mid, score) in (score desc, mid asc) order."""
    ordered = S.rank_recs("recs", n)
    return recs.select(key, F.posexplode(ordered).alias("at", "r")).select(
        key, (F.col("at") + 1).alias("rank"), "r.mid", "r.score"
    )


def tags_per_movie(tags: DataFrame) -> DataFrame:
    """Distinct tags of each movie joined by ``|`` in alphabetical order.

    Duplicates are removed on (mid, tag) first: repeated tags of a much tagged movie are
    reduced in many tasks, and only its distinct words reach the row that holds them.
    """
    return (
        tags.select("mid", "tag").distinct().groupBy("mid")
        .agg(F.array_join(F.array_sort(F.collect_list("tag")), "|").alias("tags"))
    )


def movies_with_tags(movies, tags) -> DataFrame:
    return movies.join(tags_per_movie(tags), "mid", "left")


def movies_with_avg(movies, averages) -> DataFrame:
    return movies.join(averages, "mid")


def distinct_users(ratings) -> DataFrame:
    return ratings.select("uid").distinct()


def distinct_items(ratings) -> DataFrame:
    return ratings.select("mid").distinct()


def rating_histogram(ratings: DataFrame) -> DataFrame:
    """(uid, stat): eleven half-star counts, bins 0.0 to 5.0, per user.

    Scores of one user are reduced to eleven counters before the shuffle.
    """
    bins = [
        F.count_if(S.half_star_bin("score") == i).alias(f"bin{i}") for i in range(S.HALF_STARS + 1)
    ]
    counted = ratings.groupBy("uid").agg(*bins)
    return counted.select("uid", F.array(*[F.col(f"bin{i}") for i in range(S.HALF_STARS + 1)]).alias("stat"))


def hot_movies(monthly: DataFrame, n) -> DataFrame:
    """(rank, mid, score 0.0): movies of the latest month first, most rated first.

    A movie counts with its own latest month; a month occurs once per movie.
    """
    latest = monthly.groupBy("mid").agg(
        F.max_by("count", "yearmonth").alias("count"), F.max("yearmonth").alias("yearmonth")
    )
    order = [F.desc("yearmonth"), F.desc("count"), F.col("mid")]
    return _ranked(latest.orderBy(*order).limit(n), order)


def most_rated_movies(counts: DataFrame, n) -> DataFrame:
    """(rank, mid, score 0.0): most rated movies first."""
    top = counts.orderBy(F.desc("count"), "mid").limit(n)
    return _ranked(top, [F.desc("count"), F.col("mid")])


def new_movies(movies: DataFrame, n, parse_dates=False, formats=("MMMM d, yyyy", "yyyy-MM-dd")) -> DataFrame:
    """Movies by ``issue`` descending, as text or as dates; unreadable dates come last."""
    key = F.col("issue")
    if parse_dates:
        key = F.coalesce(*[F.try_to_timestamp("issue", F.lit(f)) for f in formats])
    keyed = movies.withColumn("issued", key)
    order = [F.desc_nulls_last("issued"), F.col("mid")]
    top = keyed.orderBy(*order).limit(n)
    return top.withColumn("rank", F.row_number().over(W.orderBy(*order))).drop("issued")


def _ranked(top, order):
    """Number the rows of a report already cut to its few rows."""
    return top.select(
        F.row_number().over(W.orderBy(*order)).alias("rank"), "mid", F.lit(0.0).alias("score")
    )


def top_genre_lookup(genre_recs: DataFrame, genre, n) -> DataFrame:
    return spread_recs(genre_recs.filter(F.col("genres") == genre), "genres", n)


def rmse(predicted: DataFrame, actual="score", guess="prediction") -> DataFrame:
    """Root of the mean squared difference of two columns, one row."""
    return predicted.agg(F.sqrt(F.avg(F.pow(F.col(actual) - F.col(guess), 2))).alias("rmse"))
