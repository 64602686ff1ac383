"""Batches of serving requests answered from stored result tables."""

from pyspark.sql import DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from marquee.functions import scalars as S
from marquee.operators.similarity import DIGITS
from marquee.operators.statistics import gather_recs

# Share of each source in the hybrid list.
FACTOR_SHARE = 0.3
CONTENT_SHARE = 0.3
STREAM_SHARE = 0.4


def lookup(requests: DataFrame, recs: DataFrame, key, n) -> DataFrame:
    """Request columns with (rank, mid, score) of the stored list for ``key``, first ``n``.

    ``requests`` names the key column as the list table does; the rec column ``mid`` comes out as
    ``rec_mid`` when the key itself is ``mid``.
    """
    hit = requests.join(recs.select(key, "recs"), key)
    joined = hit.select(*requests.columns, F.posexplode(S.rank_recs("recs", n)).alias("at", "r"))
    name = "rec_mid" if "mid" in requests.columns else "mid"
    return joined.select(
        *requests.columns, (F.col("at") + 1).alias("rank"), F.col("r.mid").alias(name), F.col("r.score").alias("score")
    )


def movie_info(movies: DataFrame, averages: DataFrame) -> DataFrame:
    """Movies with their average score, 0.0 when nobody rated them."""
    scores = averages.select("mid", F.round("avg", DIGITS).alias("score"))
    return movies.join(scores, "mid", "left").withColumn("score", F.coalesce("score", F.lit(0.0)))


def movies_in_list(movies: DataFrame, mids: DataFrame) -> DataFrame:
    """Movies whose mid is listed, each once."""
    return movies.join(mids.select("mid").distinct(), "mid", "left_semi")


def with_movie_info(ranked: DataFrame, movies, averages, mid="mid") -> DataFrame:
    """A ranked list with name and average score of each movie; the rank is kept."""
    info = movie_info(movies.select(F.col("mid"), "name"), averages).select(
        F.col("mid").alias(mid), "name", F.col("score").alias("avg_score")
    )
    return ranked.join(info, mid)


def my_rated_movies(ratings: DataFrame, movies: DataFrame, users: DataFrame = None) -> DataFrame:
    """(uid, mid, name, score): movies a user rated, with the user's last score for each."""
    mine = ratings if users is None else ratings.join(users.select("uid").distinct(), "uid", "left_semi")
    last = mine.groupBy("uid", "mid").agg(F.max(F.struct("timestamp", "score")).alias("r"))
    return last.join(movies.select("mid", "name"), "mid").select("uid", "mid", "name", F.col("r.score").alias("score"))


def movie_tags(tags: DataFrame, requests: DataFrame, mine=False) -> DataFrame:
    """Tags of requested movies; with ``mine`` only those of the asking user."""
    keys = ["uid", "mid"] if mine else ["mid"]
    return tags.join(requests.select(*keys).distinct(), keys, "left_semi")


def hybrid(requests, factor_recs, content_recs, stream_recs, n, dedupe="none") -> DataFrame:
    """(request columns, rank, rec_mid, score): weighted mix of three lists per request.

    ``requests`` holds (uid, mid): similar items are looked up by mid, the live list by uid. Scores are
    neither normalised nor, with ``dedupe="none"``, merged; "sum" and "max" merge the
    entries of one movie.
    """
    requests = requests.select("uid", "mid").distinct()

    def part(recs, key, share):
        hit = requests.join(recs.select(key, "recs"), key)
        found = hit.select("uid", "mid", F.explode(S.rank_recs("recs", n)).alias("r"))
        return found.select(
            "uid", "mid", F.col("r.mid").alias("rec_mid"), S.rounded(F.col("r.score") * share).alias("score")
        )

    mixed = (
        part(factor_recs, "mid", FACTOR_SHARE)
        .unionByName(part(content_recs, "mid", CONTENT_SHARE))
        .unionByName(part(stream_recs, "uid", STREAM_SHARE))
    )
    if dedupe != "none":
        merge = {"sum": F.sum, "max": F.max}[dedupe]
        mixed = mixed.groupBy("uid", "mid", "rec_mid").agg(F.round(merge("score"), DIGITS).alias("score"))
    order = W.partitionBy("uid", "mid").orderBy(F.desc("score"), "rec_mid")
    return (
        mixed.withColumn("rank", F.row_number().over(order))
        .filter(F.col("rank") <= n)
        .select("uid", "mid", "rank", "rec_mid", "score")
    )


def _genre_pick(seed):
    at = F.lit(0) if seed is None else F.pmod(F.xxhash64("uid", F.lit(seed)), F.size("prefGenres")).cast("int")
    # Without preferences there is nothing to pick.
    return F.when(F.size("prefGenres") > 0, S.first_word(F.get("prefGenres", at)))


def chosen_genre(users: DataFrame, seed=None) -> DataFrame:
    """(uid, genres): first word of one preferred genre; users without preferences are left out.

    With a ``seed`` the pick is pseudo-random per user, otherwise the first preference.
    """
    return users.select("uid", _genre_pick(seed).alias("genres")).filter(F.col("genres").isNotNull())


def cold_start(users: DataFrame, ranked: DataFrame, genre_recs: DataFrame, n, seed=None, requests: DataFrame = None) -> DataFrame:
    """(uid, rank, mid, score, source): ``ranked`` plus a genre's top list for users without a list.

    ``ranked`` holds (uid, rank, mid, score), few per user. With ``requests`` (uid, asked), ``ranked``
    has ``asked`` too, and every request of a user is answered apart; users without one have a null.
    """
    keys = ["uid"] if requests is None else ["uid", "asked"]
    asking = users if requests is None else users.join(requests.select(*keys).distinct(), "uid", "left")
    own = gather_recs(ranked, keys).withColumnRenamed("recs", "own")
    tops = genre_recs.select("genres", S.rank_recs("recs", n).alias("tops"))
    joined = asking.withColumn("genres", _genre_pick(seed)).join(own, keys, "left").join(tops, "genres", "left")
    served = joined.select(
        *keys, F.when(F.col("own").isNotNull(), "list").otherwise("genre").alias("source"),
        F.posexplode(F.coalesce("own", "tops")).alias("at", "r"),
    )
    return served.select(*keys, (F.col("at") + 1).alias("rank"), "r.mid", "r.score", "source")


def serve_guess(requests, users, factor_recs, content_recs, stream_recs, genre_recs, movies, averages, n, seed=None):
    """Hybrid list of each request (uid, mid), or a preferred genre's top list, with movie data.

    ``asked`` is the movie of the request; users without a request get the genre list and a null.
    """
    mixed = hybrid(requests, factor_recs, content_recs, stream_recs, n).select(
        "uid", F.col("mid").alias("asked"), "rank", F.col("rec_mid").alias("mid"), "score"
    )
    asked = requests.select("uid", F.col("mid").alias("asked"))
    return with_movie_info(cold_start(users, mixed, genre_recs, n, seed, asked), movies, averages)


def serve_wish(users, user_recs, genre_recs, movies, averages, n, seed=None):
    """Stored list of each user, or a preferred genre's top list, with movie data."""
    ranked = lookup(users.select("uid"), user_recs, "uid", n)
    return with_movie_info(cold_start(users, ranked, genre_recs, n, seed), movies, averages)
