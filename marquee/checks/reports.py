"""Aggregates and ranked reports."""

from pyspark.sql import functions as F

from marquee.checks import check
from marquee.checks.sql import query
from marquee.operators import factors, merges, serving, statistics
from marquee.sources import sample

TOP = 6


@check("rate_more_movies", query("SELECT mid, count FROM counts"))
def rate_more_movies(spark, folder):
    return statistics.rate_more_movies(sample.ratings(spark, folder))


@check("rate_more_recently", query("SELECT mid, count, yearmonth FROM monthly ORDER BY yearmonth DESC, count DESC, mid"))
def rate_more_recently(spark, folder):
    return statistics.by_month(statistics.rate_more_recently(sample.ratings(spark, folder)))


@check("average_movies", query("SELECT mid, round(avg, 6) AS avg FROM averages"))
def average_movies(spark, folder):
    averages = statistics.average_movies(sample.ratings(spark, folder))
    return averages.select("mid", F.round("avg", 6).alias("avg"))


@check("tags_per_movie", query(
    "SELECT mid, string_agg(tag, '|' ORDER BY tag) AS tags FROM (SELECT DISTINCT mid, tag FROM tags) GROUP BY mid"
))
def tags_per_movie(spark, folder):
    return statistics.tags_per_movie(sample.tags(spark, folder))


@check("genres_top_movies", query("SELECT genres, rank, mid, score FROM genre_top"))
def genres_top_movies(spark, folder):
    return statistics.spread_recs(genre_recs(spark, folder), "genres")


def genre_recs(spark, folder):
    averages = statistics.average_movies(sample.ratings(spark, folder))
    return statistics.genres_top_movies(sample.movies(spark, folder), averages, sample.SAMPLE_GENRES)


@check("recs_top_n", query(f"SELECT genres, rank, mid, score FROM genre_top WHERE rank <= {TOP}"))
def recs_top_n(spark, folder):
    return statistics.spread_recs(genre_recs(spark, folder), "genres", TOP)


@check("recs_explode", query("SELECT genres, mid, score FROM genre_top"))
def recs_explode(spark, folder):
    recs = genre_recs(spark, folder)
    as_map = recs.select("genres", F.map_from_entries("recs").alias("by_mid"))
    return as_map.select("genres", F.explode("by_mid").alias("mid", "score"))


@check("top_genre_lookup", query(f"SELECT genres, rank, mid, score FROM genre_top WHERE genres = 'Small' AND rank <= {TOP}"))
def top_genre_lookup(spark, folder):
    return statistics.top_genre_lookup(genre_recs(spark, folder), "Small", TOP)


@check("distinct_users_items", query(
    "SELECT 'user' AS kind, uid AS id FROM ratings GROUP BY uid UNION ALL SELECT 'item', mid FROM ratings GROUP BY mid"
))
def distinct_users_items(spark, folder):
    ratings = sample.ratings(spark, folder)
    users = statistics.distinct_users(ratings).select(F.lit("user").alias("kind"), F.col("uid").alias("id"))
    items = statistics.distinct_items(ratings).select(F.lit("item").alias("kind"), F.col("mid").alias("id"))
    return users.unionByName(items)


@check("grid_min_by", query(
    """
    SELECT uid, mid, score FROM (
        SELECT *, row_number() OVER (PARTITION BY uid ORDER BY score, mid) AS pos FROM ratings)
    WHERE pos = 1"""
))
def grid_min_by(spark, folder):
    """The row with the least value, here per user."""
    ratings = sample.ratings(spark, folder)
    return ratings.groupBy("uid").agg(F.min_by("mid", F.struct("score", "mid")).alias("mid"), F.min("score").alias("score"))


@check("rating_histogram", query(
    """
    SELECT u.uid, b.bin AS bin, count(r.score) AS n
    FROM (SELECT DISTINCT uid FROM ratings) u
         JOIN (SELECT CAST(unnest(range(0, 11)) AS INT) AS bin) b ON true
         LEFT JOIN ratings r ON r.uid = u.uid AND CAST(floor(r.score / 0.5 + 0.5) AS INT) = b.bin
    GROUP BY u.uid, b.bin"""
))
def rating_histogram(spark, folder):
    stats = statistics.rating_histogram(sample.ratings(spark, folder))
    return stats.select("uid", F.posexplode("stat").alias("bin", "n"))


HOT = """
    SELECT CAST(row_number() OVER (ORDER BY yearmonth DESC, count DESC, mid) AS INT) AS rank, mid, 0.0::DOUBLE AS score FROM (
        SELECT mid, count, yearmonth, row_number() OVER (PARTITION BY mid ORDER BY yearmonth DESC) AS pos FROM monthly)
    WHERE pos = 1 QUALIFY rank <= 100"""
MOST = """
    SELECT CAST(row_number() OVER (ORDER BY count DESC, mid) AS INT) AS rank, mid, 0.0::DOUBLE AS score
    FROM counts QUALIFY rank <= 100"""
NEWEST = """
    SELECT CAST(row_number() OVER (ORDER BY issue DESC, mid) AS INT) AS rank, * FROM movies QUALIFY rank <= 100"""


@check("hot_movies", query("SELECT * FROM hot", hot=HOT))
def hot_movies(spark, folder):
    return statistics.hot_movies(statistics.rate_more_recently(sample.ratings(spark, folder)), 100)


@check("most_rated_movies", query("SELECT * FROM most", most=MOST))
def most_rated_movies(spark, folder):
    return statistics.most_rated_movies(statistics.rate_more_movies(sample.ratings(spark, folder)), 100)


@check("new_movies", query("SELECT rank, mid, name, issue FROM newest", newest=NEWEST))
def new_movies(spark, folder):
    return statistics.new_movies(sample.movies(spark, folder), 100).select("rank", "mid", "name", "issue")


@check("new_movies_by_date", query(
    """
    SELECT CAST(row_number() OVER (ORDER BY issued DESC, mid) AS INT) AS rank, mid, name, issue
    FROM (SELECT mid, name, strftime(CAST(issue AS DATE), '%B %-d, %Y') AS issue, CAST(issue AS DATE) AS issued FROM movies)
    QUALIFY rank <= 100"""
))
def new_movies_by_date(spark, folder):
    """Issue dates written in words, ordered as dates."""
    movies = sample.movies(spark, folder).withColumn(
        "issue", F.date_format(F.to_date("issue"), "MMMM d, yyyy")
    )
    return statistics.new_movies(movies, 100, parse_dates=True).select("rank", "mid", "name", "issue")


def _info(spark, folder):
    movies = sample.movies(spark, folder)
    return movies, statistics.average_movies(sample.ratings(spark, folder))


@check("serve_hot", query(
    "SELECT h.rank, h.mid, h.score, i.name, i.avg_score FROM hot h JOIN info i ON i.mid = h.mid", hot=HOT
))
def serve_hot(spark, folder):
    return serving.with_movie_info(hot_movies(spark, folder), *_info(spark, folder))


@check("serve_rate", query(
    "SELECT h.rank, h.mid, h.score, i.name, i.avg_score FROM most h JOIN info i ON i.mid = h.mid", most=MOST
))
def serve_rate(spark, folder):
    return serving.with_movie_info(most_rated_movies(spark, folder), *_info(spark, folder))


@check("serve_new", query(
    "SELECT h.rank, h.mid, i.name, i.avg_score FROM newest h JOIN info i ON i.mid = h.mid", newest=NEWEST
))
def serve_new(spark, folder):
    ranked = statistics.new_movies(sample.movies(spark, folder), 100).select("rank", "mid")
    return serving.with_movie_info(ranked, *_info(spark, folder))


@check("train_test_split", query(
    "SELECT uid, mid, score, \"timestamp\", CASE WHEN (CAST(uid AS BIGINT) * 31 + mid) % 10 < 8 THEN 'train' ELSE 'test' END AS side FROM ratings"
))
def train_test_split(spark, folder):
    train_set, test_set = factors.split_ratings(sample.ratings(spark, folder))
    return train_set.withColumn("side", F.lit("train")).unionByName(
        test_set.withColumn("side", F.lit("test"))
    )


@check("last_rating_per_key", query(
    """
    SELECT uid, mid, score, "timestamp" FROM (
        SELECT *, row_number() OVER (PARTITION BY uid, mid ORDER BY "timestamp" DESC, score DESC) AS pos FROM ratings)
    WHERE pos = 1"""
))
def last_rating_per_key(spark, folder):
    return merges.last_per_key(
        sample.ratings(spark, folder), ["uid", "mid"], ["timestamp"], ["score", "timestamp"]
    )
