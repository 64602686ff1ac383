"""Projections, filters, scalar functions and simple joins."""

from pyspark.sql import functions as F

from marquee.checks import check
from marquee.checks.sql import query
from marquee.checks.tables import stream_ratings
from marquee.functions import scalars as S
from marquee.operators import merges, online, serving, statistics
from marquee.sources import delimited, sample
from marquee.streaming import rating_log


@check("project_ratings", query("SELECT uid, mid, score FROM ratings"))
def project_ratings(spark, folder):
    return sample.ratings(spark, folder).select("uid", "mid", "score")


@check("rating_yearmonth", query(
    """
    SELECT mid, score,
           CAST(strftime(make_timestamp(CAST("timestamp" AS BIGINT) * 1000000), '%Y%m') AS INT) AS yearmonth
    FROM ratings"""
))
def rating_yearmonth(spark, folder):
    return sample.ratings(spark, folder).select("mid", "score", S.yearmonth("timestamp").alias("yearmonth"))


@check("genres_text", query("SELECT mid, replace(genres, '|', ' ') AS words FROM movies"))
def genres_text(spark, folder):
    return sample.movies(spark, folder).select("mid", S.genres_as_text("genres").alias("words"))


@check("filter_thresholds", query("SELECT uid, mid, score FROM ratings WHERE score > 3"))
def filter_thresholds(spark, folder):
    return sample.ratings(spark, folder).filter(S.over("score", 3)).select("uid", "mid", "score")


@check("parse_movie_lines", query("SELECT mid, name, issue, genres, directors FROM movies"))
def parse_movie_lines(spark, folder):
    lines = delimited.movie_lines(sample.movies(spark, folder))
    return delimited.parse_movie_lines(lines).select("mid", "name", "issue", "genres", "directors")


@check("log_rating_filter", query(
    """
    SELECT trim(split_part(value, 'MOVIE_RATING_PREFIX:', 2)) AS value
    FROM log_lines WHERE contains(value, 'MOVIE_RATING_PREFIX:')"""
))
def log_rating_filter(spark, folder):
    return rating_log.rating_messages(sample.log_lines(spark, folder))


@check("parse_rating_messages", query("SELECT uid, mid, score, \"timestamp\" FROM stream_ratings"))
def parse_rating_messages(spark, folder):
    return stream_ratings(spark, folder)


@check("parse_history_items", query("SELECT uid, position, mid, score FROM recent"))
def parse_history_items(spark, folder):
    """Recent ratings written as ``mid:score`` items, newest first, and read back."""
    recent = online.recent_ratings(sample.ratings(spark, folder))
    items = recent.groupBy("uid").agg(F.array_sort(F.collect_list(F.struct(
        "position", F.concat_ws(":", F.col("mid").cast("string"), F.col("score").cast("string")).alias("item")
    ))).alias("items"))
    parsed = items.select("uid", F.posexplode(S.history_items(F.col("items.item"))).alias("at", "r"))
    return parsed.select("uid", (F.col("at") + 1).alias("position"), "r.mid", "r.score")


@check("stars_to_score", query(
    "SELECT event_id, round(CAST(1 + event_id % 10 AS DOUBLE) / 2, 2) AS score FROM events"
))
def stars_to_score(spark, folder):
    stars = (1 + F.col("event_id") % 10).cast("double")
    return sample.table(spark, folder, "events").select("event_id", S.stars_to_score(stars).alias("score"))


@check("rating_log_lines", query(
    """
    SELECT concat('MOVIE_RATING_PREFIX:', CAST(uid AS VARCHAR), '|', CAST(mid AS VARCHAR), '|',
                  CAST(score AS VARCHAR), '|', CAST("timestamp" AS VARCHAR)) AS value
    FROM ratings"""
))
def rating_log_lines(spark, folder):
    return sample.ratings(spark, folder).select(
        S.rating_log_line("uid", "mid", "score", "timestamp").alias("value")
    )


@check("pref_genre_key", query(
    "SELECT uid, split_part(\"prefGenres\"[1], ' ', 1) AS genres FROM users WHERE len(\"prefGenres\") > 0"
))
def pref_genre_key(spark, folder):
    return serving.chosen_genre(sample.users(spark, folder))


@check("exists_flag", query(
    """
    SELECT s.uid, s.mid, s."timestamp",
           EXISTS (SELECT 1 FROM ratings r WHERE r.uid = s.uid AND r.mid = s.mid) AS found
    FROM stream_ratings s"""
))
def exists_flag(spark, folder):
    return merges.exists_flag(
        stream_ratings(spark, folder), sample.ratings(spark, folder), ["uid", "mid"]
    ).select("uid", "mid", "timestamp", "found")


ASKED = "SELECT DISTINCT uid, mid FROM stream_ratings"


@check("movie_tags", query(
    "SELECT * FROM tags WHERE mid IN (SELECT mid FROM asked)", asked=ASKED
))
def movie_tags(spark, folder):
    """Tags of every movie rated in the web log."""
    tags = sample.tags(spark, folder)
    return serving.movie_tags(tags, stream_ratings(spark, folder)).select(*tags.columns)


@check("my_movie_tags", query(
    "SELECT t.* FROM tags t WHERE EXISTS (SELECT 1 FROM asked a WHERE a.uid = t.uid AND a.mid = t.mid)",
    asked=ASKED,
))
def my_movie_tags(spark, folder):
    tags = sample.tags(spark, folder)
    return serving.movie_tags(tags, stream_ratings(spark, folder), mine=True).select(*tags.columns)


@check("movies_with_tags", query(
    "SELECT m.mid, m.name, t.tags FROM movies m LEFT JOIN tag_text t ON t.mid = m.mid",
    tag_text="""
    SELECT mid, string_agg(tag, '|' ORDER BY tag) AS tags FROM (SELECT DISTINCT mid, tag FROM tags) GROUP BY mid""",
))
def movies_with_tags(spark, folder):
    return statistics.movies_with_tags(
        sample.movies(spark, folder), sample.tags(spark, folder)
    ).select("mid", "name", "tags")


@check("movies_with_avg", query(
    "SELECT mid, name, genres, round(avg, 6) AS avg FROM movies JOIN averages USING (mid)"
))
def movies_with_avg(spark, folder):
    averages = statistics.average_movies(sample.ratings(spark, folder))
    return statistics.movies_with_avg(sample.movies(spark, folder), averages).select(
        "mid", "name", "genres", F.round("avg", 6).alias("avg")
    )


@check("genre_movie_match", query(
    "SELECT genre, mid, genres FROM movies JOIN genre_names ON contains(lower(genres), lower(genre))"
))
def genre_movie_match(spark, folder):
    movies = sample.movies(spark, folder).select("mid", "genres", F.col("genres").alias("listed"))
    return statistics.genre_movie_match(movies, sample.SAMPLE_GENRES).withColumnRenamed("listed", "genres")


GUESSES = """
    SELECT DISTINCT uid, mid, round(avg, 6) AS prediction FROM ratings JOIN averages USING (mid)"""


@check("actual_vs_predicted", query(
    "SELECT r.uid, r.mid, r.score, g.prediction FROM ratings r JOIN guesses g ON g.uid = r.uid AND g.mid = r.mid",
    guesses=GUESSES,
))
def actual_vs_predicted(spark, folder):
    """The average score of a movie as the prediction for all who rated it."""
    ratings = sample.ratings(spark, folder)
    averages = statistics.average_movies(ratings)
    guesses = ratings.select("uid", "mid").distinct().join(averages, "mid").select(
        "uid", "mid", F.round("avg", 6).alias("prediction")
    )
    return ratings.join(guesses, ["uid", "mid"]).select("uid", "mid", "score", "prediction")


@check("rmse_baseline", query(
    """
    SELECT round(sqrt(avg(pow(r.score - g.prediction, 2))), 6) AS rmse
    FROM ratings r JOIN guesses g ON g.uid = r.uid AND g.mid = r.mid""",
    guesses=GUESSES,
))
def rmse_baseline(spark, folder):
    return statistics.rmse(actual_vs_predicted(spark, folder)).select(F.round("rmse", 6).alias("rmse"))


@check("movies_in_list", query(
    "SELECT mid, name FROM movies WHERE mid IN (SELECT mid FROM stream_ratings)"
))
def movies_in_list(spark, folder):
    return serving.movies_in_list(
        sample.movies(spark, folder), stream_ratings(spark, folder)
    ).select("mid", "name")


@check("movie_info", query(
    """
    SELECT mid, name, descri, timelong, issue, shoot, language, genres, actors, directors,
           coalesce(round(avg, 6), 0.0) AS score
    FROM movies LEFT JOIN averages USING (mid)"""
))
def movie_info(spark, folder):
    averages = statistics.average_movies(sample.ratings(spark, folder))
    return serving.movie_info(sample.movies(spark, folder), averages)


@check("my_rated_movies", query(
    """
    SELECT l.uid, l.mid, m.name, l.score FROM (
        SELECT *, row_number() OVER (PARTITION BY uid, mid ORDER BY "timestamp" DESC, score DESC) AS pos
        FROM ratings) l JOIN movies m ON m.mid = l.mid
    WHERE pos = 1"""
))
def my_rated_movies(spark, folder):
    return serving.my_rated_movies(
        sample.ratings(spark, folder), sample.movies(spark, folder), sample.users(spark, folder)
    )


@check("rating_movie_join", query(
    "SELECT r.uid, r.mid, m.name, r.score FROM ratings r JOIN movies m ON m.mid = r.mid"
))
def rating_movie_join(spark, folder):
    return sample.ratings(spark, folder).join(
        sample.movies(spark, folder).select("mid", "name"), "mid"
    ).select("uid", "mid", "name", "score")
