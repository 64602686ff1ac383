"""Serving requests in batches."""

from pyspark.sql import functions as F

from marquee.checks import check
from marquee.checks.live import run_live
from marquee.checks.reports import _info, genre_recs
from marquee.checks.searches import MOVIE_LIKES, document_store
from marquee.checks.similar import content_index, stored_ratings, user_recs, vector_index
from marquee.checks.sql import query
from marquee.checks.tables import stream_ratings
from marquee.operators import online, serving, similarity
from marquee.operators.statistics import gather_recs
from marquee.plans import ingest, jobs
from marquee.session import scratch, written
from marquee.sources import sample
from marquee.sources.tables import TableStore

N = 6


@check("lookup_similar", query(f"SELECT mid, rank, other AS rec_mid, score FROM sims_ranked WHERE rank <= {N}"))
def lookup_similar(spark, folder):
    """The similar list of every movie."""
    return similar_of(spark, folder, sample.movies(spark, folder).select("mid"), N)


def similar_of(spark, folder, asked, n):
    """Similar movies of the asked ones, for any ``n``: nothing is cut beforehand."""
    return serving.lookup(asked, similarity.neighbour_lists(content_index(spark, folder), n, asked), "mid", n)


DEEP = 150


@check("lookup_similar_deep_all", query(f"SELECT mid, rank, other AS rec_mid, score FROM sims_ranked WHERE rank <= {DEEP}"))
def lookup_similar_deep_all(spark, folder):
    """Long lists of every movie."""
    return similar_of(spark, folder, sample.movies(spark, folder).select("mid"), DEEP)


@check("serve_same", query(
    f"""
    SELECT s.mid, s.rank, s.other AS rec_mid, s.score, i.name, i.avg_score
    FROM sims_ranked s JOIN info i ON i.mid = s.other WHERE s.rank <= {N}"""
))
def serve_same(spark, folder):
    return serving.with_movie_info(lookup_similar(spark, folder), *_info(spark, folder), mid="rec_mid")


@check("lookup_user_recs", query(f"SELECT uid, rank, mid, score FROM ranked WHERE rank <= {N}"))
def lookup_user_recs(spark, folder):
    """The list of every user."""
    recs = user_recs(spark, folder, stored_ratings(spark, folder))
    return serving.lookup(sample.users(spark, folder).select("uid"), recs, "uid", N)


@check("lookup_stream_recs", query(f"SELECT uid, rank, mid, score FROM stream_ranked WHERE rank <= {N}"))
def lookup_stream_recs(spark, folder):
    return serving.lookup(
        sample.users(spark, folder).select("uid"), run_live(spark, folder).latest(), "uid", N
    )


SERVED = f"""
    SELECT uid, rank, mid, score, 'list' AS source FROM stream_ranked WHERE rank <= {N}
    UNION ALL
    SELECT u.uid, g.rank, g.mid, g.score, 'genre'
    FROM users u JOIN genre_top g ON g.genres = split_part(u."prefGenres"[1], ' ', 1) AND g.rank <= {N}
    WHERE len(u."prefGenres") > 0 AND u.uid NOT IN (SELECT uid FROM stream_ranked)"""


@check("cold_start_fallback", query("SELECT * FROM served", served=SERVED))
def cold_start_fallback(spark, folder):
    """Web-log users have a list; every other user gets the list of a preferred genre."""
    users = sample.users(spark, folder)
    recs = written(user_recs(spark, folder, written(stream_ratings(spark, folder), "ratings")), "user-recs")
    ranked = serving.lookup(users.select("uid"), recs, "uid", N)
    return serving.cold_start(users, ranked, genre_recs(spark, folder), N)


@check("serve_wish", query(
    "SELECT s.*, i.name, i.avg_score FROM served s JOIN info i ON i.mid = s.mid", served=SERVED
))
def serve_wish(spark, folder):
    recs = written(user_recs(spark, folder, written(stream_ratings(spark, folder), "ratings")), "user-recs")
    return serving.serve_wish(
        sample.users(spark, folder), recs, genre_recs(spark, folder), *_info(spark, folder), N
    )


MIXED = f"""
    SELECT uid, mid, other AS rec_mid, round(score * 0.3::DOUBLE + 1e-10::DOUBLE, 6) AS score
    FROM stream_last l JOIN vec_ranked v USING (mid) WHERE v.rank <= {N}
    UNION ALL
    SELECT l.uid, l.mid, v.mid, round(v.score * 0.3::DOUBLE + 1e-10::DOUBLE, 6)
    FROM stream_last l JOIN movie_likes v ON v.seed = l.mid WHERE v.rank <= {N}
    UNION ALL
    SELECT l.uid, l.mid, v.mid, round(v.score * 0.4::DOUBLE + 1e-10::DOUBLE, 6)
    FROM stream_last l JOIN stream_ranked v ON v.uid = l.uid WHERE v.rank <= {N}"""
HYBRID = f"""
    SELECT *, CAST(row_number() OVER (PARTITION BY uid, mid ORDER BY score DESC, rec_mid) AS INT) AS rank FROM mixed
    QUALIFY rank <= {N}"""


def _sources(spark, folder):
    """(requests, similar by vectors, more like this, live lists); a request is a user's last movie."""
    ratings = written(stream_ratings(spark, folder), "ratings")
    index = content_index(spark, folder)
    requests = online.last_events(ratings)
    likes = jobs.movies_like(document_store(spark, folder), N, requests.select("mid"))
    return (
        requests,
        written(similarity.neighbour_lists(vector_index(spark, folder, keep=21), 20), "movie-recs"),
        written(gather_recs(likes, "seed").withColumnRenamed("seed", "mid"), "like-recs"),
        written(user_recs(spark, folder, ratings, index), "stream-recs"),
    )


@check("hybrid_recs", query("SELECT uid, mid, rank, rec_mid, score FROM hybrid", **MOVIE_LIKES, mixed=MIXED, hybrid=HYBRID))
def hybrid_recs(spark, folder):
    return serving.hybrid(*_sources(spark, folder), N)


@check("hybrid_recs_dedup", query(
    f"""
    SELECT *, CAST(row_number() OVER (PARTITION BY uid, mid ORDER BY score DESC, rec_mid) AS INT) AS rank FROM (
        SELECT uid, mid, rec_mid, round(sum(score), 6) AS score FROM mixed GROUP BY uid, mid, rec_mid)
    QUALIFY rank <= {N}""",
    **MOVIE_LIKES, mixed=MIXED,
))
def hybrid_recs_dedup(spark, folder):
    return serving.hybrid(*_sources(spark, folder), N, dedupe="sum")


@check("serve_guess", query(
    f"""
    SELECT s.*, i.name, i.avg_score FROM (
        SELECT h.uid, h.mid AS asked, h.rank, h.rec_mid AS mid, h.score, 'list' AS source
        FROM hybrid h JOIN users u ON u.uid = h.uid
        UNION ALL
        SELECT u.uid, l.mid, g.rank, g.mid, g.score, 'genre'
        FROM users u JOIN genre_top g ON g.genres = split_part(u."prefGenres"[1], ' ', 1) AND g.rank <= {N}
             LEFT JOIN stream_last l ON l.uid = u.uid
        WHERE len(u."prefGenres") > 0 AND u.uid NOT IN (SELECT uid FROM hybrid)) s
    JOIN info i ON i.mid = s.mid""",
    **MOVIE_LIKES, mixed=MIXED, hybrid=HYBRID,
))
def serve_guess(spark, folder):
    requests, by_vector, by_content, live = _sources(spark, folder)
    return serving.serve_guess(
        requests, sample.users(spark, folder), by_vector, by_content, live,
        genre_recs(spark, folder), *_info(spark, folder), N,
    )


STAR_CLICKS = """
    SELECT CAST(user_id AS INT) AS uid, CAST(event_id % (SELECT n FROM np) AS INT) AS mid,
           round(CAST(1 + event_id % 10 AS DOUBLE) / 2, 2) AS score,
           CAST(floor(epoch(ts)) AS INT) AS "timestamp"
    FROM events"""


AFTER_CLICKS = query(
    """
    SELECT r.uid, r.mid, coalesce(u.score, r.score) AS score, r."timestamp"
    FROM ratings r LEFT JOIN updates u ON u.uid = r.uid AND u.mid = r.mid
    UNION ALL
    SELECT uid, mid, score, "timestamp" FROM updates u
    WHERE NOT EXISTS (SELECT 1 FROM ratings r WHERE r.uid = u.uid AND r.mid = u.mid)""",
    clicks=STAR_CLICKS,
    updates="""
    SELECT uid, mid, score, "timestamp" FROM (
        SELECT *, row_number() OVER (PARTITION BY uid, mid ORDER BY "timestamp" DESC, score DESC) AS pos FROM clicks)
    WHERE pos = 1""",
)


@check("ingest_rating_events", AFTER_CLICKS)
def ingest_rating_events(spark, folder):
    return _ingested(spark, folder)[0]


@check("ingest_rating_history", query('SELECT uid, mid, score, "timestamp" FROM clicks', clicks=STAR_CLICKS))
def ingest_rating_history(spark, folder):
    """The history rows of the same ingest, one per click."""
    return _ingested(spark, folder)[1]


@check("ingest_rating_log", query(
    """
    SELECT concat('MOVIE_RATING_PREFIX:', CAST(uid AS VARCHAR), '|', CAST(mid AS VARCHAR), '|',
                  CAST(score AS VARCHAR), '|', CAST("timestamp" AS VARCHAR)) AS "value" FROM clicks""",
    clicks=STAR_CLICKS,
))
def ingest_rating_log(spark, folder):
    """The log lines of the same ingest, one per click."""
    return _ingested(spark, folder)[2]


def _after_ingest(spark, folder):
    store = TableStore(spark, scratch(spark, "store"))
    store.overwrite("Rating", sample.ratings(spark, folder))
    ingest.store_ratings(store, _ingested(spark, folder)[1])
    return store


@check("ingest_stored_ratings", AFTER_CLICKS)
def ingest_stored_ratings(spark, folder):
    """Rating after the same ingest into its stored buckets."""
    return _after_ingest(spark, folder).read("Rating")


@check("ingest_stored_clicks", query(
    'SELECT uid, mid, max("timestamp") AS "timestamp" FROM clicks GROUP BY uid, mid', clicks=STAR_CLICKS))
def ingest_stored_clicks(spark, folder):
    """The times of the applied clicks after the same ingest."""
    return _after_ingest(spark, folder).read("RatingClicks")


def _ingested(spark, folder):
    """Every event as a star click with a time in milliseconds."""
    n = sample.table(spark, folder, "part").agg(F.count("*").alias("n"))
    clicks = sample.table(spark, folder, "events").select(
        F.col("user_id").cast("int").alias("uid"), (F.col("event_id") % n.scalar()).cast("int").alias("mid"),
        (1 + F.col("event_id") % 10).cast("double").alias("stars"),
        F.unix_millis(F.col("ts").cast("timestamp")).alias("timestamp"),
    )
    return ingest.ingest_ratings(clicks, sample.ratings(spark, folder))
