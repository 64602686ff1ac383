"""Term weights, cosine, similar items, and the real-time scores in batch form."""

from pyspark.sql import functions as F

from marquee.checks import check
from marquee.checks.sql import query
from marquee.functions import scalars as S
from marquee.operators import content, online, similarity, statistics
from marquee.operators.similarity import SimilarItems
from marquee.session import written
from marquee.sources import sample

KEPT = 20
VECTOR_THRESHOLD = 0.3
# Ratings that one task counts by user and profile.
TASK_RATINGS = 250_000


def content_index(spark, folder, buckets=None):
    """Similar movies by genre words, as stored tables."""
    index = content.similar_by_content(sample.movies(spark, folder), buckets=buckets)
    return SimilarItems(written(index.members, "members"), written(index.pairs, "pairs"))


def vectors(spark, folder):
    return sample.table(spark, folder, "embeddings").select(
        F.col("vec_id").cast("int").alias("mid"), F.col("embedding").cast("array<double>").alias("vec")
    )


def vector_index(spark, folder, keep=None):
    index = similarity.similar_vectors(vectors(spark, folder), VECTOR_THRESHOLD, keep=keep)
    return SimilarItems(written(index.members, "members"), written(index.pairs, "pairs"))


@check("genre_tokens", query("SELECT mid, term FROM words"))
def genre_tokens(spark, folder):
    return content.genre_tokens(sample.movies(spark, folder)).select("mid", F.explode("tokens").alias("term"))


@check("term_freq", query("SELECT mid, term, tf FROM tf"))
def term_freq(spark, folder):
    return content.term_frequencies(content.genre_tokens(sample.movies(spark, folder)))


@check("hashing_tf")
def hashing_tf(spark, folder):
    return content.term_frequencies(content.genre_tokens(sample.movies(spark, folder)), buckets=50)


@check("tf_idf", query("SELECT mid, term, round(idf, 6) AS idf, round(tfidf, 6) AS tfidf FROM tfidf"))
def tf_idf(spark, folder):
    movies = sample.movies(spark, folder)
    weights = content.tf_idf(content.term_frequencies(content.genre_tokens(movies)), movies)
    return weights.select("mid", "term", F.round("idf", 6).alias("idf"), F.round("tfidf", 6).alias("tfidf"))


@check("cosine_pairs", query(
    """
    SELECT a.mid, b.mid AS other,
           round(list_inner_product(a.vec, b.vec)
                 / (sqrt(list_inner_product(a.vec, a.vec)) * sqrt(list_inner_product(b.vec, b.vec))), 6) AS cosine
    FROM all_vectors a JOIN all_vectors b ON b.mid = a.mid + 1 OR b.mid = a.mid + 7""",
))
def cosine_pairs(spark, folder):
    """Cosine of every vector with those one and seven ids further on."""
    a = vectors(spark, folder)
    b = a.select(F.col("mid").alias("other"), F.col("vec").alias("vec2"))
    asked = a.withColumn("step", F.explode(F.array(F.lit(1), F.lit(7)))).withColumn("other", F.col("mid") + F.col("step"))
    return asked.join(b, "other").select(
        "mid", "other", F.round(S.cosine("vec", "vec2"), 6).alias("cosine")
    )


SHIFT = 5_000_000_000


@check("embedding_similar_long_ids", query(
    f"SELECT mid + {SHIFT} AS mid, other + {SHIFT} AS other, score FROM vec_sims"
))
def embedding_similar_long_ids(spark, folder):
    """The same pairs under ids beyond 32 bits, in many small homes."""
    items = vectors(spark, folder).withColumn("mid", F.col("mid").cast("long") + SHIFT)
    pairs = similarity.similar_vectors(items, VECTOR_THRESHOLD, block_rows=100).pairs
    return pairs.filter(F.col("pid") != F.col("other")).select(F.col("pid").alias("mid"), "other", "score")


@check("embedding_members", query(
    "SELECT a.mid, v.mid AS pid FROM all_vectors a JOIN vectors v ON v.vec = a.vec"
))
def embedding_members(spark, folder):
    """The profile of every vector, copies included."""
    return similarity.similar_vectors(vectors(spark, folder), VECTOR_THRESHOLD).members


@check("embedding_similar_items", query("SELECT mid, other, score FROM vec_sims"))
def embedding_similar_items(spark, folder):
    """All pairs above the threshold; copies of a vector stay one profile."""
    index = similarity.similar_vectors(vectors(spark, folder), VECTOR_THRESHOLD)
    return index.pairs.filter(F.col("pid") != F.col("other")).select(F.col("pid").alias("mid"), "other", "score")


PROFILE_PAIRS = """
    SELECT DISTINCT a.pid, b.pid AS other, s.score
    FROM sims s JOIN members a ON a.mid = s.mid JOIN members b ON b.mid = s.other WHERE a.pid <> b.pid"""


@check("content_members", query("SELECT mid, pid FROM members"))
def content_members(spark, folder):
    return content.content_profiles(sample.movies(spark, folder))[0]


@check("content_similar_profiles", query("SELECT pid, other, score FROM profile_pairs", profile_pairs=PROFILE_PAIRS))
def content_similar_profiles(spark, folder):
    """With ``content_members`` the whole similarity relation of the movies."""
    index = content.similar_by_content(sample.movies(spark, folder))
    return index.pairs.filter(F.col("pid") != F.col("other")).select("pid", "other", "score")


@check("content_similar_counts", query(
    "SELECT m.mid, count(s.other) AS neighbours FROM movies m LEFT JOIN sims s ON s.mid = m.mid GROUP BY m.mid"
))
def content_similar_counts(spark, folder):
    return similarity.neighbour_counts(content_index(spark, folder))


@check("content_similar_items", query(f"SELECT mid, rank, other, score FROM sims_ranked WHERE rank <= {KEPT}"))
def content_similar_items(spark, folder):
    return spread(similarity.neighbour_lists(content_index(spark, folder), KEPT))


def spread(lists):
    return lists.select("mid", F.posexplode("recs").alias("at", "r")).select(
        "mid", (F.col("at") + 1).alias("rank"), F.col("r.mid").alias("other"), "r.score"
    )


@check("content_similar_items_hashed")
def content_similar_items_hashed(spark, folder):
    return spread(similarity.neighbour_lists(content_index(spark, folder, buckets=50), KEPT))


@check("sim_lookup", query(
    """
    SELECT l.uid, l.mid, r.mid AS other, CASE WHEN l.mid = r.mid THEN 0.0 ELSE coalesce(s.score, 0.0) END AS score
    FROM last l JOIN recent r ON r.uid = l.uid LEFT JOIN sims s ON s.mid = l.mid AND s.other = r.mid"""
))
def sim_lookup(spark, folder):
    """Similarity of a user's last movie to each of the recent ones."""
    ratings = sample.ratings(spark, folder)
    wanted = online.last_events(ratings).join(
        online.recent_ratings(ratings).select("uid", F.col("mid").alias("other")), "uid"
    )
    return similarity.pair_scores(content_index(spark, folder), wanted)


CANDIDATE_PROFILES = """
    SELECT l.uid, l.mid, b.pid AS other, any_value(s.score) AS score, count(*) AS size,
           count(*) FILTER (WHERE NOT EXISTS (SELECT 1 FROM seen e WHERE e.uid = l.uid AND e.mid = s.other)) AS unseen
    FROM last l JOIN sims s ON s.mid = l.mid JOIN members b ON b.mid = s.other
    GROUP BY l.uid, l.mid, b.pid"""


@check("sim_candidates", query(
    "SELECT uid, mid, other, score, size FROM candidate_profiles", candidate_profiles=CANDIDATE_PROFILES
))
def sim_candidates(spark, folder):
    """Profiles similar to each user's last movie, with the number of their movies."""
    index = content_index(spark, folder)
    return _candidates(index, online.last_events(sample.ratings(spark, folder)))


def _candidates(index, events):
    joined = events.join(index.members, "mid").join(index.pairs, "pid")
    # The movie itself is a member of its own profile but no candidate.
    size = F.col("size") - F.when(F.col("pid") == F.col("other"), 1).otherwise(0)
    return joined.select("uid", "mid", "other", "score", size.alias("size")).filter(F.col("size") > 0)


@check("unseen_candidates", query(
    "SELECT uid, mid, other, score, unseen FROM candidate_profiles WHERE unseen > 0",
    candidate_profiles=CANDIDATE_PROFILES,
))
def unseen_candidates(spark, folder):
    """The same less the movies the user has rated.

    Ratings are counted in tasks of ``TASK_RATINGS`` by user: Spark sizes tasks by compressed bytes, and pairs of
    ids take fifty times as much in a hash table.
    """
    index = content_index(spark, folder)
    ratings = stored_ratings(spark, folder)
    events = written(online.last_events(ratings), "last-events")
    candidates = _candidates(index, events)
    tasks = max(1, -(-ratings.count() // TASK_RATINGS))
    rated = (
        ratings.select("uid", "mid").repartition(tasks, "uid", "mid").distinct().repartition(tasks, "uid")
        .join(events.withColumnRenamed("mid", "event_mid"), "uid")
        .filter(F.col("mid") != F.col("event_mid"))
        .join(index.members, "mid").groupBy("uid", F.col("pid").alias("other")).agg(F.count("*").alias("rated"))
    )
    return candidates.join(rated, ["uid", "other"], "left").select(
        "uid", "mid", "other", "score", (F.col("size") - F.coalesce("rated", F.lit(0))).alias("unseen")
    ).filter(F.col("unseen") > 0)


@check("top_similar_unseen", query("SELECT uid, mid, rank, candidate, score FROM unseen"))
def top_similar_unseen(spark, folder):
    ratings = stored_ratings(spark, folder)
    return similarity.unseen_neighbours(
        content_index(spark, folder), online.last_events(ratings), ratings.select("uid", "mid"), 20
    ).drop("candidate_pid")


@check("recent_ratings", query("SELECT uid, position, mid, score FROM recent"))
def recent_ratings(spark, folder):
    return online.recent_ratings(sample.ratings(spark, folder))


def stored_ratings(spark, folder):
    """The ratings as a stored table."""
    return written(sample.ratings(spark, folder), "ratings")


def scored(spark, folder, ratings, mode="counted", index=None):
    index = index or content_index(spark, folder)
    candidates = similarity.unseen_neighbours(
        index, online.last_events(ratings), ratings.select("uid", "mid"), online.CANDIDATES
    )
    return online.priority_scores(index, candidates, online.recent_ratings(ratings), mode)


@check("stream_priority_scores", query("SELECT uid, mid, score FROM scores"))
def stream_priority_scores(spark, folder):
    return scored(spark, folder, stored_ratings(spark, folder))


@check("stream_priority_scores_legacy", query(
    """
    SELECT m.uid, m.candidate AS mid,
           round(avg(similarity * score) + log10(greatest(count(*) FILTER (WHERE score > 3), 1))
                 - log10(CASE WHEN any_value(d.last_down) IS NULL THEN 1
                              ELSE 1 + count(*) FILTER (WHERE score > 3 AND position < d.last_down) END) + 1e-10::DOUBLE, 6) AS score
    FROM matched m JOIN downs d ON d.uid = m.uid AND d.candidate = m.candidate
    GROUP BY m.uid, m.candidate""",
    downs="SELECT uid, candidate, max(position) FILTER (WHERE score <= 3) AS last_down FROM matched GROUP BY uid, candidate",
))
def stream_priority_scores_legacy(spark, folder):
    return scored(spark, folder, stored_ratings(spark, folder), mode="legacy")


def user_recs(spark, folder, ratings, index=None):
    """(uid, recs) of every user of ``ratings``, as stored lists."""
    return online.user_lists(ratings, scored(spark, folder, ratings, index=index))


@check("genre_recs_by_map", query("SELECT genres, count(*) AS n, round(sum(score), 6) AS total FROM genre_top GROUP BY genres"))
def genre_recs_by_map(spark, folder):
    from marquee.checks.reports import genre_recs

    return statistics.spread_recs(genre_recs(spark, folder), "genres").groupBy("genres").agg(
        F.count("*").alias("n"), F.round(F.sum("score"), 6).alias("total")
    )
