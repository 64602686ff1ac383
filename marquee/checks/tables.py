"""Sources, sinks and table updates."""

from pyspark.sql import functions as F

from marquee import schemas
from marquee.checks import check
from marquee.checks.sql import query
from marquee.operators import merges, statistics
from marquee.session import scratch
from marquee.sources import delimited, sample
from marquee.sources.tables import TableStore, search_documents


@check("scan_movies", query("SELECT * FROM movies"))
def scan_movies(spark, folder):
    path = scratch(spark, "movies-text")
    delimited.movie_lines(sample.movies(spark, folder)).write.text(path)
    return delimited.read_movies(spark, path)


def _written_csv(rows, label):
    path = scratch(rows.sparkSession, label)
    rows.write.csv(path)
    return path


@check("scan_ratings", query("SELECT * FROM ratings"))
def scan_ratings(spark, folder):
    return delimited.read_ratings(spark, _written_csv(sample.ratings(spark, folder), "ratings-text"))


@check("scan_tags", query("SELECT * FROM tags"))
def scan_tags(spark, folder):
    return delimited.read_tags(spark, _written_csv(sample.tags(spark, folder), "tags-text"))


@check("scan_table", query("SELECT * FROM tags"))
def scan_table(spark, folder):
    store = TableStore(spark, scratch(spark, "store"))
    store.overwrite("Tag", sample.tags(spark, folder))
    return store.read("Tag")


@check("write_table_roundtrip", query("SELECT mid, round(avg, 6) AS avg FROM averages"))
def write_table_roundtrip(spark, folder):
    """An overwrite of a table that is already there."""
    store = TableStore(spark, scratch(spark, "store"))
    ratings = sample.ratings(spark, folder)
    store.overwrite("AverageMovies", ratings.select("mid", F.col("score").alias("avg")))
    store.overwrite("AverageMovies", statistics.average_movies(ratings))
    return store.read("AverageMovies").select("mid", F.round("avg", 6).alias("avg"))


TAG_TEXT = "SELECT mid, string_agg(tag, '|' ORDER BY tag) AS tags FROM (SELECT DISTINCT mid, tag FROM tags) GROUP BY mid"
DOCUMENTS = "SELECT m.*, t.tags FROM movies m LEFT JOIN tag_text t ON t.mid = m.mid"


@check("search_documents", query("SELECT * FROM docs", tag_text=TAG_TEXT, docs=DOCUMENTS))
def documents_table(spark, folder):
    store = TableStore(spark, scratch(spark, "store"))
    joined = statistics.movies_with_tags(sample.movies(spark, folder), sample.tags(spark, folder))
    return store.overwrite("SearchDocument", search_documents(joined))


@check("rating_upsert", query(
    """
    SELECT r.uid, r.mid, coalesce(u.score, r.score) AS score, r."timestamp"
    FROM ratings r LEFT JOIN updates u ON u.uid = r.uid AND u.mid = r.mid
    UNION ALL
    SELECT uid, mid, score, "timestamp" FROM updates u
    WHERE NOT EXISTS (SELECT 1 FROM ratings r WHERE r.uid = u.uid AND r.mid = u.mid)""",
    updates="""
    SELECT uid, mid, score, "timestamp" FROM (
        SELECT *, row_number() OVER (PARTITION BY uid, mid ORDER BY "timestamp" DESC, score DESC) AS pos
        FROM stream_ratings) WHERE pos = 1""",
))
def rating_upsert(spark, folder):
    return merges.upsert_ratings(sample.ratings(spark, folder), stream_ratings(spark, folder))


def stream_ratings(spark, folder):
    """The ratings of the web log, read as a batch."""
    from marquee.streaming.rating_log import ratings_from_log

    return ratings_from_log(sample.log_lines(spark, folder))


@check("tag_append", query(
    """
    SELECT d.mid, CASE WHEN a.added IS NULL THEN d.tags ELSE concat_ws('|', d.tags, a.added) END AS tags
    FROM docs d LEFT JOIN added a ON a.mid = d.mid""",
    tag_text="""
    SELECT mid, string_agg(tag, '|' ORDER BY tag) AS tags
    FROM (SELECT DISTINCT mid, tag FROM tags WHERE tag <> 'purchase') GROUP BY mid""",
    docs=DOCUMENTS,
    added="""
    SELECT mid, string_agg(concat(tag, '-', uid), '|' ORDER BY "timestamp", uid) AS added
    FROM tags WHERE tag = 'purchase' GROUP BY mid""",
))
def tag_append(spark, folder):
    """Documents carry the other tags; the purchases arrive as new tags."""
    tags = sample.tags(spark, folder)
    documents = statistics.movies_with_tags(
        sample.movies(spark, folder), tags.filter(F.col("tag") != "purchase")
    )
    new = tags.filter(F.col("tag") == "purchase").withColumn("tag", F.concat_ws("-", "tag", "uid"))
    return merges.append_tags(documents, new, ["timestamp", "uid"]).select("mid", "tags")


@check("delete_by_key", query(
    """
    SELECT * FROM ratings r
    WHERE NOT EXISTS (SELECT 1 FROM stream_ratings s WHERE s.uid = r.uid AND s.mid = r.mid)"""
))
def delete_by_key(spark, folder):
    return merges.delete_by_key(
        sample.ratings(spark, folder), stream_ratings(spark, folder), ["uid", "mid"]
    ).select(*schemas.RATING.names)


@check("delete_tags_by_key", query(
    """
    SELECT * FROM tags t
    WHERE NOT EXISTS (SELECT 1 FROM stream_ratings s
                      WHERE s.uid = t.uid AND s.mid = t.mid AND t.tag = 'purchase')"""
))
def delete_tags_by_key(spark, folder):
    doomed = stream_ratings(spark, folder).select("uid", "mid", F.lit("purchase").alias("tag"))
    return merges.delete_by_key(
        sample.tags(spark, folder), doomed, ["uid", "mid", "tag"]
    ).select(*schemas.TAG.names)


@check("user_prefs_update", query(
    """
    SELECT u.uid, u.username, CASE WHEN p.wanted IS NULL THEN u."first" ELSE false END AS "first",
           concat_ws('|', nullif(array_to_string(u."prefGenres", '|'), ''), p.wanted) AS prefs
    FROM users u LEFT JOIN asked p ON p.username = u.username""",
    asked="""
    SELECT c_name AS username,
           string_agg(concat(upper(c_mktsegment), '|', event_type), '|' ORDER BY ts, event_id) AS wanted
    FROM events JOIN customer ON user_id = c_custkey WHERE event_type IN ('signup', 'view') GROUP BY c_name""",
))
def user_prefs_update(spark, folder):
    """Signups and views of a user ask for the user's market segment and the event name."""
    events = sample.table(spark, folder, "events").filter(F.col("event_type").isin("signup", "view"))
    customers = sample.table(spark, folder, "customer")
    prefs = events.join(customers, F.col("user_id") == F.col("c_custkey")).select(
        F.col("c_name").alias("username"),
        F.concat_ws(",", F.upper("c_mktsegment"), "event_type").alias("genres"),
        F.struct("ts", "event_id").alias("timestamp"),
    )
    updated = merges.update_preferences(sample.users(spark, folder), prefs)
    return updated.select("uid", "username", "first", F.array_join("prefGenres", "|").alias("prefs"))
