"""The batch and streaming jobs: stored tables in, stored tables out."""

from pyspark.sql import functions as F

from marquee import schemas
from marquee.operators import content, factors, postings, search, serving, similarity, statistics
from marquee.sources import delimited, streams
from marquee.sources.tables import TableStore, search_documents
from marquee.streaming import live, rating_log


def load(store: TableStore, movies_path, ratings_path, tags_path, mode="FAILFAST"):
    """Delimited files to Movie, Rating, Tag, SearchDocument and its indexes.

    In PERMISSIVE mode unreadable lines go to MovieRejects, RatingRejects and TagRejects.
    """
    readers = {
        "Movie": (delimited.read_movies, movies_path),
        "Rating": (delimited.read_ratings, ratings_path),
        "Tag": (delimited.read_tags, tags_path),
    }
    stored = {}
    for name, (reader, path) in readers.items():
        rows = reader(store.spark, path, mode)
        if mode.upper() == "PERMISSIVE":
            store.overwrite(f"{name}Rejects", delimited.quarantined(rows))
            rows = delimited.good_rows(rows)
        stored[name] = store.overwrite(name, rows)
    documents = search_documents(statistics.movies_with_tags(stored["Movie"], stored["Tag"]))
    stored["SearchDocument"] = store.overwrite("SearchDocument", documents)
    return {**stored, **index_documents(store)}


def index_documents(store: TableStore):
    """SearchDocument to SearchPostings, SearchWords and SearchSize, the index of searches and more-like-this."""
    documents = store.read("SearchDocument")
    fields = postings.split_fields(documents, "mid", schemas.MOVIE_TEXT)
    blocks = store.overwrite("SearchPostings", postings.laid_out(postings.block_rows(fields)), ("bucket",))
    words = postings.laid_out(postings.word_rows(blocks, fields))
    return {
        "SearchPostings": blocks,
        "SearchWords": store.overwrite("SearchWords", words, ("bucket",)),
        "SearchSize": store.overwrite("SearchSize", postings.document_count(fields)),
    }


def posting_index(store: TableStore) -> postings.Postings:
    blocks, words, size = (store.read(name) for name in ("SearchPostings", "SearchWords", "SearchSize"))
    return postings.Postings(blocks, words, schemas.MOVIE_TEXT, size)


def movie_search(store: TableStore, queries, n, fields=("name", "descri")):
    """Full-text search of (query_id, text) in the stored documents."""
    return search.multi_match(store.read("SearchDocument"), "mid", fields, queries, n, posting_index(store))


def movies_like(store: TableStore, n, seeds=None):
    """(seed, rank, mid, score): stored documents like each of ``seeds`` (mid), over all text fields."""
    return search.more_like_this(
        store.read("SearchDocument"), "mid", schemas.MOVIE_TEXT, n, seeds, posting_index(store))


def compute_statistics(store: TableStore, genres=schemas.DEFAULT_GENRES):
    ratings, movies = store.read("Rating"), store.read("Movie")
    averages = store.overwrite("AverageMovies", statistics.average_movies(ratings))
    return {
        "RateMoreMovies": store.overwrite("RateMoreMovies", statistics.rate_more_movies(ratings)),
        "RateMoreRecentlyMovies": store.overwrite(
            "RateMoreRecentlyMovies", statistics.rate_more_recently(ratings)
        ),
        "AverageMovies": averages,
        "GenresTopMovies": store.overwrite(
            "GenresTopMovies", statistics.genres_top_movies(movies, averages, genres)
        ),
    }


def store_similar(store: TableStore, name, index: similarity.SimilarItems, kept=None):
    """The whole result as members and pairs; lists of the first ``kept`` per movie only if asked for."""
    stored = similarity.SimilarItems(
        store.overwrite(f"{name}Members", index.members), store.overwrite(f"{name}Pairs", index.pairs)
    )
    if kept is not None:
        store.overwrite(name, similarity.neighbour_lists(stored, kept))
    return stored


def stored_similar(store: TableStore, name) -> similarity.SimilarItems:
    return similarity.SimilarItems(store.read(f"{name}Members"), store.read(f"{name}Pairs"))


def similar_movies(store: TableStore, requests, n, name="ContentMovieRecs"):
    """Request columns with the first ``n`` similar movies, for any ``n``: read from the whole result."""
    lists = similarity.neighbour_lists(stored_similar(store, name), n, requests)
    return serving.lookup(requests, lists, "mid", n)


def collaborative_filtering(store: TableStore, threshold=0.6, kept=None, **settings):
    """ALS on Rating: UserRecs, and similar movies by rating factors."""
    model = factors.train(store.read("Rating"), **settings)
    store.overwrite("UserRecs", factors.user_lists(model))
    return store_similar(store, "MovieRecs", factors.similar_by_factors(model, threshold), kept)


def parameter_search(store: TableStore, **grid):
    """The whole ALS grid as a table; see ``factors.best_parameters`` for the winner."""
    train_set, test_set = factors.split_ratings(store.read("Rating"))
    return store.overwrite("AlsGrid", factors.grid_search(train_set, test_set, **grid))


def content_similarity(store: TableStore, threshold=0.6, buckets=None, kept=None):
    """Similar movies by genre words; ``buckets`` hashes the words as a 50-slot vector would."""
    index = content.similar_by_content(store.read("Movie"), threshold, buckets)
    return store_similar(store, "ContentMovieRecs", index, kept)


def log_filter(lines, sink):
    """Stream of log lines to a stream of rating messages; ``sink`` makes the writer."""
    return sink(rating_log.rating_messages(lines))


def live_lists(store: TableStore, root, similar) -> live.LiveLists:
    """The handler on the stored tables, each read anew for each batch; history and Rating have the same buckets."""

    def applied(buckets=None):
        if store.exists("RatingClicks"):
            return store.read("RatingClicks", buckets=buckets)
        return store.spark.createDataFrame([], schemas.TABLES["RatingClicks"])

    return live.LiveLists(
        store.spark, root, lambda: stored_similar(store, similar), lambda buckets=None: store.read("Rating", buckets=buckets),
        buckets=store.buckets, load_clicks=applied, load_buckets=True)


def live_recommendations(store: TableStore, lines, root, checkpoint, similar="MovieRecs", trigger=live.TRIGGER):
    """(handler, writer) of the real-time job on a stream of log lines or rating messages."""
    handler = live_lists(store, root, similar)
    ratings = rating_log.ratings_from_log(lines)
    return handler, handler.writer(ratings, checkpoint, trigger)


def topic_jobs(store: TableStore, servers, root, checkpoint):
    """Log filter and real-time job between Kafka topics: (message writer, handler, list writer)."""
    spark = store.spark
    lines = streams.topic_source(spark, servers, streams.LOG_TOPIC)
    messages = log_filter(lines, lambda m: streams.topic_sink(m, servers, f"{checkpoint}/filter"))
    ratings = rating_log.parse_messages(streams.topic_source(spark, servers, streams.RATING_TOPIC))
    handler = live_lists(store, root, "MovieRecs")
    return messages, handler, handler.writer(ratings, f"{checkpoint}/lists")


def refresh_stream_recs(store: TableStore, handler: live.LiveLists):
    """Publish the newest list of each user as StreamRecs."""
    return store.overwrite("StreamRecs", handler.latest().select("uid", F.col("recs")))
