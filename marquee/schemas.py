"""Fixed table schemas. Tables are never read with schema inference."""

from pyspark.sql import types as T

# The fields of a movie line, in order.
MOVIE_COLUMNS = (
    "mid", "name", "descri", "timelong", "issue",
    "shoot", "language", "genres", "actors", "directors",
)

MOVIE = T.StructType(
    [T.StructField("mid", T.IntegerType())]
    + [T.StructField(c, T.StringType()) for c in MOVIE_COLUMNS[1:]]
)

RATING = T.StructType([
    T.StructField("uid", T.IntegerType()),
    T.StructField("mid", T.IntegerType()),
    T.StructField("score", T.DoubleType()),
    T.StructField("timestamp", T.IntegerType()),
])

TAG = T.StructType([
    T.StructField("uid", T.IntegerType()),
    T.StructField("mid", T.IntegerType()),
    T.StructField("tag", T.StringType()),
    T.StructField("timestamp", T.IntegerType()),
])

USER = T.StructType([
    T.StructField("uid", T.IntegerType()),
    T.StructField("username", T.StringType()),
    T.StructField("first", T.BooleanType()),
    T.StructField("timestamp", T.LongType()),
    T.StructField("prefGenres", T.ArrayType(T.StringType())),
])

RECOMMENDATION = T.StructType([
    T.StructField("mid", T.IntegerType()),
    T.StructField("score", T.DoubleType()),
])

RECS = T.ArrayType(RECOMMENDATION)


def _keyed_recs(key, key_type):
    return T.StructType([T.StructField(key, key_type), T.StructField("recs", RECS)])


SEARCH_DOCUMENT = T.StructType(list(MOVIE.fields) + [T.StructField("tags", T.StringType())])

# The text fields that a movie search looks at.
MOVIE_TEXT = ("name", "descri", "genres", "actors", "directors", "tags")

# The inverted index: postings of a word of a field in one part of the documents, and the words.
SEARCH_POSTINGS = T.StructType([
    T.StructField("field", T.IntegerType()),
    T.StructField("word", T.StringType()),
    T.StructField("part", T.LongType()),
    T.StructField("docs", T.ArrayType(T.LongType())),
    T.StructField("weights", T.ArrayType(T.DoubleType())),
    T.StructField("most", T.DoubleType()),
    T.StructField("bucket", T.IntegerType()),
])
SEARCH_WORDS = T.StructType([
    T.StructField("field", T.IntegerType()),
    T.StructField("word", T.StringType()),
    T.StructField("df", T.LongType()),
    T.StructField("idf", T.DoubleType()),
    T.StructField("most", T.DoubleType()),
    T.StructField("bucket", T.IntegerType()),
])

# Similar movies: the profile of each movie, and scores between profiles.
MEMBERS = T.StructType([
    T.StructField("mid", T.IntegerType()),
    T.StructField("pid", T.IntegerType()),
])
PAIRS = T.StructType([
    T.StructField("pid", T.IntegerType()),
    T.StructField("other", T.IntegerType()),
    T.StructField("score", T.DoubleType()),
    T.StructField("size", T.LongType()),
    T.StructField("before", T.LongType()),
    T.StructField("tie", T.LongType()),
])

# Names of the stored tables.
TABLES = {
    "Movie": MOVIE,
    "Rating": RATING,
    "RatingClicks": T.StructType([
        T.StructField("uid", T.IntegerType()),
        T.StructField("mid", T.IntegerType()),
        T.StructField("timestamp", T.IntegerType()),
    ]),
    "Tag": TAG,
    "User": USER,
    "SearchDocument": SEARCH_DOCUMENT,
    "SearchPostings": SEARCH_POSTINGS,
    "SearchWords": SEARCH_WORDS,
    "SearchSize": T.StructType([T.StructField("documents", T.LongType())]),
    "RateMoreMovies": T.StructType([
        T.StructField("mid", T.IntegerType()),
        T.StructField("count", T.LongType()),
    ]),
    "RateMoreRecentlyMovies": T.StructType([
        T.StructField("mid", T.IntegerType()),
        T.StructField("count", T.LongType()),
        T.StructField("yearmonth", T.IntegerType()),
    ]),
    "AverageMovies": T.StructType([
        T.StructField("mid", T.IntegerType()),
        T.StructField("avg", T.DoubleType()),
    ]),
    "GenresTopMovies": _keyed_recs("genres", T.StringType()),
    "UserRecs": _keyed_recs("uid", T.IntegerType()),
    "StreamRecs": _keyed_recs("uid", T.IntegerType()),
    "MovieRecsMembers": MEMBERS,
    "MovieRecsPairs": PAIRS,
    "MovieRecs": _keyed_recs("mid", T.IntegerType()),
    "ContentMovieRecsMembers": MEMBERS,
    "ContentMovieRecsPairs": PAIRS,
    "ContentMovieRecs": _keyed_recs("mid", T.IntegerType()),
    "AlsGrid": T.StructType([
        T.StructField("rank", T.IntegerType()),
        T.StructField("reg_param", T.DoubleType()),
        T.StructField("rmse", T.DoubleType()),
    ]),
}

# Fixed value: the genre names the per-genre statistics report on by default.
DEFAULT_GENRES = (
    "Action", "Adventure", "Animation", "Comedy", "Crime", "Documentary", "Drama",
    "Family", "Fantasy", "Foreign", "History", "Horror", "Music", "Mystery",
    "Romance", "Science", "Tv", "Thriller", "War", "Western",
)

# Fixed value: marks a rating inside a free-text log line.
RATING_LOG_PREFIX = "MOVIE_RATING_PREFIX:"
