"""Similar items from the words of their genres: tf-idf profiles and cosine."""

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from marquee.functions import scalars as S
from marquee.functions import text as X
from marquee.operators.similarity import SimilarItems, assign_profiles, similar_items, sparse_pairs
from marquee.session import written


def genre_tokens(movies: DataFrame) -> DataFrame:
    """(mid, tokens): lower-cased genre words of each movie."""
    return movies.select("mid", X.blank_tokens(S.genres_as_text("genres")).alias("tokens"))


def term_frequencies(tokens: DataFrame, buckets=None) -> DataFrame:
    """(mid, term, tf); with ``buckets`` the term is a hash bucket, as text."""
    words = tokens.select("mid", F.explode("tokens").alias("word"))
    term = F.col("word") if buckets is None else X.term_bucket("word", buckets).cast("string")
    return words.select("mid", term.alias("term")).groupBy("mid", "term").agg(F.count("*").alias("tf"))


def tf_idf(frequencies: DataFrame, items=None) -> DataFrame:
    """(mid, term, tf, df, idf, tfidf) with idf = ln((N + 1) / (df + 1)).

    ``items`` is the table that N counts; by default the items that have a term.
    """
    counted = (frequencies.select("mid").distinct() if items is None else items).agg(F.count("*").alias("n"))
    df = frequencies.groupBy("term").agg(F.count("*").alias("df"))
    idf = F.log((counted.scalar() + 1) / (F.col("df") + 1))
    return frequencies.join(df.withColumn("idf", idf), "term").select(
        "mid", "term", "tf", "df", "idf", (F.col("tf") * F.col("idf")).alias("tfidf")
    )


def content_profiles(movies: DataFrame, buckets=None):
    """(members, weights): profiles of equal term counts and their tf-idf weights.

    Every movie counts in df and N; the weights exist once per profile.
    """
    tokens = genre_tokens(movies)
    members = assign_profiles(tokens, F.array_sort("tokens"))
    sizes = members.groupBy("pid").agg(F.count("*").alias("size"))
    heads = tokens.withColumnRenamed("mid", "pid").join(sizes, "pid")
    term = F.col("word") if buckets is None else X.term_bucket("word", buckets).cast("string")
    frequencies = (
        heads.select("pid", "size", F.explode("tokens").alias("word"))
        .select("pid", "size", term.alias("term"))
        .groupBy("pid", "size", "term").agg(F.count("*").alias("tf"))
    )
    total = tokens.agg(F.count("*").alias("n"))
    df = frequencies.groupBy("term").agg(F.sum("size").alias("df"))
    weights = frequencies.join(df, "term").select(
        "pid", "term", "df", (F.col("tf") * F.log((total.scalar() + 1) / (F.col("df") + 1))).alias("w")
    )
    return members, weights


def similar_by_content(movies: DataFrame, threshold=0.6, buckets=None, block_rows=512) -> SimilarItems:
    """Similar movies by cosine of genre tf-idf, see ``similarity`` for the two tables."""
    members, weights = content_profiles(movies, buckets)
    members = written(members, "members")
    weights = written(weights, "weights")
    found = sparse_pairs(weights, threshold, block_rows)
    return similar_items(members, found, weights.filter(F.col("w") != 0).select("pid").distinct())
