"""Small helpers on frames that several operators share."""

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

WORD_BREAK = r"[\x20\x09-\x0D]+"


def table(spark, folder, name) -> DataFrame:
    return spark.read.parquet(f"{folder}/{name}.parquet")


def bucket_of(column, n):
    """crc32 of a number's decimal text modulo ``n``; null stays null."""
    return F.crc32(F.col(column).cast("string").cast("binary")) % n


def words_of(column):
    """The array of words of a text; none for null or blank text."""
    parts = F.split(F.coalesce(F.col(column), F.lit("")), WORD_BREAK)
    return F.array_remove(parts, "")


def bound(df: DataFrame, **columns) -> DataFrame:
    """Adds columns that later expressions refer to without computing them again.

    The optimiser merges plain projections, which would evaluate an array inside each step of a
    lambda over it; a one-element generator is a barrier to that.
    """
    for name, column in columns.items():
        df = df.select("*", F.explode(F.array(column)).alias(name))
    return df


def shielded(df: DataFrame, known):
    """``df`` with its columns other than ``known`` under neutral names, and the way back.

    Lets an operator add its own columns to a table whose extra columns may have the same names.
    """
    names = {c: f"_extra{i}" for i, c in enumerate(c for c in df.columns if c not in known)}
    columns = df.columns

    def restore(out):
        return out.select(*[F.col(names.get(c, c)).alias(c) for c in columns])

    return df.select(*[F.col(f"`{c}`").alias(names.get(c, c)) for c in columns]), restore


def hashed_order(column):
    """A fixed random order of ids."""
    return F.xxhash64(F.col(column))
