"""Delimited text sources: movies (``^``), ratings and tags (``,``)."""

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from marquee import schemas

CORRUPT = "_corrupt_record"


def _read(spark, path, schema, sep, mode):
    if mode.upper() == "PERMISSIVE":
        return _read_permissive(spark, path, schema, sep)
    rows = (
        spark.read.schema(schema)
        .option("sep", sep)
        .option("quote", "")
        .option("mode", mode)
        # A pruned scan does not notice missing fields.
        .option("columnPruning", False)
        .option("ignoreLeadingWhiteSpace", True)
        .option("ignoreTrailingWhiteSpace", True)
        .csv(path)
    )
    # Empty fields are empty strings in the data model, not nulls; an empty number fails the scan.
    return rows.select(*[_filled(f, mode) for f in schema.fields])


def _filled(field, mode):
    if isinstance(field.dataType, T.StringType):
        return F.coalesce(field.name, F.lit("")).alias(field.name)
    if mode.upper() != "FAILFAST":
        return F.col(field.name)
    missing = F.raise_error(F.lit(f"a line has no {field.name}")).cast(field.dataType)
    return F.coalesce(field.name, missing).alias(field.name)


def _read_permissive(spark, path, schema, sep):
    """All lines; one with a wrong number of fields or an unreadable number only fills CORRUPT."""
    parts = F.split("value", f"[{sep}]" if sep != "^" else r"\^")
    fields = [
        F.trim(F.get(parts, F.lit(i))).try_cast(f.dataType).alias(f.name) for i, f in enumerate(schema.fields)
    ]
    lines = spark.read.text(path).select("value", F.size(parts).alias("found"), F.struct(*fields).alias("row"))
    complete = F.col("found") == len(schema.fields)
    for field in schema.fields:
        complete = complete & F.col("row")[field.name].isNotNull()
    return lines.select(
        *[F.when(complete, F.col("row")[f.name]).alias(f.name) for f in schema.fields],
        F.when(~complete, F.col("value")).alias(CORRUPT),
    )


def read_movies(spark: SparkSession, path, mode="FAILFAST") -> DataFrame:
    return _read(spark, path, schemas.MOVIE, "^", mode)


def read_ratings(spark: SparkSession, path, mode="FAILFAST") -> DataFrame:
    return _read(spark, path, schemas.RATING, ",", mode)


def read_tags(spark: SparkSession, path, mode="FAILFAST") -> DataFrame:
    return _read(spark, path, schemas.TAG, ",", mode)


def good_rows(rows: DataFrame) -> DataFrame:
    """Rows of a permissive scan that parsed in full."""
    return rows.filter(F.col(CORRUPT).isNull()).drop(CORRUPT)


def quarantined(rows: DataFrame) -> DataFrame:
    """The raw text of the rows of a permissive scan that did not parse."""
    return rows.filter(F.col(CORRUPT).isNotNull()).select(F.col(CORRUPT).alias("value"))


def parse_movie_lines(lines: DataFrame, column="value") -> DataFrame:
    """Movie columns from a frame of ``^``-separated lines; unusable lines have a null ``mid``."""
    parts = F.split(F.col(column), r"\^")
    text = lambda i: F.trim(F.get(parts, F.lit(i)))
    whole = F.size(parts) >= len(schemas.MOVIE_COLUMNS)
    mid = F.when(whole, text(0).try_cast("int"))
    return lines.select(
        mid.alias("mid"),
        *[text(i).alias(name) for i, name in enumerate(schemas.MOVIE_COLUMNS) if i],
    )


def movie_lines(movies: DataFrame) -> DataFrame:
    """The ``^``-separated text of a movie table, one line per row."""
    return movies.select(
        F.concat_ws("^", *[F.col(c).cast("string") for c in schemas.MOVIE_COLUMNS]).alias("value")
    )
