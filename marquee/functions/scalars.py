"""Column functions for the fields of movies, ratings, tags and log lines."""

from pyspark.sql import Column
from pyspark.sql import functions as F

from marquee.schemas import RATING_LOG_PREFIX

# Epoch values above this are milliseconds: as seconds they would lie beyond the year 5000.
MILLIS_FLOOR = 100_000_000_000

HALF_STARS = 10

# Added before rounding, so that a value whose exact decimal ends in 5 rounds up even when the
# last bit of the double falls below it.
TIE_SLACK = 1e-10


def _c(column) -> Column:
    return F.col(column) if isinstance(column, str) else column


def epoch_seconds(timestamp) -> Column:
    """Whole epoch seconds of a timestamp column, with or without a zone."""
    return F.unix_seconds(_c(timestamp).cast("timestamp"))


def as_epoch_seconds(epoch, unit=None) -> Column:
    """Whole seconds from an epoch number in the ``unit`` of its source, "seconds" or "millis".

    Without a unit large numbers count as milliseconds, which misreads those before March 1973.
    """
    value = _c(epoch).cast("long")
    if unit is not None:
        return F.floor(value / {"seconds": 1, "millis": 1000}[unit]).cast("int")
    return (
        F.when(F.abs(value) >= MILLIS_FLOOR, F.floor(value / 1000)).otherwise(value).cast("int")
    )


def yearmonth(epoch) -> Column:
    """Epoch seconds to the integer yyyyMM of the UTC calendar, independent of session zone."""
    day = F.date_from_unix_date(F.floor(_c(epoch) / 86400).cast("int"))
    return (F.year(day) * 100 + F.month(day)).cast("int")


def genres_as_text(genres) -> Column:
    return F.translate(_c(genres), "|", " ")


def genre_array(genres) -> Column:
    return F.split(_c(genres), "[|]")


def genre_matches(genres, genre) -> Column:
    """Case-insensitive substring test, so "War" also matches "Warrior"."""
    return F.contains(F.lower(_c(genres)), F.lower(_c(genre)))


def matched_genres(genres, names) -> Column:
    """The names, out of a fixed list, that ``genres`` matches, as an array."""
    catalogue = F.array(*[F.lit(n) for n in names])
    return F.filter(catalogue, lambda name: genre_matches(genres, name))


def over(value, threshold) -> Column:
    """``value > threshold`` with NaN and null as no match."""
    return ~F.isnan(_c(value)) & _c(value).isNotNull() & (_c(value) > F.lit(threshold))


def stars_to_score(stars) -> Column:
    """A 1-10 star click to the 0.5-5.0 scale."""
    return F.round(_c(stars) / 2, 2)


def half_star_bin(score) -> Column:
    """Nearest half-star step, ties upward."""
    return F.floor(_c(score) / 0.5 + 0.5).cast("int")


def rating_log_line(uid, mid, score, seconds) -> Column:
    fields = [_c(x).cast("string") for x in (uid, mid, score, seconds)]
    return F.concat(F.lit(RATING_LOG_PREFIX), F.concat_ws("|", *fields))


def has_rating(line) -> Column:
    return F.contains(_c(line), F.lit(RATING_LOG_PREFIX))


def rating_payload(line) -> Column:
    """Text between the first and second prefix of a log line, trimmed; null without a prefix."""
    return F.trim(F.get(F.split(_c(line), RATING_LOG_PREFIX), F.lit(1)))


def message_fields(message, unit=None) -> Column:
    """``uid|mid|score|timestamp`` as a struct; null when any field does not parse."""
    part = F.split(_c(message), "[|]")
    number = lambda i, kind: F.trim(F.get(part, F.lit(i))).try_cast(kind)
    uid, mid, score, stamp = number(0, "int"), number(1, "int"), number(2, "double"), number(3, "long")
    complete = uid.isNotNull() & mid.isNotNull() & score.isNotNull() & stamp.isNotNull()
    return F.when(
        complete,
        F.struct(
            uid.alias("uid"), mid.alias("mid"), score.alias("score"),
            as_epoch_seconds(stamp, unit).alias("timestamp"),
        ),
    )


def history_items(items) -> Column:
    """``mid:score`` strings as an array of (mid, score)."""

    def parse(item):
        pair = F.split(item, ":")
        return F.struct(
            F.trim(F.get(pair, F.lit(0))).try_cast("int").alias("mid"),
            F.trim(F.get(pair, F.lit(1))).try_cast("double").alias("score"),
        )

    return F.transform(_c(items), parse)


def first_word(text) -> Column:
    return F.substring_index(_c(text), " ", 1)


def rank_recs(recs, n=None) -> Column:
    """A rec array in (score desc, mid asc) order, cut to the first ``n``."""
    keyed = F.transform(_c(recs), lambda r: F.struct((-r.score).alias("k"), r.mid.alias("mid"), r.score.alias("score")))
    ordered = F.transform(
        F.array_sort(keyed), lambda r: F.struct(r.mid.alias("mid"), r.score.alias("score"))
    )
    return ordered if n is None else F.slice(ordered, 1, n)


def rounded(value, digits=6) -> Column:
    """Rounding of a computed score whose exact value may be a decimal tie."""
    return F.round(_c(value) + F.lit(TIE_SLACK), digits)


def cosine(a, b) -> Column:
    """Cosine of two arrays of doubles; null when either has zero length."""
    a, b = _c(a), _c(b)
    dot = _sum(F.zip_with(a, b, lambda x, y: x * y))
    return F.try_divide(dot, vector_norm(a) * vector_norm(b))


def vector_norm(v) -> Column:
    return F.sqrt(_sum(F.transform(_c(v), lambda x: x * x)))


def _sum(values) -> Column:
    return F.aggregate(values, F.lit(0.0), lambda acc, x: acc + x)
