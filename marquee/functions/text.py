"""Tokenisation shared by content profiles and search."""

from pyspark.sql import Column
from pyspark.sql import functions as F

from marquee.functions.scalars import _c


def blank_tokens(text) -> Column:
    """Lower-cased pieces between single whitespace characters; empty pieces are kept."""
    return F.split(F.lower(_c(text)), r"\s")


def word_tokens(text) -> Column:
    """Lower-cased runs of letters and digits."""
    return F.filter(
        F.split(F.lower(_c(text)), r"[^\p{L}\p{N}]+"), lambda token: token != F.lit("")
    )


def term_bucket(term, buckets) -> Column:
    """Bucket of a term for hashed term frequencies (32-bit Murmur3 of its UTF-8 bytes)."""
    return F.pmod(F.hash(_c(term)), F.lit(buckets)).cast("int")


def one_letter_removed(word) -> Column:
    """Every string reached from ``word`` by removing one letter."""
    word = _c(word)
    return F.transform(
        F.sequence(F.lit(1), F.greatest(F.length(word), F.lit(1))),
        lambda i: F.concat(F.substring(word, F.lit(1), i - 1), F.substring(word, i + 1, F.length(word))),
    )


def deletion_neighbourhood(word, max_deletions) -> Column:
    """``word`` and all strings reached by removing up to ``max_deletions`` (0-2) letters.

    Two words within edit distance d always share a member of their d-deletion
    neighbourhoods, which turns a fuzzy match into an equi-join.
    """
    word = _c(word)
    once = F.when(F.length(word) > 0, one_letter_removed(word)).otherwise(F.array(word))
    layers = {0: F.array(word), 1: F.concat(F.array(word), once)}
    twice = F.flatten(F.transform(once, lambda w: F.when(F.length(w) > 0, one_letter_removed(w)).otherwise(F.array(w))))
    layers[2] = F.concat(layers[1], twice)
    chosen = F.when(F.lit(max_deletions) <= 0, layers[0]) if isinstance(max_deletions, int) else F.when(max_deletions <= 0, layers[0])
    depth = F.lit(max_deletions) if isinstance(max_deletions, int) else max_deletions
    return F.array_distinct(chosen.when(depth == 1, layers[1]).otherwise(layers[2]))
