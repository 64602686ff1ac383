"""Substring dedup by relative Lempel-Ziv parsing against an index of all texts.

Reference blocks are cut by content: among the shingles of each window the one with the least hash
is its anchor, and neighbouring windows with one anchor form a block. A window that occurs twice
has the same anchor, at the same place, both times, so equal blocks meet under their anchor and
nothing else has to be compared. Parsing is greedy: a block found whole elsewhere is a factor, and
joins its neighbours. At factor boundaries, where blocks share the anchor but not all words, the
block is checked window by window. Windows inside factors are exactly the windows whose words
start in two places or more.
"""

import hashlib

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from marquee.llm.textbytes import WORDS, Hasher, Texts, slices
from marquee.session import written

ANCHOR = "u1 long, u2 int, a int, n int, key long, ctx long"
WINDOW = "u1 long, u2 int, a int, h long, settled boolean"
PARSED = "u1 long, u2 int, n_words long, n_removed long, kept string"
SHINGLE = 8
# Text that a task works on at once; idle Python workers of an executor keep what they took for it.
SLICE_BYTES = 1 << 18


def _signed(x):
    return pa.array(x.astype(np.uint64).view(np.int64))


def _least(values, width):
    """The least of each ``width`` neighbours."""
    out, reach = values, 1
    while reach < width:
        step = min(reach, width - reach)
        out = np.minimum(out[:-step], out[step:])
        reach += step
    return out


def _blocks(hashes, first, window):
    """Blocks of all texts: text, first window within the text, windows, anchor position."""
    width = window - SHINGLE + 1
    n = len(hashes)
    if n < window:
        return (np.zeros(0, np.int64),) * 4
    shingle = Hasher(hashes, WORDS)
    at = np.arange(n - SHINGLE + 1)
    order = (shingle.of(at, at + SHINGLE) & np.uint64(0xFFFFFFFF00000000)) | at.astype(np.uint64)
    anchor = (_least(order, width) & np.uint64(0xFFFFFFFF)).astype(np.int64)
    owner = np.repeat(np.arange(len(first) - 1), np.diff(first))[: len(anchor)]
    whole = np.arange(len(anchor)) + window <= first[1:][owner]
    starts = np.flatnonzero(whole)
    if not len(starts):
        return (np.zeros(0, np.int64),) * 4
    own, anch = owner[starts], anchor[starts]
    new = np.ones(len(starts), bool)
    new[1:] = (own[1:] != own[:-1]) | (anch[1:] != anch[:-1])
    head = np.flatnonzero(new)
    count = np.diff(np.append(head, len(starts)))
    return own[head], starts[head], count, anch[head]


def _anchors(window):
    def run(batches):
        for batch in slices(batches, most=SLICE_BYTES):
            texts = Texts(batch.column("text"))
            hashes = texts.word_hashes()
            own, start, count, anchor = _blocks(hashes, texts.first, window)
            words = Hasher(hashes, WORDS)
            yield pa.RecordBatch.from_arrays([
                batch.column("u1").take(pa.array(own)), batch.column("u2").take(pa.array(own)),
                pa.array((start - texts.first[own]).astype(np.int32)), pa.array(count.astype(np.int32)),
                _signed(words.of(anchor, anchor + SHINGLE)),
                _signed(words.of(start, start + count + window - 1)),
            ], names=["u1", "u2", "a", "n", "key", "ctx"])

    return run


def _flat(column):
    """Values and per-row counts of a list column; null counts as empty."""
    counts = np.array([0 if x is None else x for x in pa.compute.list_value_length(column).to_pylist()], dtype=np.int64)
    return column.flatten(), counts


def _spread(starts, counts):
    """``starts[i] .. starts[i] + counts[i] - 1`` for all ``i``, in one array."""
    ends = np.cumsum(counts)
    return np.arange(ends[-1] if len(ends) else 0) - np.repeat(ends - counts - starts, counts)


def _windows(window):
    """Hashes of the windows of the blocks that ``spans`` lists."""

    def run(batches):
        for batch in slices(batches, most=SLICE_BYTES):
            texts = Texts(batch.column("text"))
            words = Hasher(texts.word_hashes(), WORDS)
            spans, counts = _flat(batch.column("spans"))
            own = np.repeat(np.arange(batch.num_rows), counts)
            a, n, settled = (spans.field(k).to_numpy(zero_copy_only=False) for k in range(3))
            local = _spread(a.astype(np.int64), n.astype(np.int64))
            own = np.repeat(own, n)
            at = local + texts.first[own]
            yield pa.RecordBatch.from_arrays([
                batch.column("u1").take(pa.array(own)), batch.column("u2").take(pa.array(own)),
                pa.array(local.astype(np.int32)), _signed(words.of(at, at + window)),
                pa.array(np.repeat(settled.astype(bool), n)),
            ], names=["u1", "u2", "a", "h", "settled"])

    return run


def _parse(window, with_text):
    def run(batches):
        for batch in slices(batches, most=SLICE_BYTES):
            texts = Texts(batch.column("text"))
            spans, counts = _flat(batch.column("spans"))
            own = np.repeat(np.arange(batch.num_rows), counts)
            a, n = (spans.field(k).to_numpy(zero_copy_only=False).astype(np.int64) for k in range(2))
            total = len(texts.starts)
            edge = np.zeros(total + 1, dtype=np.int64)
            np.add.at(edge, texts.first[own] + a, 1)
            np.add.at(edge, texts.first[own] + a + n + window - 1, -1)
            keep = np.cumsum(edge)[:total] == 0
            size = np.diff(texts.first)
            left = np.add.reduceat(np.append(keep, False).astype(np.int64), texts.first[:-1]) * (size > 0)
            kept = []
            for i, text in enumerate(batch.column("text")):
                mask = keep[texts.first[i]: texts.first[i + 1]]
                if with_text and left[i] == size[i]:
                    kept.append(text.as_py())
                elif with_text:
                    kept.append(texts.joined(i, mask).decode())
                else:
                    words = texts.joined(i, None if left[i] == size[i] else mask)
                    kept.append(hashlib.sha256(words).hexdigest())
            yield pa.RecordBatch.from_arrays([
                batch.column("u1"), batch.column("u2"), pa.array(size), pa.array(size - left),
                pa.array(kept, pa.string()),
            ], names=["u1", "u2", "n_words", "n_removed", "kept"])

    return run


def _spans(rows: DataFrame, *more) -> DataFrame:
    return rows.groupBy("u1", "u2").agg(F.collect_list(F.struct("a", "n", *more)).alias("spans"))


def remove_repeats(documents: DataFrame, window=35, with_text=True) -> DataFrame:
    """All rows of ``documents`` with ``n_words``, ``n_removed`` and ``kept`` in place of the text.

    ``kept`` is the text itself if nothing is removed, and else the kept words joined by one blank; if
    ``with_text`` is false, it is the SHA-256 of the kept words joined by one blank.

    Every word of a window of ``window`` words whose sequence also starts elsewhere, in the same
    or another row, is removed; windows are judged on the input. Null, empty and blank texts have
    no words. Rows with equal texts are repeats of each other, whatever their ids, so texts of
    ``window`` words or more that occur twice are removed whole. A text is known by 96 hash bits.
    Columns of the input that are named like a result are replaced.
    """
    named = documents.drop("n_words", "n_removed", "kept", "u1", "u2")
    keyed = named.withColumns({"u1": F.xxhash64("text"), "u2": F.hash("text")})
    texts = keyed.select("u1", "u2", "text")
    anchors = written(texts.mapInArrow(_anchors(window), ANCHOR), "anchors")

    # Anchors of one place only cannot start a repeat. Sums that are joined back are written first:
    # Spark splits a hot key of a join only where both sides come straight from a shuffle.
    keys = anchors.groupBy("key").agg(
        F.count("*").alias("places"), (F.min("ctx") != F.max("ctx")).alias("mixed")
    ).filter("places > 1").select("key", "mixed")
    met = written(anchors.join(written(keys, "keys"), "key"), "met")
    blocks = met.groupBy("key", "ctx").agg(
        F.count("*").alias("places"), F.first("mixed").alias("mixed"),
        F.min(F.struct("u1", "u2", "a", "n")).alias("at"),
    )
    blocks = written(blocks, "blocks")
    repeated = blocks.filter("places > 1").select("key", "ctx")
    factors = met.join(repeated, ["key", "ctx"], "left_semi").select("u1", "u2", "a", "n")

    # Blocks that differ under one anchor: one place of each is compared window by window.
    edges = blocks.filter("mixed").select("at.*", (F.col("places") > 1).alias("settled"))
    distinct = texts.groupBy("u1", "u2").agg(F.first("text").alias("text"))
    windows = written(
        distinct.join(_spans(edges, "settled"), ["u1", "u2"]).mapInArrow(_windows(window), WINDOW), "windows"
    )
    twice = windows.groupBy("h").agg(F.count("*").alias("places")).filter("places > 1").select("h")
    boundary = (
        windows.filter("not settled").join(written(twice, "twice"), "h", "left_semi")
        .select("u1", "u2", "a", F.lit(1).alias("n"))
    )
    spans = _spans(factors.unionByName(boundary).distinct())
    parsed = (
        distinct.join(spans, ["u1", "u2"], "left").select("u1", "u2", "text", "spans")
        .mapInArrow(_parse(window, with_text), PARSED)
    )
    return keyed.drop("text").join(parsed, ["u1", "u2"], "left").drop("u1", "u2")
