"""Phrase collocations from depth-truncated suffix subtrees, after vertical partitioning by prefix.

The suffixes of a piece of text are cut to four words. Vertical partitioning counts the prefixes of one and of
two words over the whole corpus; a prefix below the support holds no phrase, and its suffixes go. The
other two-word prefixes are dealt to groups whose occurrences keep a memory budget; a prefix above
the budget gets groups of its own, dealt by the words that follow. Each group builds its subtrees alone:
the suffixes sorted word by word, totals at the leaves, and the counts of inner nodes as sums of their leaves.
"""

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
import xxhash
from pyspark.sql import DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from marquee.llm.textbytes import Texts, mix, slices
from marquee.session import written

# Occurrences that one group may hold, and text bytes that are combined before they are shuffled.
BUDGET = 1 << 20
SLICE_BYTES = 2 << 20
# Bits of the filters of supported prefixes. Full filters let more through; the counts stay exact.
WORD_BITS, PAIR_BITS = 23, 26

WORD = "lang string, word string, code long, f long"
PAIR = "a long, b long, f long"
SUFFIX = "a long, b long, c long, d long, f long"
NO_LANG = "und"

BREAKS = b".,;:!?\n\x0b\x0c\r"
FOLD = np.arange(256, dtype=np.uint8)
FOLD[ord("A"): ord("Z") + 1] += 32
FOLD[ord("\t")] = ord(" ")
FOLD[list(BREAKS)] = ord("\n")


class Words:
    """The words of one slice, as codes of (language, word), and which follow each other in a piece."""

    def __init__(self, batch):
        column = pc.fill_null(batch.column("text"), "").cast(pa.large_binary())
        _, places, data = column.buffers()
        folded = FOLD[np.frombuffer(data, np.uint8)] if data is not None else np.zeros(0, np.uint8)
        self.texts = Texts(pa.Array.from_buffers(column.type, len(column), [None, places, pa.py_buffer(folded)], offset=column.offset))
        langs = pc.fill_null(batch.column("lang"), NO_LANG).dictionary_encode()
        self.langs, of_text = langs.dictionary, langs.indices.to_numpy()
        seeds = mix(np.array([xxhash.xxh64_intdigest(x.as_py().encode()) for x in self.langs], np.uint64))
        self.owner = self.texts.owner()
        self.lang = of_text[self.owner]
        self.codes = mix(self.texts.word_hashes() ^ seeds[self.lang]) if len(self.owner) else np.zeros(0, np.uint64)
        self.codes[self.codes == 0] = 1  # 0 stands for no word
        piece = np.cumsum(self.texts.data == ord("\n"))[self.texts.starts]
        self.linked = (self.owner[1:] == self.owner[:-1]) & (piece[1:] == piece[:-1])

    def text(self, i):
        return self.texts.data[self.texts.starts[i]: self.texts.ends[i]].tobytes().decode()


def _longs(x):
    return pa.array(x.astype(np.uint64).view(np.int64))


def _pair_code(a, b):
    return mix(a * np.uint64(0x9E3779B97F4A7C15) + b)


def _has(bits, codes):
    """Whether a filter of 2 ** k bits, kept as 64-bit words, may hold each code."""
    cell = codes >> np.uint64(64 - (len(bits) * 64).bit_length() + 1)
    return (bits[(cell >> np.uint64(6)).astype(np.int64)] >> (cell & np.uint64(63)) & np.uint64(1)).astype(bool)


def _filter(codes: DataFrame, size) -> np.ndarray:
    """A filter of 2 ** ``size`` bits of the column ``code``; at most 2 ** (size - 6) rows reach the driver."""
    cell = F.shiftrightunsigned("code", 64 - size)
    bit = F.expr("shiftleft(1L, cast(cell & 63 AS int))")
    rows = (
        codes.select(cell.alias("cell")).groupBy(F.shiftrightunsigned("cell", 6).alias("at"))
        .agg(F.bit_or(bit).alias("bits")).toArrow()
    )
    out = np.zeros(1 << (size - 6), np.uint64)
    out[rows["at"].to_numpy()] = rows["bits"].to_numpy().view(np.uint64)
    return out


def _combined(columns):
    """Distinct rows of the columns, sorted by them, and how often each occurs."""
    order = np.lexsort(columns[::-1])
    columns = [c[order] for c in columns]
    new = np.ones(len(order), bool)
    if len(order):
        new[1:] = np.any([c[1:] != c[:-1] for c in columns], axis=0)
    head = np.flatnonzero(new)
    return [c[head] for c in columns], np.diff(np.append(head, len(order)))


def _words(batches):
    for batch in slices(batches, most=SLICE_BYTES):
        words = Words(batch)
        codes, at, count = np.unique(words.codes, return_index=True, return_counts=True)
        yield pa.RecordBatch.from_arrays([
            words.langs.take(pa.array(words.lang[at])).cast(pa.string()), pa.array([words.text(i) for i in at.tolist()], pa.string()),
            _longs(codes), pa.array(count.astype(np.int64)),
        ], names=["lang", "word", "code", "f"])


def _pairs(known):
    def run(batches):
        for batch in slices(batches, most=SLICE_BYTES):
            words = Words(batch)
            usable = _has(known.value, words.codes)
            at = np.flatnonzero(words.linked & usable[1:] & usable[:-1])
            columns, count = _combined([words.codes[at], words.codes[at + 1]])
            yield pa.RecordBatch.from_arrays(
                [*map(_longs, columns), pa.array(count.astype(np.int64))], names=["a", "b", "f"])

    return run


def _suffixes(known):
    """Suffixes of three or four words all of whose neighbours may be supported; no fourth word is 0."""

    def run(batches):
        for batch in slices(batches, most=SLICE_BYTES):
            words = Words(batch)
            codes = words.codes
            joined = words.linked & _has(known.value, _pair_code(codes[:-1], codes[1:]))
            at = np.flatnonzero(joined[:-1] & joined[1:])
            more = np.append(joined, [False, False])[at + 2]
            fourth = np.where(more, np.append(codes, np.uint64(0))[at + 3 - ~more], np.uint64(0))
            columns, count = _combined([codes[at], codes[at + 1], codes[at + 2], fourth])
            yield pa.RecordBatch.from_arrays(
                [*map(_longs, columns), pa.array(count.astype(np.int64))], names=["a", "b", "c", "d", "f"])

    return run


def _subtrees(support):
    """A task function: the nodes of depth 3 and 4 of one group.

    Leaves are whole here. The depth 3 nodes of a prefix that is split over groups are parts, and all stay.
    """

    def build(group: pa.Table) -> pa.Table:
        columns = [group[c].to_numpy() for c in ("a", "b", "c", "d")]
        order = np.lexsort(columns[::-1])
        a, b, c, d = (x[order] for x in columns)
        f, split = group["f"].to_numpy()[order], group["split"].to_numpy()[order]
        inner = np.ones(len(order), bool)
        inner[1:] = (a[1:] != a[:-1]) | (b[1:] != b[:-1]) | (c[1:] != c[:-1])
        leaf = inner.copy()
        leaf[1:] |= d[1:] != d[:-1]
        leaf, inner = np.flatnonzero(leaf), np.flatnonzero(inner)
        totals = np.add.reduceat(f, leaf)
        sums = np.add.reduceat(totals, np.searchsorted(leaf, inner))
        deep = (d[leaf] != 0) & (totals >= support)
        wide = (sums >= support) | split[inner]
        at, count = np.append(leaf[deep], inner[wide]), np.append(totals[deep], sums[wide])
        fourth = np.append(d[leaf[deep]], np.zeros(wide.sum(), np.int64))
        return pa.table([a[at], b[at], c[at], fourth, count], names=["a", "b", "c", "d", "f"])

    return build


def phrase_counts(documents: DataFrame, support=30, budget=BUDGET):
    """(words, phrases): the words of each language, and the phrases of 2 to 4 words, with their counts.

    ``words`` holds (lang, word, code, f) of every word, ``phrases`` (a, b, c, d, f) the codes of
    the words of each phrase that occurs ``support`` times or more, 0 for no word. A word is known by 64 hash
    bits of language and word.
    """
    spark = documents.sparkSession
    texts = documents.select("text", "lang")
    words = written(
        texts.mapInArrow(_words, WORD).groupBy("lang", "word").agg(F.min("code").alias("code"), F.sum("f").alias("f")), "words")
    usable = spark.sparkContext.broadcast(_filter(words.filter(F.col("f") >= support), WORD_BITS))
    # Slices have combined their pairs: a second combination before the shuffle would only take memory.
    dealt = texts.mapInArrow(_pairs(usable), PAIR).repartition("a", "b")
    pairs = written(dealt.groupBy("a", "b").agg(F.sum("f").alias("f")).filter(F.col("f") >= support), "pairs")
    coded = pairs.mapInArrow(_coded, "code long")
    joined = spark.sparkContext.broadcast(_filter(coded, PAIR_BITS))

    groups = max(1, -(-2 * (pairs.agg(F.sum("f")).first()[0] or 0) // budget))
    # At most one prefix for each ``budget`` occurrences.
    above = written(pairs.filter(F.col("f") > budget).select("a", "b", F.ceil(2 * F.col("f") / budget).alias("parts")), "above")
    suffixes = texts.mapInArrow(_suffixes(joined), SUFFIX).join(above, ["a", "b"], "left")
    split = F.col("parts").isNotNull()
    dealt = suffixes.select(
        "a", "b", "c", "d", "f", split.alias("split"),
        F.when(~split, F.pmod(F.xxhash64("a", "b"), F.lit(groups))).alias("group"),
        F.when(split, F.struct("a", "b", F.pmod(F.xxhash64("c", "d"), F.col("parts")).alias("part"))).alias("own"),
    )
    nodes = dealt.groupBy("group", "own").applyInArrow(_subtrees(support), SUFFIX)
    deep = nodes.groupBy("a", "b", "c", "d").agg(F.sum("f").alias("f")).filter(F.col("f") >= support)
    phrases = pairs.select("a", "b", F.lit(0).cast("long").alias("c"), F.lit(0).cast("long").alias("d"), "f").unionByName(deep)
    return words, written(phrases, "phrases")


def _coded(batches):
    for batch in batches:
        a, b = (batch.column(c).to_numpy().view(np.uint64) for c in ("a", "b"))
        yield pa.RecordBatch.from_arrays([_longs(_pair_code(a, b))], names=["code"])


def _cut(*parts):
    """Struct of a cut after ``k`` words: the two parts, filled up with 0 to three words."""
    nothing = F.lit(0).cast("long")
    fields = [F.lit(len(parts[0])).alias("k")]
    for side, words in zip("lr", parts):
        fields += [(F.col(words[i]) if i < len(words) else nothing).alias(f"{side}{i}") for i in range(3)]
    return F.struct(*fields)


def collocations(documents: DataFrame, support=30, top=2000, cover=80, budget=BUDGET) -> DataFrame:
    """(lang, rank, phrase, a, l, r, n, score): the first ``top`` phrases of each language.

    A-Z is lower-cased, texts are split at ``[.,;:!?\\x0A-\\x0D]`` into pieces and those at blanks and tabs into
    words; all counts are per language, null being ``und``. A phrase of 2 to 4 words that occurs ``support``
    times (``a``) is cut in two parts with counts ``l`` and ``r``; the cut with the least
    floor(2000000 a / (l + r)) is its score, ties to the shorter first part. Phrases inside a longer one
    with ``cover`` percent of their occurrences go. Ties of the score go to the greater ``a``, then to the
    phrase in byte order. Null, empty and blank texts add nothing; repeated rows count as often as they
    stand there. Other columns than text and lang are not read.
    """
    words, phrases = phrase_counts(documents, support, budget)
    wide = lambda column: F.col(column).cast("decimal(20,0)")
    # Whatever holds a phrase also holds one of its two extensions by a word, as often or more.
    size = (F.col("c") != 0).cast("int") + (F.col("d") != 0).cast("int") + 2
    nothing = F.lit(0).cast("long")
    inside = phrases.filter("c <> 0").select("f", F.inline(F.when(F.col("d") == 0, F.array(
        F.struct("a", "b", nothing.alias("c"), nothing.alias("d")), F.struct(F.col("b").alias("a"), F.col("c").alias("b"), nothing.alias("c"), nothing.alias("d")),
    )).otherwise(F.array(
        F.struct("a", "b", "c", nothing.alias("d")), F.struct(F.col("b").alias("a"), F.col("c").alias("b"), F.col("d").alias("c"), nothing.alias("d")),
    )))).groupBy("a", "b", "c", "d").agg(F.max("f").alias("longer"))
    key = ["a", "b", "c", "d"]
    open_ = phrases.join(inside, key, "left").filter(
        F.col("longer").isNull() | (wide("longer") * 100 < wide("f") * cover)).drop("longer")

    cuts = F.when(size == 2, F.array(_cut("a", "b"))).when(
        size == 3, F.array(_cut("a", "bc"), _cut("ab", "c"))
    ).otherwise(F.array(_cut("a", "bcd"), _cut("ab", "cd"), _cut("abc", "d")))
    known = words.filter(F.col("f") >= support)
    parts = known.select(F.col("code").alias("w0"), nothing.alias("w1"), nothing.alias("w2"), F.col("f").alias("count")).unionByName(
        phrases.filter("d = 0").select(F.col("a").alias("w0"), F.col("b").alias("w1"), F.col("c").alias("w2"), F.col("f").alias("count")))
    parts = written(parts, "parts")
    side = lambda s: parts.select(*[F.col(f"w{i}").alias(f"{s}{i}") for i in range(3)], F.col("count").alias(s))
    scored = open_.select(*key, "f", F.inline(cuts))
    for s in "lr":
        scored = scored.join(side(s), [f"{s}{i}" for i in range(3)])
    score = F.expr("CAST(f AS DECIMAL(20,0)) * 2000000 div CAST(l + r AS DECIMAL(20,0))")
    best = scored.groupBy(*key, "f").agg(F.min(F.struct(score.alias("score"), "k", "l", "r")).alias("cut"))
    best = best.select(*key, "f", "cut.score", "cut.l", "cut.r")

    named = lambda c: known.select(F.col("code").alias(c), F.col("word").alias(f"{c}_word"))
    of_lang = best.join(known.select(F.col("code").alias("a"), "lang", F.col("word").alias("a_word")), "a")
    # Ties of score and count stay until the words are there.
    leading = W.partitionBy("lang").orderBy(F.desc("score"), F.desc("f"))
    first = written(of_lang.withColumn("place", F.rank().over(leading)).filter(F.col("place") <= top), "leading")
    for c in "bcd":
        first = first.join(named(c), c, "left")
    phrase = F.concat_ws(" ", *[f"{c}_word" for c in "abcd"])
    order = W.partitionBy("lang").orderBy(F.desc("score"), F.desc("a"), "phrase")
    sizes = words.groupBy("lang").agg(F.sum("f").alias("n"))
    return (
        first.select("lang", phrase.alias("phrase"), F.col("f").alias("a"), "l", "r", "score")
        .withColumn("rank", F.row_number().over(order)).filter(F.col("rank") <= top).join(sizes, "lang")
        .select("lang", F.col("rank").cast("long").alias("rank"), "phrase", "a", "l", "r", "n", "score")
    )
