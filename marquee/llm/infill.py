"""Fill-in-the-middle transformation: texts cut at unit ends that are found with SWAR words.

A unit is a run of ASCII letters or one other code point. The UTF-8 bytes of many texts are viewed as
little-endian 64-bit words. Arithmetic on whole words marks, in the top bit of each byte lane, the bytes
that end a unit; ``bitwise_count`` per word and one running sum give the units before any place. To find
the end of unit ``k`` the running sum is searched for its word, and the place within the word is
selected by clearing its lowest marks.
"""

import hashlib
import re

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from marquee.llm.textbytes import slices

SENTINELS = ("<P>", "<S>", "<M>")
RESULT = [("n", "long"), ("form", "string"), ("prefix_chars", "long"), ("middle_chars", "long"), ("output", "string")]

LOW = np.uint64(0x0101010101010101)
TOP = np.uint64(0x8080808080808080)
REST = ~TOP
ONE, BYTE, LAST = np.uint64(1), np.uint64(8), np.uint64(56)


def _lanes(value):
    return np.uint64(value) * LOW


def _letters(x):
    """Top bits of the lanes that hold A-Z or a-z."""
    small = (x | _lanes(0x20)) & REST
    from_a, past_z = small + _lanes(0x80 - ord("a")), small + _lanes(0x80 - ord("z") - 1)
    return from_a & ~past_z & ~x & TOP


def _continuations(x):
    """Top bits of the lanes that hold 10xxxxxx."""
    return x & ~(x << ONE) & TOP


def _following(marks):
    """Each lane's mark is that of the byte after it."""
    after = marks >> BYTE
    after[:-1] |= marks[1:] << LAST
    return after


class Marks:
    """Rank and select over marked bytes."""

    def __init__(self, words):
        self.words = words
        self.before = np.zeros(len(words) + 1, np.int64)
        np.cumsum(np.bitwise_count(words), out=self.before[1:])

    def rank(self, at):
        """Marks before byte ``at``."""
        word, lane = at >> 3, (at & 7).astype(np.uint64)
        inside = np.append(self.words, np.uint64(0))[word] & ((ONE << (lane * BYTE)) - ONE)
        return self.before[word] + np.bitwise_count(inside)

    def select(self, k):
        """Byte of mark number ``k``, counted from 0."""
        word = np.searchsorted(self.before, k, side="right") - 1
        left, bits = k - self.before[word], self.words[word]
        for _ in range(7):
            bits = np.where(left > 0, bits & (bits - ONE), bits)
            left = left - 1
        lowest = bits & (~bits + ONE)
        return word * 8 + (np.bitwise_count(lowest - ONE) >> np.uint8(3)).astype(np.int64)


class Units:
    """Units and code points of the texts of one Arrow array; null counts as an empty text."""

    def __init__(self, column):
        column = pc.fill_null(column, "").cast(pa.large_binary())
        offsets = np.frombuffer(column.buffers()[1], np.int64)[column.offset: column.offset + len(column) + 1]
        data = column.buffers()[2]
        raw = np.frombuffer(data, np.uint8) if data is not None and data.size else np.zeros(0, np.uint8)
        self.data, self.offsets = raw[offsets[0]: offsets[-1]], offsets - offsets[0]
        size = len(self.data)
        padded = np.zeros(-(-size // 8) * 8, np.uint8)
        padded[:size] = self.data
        x = padded.view("<u8")
        used = np.zeros(len(padded), np.uint8)
        used[:size] = 0x80
        used = used.view("<u8")
        letter, inner = _letters(x), _continuations(x)
        ends = (letter & ~_following(letter)) | (~letter & ~_following(inner) & TOP)
        # A text's last byte ends a unit whatever the next text begins with.
        last = self.offsets[1:][np.diff(self.offsets) > 0] - 1
        closing = np.zeros(len(padded), np.uint8)
        closing[last] = 0x80
        self.ends = Marks((ends | closing.view("<u8")) & used)
        self.points = Marks(~inner & used)
        self.first = self.ends.rank(self.offsets)

    def counts(self):
        return np.diff(self.first)

    def cut(self, texts, units):
        """Byte of ``data`` at which the first ``units`` units of each of ``texts`` end."""
        out = self.offsets[:-1][texts].copy()
        some = units > 0
        out[some] = self.ends.select(self.first[:-1][texts][some] + units[some] - 1) + 1
        return out


def _checked(sentinels):
    """The sentinels, if no piece of text beside one can be read as another."""
    pieces = [s.encode() for s in sentinels]
    if len(pieces) != 3 or not all(pieces):
        raise ValueError("three sentinels are needed")
    for a in pieces:
        if any(a in b for b in pieces if b is not a):
            raise ValueError("a sentinel lies inside another")
        if any(b.startswith(a[i:]) for b in pieces for i in range(1, len(a))):
            raise ValueError("a sentinel ends like another begins")
    return pieces


def _run(sentinels, plain, spm):
    begin, rest, middle = _checked(sentinels)

    def run(batches):
        for batch in slices(batches):
            texts = Units(batch.column("text"))
            n = texts.counts()
            draw = [batch.column(f"draw{i}").to_numpy() for i in range(4)]
            data, offsets = texts.data.tobytes(), texts.offsets.tolist()
            whole = [data[a:b] for a, b in zip(offsets, offsets[1:])]
            stay = np.array([not t or begin in t or rest in t or middle in t for t in whole], bool) | (draw[2] % 100 >= plain)
            moved = np.flatnonzero(~stay)
            one, two = draw[0][moved] % (n[moved] + 1), draw[1][moved] % (n[moved] + 1)
            cuts = [texts.cut(moved, f(one, two)) for f in (np.minimum, np.maximum)]
            places = [texts.offsets[moved], *cuts]
            points = np.diff([texts.points.rank(p) for p in places], axis=0)
            form, output = ["plain"] * len(whole), whole
            sizes = np.zeros((2, len(whole)), np.int64)
            sizes[:, moved] = points
            for i, low, high in zip(moved.tolist(), cuts[0].tolist(), cuts[1].tolist()):
                a, b, c = data[offsets[i]: low], data[low:high], data[high: offsets[i + 1]]
                if draw[3][i] % 100 < spm:
                    form[i], output[i] = "spm", b"".join((rest, c, begin, a, middle, b))
                else:
                    form[i], output[i] = "psm", b"".join((begin, a, rest, c, middle, b))
            names = [c for c in batch.schema.names if c != "text" and not c.startswith("draw")]
            yield pa.RecordBatch.from_arrays([
                *[batch.column(c) for c in names], pa.array(n), pa.array(form),
                *[pa.array(s, mask=stay) for s in sizes], pa.array(output, pa.binary()).cast(pa.string()),
            ], names=[*names, *[c for c, _ in RESULT]])

    return run


def transform(documents: DataFrame, salt="1:", plain=90, spm=20, sentinels=SENTINELS) -> DataFrame:
    """``documents`` without its text, with ``n``, ``form``, ``prefix_chars``, ``middle_chars`` and ``output``.

    ``n`` counts the units of the text. The first four 32-bit groups of the SHA-256 of ``salt`` and the
    ``doc_id`` decide: the first two, modulo n + 1, the units before the middle and before the suffix;
    the third, that ``plain`` of 100 texts change; the fourth, that ``spm`` of 100 of these
    put the suffix first. ``psm`` outputs hold prefix, suffix, middle behind the three sentinels, ``spm``
    ones suffix, prefix, middle; other texts are their own ``plain`` output, without the two sizes
    (code points). Empty and null texts give an empty plain output, and texts that contain a sentinel
    are plain. A null ``doc_id`` counts as empty, and rows of one id are cut by the same draws.
    Columns of the input that are named like a result are replaced.
    """
    names = [c for c, _ in RESULT]
    rest = [f for f in documents.schema.fields if f.name not in ("text", *names) and not re.fullmatch("draw[0-3]", f.name)]
    digest = F.sha2(F.concat(F.lit(salt), F.coalesce(F.col("doc_id").cast("string"), F.lit(""))).cast("binary"), 256)
    draws = [F.conv(F.substring(digest, 8 * i + 1, 8), 16, 10).cast("long").alias(f"draw{i}") for i in range(4)]
    kept = [F.col(f"`{f.name}`") for f in rest]
    schema = ", ".join([f"`{f.name}` {f.dataType.simpleString()}" for f in rest] + [f"{c} {t}" for c, t in RESULT])
    return documents.select("text", *kept, *draws).mapInArrow(_run(sentinels, plain, spm), schema)


def restored(output, form, sentinels=SENTINELS):
    """Column: the text that ``output`` was made from."""
    begin, rest, middle = (re.escape(s) for s in sentinels)
    psm = F.split(F.substr(output, F.lit(len(sentinels[0]) + 1)), f"{rest}|{middle}", 3)
    spm = F.split(F.substr(output, F.lit(len(sentinels[1]) + 1)), f"{begin}|{middle}", 3)
    piece = lambda parts, i: F.get(parts, F.lit(i))
    return (
        F.when(form == "psm", F.concat(piece(psm, 0), piece(psm, 2), piece(psm, 1)))
        .when(form == "spm", F.concat(piece(spm, 1), piece(spm, 2), piece(spm, 0)))
        .otherwise(output)
    )
