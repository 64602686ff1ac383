"""Words of many texts at once, as numpy arrays over Arrow's text buffer.

A word is a maximal run of bytes other than blank and 0x09-0x0D, which in UTF-8 equals
``[^\\x20\\x09-\\x0D]+`` on code points.
"""

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc

CHUNK_BYTES = 1 << 20

SPACE = np.zeros(256, dtype=bool)
SPACE[[9, 10, 11, 12, 13, 32]] = True


def mix(x):
    """A bijection of 64 bits that spreads every input bit (the splitmix finaliser)."""
    x = x ^ (x >> np.uint64(30))
    x = x * np.uint64(0xBF58476D1CE4E5B9)
    x = x ^ (x >> np.uint64(27))
    x = x * np.uint64(0x94D049BB133111EB)
    return x ^ (x >> np.uint64(31))


class Powers:
    """Powers of an odd base and of its inverse modulo 2**64, grown on demand."""

    def __init__(self, base):
        self.base, self.inverse = base, pow(base, -1, 1 << 64)
        self.up = self.down = np.ones(1, dtype=np.uint64)

    def upto(self, n):
        if len(self.up) < n:
            size = max(n, 2 * len(self.up))
            self.up, self.down = (self._run(b, size) for b in (self.base, self.inverse))
        return self.up[:n], self.down[:n]

    @staticmethod
    def _run(base, n):
        out = np.full(n, base, dtype=np.uint64)
        out[0] = 1
        return np.multiply.accumulate(out)


BYTES = Powers(0x9E3779B97F4A7C15)
WORDS = Powers(0xD6E8FEB86659FD93)
LETTER = mix(np.arange(1, 257, dtype=np.uint64))


class Hasher:
    """Hashes of any slice of a sequence of 64-bit values, from one prefix sum."""

    def __init__(self, values, powers):
        up, self.down = powers.upto(len(values) + 1)
        self.sums = np.zeros(len(values) + 1, dtype=np.uint64)
        np.cumsum(values * up[:-1], out=self.sums[1:])

    def of(self, start, end):
        return mix((self.sums[end] - self.sums[start]) * self.down[start] + (end - start).astype(np.uint64))


class Texts:
    """The words of the texts of one Arrow array; null counts as an empty text.

    ``starts`` and ``ends`` are the words' byte positions in ``data``; the words of text ``i``
    are ``first[i]:first[i + 1]``.
    """

    def __init__(self, column):
        column = pc.fill_null(column, "").cast(pa.large_binary())
        offsets = np.frombuffer(column.buffers()[1], dtype=np.int64)
        offsets = offsets[column.offset: column.offset + len(column) + 1]
        data = column.buffers()[2]
        raw = np.frombuffer(data, dtype=np.uint8) if data is not None and data.size else np.zeros(0, np.uint8)
        self.data = raw[offsets[0]: offsets[-1]]
        self.offsets = offsets - offsets[0]
        solid = ~SPACE[self.data]
        begin, finish = solid.copy(), solid.copy()
        begin[1:] &= ~solid[:-1]
        finish[:-1] &= ~solid[1:]
        filled = np.flatnonzero(np.diff(self.offsets))
        firsts, lasts = self.offsets[filled], self.offsets[filled + 1] - 1
        begin[firsts] = solid[firsts]
        finish[lasts] = solid[lasts]
        self.starts = np.flatnonzero(begin)
        self.ends = np.flatnonzero(finish) + 1
        self.first = np.searchsorted(self.starts, self.offsets)

    def owner(self):
        """The text of each word."""
        return np.repeat(np.arange(len(self.first) - 1), np.diff(self.first))

    def word_hashes(self):
        return Hasher(LETTER[self.data], BYTES).of(self.starts, self.ends)

    def joined(self, i, keep=None):
        """Words of text ``i`` (those that ``keep`` marks) joined by one blank."""
        words = self.data[self.offsets[i]: self.offsets[i + 1]].tobytes().split()
        if keep is not None:
            words = [w for w, k in zip(words, keep.tolist()) if k]
        return b" ".join(words)


def slices(batches, column="text", most=CHUNK_BYTES):
    """Cuts record batches so that a slice holds about ``most`` bytes of text, or one longer text."""
    for batch in batches:
        sizes = pc.fill_null(pc.binary_length(batch.column(column)), 0).to_numpy(zero_copy_only=False)
        ends = np.cumsum(sizes)
        low = 0
        while low < batch.num_rows:
            done = ends[low - 1] if low else 0
            high = max(low + 1, int(np.searchsorted(ends, done + most, side="right")))
            yield batch.slice(low, high - low)
            low = high
