"""Variable-capacity best-fit packing of documents into training sequences.

Documents are cut into pieces of at most the longest permitted length and dealt by hash into shards of
some thousand pieces, which are packed independently; what a shard loses is less than a few sequences.
Inside a shard pieces go in order of decreasing size to the open sequence, of whatever length, that
they fill best. If none has room, a sequence opens whose length costs least per word among those that
hold the piece and do not exceed a limit. Which lengths open is chosen for all pieces of the shard jointly: every
permitted length is tried as the limit, and the packing that costs least is taken. At the end each sequence
shrinks to the shortest permitted length for its contents, which is part of the cost.

Rows of equal id and text are counted first and dealt in bounded stretches, so that a group of copies
of any size is spread over the shards.
"""

from bisect import bisect_left, insort
from collections import defaultdict

import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from marquee.llm.frames import words_of
from marquee.session import written

LENGTHS = (256, 512, 1024, 2048, 4096, 8192)
SEQUENCE = "bin string, capacity int, used int, doc_ids array<bigint>, starts array<bigint>, sizes array<int>"


def cost(length):
    """Cost of one sequence: its positions, attention over them, and a fixed part."""
    return length + length * length / 65536 + 64


def _filled(sizes, lengths, limit):
    """Best fit in decreasing order, opening lengths up to ``limit`` where they hold the piece."""
    order = sorted(range(len(sizes)), key=lambda i: -sizes[i])
    room, with_room = [], defaultdict(list)  # the distinct amounts of room, and who has them
    bins = []
    for i in order:
        size = sizes[i]
        at = bisect_left(room, size)
        if at < len(room):
            left = room[at]
            mine = with_room[left].pop()
            if not with_room[left]:
                room.pop(at)
        else:
            holding = [x for x in lengths if x >= size]
            left = min([x for x in holding if x <= limit] or holding[:1], key=lambda x: cost(x) / x)
            mine = len(bins)
            bins.append([])
        bins[mine].append(i)
        left -= size
        if not with_room[left]:
            insort(room, left)
        with_room[left].append(mine)
    used = [sum(sizes[i] for i in b) for b in bins]
    return [(b, n, min(x for x in lengths if x >= n)) for b, n in zip(bins, used)]


def best_fit(sizes, lengths):
    """Sequences as lists of piece numbers, with the words and the length of each; sizes of 0 go to the first one.

    Of the packings for every limit the one of least cost, the one of the shorter limit if costs are equal.
    ``lengths`` are ascending.
    """
    tried = (_filled(sizes, lengths, limit) for limit in lengths)
    return min(tried, key=lambda bins: sum(cost(c) for _, _, c in bins))


def _pieces(sizes, longest):
    """(row, start, size) of every piece; a row of size 0 is one piece."""
    for row, size in enumerate(sizes):
        for start in range(0, max(size, 1), longest):
            yield row, start, min(longest, size - start)


def _packed(lengths, with_text):
    def run(key: tuple, group: pd.DataFrame) -> pd.DataFrame:
        group = group.sort_values(["size", "doc_id", "digest", "copies"], kind="stable")
        group = group.loc[group.index.repeat(group["copies"])]
        ids = [None if pd.isna(x) else int(x) for x in group["doc_id"].tolist()]
        pieces = list(_pieces(group["size"].tolist(), max(lengths)))
        words = [(t or "").encode().split() for t in group["text"]] if with_text else None
        rows = []
        for number, (members, used, capacity) in enumerate(best_fit([p[2] for p in pieces], lengths)):
            chosen = [pieces[m] for m in members]
            row = [f"{key[0]}-{number}", capacity, used, [ids[r] for r, _, _ in chosen],
                   [s for _, s, _ in chosen], [n for _, _, n in chosen]]
            if with_text:
                row.append([b" ".join(words[r][s: s + n]).decode() for r, s, n in chosen])
            rows.append(row)
        columns = ["bin", "capacity", "used", "doc_ids", "starts", "sizes", "texts"]
        return pd.DataFrame(rows, columns=columns[: 6 + with_text])

    return run


def pack(documents: DataFrame, lengths=LENGTHS, shard_rows=4096, shard_bytes=16 << 20, with_text=False) -> DataFrame:
    """One row per sequence: ``bin``, ``capacity``, ``used`` words, and its pieces in lists.

    Shards hold about ``shard_rows`` rows and ``shard_bytes`` of text, whichever is fewer, so that a task
    needs the memory of one shard. A piece is words ``start`` to ``start + size`` of a document; ``with_text`` adds their texts.
    Every row of ``documents`` is in a sequence, whatever its id: repeated rows as often as they
    occur, null, empty and blank texts as pieces of size 0, a null id as a null in ``doc_ids``.
    Longer texts than the longest length are cut into pieces, none is dropped. An empty table gives
    no sequence.
    """
    rows = documents.select(
        F.col("doc_id").cast("long").alias("doc_id"), F.xxhash64("text").alias("digest"),
        F.size(words_of("text")).alias("size"), *(["text"] if with_text else []),
    )
    whole = documents.agg(F.count("*").alias("rows"), F.sum(F.octet_length("text")).alias("bytes")).first()
    shards = max(1, -(-whole["rows"] // shard_rows), -(-(whole["bytes"] or 0) // shard_bytes))
    # An eighth of a shard holds a stretch of copies.
    bytes_each = F.greatest(F.coalesce(F.octet_length("text"), F.lit(0)), F.lit(1))
    stretch = F.greatest(F.lit(1), F.least(F.lit(shard_rows // 8), F.floor(F.lit(shard_bytes // 8) / bytes_each))).cast("long")
    counts = documents.select(F.col("doc_id").cast("long").alias("id"), F.xxhash64("text").alias("hash"), stretch.alias("stretch"))
    hot = written(counts.groupBy("id", "hash").agg(
        F.count("*").alias("rows"), F.max("stretch").alias("stretch")).filter("rows > stretch"), "hot-rows")
    same = F.col("doc_id").eqNullSafe(F.col("id")) & (F.col("digest") == F.col("hash"))
    alone = rows.join(hot, same, "left_anti").select("*", F.lit(1).cast("long").alias("copies"), F.lit(0).cast("long").alias("part"))
    kept = [F.min(c).alias(c) for c in rows.columns if c not in ("doc_id", "digest")]
    one = rows.join(hot, same).groupBy("doc_id", "digest").agg(*kept, F.max("rows").alias("rows"), F.max("stretch").alias("stretch"))
    last = F.floor((F.col("rows") - 1) / F.col("stretch")).cast("long")
    parts = one.select("*", F.explode(F.sequence(F.lit(0).cast("long"), last)).alias("part")).select(
        *rows.columns, F.least("stretch", F.col("rows") - F.col("part") * F.col("stretch")).alias("copies"), "part")
    dealt = alone.unionByName(parts).withColumn("shard", F.pmod(F.xxhash64("doc_id", "digest") + F.col("part"), F.lit(shards))).drop("part")
    schema = SEQUENCE + (", texts array<string>" if with_text else "")
    return dealt.groupBy("shard").applyInPandas(_packed(tuple(sorted(lengths)), with_text), schema)
