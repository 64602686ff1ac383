"""Near-duplicates by SimHash fingerprints and multi-index hashing.

A fingerprint's bits are cut into ``segments``. Two fingerprints that differ in at most ``distance``
bits differ in at most ``distance // segments`` bits of some segment, so every fingerprint is stored
under each of its segments and looks up a small Hamming ball around each of them. Table matches are
verified on all 64 bits. A ball holds only flips of 0 to 1: of two segments of a pair, the one with
the zeros finds the other one when all differing bits go one way, so balls are complete for one bit.
"""

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from marquee.llm.textbytes import slices
from marquee.session import written

BITS = 64
# Edges that a task turns into stars at once.
STRETCH = 1 << 20


def _fingerprint(text, shingle, seed):
    words = text.lower().split()
    if not words:
        return 0
    if len(words) <= shingle:
        pieces = [b" ".join(words)]
    else:
        joined = b" ".join(words)
        ends = np.cumsum(np.fromiter(map(len, words), np.int64, len(words)) + 1) - 1
        starts = np.append(0, ends[:-shingle] + 1).tolist()
        pieces = [joined[a:b] for a, b in zip(starts, ends[shingle - 1:].tolist())]
    votes, step = np.zeros(BITS, np.int64), 1 << 16
    for low in range(0, len(pieces), step):
        digests = b"".join([xxhash.xxh64_digest(p, seed) for p in pieces[low: low + step]])
        bits = np.unpackbits(np.frombuffer(digests, np.uint8).reshape(-1, 8), axis=1)
        votes += bits.sum(axis=0, dtype=np.int64)
    return int.from_bytes(np.packbits(2 * votes > len(pieces)).tobytes(), "big", signed=True)


def _run(shingle, seed):
    def run(batches):
        for batch in slices(batches):
            prints = [_fingerprint((t or "").encode(), shingle, seed) for t in batch.column("text").to_pylist()]
            others = [batch.column(c) for c in batch.schema.names if c != "text"]
            yield pa.RecordBatch.from_arrays(
                [*others, pa.array(prints, pa.int64())],
                names=[*(c for c in batch.schema.names if c != "text"), "print"],
            )

    return run


def fingerprints(documents: DataFrame, shingle=3, seed=42) -> DataFrame:
    """``documents`` without its text, with ``print``: the SimHash of the text as a signed long.

    A-Z is lower-cased; shingles of ``shingle`` words joined by blanks, repeats included, vote with
    their XXH64. A text with fewer words is one shingle; one without words, or null, has print 0.
    """
    rest = [f for f in documents.schema.fields if f.name not in ("text", "print")]
    schema = ", ".join([f"`{f.name}` {f.dataType.simpleString()}" for f in rest] + ["print long"])
    return documents.select("text", *[f"`{f.name}`" for f in rest]).mapInArrow(_run(shingle, seed), schema)


def _segment(column, number, segments):
    width = BITS // segments
    return F.shiftrightunsigned(column, number * width).bitwiseAND((1 << width) - 1)


def near_pairs(prints: DataFrame, distance=3, segments=2) -> DataFrame:
    """Pairs (``low`` < ``high``) of distinct values of ``print`` that differ in 1 to ``distance`` bits.

    ``distance // segments`` must be 0 or 1, the ball radii that are enumerated.
    """
    radius, width = distance // segments, BITS // segments
    if radius > 1 or BITS % segments:
        raise ValueError("segments must divide 64 and exceed half the distance")
    home = [F.struct(F.lit(i).alias("seg"), _segment(F.col("print"), i, segments).alias("key")) for i in range(segments)]
    index = prints.select(F.col("print").alias("match"), F.inline(F.array(*home)))
    # The home table is its own ball of radius 0.
    ball = index
    if radius:
        flip = F.explode(F.sequence(F.lit(0), F.lit(width - 1))).alias("bit")
        ball = index.select("match", "seg", "key", flip).select(
            "match", "seg", F.col("key").bitwiseOR(F.expr("shiftleft(1L, bit)")).alias("probe"), "key"
        ).filter("probe <> key").select("match", "seg", F.col("probe").alias("key")).unionByName(index)
    found = ball.withColumnRenamed("match", "print").join(index, ["seg", "key"]).filter("print <> match")
    near = F.bit_count(F.col("print").bitwiseXOR(F.col("match"))) <= distance
    return found.filter(near).select(
        F.least("print", "match").alias("low"), F.greatest("print", "match").alias("high")
    ).distinct()


def _stars(u, v):
    """Each node that is not the least one of its component, and the least one."""
    nodes, ends = np.unique(np.concatenate([u, v]), return_inverse=True)
    a, b = np.split(ends, 2)
    own = np.arange(len(nodes))
    root, moved = own, True
    while moved:
        low = np.minimum(root[a], root[b])
        hung = root.copy()
        np.minimum.at(hung, root[a], low)
        np.minimum.at(hung, root[b], low)
        while (hung[hung] != hung).any():
            hung = hung[hung]
        root, moved = hung, (hung != root).any()
    hanging = np.flatnonzero(root != own)
    return nodes[hanging], nodes[root[hanging]]


def _contracted(batches):
    """The edges of a task as stars, in stretches of at most about ``STRETCH`` edges."""
    u, v = (np.zeros(0, np.int64),) * 2
    for batch in batches:
        u, v = (np.append(x, batch.column(c).to_numpy()) for x, c in ((u, "u"), (v, "v")))
        if len(u) >= STRETCH:
            yield pa.RecordBatch.from_arrays([pa.array(x) for x in _stars(u, v)], names=["u", "v"])
            u, v = (np.zeros(0, np.int64),) * 2
    if len(u):
        yield pa.RecordBatch.from_arrays([pa.array(x) for x in _stars(u, v)], names=["u", "v"])


def components(pairs: DataFrame) -> DataFrame:
    """(``node``, ``root``): the least node of each connected component of the pairs of longs.

    Every task turns the edges it works on into stars, which loses no connection. Where stars of several tasks
    meet, the least parent of a node gives way to its own parent, twice in a round, and what stands above
    another parent is tied to what stands above the least one, until all edges are one set of stars. Edges never become more, and each round writes two
    tables. A hot parent's children are never gathered into a list; the parents are written before they
    are joined, because Spark splits a hot key of a join only where both sides come straight from a shuffle.
    """
    edge = "u long, v long"
    edges = written(pairs.select(F.col("high").cast("long").alias("u"), F.col("low").cast("long").alias("v")), "edges")
    edges = written(edges.mapInArrow(_contracted, edge), "stars")
    while True:
        parents = written(edges.groupBy("u").agg(F.min("v").alias("v"), F.max("v").alias("most")), "parents")
        above = parents.select(F.col("u").alias("v"), F.col("v").alias("m"))
        # Done if nobody has two parents and no parent has a parent.
        if parents.filter("v <> most").select("u").unionByName(parents.join(above, "v", "left_semi").select("u")).isEmpty():
            return parents.select(F.col("u").alias("node"), F.col("v").alias("root"))
        lifted = lambda rows, end: rows.join(above.toDF(end, "above"), end, "left").withColumn(
            end, F.coalesce("above", end)).drop("above")
        raised = lifted(lifted(parents.select("u", "v"), "v"), "v").select("u", "v")
        least = parents.filter("v <> most").select("u", F.col("v").alias("m"))
        others = lifted(lifted(edges.join(least, "u").filter("v <> m").select("v", "m"), "v"), "m")
        others = others.filter("v <> m").select(F.greatest("v", "m").alias("u"), F.least("v", "m").alias("v"))
        edges = written(raised.unionByName(others).mapInArrow(_contracted, edge), "stars")


def _rooted(prints: DataFrame, least, distance) -> DataFrame:
    """(``print``, ``least``, ``root``) of each distinct fingerprint; ``least`` is an aggregate of its rows."""
    nodes = written(prints.groupBy("print").agg(least.alias("least")), "nodes")
    roots = components(near_pairs(nodes.select("print"), distance))
    return nodes.join(roots, nodes["print"] == roots["node"], "left").select(
        "print", "least", F.coalesce("root", "print").alias("root"))


def groups(documents: DataFrame, shingle=3, distance=3) -> DataFrame:
    """``documents`` without its text, with ``print``, ``root`` and ``component_id``.

    ``component_id`` is the smallest ``doc_id`` that can be reached over links between fingerprints
    of ``distance`` or fewer differing bits. Copies share a fingerprint, which is one node whatever
    their number; ``root`` is the least fingerprint of the component. Rows with a null ``doc_id`` take
    part; a component of nothing else has a null id. Input columns named like a result are replaced.
    Empty and null texts have fingerprint 0 and link like any other.
    """
    prints = written(fingerprints(documents.drop("component_id", "root"), shingle), "prints")
    rooted = written(_rooted(prints, F.min("doc_id"), distance), "rooted")
    named = written(rooted.groupBy("root").agg(F.min("least").alias("component_id")), "named")
    member = written(rooted.join(named, "root").select("print", "root", "component_id"), "member")
    return prints.join(member, "print")


def keep_one(documents: DataFrame, shingle=3, distance=3) -> DataFrame:
    """One row of each group: the least ``doc_id`` (a null one only if there is no other).

    Rows of equal id and text are known by 96 hash bits; of several, the one with the least other
    columns stays.
    """
    columns = documents.columns
    keyed = documents.withColumns({"u1": F.xxhash64("doc_id", "text"), "u2": F.hash("doc_id", "text")})
    prints = fingerprints(keyed.select("doc_id", "text", "u1", "u2"), shingle)
    rooted = _rooted(prints, F.min(F.struct(F.col("doc_id").isNull(), "doc_id", "u1", "u2")), distance)
    kept = written(rooted.groupBy("root").agg(F.min("least").alias("first")).select("first.u1", "first.u2"), "kept")
    rows = keyed.join(kept, ["u1", "u2"], "left_semi").groupBy("u1", "u2").agg(
        F.min(F.struct("doc_id", "text", *[c for c in columns if c not in ("doc_id", "text")])).alias("row"))
    return rows.select("row.*").select(*columns)
