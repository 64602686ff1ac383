"""Exact item-to-item cosine similarity above a threshold.

Items with the same vector share a *profile*; scores are computed between profiles only. A
similarity result is therefore two tables:

* ``members`` (mid, pid): the profile of each item, named by its smallest mid;
* ``pairs`` (pid, other, score, size, before, tie): every ordered pair of profiles above the threshold,
  and each profile with itself. ``size`` is the number of items of ``other``, ``before`` the number of
  items of all profiles that score higher for ``pid``, ``tie`` the place of ``other`` among the profiles
  of equal score, from 1 by pid.

Together they hold every similar pair of items without ever writing the square of a group of
copies. Lists, counts and candidates are read from the two tables.
"""

import math
from collections.abc import Iterator
from typing import NamedTuple

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F
from pyspark.sql import types as T

from marquee.functions.scalars import vector_norm
from marquee.operators import tiles
from marquee.session import written

DIGITS = 6
# Ids are long inside; results have the id type of their input.
PAIR = "pid long, other long, score double"
SIZED = f"{PAIR}, size long"
STRIP = 512
# Columns of one product of a strip.
SPAN = 8192
# Found pairs that a task holds before it keeps the best of them.
HELD_PAIRS = 1 << 21
# Members of a profile are numbered in stretches of this many consecutive mids.
STRETCH = 4096
# Entries of lists that one task spreads.
TASK_ENTRIES = 1 << 20
# Ranked members are fetched in blocks of this many ranks.
RANK_BLOCK = 32


class SimilarItems(NamedTuple):
    members: DataFrame
    pairs: DataFrame


def assign_profiles(items: DataFrame, key) -> DataFrame:
    """(mid, pid): items with equal ``key`` get the smallest mid of their group."""
    keyed = items.select("mid", key.alias("key"))
    heads = keyed.groupBy("key").agg(F.min("mid").alias("pid"))
    return keyed.join(heads, "key").select("mid", "pid")


def unit_vectors(vectors: DataFrame, column="vec") -> DataFrame:
    """Vectors scaled to length one; vectors without a usable length are left out."""
    norm = vector_norm(column)
    # Spark writes an expression out wherever it is used: inside the function it would be computed for each element.
    return (
        vectors.withColumn("norm", norm)
        .filter((F.col("norm") > 0) & ~F.isnan("norm"))
        .withColumn(column, F.expr(f"zip_with({column}, array_repeat(norm, size({column})), (x, y) -> x / y)"))
        .drop("norm")
    )


# --- all pairs of dense vectors -------------------------------------------------------------


def dense_pairs(vectors: DataFrame, threshold, block_rows=2048, keep=None) -> DataFrame:
    """(pid, other, score, size) with cosine above ``threshold`` from (pid, vec, size) with vectors of length one, both directions.

    Vectors are homed at the nearest of some pivot vectors. By the triangle inequality for
    angles a vector can only match a home of pivot b when its angle to b is at most the
    threshold angle plus the radius of b, so it is only compared with those homes. Whole homes are
    packed into tiles, large ones into several. Tiles with homes in reach of each other meet in one task, and only
    pairs above the threshold leave it, batch by batch. With ``keep`` only the first ``keep`` of each pid by
    (score desc, other) do. ``size`` is that of ``other``: it travels with the vectors, so that no shuffle of the
    pairs has to fetch it.
    """
    id_type = vectors.schema["pid"].dataType
    unit = vectors.select(F.col("pid").cast("long").alias("pid"), "vec", "size")
    size = unit.count()
    # One home per block of rows, and no more than the square root of the rows: pivots reach the driver.
    wanted = max(1, min(-(-size // block_rows), math.isqrt(size)))
    pivots = _pivots(unit, wanted)
    homed = written(_nearest(unit, pivots), "homes")
    # A row per pivot.
    sizes = homed.groupBy("grp").agg(F.count("*").alias("n"), F.max("angle").alias("radius")).collect()
    radii = {r["grp"]: r["radius"] for r in sizes}
    reach = np.array([radii.get(b, -np.inf) for b in range(len(pivots))]) + np.arccos(np.clip(threshold, -1, 1))
    places = unit.sparkSession.createDataFrame(
        _tile_places({r["grp"]: r["n"] for r in sizes}, tiles.tile_rows(size, 8 * pivots.shape[1], block_rows)),
        "grp int, first int, parts int")
    met = written(_tile_pairs(_visits(homed, pivots, reach), places), "tile-pairs")
    part = F.pmod(F.xxhash64("pid"), F.col("parts")).cast("int")
    packed = tiles.packed(homed.join(places, "grp").select(
        (F.col("first") + part).alias("tile"), F.col("pid").alias("id"), F.col("grp").alias("home"), "vec", "size"), "float64")
    routed = met.select("x", "y", F.explode(F.array_distinct(F.array("x", "y"))).alias("tile")).join(packed, "tile")
    schema = SIZED if keep is not None else f"{SIZED}, own long"
    found = routed.groupBy("x", "y").applyInArrow(_meeting(pivots, threshold, keep), schema)
    if keep is None:
        return _both_ways(_rounded(found, threshold), id_type, ("size", "own"))
    best = _first(found, "pid", [F.desc("score"), "other"], keep)
    return best.select(F.col("pid").cast(id_type).alias("pid"), F.col("other").cast(id_type).alias("other"), "score", "size")


def _tile_places(sizes, rows):
    """(grp, first tile, tiles) of each home: small ones share a tile of at most ``rows`` rows."""
    out, at, filled = [], 0, 0
    for grp in sorted(sizes):
        parts = -(-sizes[grp] // rows)
        if filled and filled + sizes[grp] > rows:
            at, filled = at + 1, 0
        out.append((grp, at, parts))
        if parts > 1:
            at += parts
        else:
            filled += sizes[grp]
    return out


def _tile_pairs(visits, places):
    """(x, y): the pairs of tiles, x up to y, that hold homes in reach of each other."""
    both = visits.distinct().unionByName(places.select(F.col("grp").alias("home"), "grp"))
    held = places.select("grp", F.explode(F.sequence("first", F.col("first") + F.col("parts") - 1)).alias("tile"))
    joined = both.join(held.toDF("home", "a"), "home").join(held.toDF("grp", "b"), "grp")
    return joined.select(F.least("a", "b").alias("x"), F.greatest("a", "b").alias("y")).distinct()


def _pivots(unit, wanted):
    """``wanted`` vectors, chosen by hash order so that a rerun picks the same."""
    rows = unit.orderBy(F.xxhash64("pid"), "pid").limit(wanted).select("vec").collect()
    return np.unique(np.array([r["vec"] for r in rows]), axis=0) if rows else np.zeros((0, 1))


def _angles(vecs, pivots):
    return np.arccos(np.clip(vecs @ pivots.T, -1.0, 1.0))


def _nearest(unit, pivots):
    def nearest(batches):
        for pdf in batches:
            for at in range(0, len(pdf), STRIP):
                rows = pdf.iloc[at:at + STRIP]
                angles = _angles(np.stack(rows["vec"].to_numpy()), pivots)
                home = angles.argmin(axis=1)
                yield rows.assign(grp=home.astype("int32"), angle=angles[np.arange(len(rows)), home])

    return unit.mapInPandas(nearest, T.StructType(
        [*unit.schema.fields, T.StructField("grp", T.IntegerType()), T.StructField("angle", T.DoubleType())]))


def _visits(homed, pivots, reach):
    """(home, grp): homes with a vector that has to visit the home ``grp``, one of a larger number."""

    def visits(batches):
        near = np.zeros((len(pivots), len(pivots)), bool)
        for pdf in batches:
            for at in range(0, len(pdf), STRIP):
                rows = pdf.iloc[at:at + STRIP]
                # The slack covers rounding of the angles; the product decides in the end.
                visited = _angles(np.stack(rows["vec"].to_numpy()), pivots) <= reach[None, :] + 1e-6
                np.logical_or.at(near, rows["grp"].to_numpy(), visited)
        home, grp = np.nonzero(np.triu(near, 1))
        for at in range(0, len(home), HELD_PAIRS):
            yield pd.DataFrame({"home": home[at:at + HELD_PAIRS].astype("int32"), "grp": grp[at:at + HELD_PAIRS].astype("int32")})

    return homed.mapInPandas(visits, "home int, grp int")


def _chunked(rows, block_rows):
    """Adds ``chunk`` and ``chunks``: a group is cut into pieces of about ``block_rows`` rows."""
    sizes = rows.groupBy("grp").agg(
        F.ceil(F.count("*") / F.lit(block_rows)).cast("int").alias("chunks")
    )
    return _placed(rows.join(sizes, "grp"))


def _placed(rows):
    return rows.withColumn("chunk", F.pmod(F.xxhash64("pid"), F.col("chunks")).cast("int"))


def _meeting(pivots, threshold, keep):
    """A task function: the pairs of the rows of two tiles, or of one with itself."""

    def meet(key: tuple[pa.Scalar, ...], batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held = {}
        for batch in batches:
            for row in batch.select(["tile", "ids", "homes", "vecs", "sizes"]).to_pylist():
                held[row["tile"]] = (
                    *tiles.unpacked(row["ids"], row["homes"], row["vecs"], "float64"), np.frombuffer(row["sizes"], "int64"))
        x, y = key[0].as_py(), key[1].as_py()
        (left, _, _, left_sizes), (right, _, _, right_sizes) = held[x], held[y]
        best = None if keep is None else _Best(left, right, left_sizes, right_sizes, x == y, keep)
        for i, j, score in _close(held[x][:3], held[y][:3], x == y, pivots, threshold, best):
            if best is None:
                yield _pair_batch(left[i], right[j], score, right_sizes[j], left_sizes[i])
            else:
                best.add(i, j, score, threshold)
        if best is not None:
            yield from best.batches()

    return meet


def _pair_batch(*columns):
    names = ["pid", "other", "score", "size", "own"][:len(columns)]
    return pa.RecordBatch.from_arrays([pa.array(c) for c in columns], names=names)


def _close(a, b, same, pivots, threshold, best):
    """Places in two tiles, and products, of the pairs that may exceed the threshold, each pair once.

    Single precision finds them, and double precision scores what it finds.
    """
    left, (_, homes, right) = a[2], b
    small_left, small_right = left.astype("float32"), right.astype("float32")
    least = threshold - 1e-5 - 2e-7 * left.shape[1]
    starts = np.flatnonzero(np.append(True, homes[1:] != homes[:-1]))
    for start, end in zip(starts.tolist(), np.append(starts[1:], len(homes)).tolist()):
        pivot = pivots[homes[start]]
        radius = np.arccos(np.clip((right[start:end] @ pivot).min(), -1, 1))
        reach = radius + np.arccos(np.clip(threshold, -1, 1)) + 1e-6
        # In one tile the rows of a home meet those of earlier homes and each other.
        rows = np.arange(end if same else len(left))
        rows = rows[(left[rows] @ pivot >= np.cos(min(reach, np.pi)) - 1e-9) | ((rows >= start) & same)]
        for at in range(0, len(rows), STRIP):
            strip = rows[at:at + STRIP]
            for first in range(start, end, SPAN):
                scores = small_left[strip] @ small_right[first:min(first + SPAN, end)].T
                i, j = np.nonzero(scores > least)
                found = scores[i, j]
                i, j = strip[i], j + first
                wanted = np.ones(len(i), bool) if not same else j > i
                if best is not None:
                    wanted &= best.may_count(i, j, found)
                i, j = i[wanted], j[wanted]
                for cut in range(0, len(i), STRIP * STRIP):
                    p, q = i[cut:cut + STRIP * STRIP], j[cut:cut + STRIP * STRIP]
                    score = np.einsum("ij,ij->i", left[p], right[q])
                    kept = score > threshold - 1e-5
                    if kept.any():
                        yield p[kept], q[kept], score[kept]


class _Best:
    """The first ``keep`` partners of every row of two tiles, by (score desc, other)."""

    def __init__(self, left, right, left_sizes, right_sizes, same, keep):
        self.ids = left if same else np.concatenate([left, right])
        self.sizes = left_sizes if same else np.concatenate([left_sizes, right_sizes])
        self.shift, self.keep = 0 if same else len(left), keep
        self.floor = np.full(len(self.ids), -np.inf)
        self.found, self.waiting = [], 0

    def may_count(self, i, j, score):
        slack = 1e-4
        return (score >= self.floor[i] - slack) | (score >= self.floor[j + self.shift] - slack)

    def add(self, i, j, score, threshold):
        j, score = j + self.shift, np.round(score, DIGITS)
        for row, other in ((i, j), (j, i)):
            counts = (score > threshold) & (score >= self.floor[row])
            self.found.append((row[counts], other[counts], score[counts]))
            self.waiting += int(counts.sum())
        if self.waiting > HELD_PAIRS:
            self._cut()

    def _cut(self):
        row, other, score = (np.concatenate(c) for c in zip(*self.found))
        order = np.lexsort((self.ids[other], -score, row))
        row, other, score = row[order], other[order], score[order]
        place = np.arange(len(row)) - np.searchsorted(row, row)
        last = place == self.keep - 1
        self.floor[row[last]] = score[last]
        kept = place < self.keep
        self.found = [(row[kept], other[kept], score[kept])]
        # What is kept does not count towards the next cut.
        self.waiting = 0

    def batches(self):
        if self.found:
            self._cut()
            row, other, score = self.found[0]
            for at in range(0, len(row), STRIP * STRIP):
                cut = slice(at, at + STRIP * STRIP)
                yield _pair_batch(self.ids[row[cut]], self.ids[other[cut]], score[cut], self.sizes[other[cut]])


def _product(left_ids, left, right_ids, right, threshold, same):
    found = []
    for at in range(0, len(left), STRIP):
        scores = left[at:at + STRIP] @ right.T
        i, j = np.nonzero(scores > threshold - 1e-5)
        if same:
            upper = j > i + at
            i, j = i[upper], j[upper]
        found.append((left_ids[i + at], right_ids[j], scores[i, j]))
    return _pair_frame(found)


def _pair_frame(found):
    if not found:
        return pd.DataFrame({"pid": np.empty(0, "int64"), "other": np.empty(0, "int64"), "score": np.empty(0)})
    pid, other, score = (np.concatenate(part) for part in zip(*found))
    return pd.DataFrame({"pid": pid.astype("int64"), "other": other.astype("int64"), "score": score})


def _rounded(pairs, threshold):
    return pairs.withColumn("score", F.round("score", DIGITS)).filter(F.col("score") > threshold)


def _both_ways(pairs, id_type, sizes=None):
    """``sizes`` names the columns with the sizes of ``other`` and of ``pid``, if there are any."""
    pid, other = F.col("pid").cast(id_type), F.col("other").cast(id_type)
    size, own = ([F.col(c).alias("size")] for c in sizes) if sizes else ([], [])
    return pairs.select(
        F.explode(F.array(
            F.struct(pid.alias("pid"), other.alias("other"), "score", *size),
            F.struct(other.alias("pid"), pid.alias("other"), "score", *own),
        )).alias("p")
    ).select("p.*")


# --- all pairs of sparse vectors ------------------------------------------------------------


def sparse_pairs(weights: DataFrame, threshold, block_rows=512) -> DataFrame:
    """(pid, other, score) with cosine above ``threshold`` from (pid, term, w, df), both directions.

    ``df`` orders the terms, rarest first. With vectors scaled to length one, two of them can only
    exceed the threshold when they share a term of their *prefixes*: the leading rare terms up to where the
    rest of the vector is shorter than the threshold. Pairs are therefore looked for per prefix
    term, and frequent terms are hardly ever among them. The holders of one prefix term are cut
    into blocks and compared block against block.
    """
    # One array per profile; a profile has as many entries as distinct terms.
    vectors = weights.filter(F.col("w") != 0).groupBy("pid").agg(
        F.array_sort(F.collect_list(F.struct("df", F.xxhash64("term").alias("t"), "w"))).alias("raw"),
        F.sqrt(F.sum(F.col("w") * F.col("w"))).alias("norm"),
    )
    terms = vectors.withColumn("terms", F.expr("transform(raw, x -> struct(x.t AS t, x.w / norm AS w))"))
    # One running sum of squares tells how many leading terms belong to the prefix.
    leading = f"""aggregate(terms, struct(0 AS n, 0D AS used), (acc, y) -> struct(
        acc.n + IF(1 - acc.used >= {threshold * threshold - 1e-9}, 1, 0) AS n, acc.used + y.w * y.w AS used)).n"""
    prefixed = terms.withColumn("prefix", F.expr(f"slice(terms, 1, {leading})"))
    posted = prefixed.select(
        F.explode("prefix.t").alias("grp"), "pid",
        F.col("terms.t").alias("idx"), F.col("terms.w").alias("val"),
    )
    blocks = _chunked(posted, block_rows)
    routed = blocks.select(
        "grp", "pid", "idx", "val", "chunk",
        F.explode(F.sequence(F.lit(0), F.col("chunks") - 1)).alias("partner"),
    ).select(
        "grp", "pid", "idx", "val", "chunk",
        F.least("chunk", "partner").alias("x"), F.greatest("chunk", "partner").alias("y"),
    )

    def compare(pdf):
        x, y = pdf["x"].iat[0], pdf["y"].iat[0]
        a = pdf[pdf["chunk"] == x]
        b = a if x == y else pdf[pdf["chunk"] == y]
        if not len(a) or not len(b):
            return _pair_frame([])
        vocabulary = np.intersect1d(np.concatenate(a["idx"].to_numpy()), np.concatenate(b["idx"].to_numpy()))
        left = _densify(a, vocabulary)
        right = left if x == y else _densify(b, vocabulary)
        return _product(a["pid"].to_numpy(), left, b["pid"].to_numpy(), right, threshold, x == y)

    found = routed.groupBy("grp", "x", "y").applyInPandas(compare, PAIR)
    # A pair that shares several prefix terms is found once for each.
    ordered = found.select(
        F.least("pid", "other").alias("pid"), F.greatest("pid", "other").alias("other"), "score"
    )
    once = _rounded(ordered, threshold).groupBy("pid", "other").agg(F.max("score").alias("score"))
    return _both_ways(once, weights.schema["pid"].dataType)


def _densify(block, vocabulary):
    dense = np.zeros((len(block), len(vocabulary)))
    lengths = block["idx"].str.len().to_numpy()
    rows = np.repeat(np.arange(len(block)), lengths)
    terms = np.concatenate(block["idx"].to_numpy())
    at = np.minimum(np.searchsorted(vocabulary, terms), max(len(vocabulary) - 1, 0))
    known = vocabulary[at] == terms if len(vocabulary) else np.zeros(len(terms), bool)
    dense[rows[known], at[known]] = np.concatenate(block["val"].to_numpy())[known]
    return dense


def similar_items(members: DataFrame, found: DataFrame, usable: DataFrame) -> SimilarItems:
    """The two tables from ``found`` (pid, other, score) and the ``usable`` profiles (pid)."""
    own = usable.select("pid", F.col("pid").alias("other"), F.lit(1.0).alias("score"))
    sizes = members.groupBy(F.col("pid").alias("other")).agg(F.count("*").alias("size"))
    return _ranked(members, found.select("pid", "other", "score").unionByName(own).join(sizes, "other"))


def _ranked(members, sized):
    """The two tables from (pid, other, score, size) of all pairs, those of a profile with itself included."""
    upto = W.partitionBy("pid").orderBy(F.desc("score")).rangeBetween(W.unboundedPreceding, W.currentRow)
    equal = W.partitionBy("pid", "score")
    before = F.sum("size").over(upto) - F.sum("size").over(equal)
    tie = F.row_number().over(equal.orderBy("other")).cast("long")
    return SimilarItems(
        members, sized.select("pid", "other", "score", "size", before.alias("before"), tie.alias("tie"))
    )


def similar_vectors(items: DataFrame, threshold=0.6, block_rows=2048, keep=None) -> SimilarItems:
    """Similar items of (mid, vec) by cosine; copies of a vector form one profile.

    With ``keep`` the pairs hold the first ``keep`` other profiles of each, which is all that lists of ``keep`` - 1 read.
    """
    members = written(assign_profiles(items, F.col("vec")), "members")
    sizes = members.groupBy("pid").agg(F.count("*").alias("size"))
    heads = items.select(F.col("mid").alias("pid"), "vec").join(sizes, "pid")
    unit = written(unit_vectors(heads), "unit-vectors")
    own = unit.select("pid", F.col("pid").alias("other"), F.lit(1.0).alias("score"), "size")
    return _ranked(members, dense_pairs(unit, threshold, block_rows, keep).unionByName(own))


# --- reading a similarity result ------------------------------------------------------------


def neighbour_counts(index: SimilarItems) -> DataFrame:
    """(mid, neighbours): how many items are similar to each item, from the whole result."""
    per_profile = index.pairs.groupBy("pid").agg(F.sum("size").alias("n"))
    return index.members.join(per_profile, "pid").select("mid", (F.col("n") - 1).alias("neighbours"))


def neighbour_lists(index: SimilarItems, k, wanted: DataFrame = None) -> DataFrame:
    """(mid, recs): the exact first ``k`` similar items of each item, score desc, mid asc.

    ``wanted`` (mid) asks for some items only; any ``k`` is answered from the whole result. The
    ``k + 1`` smallest members of the ``k + 1`` best profiles always contain the answer, because
    a profile is named by its smallest member, and a profile with ``before`` better items gives at
    most ``k + 1 - before`` of them. All items of a profile read one shared list.
    """
    near = index.pairs.filter((F.col("before") <= k) & (F.col("tie") <= k + 1))
    members = index.members
    if wanted is not None:
        members = members.join(wanted.select("mid").distinct(), "mid", "left_semi")
        near = near.join(members.select("pid").distinct(), "pid", "left_semi")
    place = F.row_number().over(W.partitionBy("pid").orderBy("mid"))
    heads = index.members.withColumn("place", place).filter(F.col("place") <= k + 1).select(
        F.col("pid").alias("other"), "mid", "place"
    )
    best = _first(near.select("pid", "other", "score", "before"), "pid", [F.desc("score"), "other"], k + 1)
    within = best.join(heads, "other").filter(F.col("place") <= k + 1 - F.col("before"))
    merged = _first(within.select("pid", "mid", "score"), "pid", [F.desc("score"), "mid"], k + 1)
    shared = merged.groupBy("pid").agg(
        F.array_sort(F.collect_list(F.struct((-F.col("score")).alias("k"), "mid", "score"))).alias("list")
    )
    own = F.filter("list", lambda r: r.mid != F.col("mid"))
    recs = F.transform(F.slice(own, 1, k), lambda r: F.struct(r.mid.alias("mid"), r.score.alias("score")))
    return _dealt(members, shared, max(1, TASK_ENTRIES // (k + 1))).select("mid", recs.alias("recs")).filter(F.size("recs") > 0)


def _dealt(members, shared, rows):
    """``members`` joined with ``shared`` by pid, in tasks of about ``rows`` members.

    Spark sizes tasks by compressed bytes, of which ids have few and lists many. Profiles of more members are cut
    into parts, so that no task gets a large group of copies whole.
    """
    parts = members.groupBy("pid").agg(F.ceil(F.count("*") / F.lit(rows)).cast("int").alias("parts"))
    tasks = max(1, -(-members.count() // rows))
    keys = ["pid", "part"]
    left = members.join(parts, "pid").withColumn("part", F.pmod(F.xxhash64("mid"), F.col("parts")).cast("int"))
    right = shared.join(parts, "pid").withColumn("part", F.explode(F.sequence(F.lit(0), F.col("parts") - 1)))
    return left.drop("parts").repartition(tasks, *keys).join(right.drop("parts").repartition(tasks, *keys), keys)


def _first(rows, key, order, n):
    """The first ``n`` rows per key; Spark cuts each task's rows before the shuffle too."""
    return (
        rows.withColumn("_rank", F.row_number().over(W.partitionBy(key).orderBy(*order)))
        .filter(F.col("_rank") <= n)
        .drop("_rank")
    )


def pair_scores(index: SimilarItems, wanted: DataFrame, left="mid", right="other") -> DataFrame:
    """``wanted`` with the ``score`` of its two items; 0.0 when not similar or the same item."""
    own = index.members.select(F.col("mid").alias(left), F.col("pid").alias("_p"))
    other = index.members.select(F.col("mid").alias(right), F.col("pid").alias("_o"))
    scores = index.pairs.select(F.col("pid").alias("_p"), F.col("other").alias("_o"), F.col("score").alias("_s"))
    joined = wanted.join(own, left, "left").join(other, right, "left").join(scores, ["_p", "_o"], "left")
    score = F.when(F.col(left) == F.col(right), F.lit(0.0)).otherwise(F.coalesce("_s", F.lit(0.0)))
    return joined.withColumn("score", score).select(*wanted.columns, "score")


def member_ranks(members: DataFrame) -> DataFrame:
    """(pid, rank, mid): members of each profile numbered from 1 by mid.

    Numbered per stretch of mids and then shifted by the sizes of the earlier stretches, so a
    profile that holds a third of all items is numbered in many tasks.
    """
    placed = members.select("pid", "mid", F.floor(F.col("mid") / STRETCH).alias("stretch"))
    sizes = placed.groupBy("pid", "stretch").agg(F.count("*").alias("n"))
    before = W.partitionBy("pid").orderBy("stretch").rowsBetween(W.unboundedPreceding, -1)
    shifts = sizes.select("pid", "stretch", F.coalesce(F.sum("n").over(before), F.lit(0)).alias("shift"))
    inner = F.row_number().over(W.partitionBy("pid", "stretch").orderBy("mid"))
    return placed.withColumn("inner", inner).join(shifts, ["pid", "stretch"]).select(
        "pid", (F.col("inner") + F.col("shift")).alias("rank"), "mid"
    )


def unseen_neighbours(index: SimilarItems, events: DataFrame, seen: DataFrame, n) -> DataFrame:
    """(uid, mid, rank, candidate, candidate_pid, score): first ``n`` similar items a user has not seen.

    ``events`` holds (uid, mid); ``seen`` holds (uid, mid). The item of the event itself is no
    candidate. Exact without reading whole lists. The answer lies among the first ``need`` =
    ``n`` + (items the user has seen) of a list, so only profiles with ``before`` < ``need`` are fetched;
    of those, the ones stay whose better profiles hold fewer than ``n`` unseen items; and of each the
    first ``n`` + (members seen) items. Rows stay within events x ``n`` + seen items.
    """
    events = events.select("uid", "mid").distinct()
    known = seen.select("uid", "mid").join(
        events.select("uid").distinct(), "uid", "left_semi"
    ).unionByName(events).distinct()
    known_sizes = (
        known.join(index.members, "mid").groupBy("uid", F.col("pid").alias("other")).agg(F.count("*").alias("seen"))
    )
    totals = known_sizes.groupBy("uid").agg(F.sum("seen").alias("total"))

    # Equal powers of two make the range condition on ``before`` an equi-join.
    level = lambda count: F.floor(F.log2(count + 1))
    asking = (
        events.join(index.members, "mid").join(totals, "uid")
        .select("uid", "mid", "pid", (F.col("total") + n).alias("need"))
        .withColumn("level", F.explode(F.sequence(F.lit(0).cast("long"), level(F.col("need")))))
    )
    # Of profiles with equal scores the first ``need`` by pid hold the first ``need`` items, because a
    # profile is named by its smallest member: ties cannot fetch more than that either.
    first = F.greatest("before", F.col("tie") - 1)
    lists = index.pairs.withColumn("first", first).withColumn("level", level(F.col("first")))
    near = (
        asking.join(lists, ["pid", "level"]).filter(F.col("first") < F.col("need"))
        .join(known_sizes, ["uid", "other"], "left")
        .withColumn("seen", F.coalesce("seen", F.lit(0)))
        .withColumn("left", F.col("size") - F.col("seen"))
    )
    upto = W.partitionBy("uid", "mid").orderBy(F.desc("score")).rangeBetween(W.unboundedPreceding, W.currentRow)
    equal = W.partitionBy("uid", "mid", "score")
    kept = near.withColumn("better", F.sum("left").over(upto) - F.sum("left").over(equal)).filter(
        (F.col("better") < n) & (F.col("left") > 0)
    )

    block = lambda rank: F.floor((rank - 1) / RANK_BLOCK)
    ranked = member_ranks(index.members).select(
        F.col("pid").alias("other"), block(F.col("rank")).alias("block"),
        F.col("rank").alias("at"), F.col("mid").alias("candidate"),
    )
    fetched = kept.select(
        "uid", "mid", "other", "score", F.least(F.col("seen") + n, F.col("size")).alias("upto"),
    ).withColumn(
        "block", F.explode(F.sequence(F.lit(0).cast("long"), block(F.col("upto"))))
    ).join(ranked, ["other", "block"]).filter(F.col("at") <= F.col("upto"))
    fresh = fetched.join(
        known.select("uid", F.col("mid").alias("candidate")), ["uid", "candidate"], "left_anti"
    )
    order = W.partitionBy("uid", "mid").orderBy(F.desc("score"), "candidate")
    return (
        fresh.withColumn("rank", F.row_number().over(order))
        .filter(F.col("rank") <= n)
        .select("uid", "mid", "rank", "candidate", F.col("other").alias("candidate_pid"), "score")
    )
