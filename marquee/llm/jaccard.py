"""Jaccard join of shingle sets by a token-group matrix.

Sets that look alike are partitioned into groups, and the matrix tells for each token which groups hold it: it
is the union of the tokens of a group's sets. A set whose overlap with a group's union is below the
overlap that a link needs has no partner in the group, so only groups that reach the bound are opened.

Groups come from min-hashes. Sets that meet a leader of their band, and are verified to link with it, form
cores; whoever is linked with a core's set belongs to its component, so sets of one core are never
compared with each other, and a group of copies costs as much as its size. The other sets are grouped, linked or
not, by the most frequent token that they have in the matrix if the sample holds it often, so that the many sets of
such a token are few groups, and else by their first band. Cores and groups are opened in blocks of bounded size. The matrix holds the
rarest tokens of each set only: of n tokens with an overlap of c needed, the n - c + 1 rarest share one
with every partner. How rare a token is comes from a sample, which decides the order and hence the cost but
no result, as any fixed order of tokens is right. Before the tokens of a block are fetched, parity sketches of
its sets (two to four bits a token) rule out pairs: sketches differ in no more bits than sets in tokens.
"""

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from marquee.llm.simhash import components
from marquee.llm.textbytes import WORDS, Hasher, Texts, mix, slices
from marquee.session import written

# Tokens that one side of a block may hold, unless a single set has more.
BLOCK_TOKENS = 1 << 20
# One text of so many is sampled for the order of tokens, which is kept in a table of 2 ** CELL_BITS bytes.
SAMPLE = 16
CELL_BITS = 22
SEEN_TWICE = 3
# Tokens of 2 ** HOT texts of the sample make groups of their own.
HOT = 4
BANDS = 4

FOLD = np.arange(256, dtype=np.uint8)
FOLD[ord("A"): ord("Z") + 1] += 32
TURNS = mix(np.arange(1, 2 * BANDS + 1, dtype=np.uint64)) | np.uint64(1)

EDGES = "high long, low long"


def _longs(x):
    return pa.array(x.astype(np.uint64).view(np.int64))


class Sets:
    """The distinct shingles of the texts of one Arrow array, as sorted 64-bit tokens text after text."""

    def __init__(self, column, shingle):
        column = pc.fill_null(column, "").cast(pa.large_binary())
        _, places, data = column.buffers()
        folded = FOLD[np.frombuffer(data, np.uint8)] if data is not None else np.zeros(0, np.uint8)
        texts = Texts(pa.Array.from_buffers(column.type, len(column), [None, places, pa.py_buffer(folded)], offset=column.offset))
        size, count = np.diff(texts.first), len(texts.first) - 1
        words = Hasher(texts.word_hashes(), WORDS)
        # The whole sequence of a text that is shorter than a shingle is one.
        n = np.where(size > 0, np.maximum(size - shingle + 1, 1), 0)
        owner = np.repeat(np.arange(count), n)
        start = np.arange(len(owner)) - np.repeat(np.cumsum(n) - n, n) + texts.first[owner]
        tokens = words.of(start, start + np.minimum(size, shingle)[owner])
        order = np.lexsort((tokens, owner))
        tokens, owner = tokens[order], owner[order]
        new = np.ones(len(tokens), bool)
        new[1:] = (tokens[1:] != tokens[:-1]) | (owner[1:] != owner[:-1])
        self.tokens, self.owner = tokens[new], owner[new]
        self.n = np.bincount(self.owner, minlength=count)
        self.first = np.append(0, np.cumsum(self.n))
        self.filled = np.flatnonzero(self.n)
        self.key = np.zeros(count, np.uint64)
        if len(self.filled):
            self.key[self.filled] = mix(self.per_set(np.add, mix(self.tokens)) + self.n[self.filled].astype(np.uint64))

    def sketches(self):
        """Per text the parities of its tokens modulo a power of two, as bytes."""
        bits = 64 << np.ceil(np.log2(np.maximum(self.n / 32, 1))).astype(np.int64)
        start = np.cumsum(bits) - bits
        place = start[self.owner] + (self.tokens & (bits - 1)[self.owner].astype(np.uint64)).astype(np.int64)
        parity = np.bincount(place, minlength=bits.sum()).astype(np.uint8) & 1
        packed = np.packbits(parity, bitorder="little").tobytes()
        return [packed[a // 8: b // 8] for a, b in zip(start.tolist(), (start + bits).tolist())]

    def per_set(self, reduce, values):
        return reduce.reduceat(values, self.first[:-1][self.filled])

    def rarest(self, levels, percent):
        """Places of the tokens of which a set needs one to have a link, rarest first, and their levels."""
        level = levels.value[(self.tokens >> np.uint64(64 - CELL_BITS)).astype(np.int64)]
        order = np.argsort(self.owner * 64 + level, kind="stable")
        place = np.arange(len(order)) - self.first[self.owner]
        at = order[place <= (self.n - _needed(self.n, percent))[self.owner]]
        return at, level[at]

    def homes(self, levels, percent, bands):
        """Per text its least one of the most frequent of these tokens, or its band if none is frequent."""
        at, level = self.rarest(levels, percent)
        at, level = at[level >= HOT], level[level >= HOT].astype(np.int64)
        order = np.lexsort((self.tokens[at], -level, self.owner[at]))
        owner, first = np.unique(self.owner[at][order], return_index=True)
        out = bands.copy()
        out[owner] = self.tokens[at[order[first]]]
        return out

    def fresh(self, seen):
        """Texts with a set that the task has not met before."""
        out = []
        for i in self.filled.tolist():
            k = int(self.key[i])
            if k not in seen:
                seen.add(k)
                out.append(i)
        return np.array(out, np.int64)


def _info(shingle, percent, levels):
    def run(batches):
        for batch in slices(batches):
            sets = Sets(batch.column("text"), shingle)
            least = np.zeros((2 * BANDS, len(sets.n)), np.uint64)
            if len(sets.filled):
                for row, turn in zip(least, TURNS):
                    row[sets.filled] = sets.per_set(np.minimum, sets.tokens * turn)
            bands = mix(least[0::2] * TURNS[0] + least[1::2] + TURNS[:BANDS, None])
            names = [c for c in batch.schema.names if c != "text"]
            yield pa.RecordBatch.from_arrays([
                *[batch.column(c) for c in names], _longs(sets.key), pa.array(sets.n), pa.array(sets.sketches(), pa.binary()),
                pa.ListArray.from_arrays(np.arange(0, bands.size + 1, BANDS, dtype=np.int32), _longs(bands.T.ravel())),
                _longs(sets.homes(levels, percent, bands[0])),
            ], names=[*names, "s", "n", "sketch", "bands", "home"])

    return run


def _tokens(shingle):
    def run(batches):
        for batch in slices(batches):
            yield pa.RecordBatch.from_arrays([_longs(Sets(batch.column("text"), shingle).tokens)], names=["token"])

    return run


def _needed(n, percent):
    """Least overlap of a set of ``n`` tokens with a partner."""
    return -(-n * percent // 100)


def _prefixes(shingle, percent, levels):
    def run(batches):
        seen = set()
        for batch in slices(batches):
            sets = Sets(batch.column("text"), shingle)
            at, _ = sets.rarest(levels, percent)
            chosen = np.zeros(len(sets.n), bool)
            chosen[sets.fresh(seen)] = True
            at = at[chosen[sets.owner[at]]]
            owner = sets.owner[at]
            yield pa.RecordBatch.from_arrays(
                [_longs(sets.tokens[at]), _longs(sets.key[owner]), pa.array(sets.n[owner])], names=["token", "s", "n"])

    return run


def _whole(shingle):
    def run(batches):
        seen = set()
        for batch in slices(batches):
            sets = Sets(batch.column("text"), shingle)
            chosen = sets.fresh(seen)
            pieces = [sets.tokens[sets.first[i]: sets.first[i + 1]].tobytes() for i in chosen.tolist()]
            yield pa.RecordBatch.from_arrays([_longs(sets.key[chosen]), pa.array(pieces, pa.binary())], names=["s", "tokens"])

    return run


def _folded(sketch, words):
    """Sketches (rows of ``sketch``) of fewer bits: the parities modulo the smaller power of two."""
    while sketch.shape[1] > words:
        half = sketch.shape[1] // 2
        sketch = sketch[:, :half] ^ sketch[:, half:]
    return sketch


def _sieve(percent):
    """A task function: the sets and queries of a block that can have a link in it."""

    def sieve(block: pa.Table) -> pa.Table:
        member, n = block["member"].to_numpy(), block["n"].to_numpy()
        sketch = [np.frombuffer(x.as_py(), np.uint64) for x in block["sketch"]]
        width, keys, keep = np.array([len(x) for x in sketch]), block["s"].to_numpy(), np.zeros(len(member), bool)
        queries = np.flatnonzero(~member)
        for w in np.unique(width[member]).tolist():
            inside = np.flatnonzero(member & (width == w))
            held = {w: np.stack([sketch[i] for i in inside])}
            for q in queries.tolist():
                least = min(w, width[q])
                if least not in held:
                    held[least] = _folded(held[w], least)
                apart = np.bitwise_count(held[least] ^ _folded(sketch[q][None], least)).sum(axis=1, dtype=np.int64)
                near = apart * (100 + percent) <= (n[inside] + n[q]) * (100 - percent)
                near &= keys[inside] != keys[q]
                keep[q] |= near.any()
                keep[inside[near]] = True
        return block.select(["c", "p", "q", "s", "member"]).filter(pa.array(keep))

    return sieve


def _compare(percent):
    """A task function: links of the queries of a block with its sets, as a spanning forest."""

    def compare(block: pa.Table) -> pa.Table:
        member = block["member"].to_numpy()
        keys, found = block["s"].to_numpy(), []
        sets = [np.frombuffer(x.as_py(), np.uint64) for x in block["tokens"]]
        inside, queries = np.flatnonzero(member), np.flatnonzero(~member)
        if len(inside) and len(queries):
            held = np.concatenate([sets[i] for i in inside])
            size = np.array([len(sets[i]) for i in inside])
            order = np.argsort(held, kind="stable")
            owner, held = np.repeat(np.arange(len(inside)), size)[order], held[order]
            union, start = np.unique(held, return_index=True)
            end, tree = np.append(start[1:], len(held)), np.arange(len(inside))
            for q in queries.tolist():
                mine = sets[q]
                place = np.minimum(np.searchsorted(union, mine), len(union) - 1)
                place = place[union[place] == mine]
                if len(place) < _needed(len(mine), percent):
                    continue
                count = end[place] - start[place]
                at = np.arange(count.sum()) - np.repeat(np.cumsum(count) - count - start[place], count)
                both = np.bincount(owner[at], minlength=len(inside))
                linked = (100 * both >= percent * (len(mine) + size - both)) & (keys[inside] != keys[q])
                partners = np.flatnonzero(linked)
                trees, first = np.unique(tree[partners], return_index=True)
                found += [(keys[q], keys[inside[i]]) for i in partners[first].tolist()]
                if len(trees) > 1:
                    tree[np.isin(tree, trees)] = trees[0]
        edges = np.array(found, np.int64).reshape(-1, 2)
        return pa.table({"high": edges.max(axis=1, initial=-(1 << 63)), "low": edges.min(axis=1, initial=(1 << 63) - 1)})

    return compare


def _open(visits, documents, sets, shingle, percent) -> DataFrame:
    """Links (``high``, ``low``) in the blocks of ``visits`` (c, p, q, s, member), which is a written table."""
    kind = visits.schema["c"].dataType.simpleString()
    sketched = visits.join(sets.select("s", "n", "sketch"), "s").select(*visits.columns, "n", "sketch")
    visits = written(sketched.groupBy("c", "p", "q").applyInArrow(
        _sieve(percent), f"c {kind}, p long, q long, s long, member boolean"), "sieved")
    asked = visits.select("s").distinct().join(sets.select("s", "at.*"), "s").select("u1", "u2").distinct()
    texts = documents.join(written(asked, "asked"), ["u1", "u2"], "left_semi").select("text")
    tokens = texts.mapInArrow(_whole(shingle), "s long, tokens binary").groupBy("s").agg(F.first("tokens").alias("tokens"))
    rows = visits.join(written(tokens, "tokens"), "s").select("c", "p", "q", "s", "member", "tokens")
    return written(rows.groupBy("c", "p", "q").applyInArrow(_compare(percent), EDGES).distinct(), "links")


def _parts(weight):
    return F.ceil(F.sum(weight) / BLOCK_TOKENS).cast("long")


def _dealt(parts):
    return F.pmod(F.xxhash64("s", F.lit(0)), F.col(parts))


def _token_levels(documents, shingle, sample):
    """How frequent the tokens of each cell are in a sample, as a logarithm; at most 2 ** CELL_BITS rows are collected."""
    some = documents.filter(F.pmod(F.xxhash64("text"), F.lit(sample)) == 0).select("text")
    often = some.mapInArrow(_tokens(shingle), "token long").groupBy("token").agg(F.count("*").alias("df"))
    cell = F.shiftrightunsigned("token", 64 - CELL_BITS).alias("cell")
    rows = (
        often.filter(F.col("df") >= SEEN_TWICE).groupBy(cell)
        .agg(F.max(F.floor(F.log2("df"))).cast("int").alias("level")).toArrow()
    )
    out = np.zeros(1 << CELL_BITS, np.uint8)
    out[rows["cell"].to_numpy()] = rows["level"].to_numpy()
    return documents.sparkSession.sparkContext.broadcast(out)


def _leader_links(sets, documents, shingle, percent):
    """Verified links of sets with the first and last set of their bands."""
    bands = sets.select("s", "n", F.explode("bands").alias("band"))
    ends = bands.groupBy("band").agg(F.min("s").alias("low"), F.max("s").alias("high")).filter("low < high")
    met = bands.join(written(ends, "ends"), "band").select("s", "n", F.explode(F.array("low", "high")).alias("c"))
    met = written(met.filter("s <> c").distinct(), "met")
    size = written(met.groupBy("c").agg(_parts("n").alias("parts")), "sizes")
    none = F.lit(0).cast("long")
    asking = met.join(size, "c").select("c", _dealt("parts").alias("p"), none.alias("q"), "s", F.lit(False).alias("member"))
    leading = asking.select("c", "p", "q").distinct().select("c", "p", "q", F.col("c").alias("s"), F.lit(True).alias("member"))
    return _open(written(asking.unionByName(leading), "visits"), documents, sets, shingle, percent)


def _matrix_links(sets, cores, documents, shingle, percent, levels):
    """Verified links between sets of different groups, and between sets without a core."""
    prefixes = documents.select("text").mapInArrow(_prefixes(shingle, percent, levels), "token long, s long, n long")
    of_token = W.partitionBy("token")
    shared = (
        prefixes.withColumns({"low": F.min("s").over(of_token), "high": F.max("s").over(of_token)})
        .filter("low < high").select("token", "s", "n").distinct()
    )
    size = written(cores.groupBy("root").agg(F.count("*").alias("size")), "core-sizes")
    placed = written(
        sets.join(cores, sets["s"] == cores["node"], "left").join(size, "root", "left")
        .select("s", "n", "home", "root", "size"), "placed")
    # c: a core, or the sets that have none and one home.
    alone = F.col("size").isNull()
    placed = placed.select("s", "n", alone.alias("alone"), F.coalesce("size", F.lit(0)).alias("size"),
                           F.struct(alone.alias("alone"), F.coalesce("root", "home").alias("id")).alias("c"))
    tokens = written(shared.join(placed.drop("n"), "s"), "matrix-tokens")
    matrix = written(tokens.groupBy("token", "c", F.col("size").alias("c_size")).agg(
        F.min("n").alias("least"), F.max("n").alias("most"), F.max("s").alias("last")), "matrix")
    fits = lambda least, most: (F.col(most) * 100 >= F.col("n") * percent) & (F.col(least) * percent <= F.col("n") * 100)
    # A set without a core asks all groups, of two such sets the smaller one; a core's sets ask larger cores.
    asks = F.when(F.col("to.alone"), F.col("alone") & (F.col("last") > F.col("s"))).otherwise(
        F.struct("size", "c.id") < F.struct("c_size", "to.id"))
    found = tokens.join(matrix.withColumnRenamed("c", "to"), "token").filter(asks & fits("least", "most"))
    found = written(found.select("s", "n", "to").distinct(), "found")

    parts = written(placed.join(found.select(F.col("to").alias("c")).distinct(), "c", "left_semi")
                    .groupBy("c").agg(_parts("n").alias("parts")), "group-parts")
    members = written(placed.join(parts, "c").select("c", _dealt("parts").alias("p"), "s", "n"), "members")
    blocks = members.groupBy("c", "p").agg(F.min("n").alias("least"), F.max("n").alias("most"), F.max("s").alias("last"))
    asking = found.withColumnRenamed("to", "c").join(written(blocks, "blocks"), "c").filter(
        fits("least", "most") & (~F.col("c.alone") | (F.col("last") > F.col("s")))).select("c", "p", "s", "n")
    asking = written(asking, "asking")
    turns = written(asking.groupBy("c", "p").agg(_parts("n").alias("turns")), "turns")
    asking = asking.join(turns, ["c", "p"]).select("c", "p", _dealt("turns").alias("q"), "s", F.lit(False).alias("member"))
    held = members.join(turns, ["c", "p"]).select(
        "c", "p", F.explode(F.sequence(F.lit(0).cast("long"), F.col("turns") - 1)).alias("q"), "s", F.lit(True).alias("member"))
    return _open(written(asking.unionByName(held), "visits"), documents, sets, shingle, percent)


def groups(documents: DataFrame, shingle=5, percent=80, sample=SAMPLE) -> DataFrame:
    """``documents`` without its text, with ``n_shingles`` and ``component_id``.

    A text's set is its distinct shingles of ``shingle`` words, A-Z lower-cased; with fewer words, the
    whole sequence as one; empty, blank and null texts have none and link with nothing. Texts whose sets share
    ``percent`` of 100 of their union link; ``component_id`` is the smallest ``doc_id`` that links reach.
    Texts with equal sets, repeated rows too, are one node whatever their number. Rows with a null ``doc_id``
    take part; a component of nothing else has a null id. Tokens are 64-bit hashes of shingles, and a set is
    known by 64 hash bits of tokens and size. Columns of the input that are named like a result are replaced.
    """
    rest = [f for f in documents.schema.fields if f.name not in ("text", "n_shingles", "component_id")]
    keyed = documents.select("text", F.xxhash64("text").alias("u1"), F.hash("text").alias("u2"))
    others = [F.col(f"`{f.name}`").alias(f"_{i}") for i, f in enumerate(rest)]
    schema = ", ".join([f"_{i} {f.dataType.simpleString()}" for i, f in enumerate(rest)]
                       + ["_id long, u1 long, u2 int, s long, n long, sketch binary, bands array<long>, home long"])
    rows = documents.select("text", *others, F.col("doc_id").cast("long").alias("_id"), F.xxhash64("text").alias("u1"), F.hash("text").alias("u2"))
    levels = _token_levels(keyed, shingle, sample)
    info = written(rows.mapInArrow(_info(shingle, percent, levels), schema), "info")
    sets = written(info.filter("n > 0").groupBy("s").agg(
        F.first("n").alias("n"), F.first("sketch").alias("sketch"), F.first("bands").alias("bands"), F.first("home").alias("home"),
        F.min(F.struct("u1", "u2")).alias("at"), F.min("_id").alias("least_id")), "sets")

    links = _leader_links(sets, keyed, shingle, percent)
    cores = written(components(links), "cores")
    more = _matrix_links(sets, cores, keyed, shingle, percent, levels)
    roots = written(components(written(links.unionByName(more), "all-links")), "roots")
    rooted = written(sets.join(roots, sets["s"] == roots["node"], "left").select(
        "s", "least_id", F.coalesce("root", "s").alias("root")), "rooted")
    least = written(rooted.groupBy("root").agg(F.min("least_id").alias("component")), "least-ids")
    named = written(rooted.join(least, "root").select("s", "component"), "named")
    return info.join(named, "s", "left").select(
        *[F.col(f"_{i}").alias(f.name) for i, f in enumerate(rest)], F.col("n").alias("n_shingles"),
        F.when(F.col("n") > 0, F.col("component")).otherwise(F.col("_id")).alias("component_id"),
    )
