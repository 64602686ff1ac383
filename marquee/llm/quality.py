"""A quality classifier by positive-unlabelled learning.

The features are shares of characters, words, lines and repeats of a whole text, each cut into bins;
the model is additive over bins. It minimises the non-negative unbiased risk: trusted positives give
the positive risk; the negative risk is that of unlabelled web text less the positives' part of it,
and a step that would make it negative is undone instead of taken. Labels 0 are used for nothing but
the class prior, which is the share of 1 among the labels that may be learnt from.
"""

from typing import NamedTuple

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from marquee.llm.frames import bucket_of, hashed_order
from marquee.llm.textbytes import WORDS, Hasher, Texts, mix, slices

BINS = 12
THRESHOLD = 0.3


def _class(members):
    table = np.zeros(256, dtype=np.int64)
    table[list(members)] = 1
    return table


CLASSES = {
    "lower": _class(range(97, 123)), "upper": _class(range(65, 91)), "digit": _class(range(48, 58)),
    "stop": _class(b".,;:?"), "bang": _class(b"!"), "bar": _class(b"|"), "symbol": _class(b"#*$%&<>~^_={}[]\\/@+"),
    "blank": _class(b" \t"), "break": _class(b"\n\r"), "high": _class(range(128, 256)),
}
FEATURES = (*CLASSES, "words", "word_length", "same_as_last", "distinct", "repeated", "line_words")


def _per_text(values, bounds):
    """Sums of ``values`` between consecutive bounds; empty stretches sum to 0."""
    sums = np.append(0, np.cumsum(values))
    return sums[bounds[1:]] - sums[bounds[:-1]]


def _seen_before(hashes, owner):
    """Marks values that occurred before in the same text."""
    keyed = mix(hashes + owner.astype(np.uint64) * np.uint64(0x9E3779B97F4A7C15))
    order = np.argsort(keyed, kind="stable")
    again = np.zeros(len(hashes), dtype=bool)
    again[order[1:]] = keyed[order[1:]] == keyed[order[:-1]]
    return again


def features(column):
    """One row of ``FEATURES`` per text; all 0 for a null or empty text."""
    texts = Texts(column)
    size = np.maximum(np.diff(texts.offsets), 1)
    out = [_per_text(t[texts.data], texts.offsets) / size for t in CLASSES.values()]
    lines = _per_text(CLASSES["break"][texts.data], texts.offsets) + 1
    n = np.diff(texts.first)
    some = np.maximum(n, 1)
    words, owner = texts.word_hashes(), texts.owner()
    same = np.zeros(len(words), dtype=bool)
    same[1:] = (words[1:] == words[:-1]) & (owner[1:] == owner[:-1])
    at = np.arange(max(len(words) - 2, 0))
    triple, inside = Hasher(words, WORDS).of(at, at + 3), owner[: len(at)] == owner[2:]
    repeat = np.zeros(len(words), dtype=bool)
    repeat[: len(at)] = _seen_before(np.where(inside, triple, at.astype(np.uint64)), owner[: len(at)]) & inside
    out += [
        np.log1p(n), _per_text(texts.ends - texts.starts, texts.first) / some,
        _per_text(same, texts.first) / some, 1 - _per_text(_seen_before(words, owner), texts.first) / some,
        _per_text(repeat, texts.first) / some, np.log1p(n / lines),
    ]
    return np.column_stack(out)


class Model(NamedTuple):
    edges: np.ndarray
    weights: np.ndarray
    prior: float

    def binned(self, rows):
        """Column numbers of the bins that are on, one per feature."""
        cells = np.column_stack([np.searchsorted(e, x, side="right") for e, x in zip(self.edges, rows.T)])
        return cells + np.arange(len(self.edges)) * (BINS + 1)

    def score(self, rows):
        margin = self.weights[self.binned(rows)].sum(axis=1) + self.weights[-1]
        return 1 / (1 + np.exp(-np.clip(margin, -30, 30)))


def fit(positives, unlabelled, prior, steps=3000, rate=0.1, decay=3e-6) -> Model:
    """Minimises the non-negative unbiased risk of the logistic loss with Adam, in full batches."""
    spread = np.quantile(unlabelled, np.linspace(0, 1, BINS + 1)[1:-1], axis=0).T
    # The last edge keeps what exceeds nearly all of the sample apart, the first one exact zeros.
    edges = np.sort(np.column_stack([np.full(len(spread), 1e-9), spread, np.quantile(unlabelled, 0.99, axis=0)]), axis=1)
    model = Model(edges, np.zeros(len(edges) * (BINS + 1) + 1), prior)
    at_p, at_u = model.binned(positives), model.binned(unlabelled)
    weights, size = model.weights, len(model.weights)
    first, second = np.zeros(size), np.zeros(size)

    def pulled(cells, slope):
        grad = np.bincount(cells.ravel(), np.repeat(slope, cells.shape[1]), size) / len(cells)
        grad[-1] = slope.mean()
        return grad

    for step in range(1, steps + 1):
        m_p = weights[at_p].sum(axis=1) + weights[-1]
        m_u = weights[at_u].sum(axis=1) + weights[-1]
        s_p, s_u = 1 / (1 + np.exp(-m_p)), 1 / (1 + np.exp(-m_u))
        negative = np.logaddexp(0, m_u).mean() - prior * np.logaddexp(0, m_p).mean()
        grad_negative = pulled(at_u, s_u) - prior * pulled(at_p, s_p)
        grad = prior * pulled(at_p, s_p - 1) + grad_negative if negative >= 0 else -grad_negative
        grad += decay * weights
        first = 0.9 * first + 0.1 * grad
        second = 0.999 * second + 0.001 * grad * grad
        weights -= rate * (first / (1 - 0.9**step)) / (np.sqrt(second / (1 - 0.999**step)) + 1e-8)
    return model


def _measured(batches):
    for batch in slices(batches):
        rows = features(batch.column("text"))
        yield pa.RecordBatch.from_arrays(
            [batch.column("doc_id"), pa.array(list(rows), pa.list_(pa.float64()))], names=["doc_id", "row"])


def _sample(documents, ids, most):
    """Features of up to ``most`` ids, the first ones in hashed order, sorted by id.

    Of the rows of an id the one with the least hash of its text counts, the least text if hashes are equal.
    """
    chosen = ids.select("doc_id").distinct().orderBy(hashed_order("doc_id"), "doc_id").limit(most)
    rows = documents.select("doc_id", "text").join(F.broadcast(chosen), "doc_id")
    single = rows.groupBy("doc_id").agg(F.min(F.struct(F.xxhash64("text").alias("hash"), "text")).alias("least"))
    key = documents.schema["doc_id"].dataType.simpleString()
    found = single.select("doc_id", "least.text").mapInArrow(_measured, f"doc_id {key}, row array<double>").collect()
    found.sort(key=lambda r: r.doc_id)
    return np.array([r.row for r in found]).reshape(len(found), len(FEATURES))


def train(documents: DataFrame, labels: DataFrame, positives=4000, unlabelled=8000, fold=5) -> Model | None:
    """Learns from rows whose crc32(doc_id) modulo ``fold`` is not 0.

    The samples are bounded by ``positives`` and ``unlabelled`` ids, with one row of each; risk and edges
    of bins come from them. Repeated rows count once. None without any positive.
    """
    allowed = bucket_of("doc_id", fold) != 0
    known = labels.filter(allowed).filter("quality is not null").groupBy("doc_id").agg(F.max("quality").alias("quality"))
    counts = known.agg(F.avg((F.col("quality") == 1).cast("double")).alias("prior")).first()
    if not counts.prior:
        return None
    good = _sample(documents, known.filter("quality = 1"), positives)
    rest = _sample(documents, documents.filter(allowed), unlabelled)
    if not len(good):
        return None
    return fit(good, rest, min(counts.prior, 1 - 1e-3))


def _scored(model):
    def run(batches):
        for batch in slices(batches):
            scores = np.full(batch.num_rows, 0.5)
            if model is not None:
                scores = model.score(features(batch.column("text")))
            names = [n for n in batch.schema.names]
            yield pa.RecordBatch.from_arrays([*batch.columns, pa.array(scores)], names=[*names, "score"])

    return run


def score(documents: DataFrame, model: Model | None, keep_text=True) -> DataFrame:
    """``documents`` with ``score`` (0 to 1) and ``predicted`` (1 from ``THRESHOLD`` up).

    Empty and null texts are scored like any other, by their zero features. Without a model every
    score is 0.5. Columns of the input that are named like a result are replaced.
    """
    rows = documents.drop("score", "predicted")
    schema = ", ".join([f"`{f.name}` {f.dataType.simpleString()}" for f in rows.schema.fields] + ["score double"])
    scored = rows.mapInArrow(_scored(model), schema)
    if not keep_text:
        scored = scored.drop("text")
    return scored.withColumn("predicted", (F.col("score") >= THRESHOLD).cast("int"))
