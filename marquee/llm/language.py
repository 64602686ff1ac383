"""Language identification with a linear-chain conditional random field over the words of a text.

Words (runs of letters) are labelled one by one, so that code-switched texts get a mixture; the text's
language is the label with the largest expected number of words. A word's features are its affixes, its
byte trigrams and itself if the training lexicon has it; the transitions between labels are learnt too.
Marginals come from forward-backward. It runs over all texts of a slice as one chain with resets: the
chain is cut into equal stretches, whose transfer matrices carry the messages from one to the next, so
that numpy works across stretches and one very long text costs no more per word than many short ones.
"""

from typing import NamedTuple

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from marquee.llm.frames import bucket_of, hashed_order
from marquee.llm.textbytes import BYTES, LETTER, Hasher, Texts, mix, slices

UNKNOWN = "und"
TABLE = 1 << 17
STRETCH = 256

_LETTERS = np.zeros(256, dtype=bool)
_LETTERS[65:91] = _LETTERS[97:123] = _LETTERS[128:] = True


def _lowered(data):
    """ASCII and Latin-1 capitals of UTF-8 bytes in lower case."""
    out = data.copy()
    out[(data >= 65) & (data < 91)] += 32
    latin = np.zeros(len(data), dtype=bool)
    latin[1:] = (data[:-1] == 0xC3) & (data[1:] >= 0x80) & (data[1:] <= 0x9E) & (data[1:] != 0x97)
    out[latin] += 32
    return out


class Tokens:
    """Letter runs of the texts of an Arrow array, with the table cells of their features."""

    def __init__(self, column):
        texts = Texts(column)
        data, offsets = _lowered(texts.data), texts.offsets
        letter = _LETTERS[data]
        begin, finish = letter.copy(), letter.copy()
        begin[1:] &= ~letter[:-1]
        finish[:-1] &= ~letter[1:]
        filled = np.flatnonzero(np.diff(offsets))
        begin[offsets[filled]] = letter[offsets[filled]]
        finish[offsets[filled + 1] - 1] = letter[offsets[filled + 1] - 1]
        starts, ends = np.flatnonzero(begin), np.flatnonzero(finish) + 1
        self.first = np.searchsorted(starts, offsets)
        hashes = Hasher(LETTER[data], BYTES)
        size = ends - starts
        affix = [(starts, starts + np.minimum(n, size)) for n in (2, 3)]
        affix += [(ends - np.minimum(n, size), ends) for n in (2, 3, 4)]
        self.words = hashes.of(starts, ends)
        cells = [mix(hashes.of(a, b) + np.uint64(i)) for i, (a, b) in enumerate(affix)]
        cells.append(mix(self.words + np.uint64(9)))
        self.fixed = (np.column_stack(cells) & np.uint64(TABLE - 1)).astype(np.int32)
        inner = np.flatnonzero(letter[:-2] & letter[1:-1] & letter[2:] & ~begin[1:-1] & ~begin[2:]) if len(data) > 2 else np.zeros(0, np.int64)
        code = data[inner].astype(np.uint64) | (data[inner + 1].astype(np.uint64) << np.uint64(8)) | (
            data[inner + 2].astype(np.uint64) << np.uint64(16)) if len(inner) else np.zeros(0, np.uint64)
        self.grams = (mix(code + np.uint64(1 << 40)) & np.uint64(TABLE - 1)).astype(np.int32)
        self.gram_first = np.searchsorted(inner, np.append(starts, len(data)))

    def __len__(self):
        return len(self.words)

    def starting(self):
        """Marks the first word of each text."""
        out = np.zeros(len(self) + 1, dtype=bool)
        out[self.first[:-1]] = True
        return out[:-1]


def forward_backward(logits, start, trans, init):
    """Marginals (words x labels) of chains that begin where ``start`` is set, and expected transitions."""
    n, k = logits.shape
    parts = max(1, -(-n // STRETCH))
    p = np.ones((parts * STRETCH, k))
    p[:n] = np.exp(logits - logits.max(axis=1, keepdims=True))
    reset = np.ones(parts * STRETCH, dtype=bool)
    reset[:n] = start
    p, reset = p.reshape(parts, STRETCH, k), reset.reshape(parts, STRETCH)
    a, pi = np.exp(trans), np.exp(init)

    transfer = np.broadcast_to(np.eye(k), (parts, k, k)).copy()
    for t in range(STRETCH):
        moved = transfer @ a
        again = transfer.sum(axis=2, keepdims=True) * pi
        transfer = np.where(reset[:, t, None, None], again, moved) * p[:, t, None, :]
        transfer /= transfer.sum(axis=(1, 2), keepdims=True)
    into, out = np.ones((parts, k)), np.ones((parts, k))
    for s in range(1, parts):
        into[s] = into[s - 1] @ transfer[s - 1]
        into[s] /= into[s].sum()
        back = parts - s
        out[back - 1] = transfer[back] @ out[back]
        out[back - 1] /= out[back - 1].sum()

    alpha, beta = np.empty_like(p), np.empty_like(p)
    message = into
    for t in range(STRETCH):
        message = np.where(reset[:, t, None], pi, message @ a) * p[:, t]
        message = message / message.sum(axis=1, keepdims=True)
        alpha[:, t] = message
    message = out
    for t in range(STRETCH - 1, -1, -1):
        beta[:, t] = message
        weighted = p[:, t] * message
        message = np.where(reset[:, t, None], 1.0, weighted @ a.T)
        message = message / message.sum(axis=1, keepdims=True)
    alpha, beta = alpha.reshape(-1, k)[:n], beta.reshape(-1, k)[:n]
    marginals = alpha * beta
    marginals /= marginals.sum(axis=1, keepdims=True)

    def transitions():
        inside = np.flatnonzero(~start[1:]) + 1
        right = p.reshape(-1, k)[inside] * beta[inside]
        pairs = alpha[inside - 1][:, :, None] * a * right[:, None, :]
        return (pairs / pairs.sum(axis=(1, 2), keepdims=True)).sum(axis=0)

    return marginals, transitions


class Model(NamedTuple):
    labels: list
    table: np.ndarray
    trans: np.ndarray
    init: np.ndarray

    def logits(self, tokens):
        out = self.table[tokens.fixed].sum(axis=1, dtype=np.float64)
        if len(tokens.grams):
            sums = np.add.reduceat(np.vstack([self.table[tokens.grams], np.zeros((1, len(self.labels)), self.table.dtype)]),
                                   tokens.gram_first[:-1], axis=0)
            out += sums * (np.diff(tokens.gram_first) > 0)[:, None]
        return out


def fit(texts, languages, epochs=25, rate=0.3, decay=1e-3, piece=40, seen=2) -> Model:
    """Maximises the conditional likelihood with Adagrad in full batches.

    Every word of a training text carries the text's language. Texts are cut into pieces of ``piece``
    words that are dealt out in a fixed random order, so that chains switch and transitions are learnt.
    """
    labels = sorted(set(languages))
    tokens = Tokens(pa.array(texts, pa.string()))
    n, k = len(tokens), len(labels)
    owner = np.repeat(np.arange(len(texts)), np.diff(tokens.first))
    gold = np.array([labels.index(x) for x in languages])[owner]
    kinds, where, count = np.unique(tokens.words, return_inverse=True, return_counts=True)
    fixed, grams = tokens.fixed.copy(), tokens.grams
    rare = count[where] < seen  # words outside the lexicon: their affixes and trigrams speak for them
    gram_owner = np.repeat(np.arange(n), np.diff(tokens.gram_first))
    order = np.arange(n).reshape(-1)
    cuts = np.array_split(order, max(1, n // piece))
    shuffled = np.concatenate([cuts[i] for i in np.random.default_rng(7).permutation(len(cuts))]) if n else order
    start = np.zeros(n, dtype=bool)
    start[:: piece * 25] = True
    truth = np.eye(k)[gold]
    observed = np.zeros((k, k))
    inside = np.flatnonzero(~start[1:]) + 1
    np.add.at(observed, (gold[shuffled][inside - 1], gold[shuffled][inside]), 1)
    known = np.ones((n, fixed.shape[1]), dtype=bool)
    known[rare, -1] = False
    cell = np.concatenate([fixed[known], grams])
    cell_owner = np.concatenate([np.repeat(np.arange(n), known.sum(axis=1)), gram_owner])

    table, trans, init = np.zeros((TABLE, k)), np.zeros((k, k)), np.zeros(k)
    power = [np.full(x.shape, 1e-8) for x in (table, trans)]
    for _ in range(epochs):
        scores = np.column_stack([np.bincount(cell_owner, table[cell, j], n) for j in range(k)])
        marginals, transitions = forward_backward(scores[shuffled], start, trans, init)
        error = np.empty((n, k))
        error[shuffled] = truth[shuffled] - marginals
        slope = np.column_stack([np.bincount(cell, error[cell_owner, j], TABLE) for j in range(k)])
        for value, grad, sums in ((table, slope - decay * table, power[0]), (trans, observed - transitions() - decay * trans, power[1])):
            sums += grad * grad
            value += rate * grad / np.sqrt(sums)
    return Model(labels, table.astype(np.float32), trans, init)


def train(documents: DataFrame, fold=4, held=2, per_language=100, bytes_per_language=16 << 20) -> Model | None:
    """Learns from up to ``per_language`` texts of each language, the first ones in hashed order of id.

    Only rows with a language and with crc32(doc_id) modulo ``fold`` other than ``held`` are looked at. Of
    the rows of an id in one language the one with the least hash of its text counts. Texts that would take those
    of a language over ``bytes_per_language`` are not learnt from. None if there is no row to learn from.
    """
    usable = (bucket_of("doc_id", fold) != held) & F.col("lang").isNotNull() & F.col("text").isNotNull()
    rows = documents.filter(usable).select("doc_id", "lang", "text").withColumn("hash", F.xxhash64("text"))
    single = rows.groupBy("doc_id", "lang").agg(F.min(F.struct("hash", F.octet_length("text").alias("bytes"))).alias("least"))
    first = Window.partitionBy("lang").orderBy(hashed_order("doc_id"), "doc_id")
    small = single.select("doc_id", "lang", "least.*").filter(F.col("bytes") <= bytes_per_language)
    chosen = small.withColumn("nth", F.row_number().over(first)).filter(F.col("nth") <= per_language)
    chosen = chosen.withColumn("so_far", F.sum("bytes").over(first)).filter(F.col("so_far") <= bytes_per_language)
    found = rows.join(F.broadcast(chosen.select("doc_id", "lang", "hash")), ["doc_id", "lang", "hash"])
    sample = sorted(tuple(r) for r in found.groupBy("doc_id", "lang").agg(F.min("text").alias("text")).collect())
    if not sample:
        return None
    return fit([t for _, _, t in sample], [lang for _, lang, _ in sample])


def _label(model, column):
    texts = column.to_pylist()
    names, scores = [UNKNOWN] * len(texts), [0.0] * len(texts)
    tokens = Tokens(column)
    if model is None or not len(tokens):
        return names, scores
    marginals, _ = forward_backward(model.logits(tokens), tokens.starting(), model.trans, model.init)
    for i, text in enumerate(texts):
        own = marginals[tokens.first[i]: tokens.first[i + 1]]
        if len(own) and any(map(str.isalpha, text)):
            mass = own.sum(axis=0)
            best = int(mass.argmax())
            names[i], scores[i] = model.labels[best], float(min(1.0, mass[best] / len(own)))
    return names, scores


def _run(model):
    def run(batches):
        for batch in slices(batches):
            names, scores = _label(model, batch.column("text"))
            others = [c for c in batch.schema.names if c != "text"]
            yield pa.RecordBatch.from_arrays(
                [*(batch.column(c) for c in others), pa.array(names, pa.string()), pa.array(scores)],
                names=[*others, "lang_pred", "score"])

    return run


def identify(documents: DataFrame, model: Model | None) -> DataFrame:
    """``documents`` without its text, with ``lang_pred`` and ``score``, the share of its words.

    Null texts, texts without a letter, and all texts if there is no model get ``und`` and 0. Columns
    of the input that are named like a result are replaced.
    """
    rows = documents.drop("lang_pred", "score")
    fields = [f"`{f.name}` {f.dataType.simpleString()}" for f in rows.schema.fields if f.name != "text"]
    return rows.mapInArrow(_run(model), ", ".join([*fields, "lang_pred string", "score double"]))
