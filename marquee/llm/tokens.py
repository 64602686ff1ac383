"""Token counts of documents by scanning flat token files for separators.

A token file is a stream of 16-bit ids with an end-of-document id after each document and no index; it
is stored in blocks of equal size that know nothing of documents. Each block is searched for the
separator with one vectorised comparison. A prefix scan over the blocks' separator counts gives every
piece of a block the number of its document in the file, and pieces of one document that lie in
several blocks are added up.
"""

import base64
import functools

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from marquee.llm.textbytes import slices
from marquee.session import scratch

# The public pattern and separator of the 50k byte-level vocabulary.
PATTERN = r"'(?:[sdmt]|ll|ve|re)| ?\p{L}+| ?\p{N}+| ?[^\s\p{L}\p{N}]+|\s+(?!\S)|\s+"
SEPARATOR = 50256
VOCABULARY = "/opt/tokenizers/byte_bpe_50k.tiktoken"

BLOCK_TOKENS = 1 << 15
GROUP_BLOCKS = 1024  # blocks that one step of the prefix scan takes together
ID = np.dtype("<u2")
STORED = "file int, block int, tokens binary, ids array<bigint>"


@functools.lru_cache(maxsize=1)
def encoder(ranks: bytes):
    import tiktoken

    pairs = (line.split() for line in ranks.splitlines())
    return tiktoken.Encoding("vocabulary", pat_str=PATTERN, special_tokens={},
                             mergeable_ranks={base64.b64decode(t): int(n) for t, n in pairs})


def _encode(ranks, separator, block):
    """One token file per task, in blocks; the ids of its documents follow in rows of their own."""

    def rows(blocks, first, ids, first_ids, file):
        n, m = len(blocks), len(ids)
        return pa.RecordBatch.from_arrays([
            pa.array([file] * (n + m), pa.int32()),
            pa.array([*range(first, first + n), *range(first_ids, first_ids + m)], pa.int32()),
            pa.array([*blocks, *[None] * m], pa.binary()), pa.array([*[None] * n, *ids], pa.list_(pa.int64())),
        ], names=["file", "block", "tokens", "ids"])

    def run(batches):
        encode = encoder(ranks).encode_ordinary
        file, size = TaskContext.get().partitionId(), block * ID.itemsize
        rest, done, listed = b"", 0, 0
        for batch in slices(batches):
            parts = [rest]
            for text in batch.column("text").to_pylist():
                parts.append(np.array([*encode(text or ""), separator], dtype=ID).tobytes())
            stream = b"".join(parts)
            whole = len(stream) // size
            blocks = [stream[i * size: (i + 1) * size] for i in range(whole)]
            rest = stream[whole * size:]
            yield rows(blocks, done, [batch.column("doc_id").to_pylist()], listed, file)
            done, listed = done + whole, listed + 1
        if rest:
            yield rows([rest], done, [], listed, file)

    return run


def write_token_files(documents: DataFrame, vocabulary=VOCABULARY, separator=SEPARATOR, block=BLOCK_TOKENS) -> DataFrame:
    """Writes the texts as token files below the shared folder: (``file``, ``block``, ``tokens``).

    ``ids`` rows, numbered like blocks, list the documents of a file in order; the scan never sees them.
    Null and empty texts are documents of no tokens. The vocabulary is read by the driver alone.
    """
    with open(vocabulary, "rb") as f:
        ranks = f.read()
    path = scratch(documents.sparkSession, "tokens")
    rows = documents.select(F.col("doc_id").cast("long").alias("doc_id"), "text")
    rows.mapInArrow(_encode(ranks, separator, block), STORED).write.option("compression", "zstd").parquet(path)
    return documents.sparkSession.read.schema(STORED).parquet(path)


def _scan(separator):
    """Per block: separators, tokens before the first, after the last, and between neighbours."""

    def run(batches):
        for batch in batches:
            for low in range(0, batch.num_rows, 64):
                part = batch.slice(low, 64)
                count, head, tail, inner = [], [], [], []
                for tokens in part.column("tokens"):
                    ids = np.frombuffer(tokens.as_buffer(), dtype=ID)
                    at = np.flatnonzero(ids == separator)
                    count.append(len(at))
                    head.append(int(at[0]) if len(at) else len(ids))
                    tail.append(len(ids) - 1 - int(at[-1]) if len(at) else 0)
                    inner.append(np.diff(at) - 1)
                yield pa.RecordBatch.from_arrays([
                    part.column("file"), part.column("block"), pa.array(count, pa.int64()), pa.array(head, pa.int64()),
                    pa.array(tail, pa.int64()), pa.array(inner, pa.list_(pa.int64())),
                ], names=["file", "block", "count", "head", "tail", "inner"])

    return run


def scan(files: DataFrame, separator=SEPARATOR) -> DataFrame:
    """(``file``, ``number``, ``n_tokens``) of every document of token files of (file, block, tokens).

    ``number`` counts from 0. A document may span any number of blocks and may have no tokens; tokens
    after the last separator are a document that was not ended. No blocks, no documents.
    """
    summary = files.select("file", "block", "tokens").mapInArrow(
        _scan(separator), "file int, block int, count long, head long, tail long, inner array<bigint>")
    group = F.floor(F.col("block") / GROUP_BLOCKS).alias("group")
    summary = summary.select("*", group)
    groups = summary.groupBy("file", "group").agg(F.sum("count").alias("count"))
    ahead = lambda *keys: Window.partitionBy(*keys[:-1]).orderBy(keys[-1]).rowsBetween(Window.unboundedPreceding, -1)
    before = lambda window: F.coalesce(F.sum("count").over(window), F.lit(0))
    groups = groups.select("file", "group", before(ahead("file", "group")).alias("base"))
    placed = summary.withColumn("inside", before(ahead("file", "group", "block"))).join(groups, ["file", "group"])
    first = F.col("base") + F.col("inside")
    piece = lambda number, n: F.struct(number.alias("number"), n.alias("n"))
    pieces = F.concat(
        F.array(piece(first, F.col("head"))),
        F.transform("inner", lambda n, i: piece(first + i + 1, n)),
        F.when(F.col("tail") > 0, F.array(piece(first + F.col("count"), F.col("tail")))).otherwise(F.array()),
    )
    return placed.select("file", F.inline(pieces)).groupBy("file", "number").agg(F.sum("n").alias("n_tokens"))


def count(documents: DataFrame, vocabulary=VOCABULARY) -> DataFrame:
    """``doc_id`` and ``n_tokens`` of every row, from token files written for the purpose.

    Repeated rows and null ids are counted like any other row.
    """
    files = write_token_files(documents, vocabulary)
    listed = files.filter("ids is not null").select("file", "block", F.size("ids").alias("n"), "ids")
    earlier = Window.partitionBy("file").orderBy("block").rowsBetween(Window.unboundedPreceding, -1)
    listed = listed.withColumn("base", F.coalesce(F.sum("n").over(earlier), F.lit(0)))
    names = listed.select("file", "base", F.posexplode("ids").alias("at", "doc_id")).select(
        "file", (F.col("base") + F.col("at")).alias("number"), "doc_id")
    found = scan(files.filter("tokens is not null"))
    return names.join(found, ["file", "number"]).select("doc_id", "n_tokens")
