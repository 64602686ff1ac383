"""Registered queries against their SQL, and the contracts of those without."""

import collections
import zlib

import pytest

from compare import compare, database
from marquee.llm.queries import QUERIES

FOLDER = "/root/testdata/sf0.001"
LARGER = "/root/testdata/sf0.01"


@pytest.fixture(scope="module")
def con():
    return database(FOLDER)


@pytest.mark.parametrize("name", [n for n, q in QUERIES.items() if q.sql])
def test_equal_to_sql(spark, con, name):
    assert compare(con, QUERIES[name].run(spark, FOLDER), QUERIES[name].sql) is None


def test_one_query_per_operator():
    assert sorted(int(n[2:].split("_")[0]) for n in QUERIES) == list(range(1, 14))


def share(rows, truth, right):
    found = [r for r in rows if r.held_out and r.doc_id in truth]
    return sum(right(r) == truth[r.doc_id] for r in found) / len(found)


def test_languages_of_held_out_texts(spark):
    truth = {r.doc_id: r.lang for r in spark.read.parquet(f"{LARGER}/documents.parquet").collect()}
    rows = QUERIES["op2_language"].run(spark, LARGER).collect()
    assert len(rows) == len(truth)
    assert all(r.held_out == (zlib.crc32(str(r.doc_id).encode()) % 4 == 2) for r in rows)
    assert share(rows, truth, lambda r: r.lang_pred) > 0.99


def test_quality_of_held_out_texts(spark):
    labels = spark.read.parquet("/root/testdata/sf0.1/labels.parquet").collect()
    rows = QUERIES["op5_quality"].run(spark, "/root/testdata/sf0.1").collect()
    truth = {r.doc_id: r.quality for r in labels}
    assert all(r.held_out == (zlib.crc32(str(r.doc_id).encode()) % 5 == 0) for r in rows)
    assert all(r.predicted == (r.score >= 0.3) and 0 <= r.score <= 1 for r in rows)
    assert share(rows, truth, lambda r: r.predicted) > 0.97


def test_articles_of_pages(spark):
    """Pages are made of documents: after the heading comes a document's text."""
    texts = {" ".join(r.text.split()) for r in spark.read.parquet(f"{LARGER}/documents.parquet").collect()}
    rows = QUERIES["op3_main_text"].run(spark, LARGER).collect()
    bodies = [" ".join(r.text.split("\n\n", 1)[-1].split()) for r in rows]
    assert sum(b in texts for b in bodies) >= 0.98 * len(bodies)
    assert all(r.n_chars == len(r.text) for r in rows)


def test_every_document_is_packed_once(spark):
    docs = {r.doc_id: len((r.text or "").encode().split()) for r in spark.read.parquet(f"{FOLDER}/documents.parquet").collect()}
    packed = collections.Counter()
    for r in QUERIES["op10_packing"].run(spark, FOLDER).collect():
        assert sum(r.sizes) == r.used <= r.capacity
        packed.update(dict(zip(r.doc_ids, [0] * len(r.doc_ids))))
        for doc_id, size in zip(r.doc_ids, r.sizes):
            packed[doc_id] += size
    assert packed == docs
