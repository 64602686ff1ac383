"""Fill-in-the-middle against a plain version over code points."""

import hashlib
import re

import pyarrow as pa
import pytest
from pyspark.sql import functions as F

from marquee.llm import infill
from test_operators import SCHEMA, docs, empty, same  # noqa: F401

UNIT = re.compile("[A-Za-z]+|[^A-Za-z]", re.S)
ODD = ["é", "aé", "éa", "日本 語x", "@[`{", "ab<P>c", "x<M>", "a<S", "\x00a\x7f", "😀b😀", "Z", "zzzzzzzz", "zzzzzzzzz", "é" * 9, "a>b<", "S>a"]


def plainly(doc_id, text):
    text = text or ""
    units = UNIT.findall(text)
    digest = hashlib.sha256(f"1:{'' if doc_id is None else doc_id}".encode()).hexdigest()
    h = [int(digest[8 * i: 8 * i + 8], 16) for i in range(4)]
    n = len(units)
    a, b = sorted((h[0] % (n + 1), h[1] % (n + 1)))
    if not text or any(s in text for s in infill.SENTINELS) or h[2] % 100 >= 90:
        return n, "plain", None, None, text
    p, m, s = "".join(units[:a]), "".join(units[a:b]), "".join(units[b:])
    if h[3] % 100 < 20:
        return n, "spm", len(p), len(m), f"<S>{s}<P>{p}<M>{m}"
    return n, "psm", len(p), len(m), f"<P>{p}<S>{s}<M>{m}"


def check(frame):
    found = infill.transform(frame).withColumn("back", infill.restored(F.col("output"), F.col("form"))).collect()
    rows = frame.collect()
    expected = [(r.doc_id, *plainly(r.doc_id, r.text), r.text or "") for r in rows]
    same([(r.doc_id, r.n, r.form, r.prefix_chars, r.middle_chars, r.output, r.back) for r in found], expected)
    return {r.form for r in found}


def test_equal_to_plain_version(spark, docs, empty):
    odd = spark.createDataFrame([(i * 16 + j, t, None, None, 0) for i, t in enumerate(ODD) for j in range(16)], SCHEMA)
    # Longer than one slice.
    long = spark.createDataFrame([(9000 + j, "née Ab12 日 " * 250_000, None, None, 0) for j in range(2)], SCHEMA)
    assert check(docs.unionByName(odd).unionByName(long).repartition(3)) == {"plain", "psm", "spm"}
    assert infill.transform(empty).count() == 0


def test_units_of_neighbouring_texts():
    texts = ["abc", None, "def", "", "é", "g日h", "x" * 23, "1"]
    units = infill.Units(pa.array(texts))
    assert units.counts().tolist() == [len(UNIT.findall(t or "")) for t in texts]
    assert infill.Units(pa.array([], pa.string())).counts().tolist() == []
    assert infill.Units(pa.array(["ab", "c-d"])[1:]).counts().tolist() == [3]


def test_clashing_names_and_other_rates(docs):
    named = docs.withColumn("output", F.lit(1)).withColumn("draw0", F.lit("x")).withColumn("n", F.lit(None).cast("string"))
    assert infill.transform(named).columns == ["doc_id", "lang", "source", "n_chars", "n", "form", "prefix_chars", "middle_chars", "output"]
    assert {r.form for r in infill.transform(docs, plain=100, spm=100).select("form").distinct().collect()} == {"spm", "plain"}


def test_sentinels_that_could_be_misread():
    for bad in (("aa", "<S>", "<M>"), ("<P>", "<", "<M>"), ("ab", "bc", "x"), ("", "<S>", "<M>")):
        with pytest.raises(ValueError):
            infill._checked(bad)
