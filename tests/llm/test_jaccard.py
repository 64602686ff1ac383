"""The Jaccard join against all pairs."""

import collections
import random

import pytest
from pyspark.sql import functions as F

from marquee.llm import jaccard
from test_operators import SCHEMA, docs, empty, same, words  # noqa: F401


def shingles(text):
    w = [x.encode().lower() for x in words(text)]
    return frozenset(tuple(w[i: i + 5]) for i in range(max(len(w) - 4, 1))) if w else frozenset()


def plainly(rows):
    sets = {shingles(r.text) for r in rows} - {frozenset()}
    listed = sorted(sets, key=len)
    root = {s: s for s in listed}

    def find(x):
        while root[x] is not x:
            x = root[x]
        return x

    for i, a in enumerate(listed):
        for b in listed[i + 1:]:
            if 100 * len(a) < 80 * len(b):
                break
            n = len(a & b)
            if 100 * n >= 80 * (len(a) + len(b) - n):
                root[find(a)] = find(b)
    least = collections.defaultdict(list)
    for r in rows:
        if r.doc_id is not None and r.text:
            least[find(shingles(r.text)) if shingles(r.text) else None].append(r.doc_id)
    out = []
    for r in rows:
        s = shingles(r.text)
        out.append((r.doc_id, len(s), min(least[find(s)], default=None) if s else r.doc_id))
    return out


def changed(pick, body, edits):
    body = list(body)
    for _ in range(edits):
        body[pick.randrange(len(body))] = f"new{pick.randrange(10 ** 6)}"
    return body


@pytest.fixture(scope="module")
def corpus(spark, docs):  # noqa: F811
    """Hot groups of copies and near copies, chains, shared passages, borderline pairs."""
    pick = random.Random(3)
    word = lambda: f"w{pick.randrange(5000)}"
    passage = [word() for _ in range(40)]
    bases = [[word() for _ in range(n)] for n in (6, 30, 90, 90, 300)]
    made = [changed(pick, b, k) for b in bases for k in (0, 1, 1, 2, 2, 3, 4, 6, 9) for _ in range(6)]
    made += [changed(pick, bases[2], pick.randrange(6)) for _ in range(250)]
    chain = list(bases[3])
    for _ in range(25):
        chain = changed(pick, chain, 1)
        made.append(chain)
    made += [[word() for _ in range(pick.randrange(1, 25))] + passage + [word() for _ in range(pick.randrange(25))] for _ in range(60)]
    made += [["one"], ["One"], ["one", "two"], ["a", "b", "c", "d"], ["a", "b", "c", "d", "e"]] + [bases[1]] * 40
    long = [word() for _ in range(500_000)]
    made += [long, changed(pick, long, 3)]
    rows = [(1000 + i, " ".join(m), None, None, 0) for i, m in enumerate(made)]
    return docs.unionByName(spark.createDataFrame(rows, SCHEMA)).repartition(6).cache()


def test_equal_to_all_pairs(corpus, monkeypatch):
    monkeypatch.setattr(jaccard, "BLOCK_TOKENS", 3000)
    expected = plainly(corpus.collect())
    found = jaccard.groups(corpus, sample=1).select("doc_id", "n_shingles", "component_id").collect()
    same(map(tuple, found), expected)
    sizes = collections.Counter(c for _, n, c in expected if n).most_common()
    assert sizes[0][1] > 100 and sum(n > 1 for _, n in sizes) > 10


def test_links_of_the_matrix_alone(corpus, monkeypatch):
    """Without leaders every set stands alone, and the matrix finds all links."""
    monkeypatch.setattr(jaccard, "_leader_links", lambda sets, *_: sets.select(F.col("s").alias("high"), F.col("s").alias("low")).limit(0))
    expected = plainly(corpus.collect())
    same(map(tuple, jaccard.groups(corpus).select("doc_id", "n_shingles", "component_id").collect()), expected)


def test_empty_and_clashing_names(spark, empty, docs):  # noqa: F811
    assert jaccard.groups(empty).count() == 0
    blank = spark.createDataFrame([(1, None, None, None, 0), (2, "", None, None, 0), (None, " \n", None, None, 0), (4, "x", None, None, 0)], SCHEMA)
    found = jaccard.groups(blank).select("doc_id", "n_shingles", "component_id").collect()
    same(map(tuple, found), [(1, 0, 1), (2, 0, 2), (None, 0, None), (4, 1, 4)])
    clash = docs.withColumn("s", F.lit("a")).withColumn("component_id", F.lit("b")).withColumn("n", F.lit(1.5)).withColumn("u1", F.lit(True))
    out = jaccard.groups(clash)
    assert out.columns == ["doc_id", "lang", "source", "n_chars", "s", "n", "u1", "n_shingles", "component_id"]
    assert out.filter("s = 'a' AND n = 1.5 AND u1").count() == docs.count()


def test_sets_of_a_frequent_token_ask_few_groups(spark, monkeypatch):
    """Texts of one passage with a word of their own: close, but not linked, and all share a token of the matrix."""
    asked = {}
    write = jaccard.written

    def counting(df, label):
        out = write(df, label)
        asked[label] = asked.get(label, 0) + (out.count() if label == "asking" else 0)
        return out

    monkeypatch.setattr(jaccard, "written", counting)
    common = [f"word{i}" for i in range(9)]
    texts = [(i, " ".join([f"own{i}", *common])) for i in range(400)]
    found = jaccard.groups(spark.createDataFrame(texts, "doc_id long, text string"), sample=1).collect()
    assert all(r.component_id == r.doc_id and r.n_shingles == 6 for r in found)
    assert asked["asking"] <= 400
