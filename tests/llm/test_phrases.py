"""Phrase collocations against plain counting."""

import collections
import random
import re

import pytest
from pyspark.sql import functions as F

from marquee.llm import phrases
from test_operators import SCHEMA, docs, empty  # noqa: F401


def plainly(rows, support, top, cover):
    count = collections.defaultdict(collections.Counter)
    for r in rows:
        low = re.sub("[A-Z]", lambda m: m.group().lower(), r.text or "")
        for piece in re.split("[.,;:!?\x0a-\x0d]", low):
            w = re.findall("[^\x20\x09]+", piece)
            for k in range(1, 5):
                count["und" if r.lang is None else r.lang].update(tuple(w[i: i + k]) for i in range(len(w) - k + 1))
    out = []
    for lang, f in count.items():
        n = sum(c for p, c in f.items() if len(p) == 1)
        found = {p: c for p, c in f.items() if len(p) > 1 and c >= support}
        covered = set()
        for long, c in found.items():
            for k in range(2, len(long)):
                for i in range(len(long) - k + 1):
                    if 100 * c >= cover * found[long[i: i + k]]:
                        covered.add(long[i: i + k])
        scored = []
        for p, a in found.items():
            if p not in covered:
                score, _, l, r = min((2000000 * a // (f[p[:k]] + f[p[k:]]), k, f[p[:k]], f[p[k:]]) for k in range(1, len(p)))
                scored.append((-score, -a, " ".join(p).encode(), l, r))
        for rank, (score, a, p, l, r) in enumerate(sorted(scored)[:top], 1):
            out.append((lang, rank, p.decode(), -a, l, r, n, -score))
    return sorted(out)


@pytest.fixture(scope="module")
def prose(spark, docs):  # noqa: F811
    pick = random.Random(5)
    common = ["of the", "in New  York", "Of The same", "as\twell as", "é à", "x"]
    lines = []
    for i in range(200):
        body = [pick.choice(common) if pick.random() < 0.5 else f"v{pick.randint(0, 30)}" for _ in range(pick.randint(0, 60))]
        lines.append((i, "".join(w + pick.choice([" ", " ", " ", ", ", ".", "\n"]) for w in body), pick.choice(["en", "fr", None, "und"]), None, 0))
    long = (999, "of the same old story. " * 150_000, "en", None, 0)
    return docs.unionByName(spark.createDataFrame([*lines, lines[3], lines[3], long], SCHEMA)).repartition(5).cache()


@pytest.mark.parametrize("budget", [phrases.BUDGET, 100, 7])
def test_equal_to_plain_counts(prose, budget):
    expected = plainly(prose.collect(), 6, 40, 80)
    found = sorted(map(tuple, phrases.collocations(prose, 6, 40, 80, budget).collect()))
    assert found == expected
    assert {len(p[2].split(" ")) for p in expected} == {2, 3, 4}


def test_counts_past_64_bits(prose, monkeypatch):
    # Every word counts 3e12 times, so 2000000 * a needs 63 bits and more.
    words, found = phrases.phrase_counts(prose, 6)
    factor = 3 * 10 ** 12
    grown = [words.withColumn("f", F.col("f") * factor), found.withColumn("f", F.col("f") * factor)]
    monkeypatch.setattr(phrases, "phrase_counts", lambda *_: grown)
    large = phrases.collocations(prose, 6, 40, 80)
    small = plainly(prose.collect(), 6, 40, 80)
    assert sorted(map(tuple, large.select("lang", "rank", "phrase", "score").collect())) == [(*r[:3], r[7]) for r in small]


def test_empty_and_clashing_names(spark, empty, prose):  # noqa: F811
    assert phrases.collocations(empty).count() == 0
    nulls = spark.createDataFrame([(1, None, None, None, 0), (2, "", "en", None, 0), (3, " . ", None, None, 0), (4, "a", None, None, 0)], SCHEMA)
    assert phrases.collocations(nulls).count() == 0
    clash = prose.withColumn("phrase", F.lit(1)).withColumn("a", F.lit(1)).withColumn("word", F.lit(1))
    assert phrases.collocations(clash, 6, 5).count() == 25
