"""Every registered query against its SQL, or for a property when it has no SQL."""

import os

import pytest

from compare import compare, database
from marquee.checks import load_all

FOLDER = os.environ.get("MARQUEE_TEST_SF", "/root/testdata/sf0.001")
CHECKS = load_all()


@pytest.fixture(scope="module")
def con():
    return database(FOLDER)


@pytest.mark.parametrize("name", [n for n, c in CHECKS.items() if c.sql])
def test_equal_to_sql(spark, con, name):
    assert compare(con, CHECKS[name].run(spark, FOLDER), CHECKS[name].sql) is None


def run(spark, name):
    return CHECKS[name].run(spark, FOLDER).collect()


def test_user_lists_are_short_positive_and_sorted(spark):
    lists = {}
    for r in run(spark, "als_user_recs"):
        lists.setdefault(r.uid, []).append((r["rank"], r.score))
    users = {r.uid for r in run(spark, "project_ratings")}
    assert lists and set(lists) <= users
    for items in lists.values():
        scores = [s for _, s in sorted(items)]
        assert len(scores) <= 20 and min(scores) > 0 and scores == sorted(scores, reverse=True)


def test_grid_has_nine_finite_rows(spark):
    grid = run(spark, "als_grid")
    assert len(grid) == 9 and all(0 < r.rmse < 100 for r in grid)


def test_similar_factors_are_symmetric(spark):
    pairs = {(r.pid, r.other): r.score for r in run(spark, "als_similar_items")}
    assert pairs and all(pairs[b, a] == s and s > 0.6 for (a, b), s in pairs.items())


def test_hashed_terms_keep_the_word_count(spark):
    from marquee.operators import content
    from marquee.sources import sample

    words = content.genre_tokens(sample.movies(spark, FOLDER))
    total = lambda rows: sum(r.tf for r in rows)
    assert total(run(spark, "hashing_tf")) == total(content.term_frequencies(words).collect())


def test_deep_lists_of_every_movie_are_looked_up(spark):
    movies = {r.mid for r in run(spark, "content_similar_counts") if r.neighbours}
    assert {r.mid for r in run(spark, "lookup_similar_deep_all")} == movies
    assert len({m % 10 for m in movies}) == 10


def test_entry(spark):
    import __spark_entry__ as entry

    assert entry.entry(spark).count() > 0
    assert set(entry.oracle_sql()) <= set(entry.queries())
