import numpy as np
import pytest
from pyspark.sql import functions as F

from conftest import rows
from marquee.checks import similar
from marquee.operators import content, similarity


def brute(vectors, threshold):
    """{(a, b): cosine} of all ordered pairs above the threshold."""
    usable = {m: np.array(v) / np.linalg.norm(v) for m, v in vectors.items() if np.linalg.norm(v) > 0}
    found = {}
    for a, x in usable.items():
        for b, y in usable.items():
            score = round(float(x @ y), 6)
            if a != b and score > threshold:
                found[a, b] = score
    return found


def expanded(index):
    """Item pairs of a small similarity result."""
    members, pairs = {}, {}
    for mid, pid in rows(index.members):
        members.setdefault(pid, []).append(mid)
    for pid, other, score in rows(index.pairs, "pid", "other", "score"):
        pairs.update({(a, b): score for a in members[pid] for b in members[other] if a != b})
    return pairs


def clustered(seed, n, width=8, copies=0):
    rng = np.random.default_rng(seed)
    centres = rng.normal(size=(6, width))
    vectors = {i: (centres[i % 6] + 0.4 * rng.normal(size=width)).tolist() for i in range(n)}
    vectors.update({n + i: vectors[0] for i in range(copies)})
    vectors[n + copies] = [0.0] * width
    return vectors


@pytest.mark.parametrize("block_rows", [8, 40, 1000])
def test_dense_pairs_equal_brute_force(frame, block_rows):
    vectors = clustered(3, 150, copies=60)
    items = frame(list(vectors.items()), "mid int, vec array<double>")
    index = similarity.similar_vectors(items, 0.6, block_rows)
    got, want = expanded(index), brute(vectors, 0.6)
    assert set(got) == set(want)
    assert max(abs(got[p] - want[p]) for p in want) < 2e-6
    # The sixty copies are one profile.
    assert index.members.filter("pid = 0").count() == 61


def test_a_home_larger_than_a_block_is_split(frame):
    rng = np.random.default_rng(1)
    vectors = {i: (np.ones(4) + 0.05 * rng.normal(size=4)).tolist() for i in range(90)}
    items = frame(list(vectors.items()), "mid int, vec array<double>")
    assert set(expanded(similarity.similar_vectors(items, 0.6, 7))) == set(brute(vectors, 0.6))


def test_visits_skip_far_homes(spark):
    pivots = np.eye(3)
    unit = spark.createDataFrame([(0, [1.0, 0.0, 0.0]), (1, [0.0, 0.0, 1.0])], "pid int, vec array<double>")
    homed = similarity._nearest(unit, pivots)
    reach = np.array([0.1, 0.1, 0.1]) + np.arccos(0.6)
    assert similarity._visits(homed, pivots, reach).count() == 0


def test_visits_name_homes_and_not_vectors(spark):
    rng = np.random.default_rng(4)
    pivots = np.eye(4)
    vectors = [(i, (v / np.linalg.norm(v)).tolist()) for i, v in enumerate(rng.normal(size=(400, 4)))]
    homed = similarity._nearest(spark.createDataFrame(vectors, "pid int, vec array<double>").coalesce(1), pivots)
    got = similarity._visits(homed, pivots, np.full(4, np.pi))
    assert got.columns == ["home", "grp"]
    assert sorted(map(tuple, got.collect())) == [(a, b) for a in range(4) for b in range(a + 1, 4)]


@pytest.mark.parametrize("block_rows, held", [(8, 10), (40, 1 << 21)])
def test_kept_pairs_are_the_first_of_all(frame, monkeypatch, block_rows, held):
    monkeypatch.setattr(similarity, "HELD_PAIRS", held)
    vectors = clustered(5, 150, copies=20)
    # Several partners of one score, and items beside each other in more than one tile.
    vectors.update({1000 + i: (2 * np.array(vectors[i % 3])).tolist() for i in range(9)})
    items = frame(list(vectors.items()), "mid int, vec array<double>")
    whole = similarity.similar_vectors(items, 0.6, block_rows)
    some = similarity.similar_vectors(items, 0.6, block_rows, keep=6)
    listed = lambda index: {r.mid: [tuple(x) for x in r.recs] for r in similarity.neighbour_lists(index, 5).collect()}
    assert listed(some) == listed(whole)
    assert some.pairs.count() < whole.pairs.count()


WORDS = ["action", "drama", "war", "comedy", "crime", "music", "tv", "western"]


def random_movies(seed, n):
    rng = np.random.default_rng(seed)
    listed = ["|".join(rng.choice(WORDS, size=rng.integers(1, 5))) for _ in range(n)]
    return {i: g for i, g in enumerate(listed)} | {n: "", n + 1: "drama||war"}


def tfidf_vectors(movies):
    tokens = {m: g.lower().replace("|", " ").split(" ") for m, g in movies.items()}
    vocabulary = sorted({t for ts in tokens.values() for t in ts})
    df = {t: sum(t in ts for ts in tokens.values()) for t in vocabulary}
    idf = {t: np.log((len(movies) + 1) / (df[t] + 1)) for t in vocabulary}
    return {m: [ts.count(t) * idf[t] for t in vocabulary] for m, ts in tokens.items()}


@pytest.mark.parametrize("block_rows", [3, 500])
def test_content_pairs_equal_brute_force(frame, block_rows):
    movies = random_movies(5, 120)
    df = frame(list(movies.items()), "mid int, genres string")
    got = expanded(content.similar_by_content(df, block_rows=block_rows))
    want = brute(tfidf_vectors(movies), 0.6)
    assert set(got) == set(want)
    assert max(abs(got[p] - want[p]) for p in want) < 2e-6


def small_index(frame):
    """Profiles 1 (with 2, 3), 4 (with 5) and 6; 1-4 at 0.9, 1-6 at 0.8."""
    members = frame([(1, 1), (2, 1), (3, 1), (4, 4), (5, 4), (6, 6)], "mid int, pid int")
    found = frame([(1, 4, 0.9), (4, 1, 0.9), (1, 6, 0.8), (6, 1, 0.8)], "pid int, other int, score double")
    return similarity.similar_items(members, found, frame([(1,), (4,), (6,)], "pid int"))


def test_lists_and_counts(frame):
    index = small_index(frame)
    lists = {r.mid: [(x.mid, x.score) for x in r.recs] for r in similarity.neighbour_lists(index, 3).collect()}
    assert lists[2] == [(1, 1.0), (3, 1.0), (4, 0.9)]
    assert lists[6] == [(1, 0.8), (2, 0.8), (3, 0.8)]
    assert dict(rows(similarity.neighbour_counts(index))) == {1: 5, 2: 5, 3: 5, 4: 4, 5: 4, 6: 3}


def test_pair_scores(frame):
    wanted = frame([(1, 2), (1, 1), (4, 6), (5, 1), (1, 77)], "mid int, other int")
    got = rows(similarity.pair_scores(small_index(frame), wanted))
    assert got == [(1, 1, 0.0), (1, 2, 1.0), (1, 77, 0.0), (4, 6, 0.0), (5, 1, 0.9)]


def test_member_ranks_cross_stretches(frame):
    mids = [1, 5000, 5001, 9000, 40000]
    ranked = similarity.member_ranks(frame([(m, 1) for m in mids], "mid int, pid int"))
    assert rows(ranked) == [(1, i + 1, m) for i, m in enumerate(mids)]


@pytest.mark.parametrize("n", [3, 20])
def test_unseen_neighbours_equal_brute_force(frame, n):
    movies = {i: f"{['action', 'drama|war', 'war', 'drama|war|tv'][i % 4 if i > 60 else 0]}" for i in range(200)}
    index = content.similar_by_content(frame(list(movies.items()), "mid int, genres string"))
    sims = expanded(index)
    rng = np.random.default_rng(2)
    # User 1 has seen most of one large profile.
    seen = {(1, int(m)) for m in rng.choice(61, 50, replace=False)} | {(u, int(rng.integers(200))) for u in range(2, 12) for _ in range(15)}
    events = [(1, 0), (1, 70)] + [(u, int(rng.integers(200))) for u in range(2, 12)] + [(12, 999)]
    got = similarity.unseen_neighbours(
        index, frame(events, "uid int, mid int"), frame(sorted(seen), "uid int, mid int"), n
    )
    want = []
    for uid, mid in set(events):
        known = {m for u, m in seen if u == uid} | {m for u, m in events if u == uid}
        ranked = sorted((-s, b) for (a, b), s in sims.items() if a == mid and b not in known)[:n]
        want += [(uid, mid, i + 1, b, -s) for i, (s, b) in enumerate(ranked)]
    assert rows(got.drop("candidate_pid")) == sorted(want)


def test_idf(frame):
    movies = frame([(1, "a|b"), (2, "a"), (3, "c")], "mid int, genres string")
    weights = content.tf_idf(content.term_frequencies(content.genre_tokens(movies)), movies)
    got = {(r.mid, r.term): round(r.tfidf, 5) for r in weights.collect()}
    assert got[1, "a"] == 0.28768 and got[3, "c"] == 0.69315
    assert weights.filter(F.col("df") == 2).count() == 2


def test_ids_beyond_32_bits(frame):
    near, far = [1.0, 0.1], [1.0, 0.2]
    big = 5_000_000_000
    items = frame([(big, near), (big + 1, far), (7, [0.0, 1.0])], "mid long, vec array<double>")
    index = similarity.similar_vectors(items, 0.6, block_rows=1)
    assert {(r.pid, r.other) for r in index.pairs.collect() if r.pid != r.other} == {(big, big + 1), (big + 1, big)}
    assert index.pairs.schema["pid"].dataType.simpleString() == "bigint"


def test_ties_fetch_no_more_than_asked(frame):
    """Thousands of profiles of equal score: only the first ones by id are fetched."""
    many, n = 3000, 5
    members = frame([(i, i) for i in range(many + 1)], "mid int, pid int")
    pairs = frame(
        [(0, 0, 1.0, 1, 0, 1)] + [(0, i, 0.8, 1, 1, i) for i in range(1, many + 1)],
        "pid int, other int, score double, size long, before long, tie long",
    )
    index = similarity.SimilarItems(members, pairs)
    events, seen = frame([(1, 0)], "uid int, mid int"), frame([(1, 2), (1, 3)], "uid int, mid int")
    found = similarity.unseen_neighbours(index, events, seen, n)
    assert [r.candidate for r in found.orderBy("rank").collect()] == [1, 4, 5, 6, 7]
    lists = similarity.neighbour_lists(index, n, frame([(0,)], "mid int")).collect()
    assert [r.mid for r in lists[0].recs] == [1, 2, 3, 4, 5] and len(lists) == 1


def test_long_lists_of_copies_are_dealt_over_tasks(spark, monkeypatch):
    # Spark sizes tasks by bytes; without a bound on rows, one task spread the lists of all these items.
    movies = spark.createDataFrame(
        [(i, "A|B" if i < 300 else "A|B|C" if i < 400 else "D") for i in range(420)] + [(7, "A|B")], "mid int, genres string")
    index = content.similar_by_content(movies)
    lists = lambda: similarity.neighbour_lists(index, 15)
    whole = sorted(map(str, lists().collect()))
    monkeypatch.setattr(similarity, "TASK_ENTRIES", 16 * 20, raising=False)
    dealt = lists()
    assert sorted(map(str, dealt.collect())) == whole
    sizes = dealt.groupBy(F.spark_partition_id()).count().collect()
    assert len(whole) == 421 and len(sizes) > 5 and max(r["count"] for r in sizes) < 200


def test_unseen_candidates_count_ratings_in_bounded_tasks(spark, monkeypatch):
    folder = "/root/testdata/sf0.001"
    whole = sorted(map(str, similar.unseen_candidates(spark, folder).collect()))
    monkeypatch.setattr(similar, "TASK_RATINGS", 500, raising=False)
    found = similar.unseen_candidates(spark, folder)
    assert sorted(map(str, found.collect())) == whole
    plan = found._jdf.queryExecution().executedPlan().toString()
    rows = similar.stored_ratings(spark, folder).count()
    assert f", {-(-rows // 500)}), REPARTITION_BY_NUM" in plan


def test_pairs_are_not_shuffled_for_the_sizes_of_profiles(frame):
    """All pairs were joined with the sizes, and the whole result lay on disk for it."""
    items = frame([(i, [1.0, 0.01 * (i // 2), 0.5]) for i in range(60)], "mid int, vec array<double>")
    pairs = similarity.similar_vectors(items, 0.6, 7).pairs
    assert {r["size"] for r in pairs.collect()} == {2}
    plan = pairs.filter("pid != other").select("pid", "other", "score")._jdf.queryExecution().optimizedPlan().toString()
    above = plan[:plan.index("FlatMapGroupsInArrow")]
    assert "Join" not in above and "Window" not in above


def test_unit_vectors_compute_a_length_once(frame):
    rows = frame([(1, [3.0, 4.0]), (2, [0.0, 0.0]), (3, None), (4, [1.0, None]), (5, [])], "pid int, vec array<double>")
    unit = similarity.unit_vectors(rows)
    assert [(r.pid, r.vec) for r in unit.collect()] == [(1, [3.0 / 5.0, 4.0 / 5.0])]
    plan = unit._jdf.queryExecution().optimizedPlan().toString()
    # Not inside the function of an element, where it stood.
    element = plan.split("zip_with")[1].split("lambdafunction(")[-1]
    assert "aggregate" not in element and "SQRT" not in element
