import math

from conftest import rows
from marquee.operators import online
from test_similarity import small_index

RATING = "uid int, mid int, score double, timestamp int"


def test_recent_ratings_repeat_a_rerated_movie(frame):
    ratings = frame([(1, i, 3.0, i) for i in range(45)] + [(1, 44, 5.0, 100)], RATING)
    got = rows(online.recent_ratings(ratings))
    assert len(got) == 20 and got[0] == (1, 1, 44, 5.0) and got[1] == (1, 2, 44, 3.0) and got[-1] == (1, 20, 26, 3.0)


def scores(frame, recent, mode="counted"):
    candidates = frame([(1, 6, 6)], "uid int, candidate int, candidate_pid int")
    recent = frame([(1, i + 1, m, s) for i, (m, s) in enumerate(recent)], "uid int, position int, mid int, score double")
    return [r.score for r in online.priority_scores(small_index(frame), candidates, recent, mode).collect()]


def test_priority_modes_differ_when_likes_are_newer(frame):
    # Newest first: two liked, then a disliked one.
    recent = [(1, 5.0), (2, 4.0), (3, 1.0)]
    base = 0.8 * 10 / 3
    assert scores(frame, recent) == [round(base + math.log10(2), 6)]
    assert scores(frame, recent, "legacy") == [round(base + math.log10(2) - math.log10(3), 6)]
    assert scores(frame, recent[::-1], "legacy") == [round(base + math.log10(2) - math.log10(1), 6)]


def test_no_liked_rating(frame):
    assert scores(frame, [(1, 3.0), (2, 2.0)]) == [round(0.8 * 2.5 - math.log10(2), 6)]


def test_candidate_without_similar_rating_is_dropped(frame):
    assert scores(frame, [(4, 5.0)]) == []


def test_empty_list_is_still_a_list(frame):
    events = frame([(1, 1), (2, 1)], "uid int, mid int")
    found = frame([(1, 6, 1.0), (1, 4, 1.0), (1, 5, 2.0)], "uid int, mid int, score double")
    got = {r.uid: [x.mid for x in r.recs] for r in online.user_lists(events, found).collect()}
    assert got == {1: [5, 4, 6], 2: []}


def test_live_lists_with_unknown_movie_and_all_seen(frame):
    index = small_index(frame)
    events = frame([(1, 1), (2, 777), (3, 6)], "uid int, mid int")
    seen = frame([(3, m) for m in (1, 2, 3)], "uid int, mid int")
    recent = frame([(1, 1, 1, 5.0), (2, 1, 777, 5.0), (3, 1, 6, 5.0)], "uid int, position int, mid int, score double")
    got = {r.uid: [(x.mid, x.score) for x in r.recs] for r in online.live_lists(index, events, seen, recent).collect()}
    assert got == {1: [(2, 5.0), (3, 5.0), (4, 4.5), (5, 4.5), (6, 4.0)], 2: [], 3: []}


def test_newest_batch_wins(frame):
    results = frame([(1, [(1, 1.0)], 0), (1, [], 3), (2, [(2, 1.0)], 1)], "uid int, recs array<struct<mid:int,score:double>>, batch_id long")
    got = {r.uid: len(r.recs) for r in online.latest_lists(results).collect()}
    assert got == {1: 0, 2: 1}
