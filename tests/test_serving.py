import numpy as np

from conftest import rows
from marquee.operators import factors, serving

RECS = "array<struct<mid:int,score:double>>"
USER = "uid int, username string, prefGenres array<string>"


def test_hybrid_modes(frame):
    requests = frame([(1, 10), (2, 77)], "uid int, mid int")
    by_factor = frame([(10, [(5, 1.0), (6, 0.9)])], f"mid int, recs {RECS}")
    by_content = frame([(10, [(5, 1.0)])], f"mid int, recs {RECS}")
    live = frame([(1, [(7, 1.0), (5, 0.2)])], f"uid int, recs {RECS}")
    got = lambda mode: [tuple(r)[2:] for r in serving.hybrid(requests, by_factor, by_content, live, 3, mode).orderBy("rank").collect()]
    assert got("none") == [(1, 7, 0.4), (2, 5, 0.3), (3, 5, 0.3)]
    assert got("sum") == [(1, 5, 0.68), (2, 7, 0.4), (3, 6, 0.27)]
    assert got("max") == [(1, 7, 0.4), (2, 5, 0.3), (3, 6, 0.27)]


def test_cold_start(frame):
    users = frame([(1, "a", ["X"]), (2, "b", ["Sci Fi"]), (3, "c", [])], USER)
    ranked = frame([(1, 1, 9, 2.0)], "uid int, rank int, mid int, score double")
    tops = frame([("Sci", [(4, 1.0), (5, 3.0)]), ("X", [(6, 1.0)])], f"genres string, recs {RECS}")
    assert rows(serving.cold_start(users, ranked, tops, 2)) == [
        (1, 1, 9, 2.0, "list"), (2, 1, 5, 3.0, "genre"), (2, 2, 4, 1.0, "genre"),
    ]


def test_guess_answers_each_request_of_a_user_apart(frame):
    requests = frame([(1, 10), (1, 20), (1, 30), (9, 10)], "uid int, mid int")
    likes = frame([(10, [(5, 1.0), (6, 0.9)]), (20, [(7, 1.0)])], f"mid int, recs {RECS}")
    none = frame([], f"mid int, recs {RECS}")
    users = frame([(1, "a", ["X"]), (2, "b", ["X"])], USER)
    tops = frame([("X", [(6, 1.0)])], f"genres string, recs {RECS}")
    movies = frame([(i, f"m{i}") for i in range(5, 8)], "mid int, name string")
    averages = frame([(5, 2.0)], "mid int, avg double")
    live = none.withColumnRenamed("mid", "uid")
    got = serving.serve_guess(requests, users, none, likes, live, tops, movies, averages, 2)
    found = got.selectExpr("uid", "coalesce(asked, -1) asked", "rank", "mid", "score", "source", "name", "avg_score")
    assert rows(found) == [
        (1, 10, 1, 5, 0.3, "list", "m5", 2.0), (1, 10, 2, 6, 0.27, "list", "m6", 0.0), (1, 20, 1, 7, 0.3, "list", "m7", 0.0),
        (1, 30, 1, 6, 1.0, "genre", "m6", 0.0), (2, -1, 1, 6, 1.0, "genre", "m6", 0.0),
    ]


def test_seeded_genre_is_one_of_the_preferences(frame):
    users = frame([(i, str(i), ["A", "B", "C"]) for i in range(40)], USER)
    picks = dict(rows(serving.chosen_genre(users, seed=7)))
    assert set(picks.values()) == {"A", "B", "C"}
    assert picks == dict(rows(serving.chosen_genre(users, seed=7)))


def test_lookup_cuts_and_ranks(frame):
    recs = frame([(1, [(3, 0.5), (2, 0.5), (4, 0.9)])], f"uid int, recs {RECS}")
    asked = frame([(1,), (9,)], "uid int")
    assert rows(serving.lookup(asked, recs, "uid", 2)) == [(1, 1, 4, 0.9), (1, 2, 2, 0.5)]


def test_unrated_movie_scores_zero(frame):
    movies = frame([(1, "a"), (2, "b")], "mid int, name string")
    averages = frame([(1, 2.5)], "mid int, avg double")
    assert rows(serving.movie_info(movies, averages)) == [(1, "a", 2.5), (2, "b", 0.0)]


def test_last_own_rating_wins(frame):
    ratings = frame([(1, 1, 2.0, 5), (1, 1, 4.0, 9)], "uid int, mid int, score double, timestamp int")
    movies = frame([(1, "a")], "mid int, name string")
    assert rows(serving.my_rated_movies(ratings, movies)) == [(1, 1, "a", 4.0)]


def low_rank(frame, seed=0, users=60, items=40):
    rng = np.random.default_rng(seed)
    truth = 2.5 + rng.normal(size=(users, 2)) @ rng.normal(size=(2, items)) * 0.8
    cells = [(u, i, float(truth[u, i])) for u in range(users) for i in range(items) if rng.random() < 0.6]
    return frame(cells, "uid int, mid int, score double")


def test_training_beats_the_mean_on_structured_data(frame):
    train_set, test_set = factors.split_ratings(low_rank(frame))
    model = factors.train(train_set, rank=4, iterations=10, reg=0.05)
    learned = factors.holdout_rmse(model, test_set).first()["rmse"]
    mean = train_set.agg({"score": "avg"}).first()[0]
    scores = [r.score for r in test_set.collect()]
    assert learned < 0.6 * float(np.sqrt(np.mean([(s - mean) ** 2 for s in scores])))


def test_split_keeps_pairs_together(frame):
    ratings = frame([(u, m, 1.0) for u in range(20) for m in range(20)] * 2, "uid int, mid int, score double")
    a, b = (set(rows(s.select("uid", "mid"))) for s in factors.split_ratings(ratings))
    assert not a & b and len(a) + len(b) == 400


def test_best_parameters_break_ties_downwards(frame):
    grid = frame([(50, 0.1, 0.5), (20, 0.1, 0.5), (20, 0.01, 0.9)], "rank int, reg_param double, rmse double")
    assert rows(factors.best_parameters(grid)) == [(20, 0.1, 0.5)]


def test_repeated_training_gives_the_same_lists(frame):
    ratings = low_rank(frame)
    lists = lambda: rows(factors.user_lists(factors.train(ratings, rank=3), 5).selectExpr("uid", "to_json(recs)"))
    assert lists() == lists()
