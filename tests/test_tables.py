import os

import pytest

from conftest import rows
from marquee.operators import merges, statistics
from marquee.plans import ingest, jobs
from marquee.sources import delimited
from marquee.sources.tables import TableStore, search_documents

GOOD = "260^Star^desc^121 minutes^September 21, 2004^1977^English^Action|Sci-Fi^Mark^George"


def movie_file(folder, lines):
    path = folder / "movies.csv"
    path.write_text("\n".join(lines) + "\n")
    return str(path)


def test_movie_lines(spark, tmp_path):
    lines = [
        GOOD, " 7 ^ Padded ^d^t^i^s^l^^a^b", "8^Empty last^d^t^i^s^l^g^a^",
        "9^nine fields^d^t^i^s^l^g^a", "ten^bad key^d^t^i^s^l^g^a^b", '11^quo"te^d^t^i^s^l^A||B^a^b',
    ]
    scan = delimited.read_movies(spark, movie_file(tmp_path, lines), mode="PERMISSIVE")
    good = delimited.good_rows(scan)
    assert rows(good, "mid", "name", "genres", "directors") == [
        (7, "Padded", "", "b"), (8, "Empty last", "g", ""), (11, 'quo"te', "A||B", "b"), (260, "Star", "Action|Sci-Fi", "George"),
    ]
    assert rows(delimited.quarantined(scan)) == [(lines[3],), (lines[4],)]


def test_bad_movie_line_fails_a_strict_scan(spark, tmp_path):
    with pytest.raises(Exception):
        delimited.read_movies(spark, movie_file(tmp_path, [GOOD, "9^short"])).collect()


def test_parse_movie_lines_marks_unusable_ones(frame):
    parsed = delimited.parse_movie_lines(frame([(GOOD,), ("x^y",)], "value string"))
    assert sorted(r.mid or 0 for r in parsed.collect()) == [0, 260]


def test_comma_in_a_tag_is_quarantined(spark, tmp_path):
    path = tmp_path / "tags.csv"
    path.write_text("15,1955, dentist ,1193435061\n15,1955,good,bad,1193435061\n")
    scan = delimited.read_tags(spark, str(path), mode="PERMISSIVE")
    assert rows(delimited.good_rows(scan)) == [(15, 1955, "dentist", 1193435061)]
    assert delimited.quarantined(scan).count() == 1


def test_overwrite_survives_a_dead_writer(spark, tmp_path, frame):
    store = TableStore(spark, str(tmp_path))
    store.overwrite("AverageMovies", frame([(1, 2.0)], "mid int, avg double"))
    os.makedirs(tmp_path / "AverageMovies" / "v00000002")
    assert rows(store.read("AverageMovies")) == [(1, 2.0)]
    store.overwrite("AverageMovies", store.read("AverageMovies").selectExpr("mid", "avg + 1 AS avg"))
    assert rows(store.read("AverageMovies")) == [(1, 3.0)]
    assert store.versions("AverageMovies") == [1, 2]


def test_missing_table(spark, tmp_path):
    with pytest.raises(FileNotFoundError):
        TableStore(spark, str(tmp_path)).read("Movie")


def test_one_document_per_movie(frame):
    df = frame([(1, "a", "x"), (1, "b", "w"), (2, "c", None)], "mid int, name string, tags string")
    assert rows(search_documents(df)) == [(1, "b", "w"), (2, "c", None)]


RATING = "uid int, mid int, score double, timestamp int"


def test_upsert_keeps_the_old_time(frame):
    current = frame([(1, 1, 3.0, 10), (1, 2, 4.0, 11), (1, 2, 4.5, 12)], RATING)
    updates = frame([(1, 1, 1.0, 50), (1, 1, 2.0, 60), (2, 9, 5.0, 70), (1, 2, 0.5, 80)], RATING)
    assert rows(merges.upsert_ratings(current, updates)) == [
        (1, 1, 2.0, 10), (1, 2, 0.5, 11), (1, 2, 0.5, 12), (2, 9, 5.0, 70),
    ]


def test_append_tags(frame):
    documents = frame([(1, "old"), (2, None), (3, None)], "mid int, tags string")
    new = frame([(1, "b", 7200), (1, "a", 10), (1, "a", 11), (2, "z", 5)], "mid int, tag string, timestamp int")
    assert rows(merges.append_tags(documents, new, ["timestamp"]).na.fill("")) == [(1, "old|a|a|b"), (2, "z"), (3, "")]


def test_preferences(frame):
    users = frame([(1, "a", True, 0, ["X"]), (2, "b", True, 0, [])], "uid int, username string, first boolean, timestamp long, prefGenres array<string>")
    prefs = frame([("b", "Q,R", 2), ("b", "P", 1)], "username string, genres string, timestamp int")
    got = {r.uid: (r["first"], r.prefGenres) for r in merges.update_preferences(users, prefs).collect()}
    assert got == {1: (True, ["X"]), 2: (False, ["P", "Q", "R"])}


def test_delete_and_exists(frame):
    tags = frame([(1, 1, "a"), (1, 1, "b"), (2, 1, "a")], "uid int, mid int, tag string")
    doomed = frame([(1, 1, "a"), (1, 1, "a")], "uid int, mid int, tag string")
    assert rows(merges.delete_by_key(tags, doomed, ["uid", "mid", "tag"]).select("uid", "mid", "tag")) == [(1, 1, "b"), (2, 1, "a")]
    flagged = merges.exists_flag(tags, doomed, ["uid"])
    assert rows(flagged, "uid", "tag", "found") == [(1, "a", True), (1, "b", True), (2, "a", False)]


def test_clicks_are_halved_and_logged(frame):
    clicks = frame([(1, 5, 9.0, 1554349689123)], "uid int, mid int, stars double, timestamp long")
    table, history, lines = ingest.ingest_ratings(clicks, frame([], RATING))
    assert rows(table) == [(1, 5, 4.5, 1554349689)] == rows(history)
    assert rows(lines) == [("MOVIE_RATING_PREFIX:1|5|4.5|1554349689",)]


def test_histogram_has_room_for_five_stars(frame):
    df = frame([(1, 5.0), (1, 5.0), (1, 0.25)], "uid int, score double")
    assert rows(statistics.rating_histogram(df)) == [(1, [0, 1] + [0] * 8 + [2])]


def test_genre_lists_cut_ties_by_mid(frame):
    movies = frame([(i, "Drama|War") for i in range(30, 0, -1)] + [(99, "Comedy")], "mid int, genres string")
    averages = frame([(i, 3.0) for i in range(1, 31)], "mid int, avg double")
    got = {r.genres: [x.mid for x in r.recs] for r in statistics.genres_top_movies(movies, averages).collect()}
    assert got == {"Drama": list(range(1, 11)), "War": list(range(1, 11))}


def test_newest_by_text_and_by_date(frame):
    movies = frame([(1, "April 1, 2010"), (2, "September 21, 2004"), (3, "unknown")], "mid int, issue string")
    mids = lambda df: [r.mid for r in df.orderBy("rank").collect()]
    assert mids(statistics.new_movies(movies, 3)) == [3, 2, 1]
    assert mids(statistics.new_movies(movies, 3, parse_dates=True)) == [1, 2, 3]


def test_batch_jobs(spark, tmp_path):
    """Load, statistics, content and factor jobs over files; then their tables."""
    store = TableStore(spark, str(tmp_path / "store"))
    names = ["Action|Drama", "Action|Drama", "Comedy", "Action|War"]
    movies = [f"{i}^m{i}^d^t^i^s^l^{names[i % 4]}^a^b" for i in range(12)] + ["bad line"]
    (tmp_path / "m").write_text("\n".join(movies))
    (tmp_path / "r").write_text("\n".join(f"{u},{(u * 3 + j) % 12},{(u + j) % 10 / 2 + 0.5},{1000 + u * j}" for u in range(8) for j in range(6)))
    (tmp_path / "t").write_text("1,1,funny,5\n1,1,funny,6\n2,1,dark,7\n")
    jobs.load(store, *(str(tmp_path / n) for n in "mrt"), mode="PERMISSIVE")
    assert store.read("Movie").count() == 12
    assert rows(store.read("MovieRejects", store.read("MovieRejects", "value string").schema)) == [("bad line",)]
    documents = {r.mid: r.tags for r in store.read("SearchDocument").collect()}
    assert documents[1] == "dark|funny" and documents[2] is None
    jobs.compute_statistics(store)
    assert store.read("RateMoreMovies").count() == 12
    assert {r.genres for r in store.read("GenresTopMovies").collect()} == {"Action", "Drama", "Comedy", "War"}
    jobs.content_similarity(store, kept=5)
    lists = {r.mid: [x.mid for x in r.recs] for r in store.read("ContentMovieRecs").collect()}
    assert set(lists[0]) == {1, 4, 5, 8, 9}
    asked = store.read("Movie").select("mid").filter("mid = 0")
    near = {n: {r.rec_mid for r in jobs.similar_movies(store, asked, n).collect()} for n in (2, 5, 50)}
    assert near[2] == {1, 4} and near[5] == set(lists[0]) and near[50] >= near[5]
    queries = store.read("Movie").filter("mid = 3").selectExpr("'q' as query_id", "name as text")
    assert [r.mid for r in jobs.movie_search(store, queries, 5).collect()] == [3]
    assert jobs.movies_like(store, 5).count() == 0  # no word stands twice in a field
    index = jobs.collaborative_filtering(store, rank=3)
    assert index.members.count() == 12 and store.read("UserRecs").count() > 0
    grid = jobs.parameter_search(store, ranks=(2, 3), regs=(0.1,))
    assert grid.count() == 2


@pytest.mark.parametrize("reader, line", [
    (delimited.read_movies, "^noid^d^t^i^s^l^g^a^r"), (delimited.read_ratings, "1,,4.0,11"),
])
def test_strict_scans_fail_on_an_empty_number(spark, tmp_path, reader, line):
    spark.createDataFrame([(line,)], "value string").write.text(str(tmp_path / "lines"))
    with pytest.raises(Exception, match="a line has no mid"):
        reader(spark, str(tmp_path / "lines")).collect()


def test_old_versions_go(spark, tmp_path, frame):
    store = TableStore(spark, str(tmp_path), keep=2)
    for n in range(4):
        store.overwrite("numbers", frame([(n,)], "n int"))
    assert store.versions("numbers") == [3, 4]
    assert rows(store.read("numbers", store.overwrite("numbers", frame([(9,)], "n int")).schema)) == [(9,)]


def bucket_files(store, name):
    """Folder of each bucket with its files and their times of change."""
    found = {}
    for folder, _, files in os.walk(store.path(name)):
        if "=" in folder:
            found[folder.rpartition("=")[2]] = {f: os.stat(os.path.join(folder, f)).st_mtime_ns for f in files if f.endswith(".parquet")}
    return found


def test_clicks_replace_the_buckets_of_their_users_only(spark, tmp_path, frame):
    store = TableStore(spark, str(tmp_path), buckets=8)
    stored = [(u, m, 3.0, u * 10 + m) for u in range(200) for m in range(3)]
    store.overwrite("Rating", frame(stored, RATING))
    before = bucket_files(store, "Rating")
    assert len(before) == 8
    clicks = [(5, 1, 1.0, 9000), (5, 77, 4.0, 9001), (5, 77, 5.0, 9002)]
    expected = sorted([r for r in stored if r[:2] != (5, 1)] + [(5, 1, 1.0, 51), (5, 77, 5.0, 9002)])
    for _ in range(2):  # a replay changes nothing
        assert rows(ingest.store_ratings(store, frame(clicks, RATING))) == expected
        after = bucket_files(store, "Rating")
        assert sum(after[b] != before[b] for b in before) == 1 and after.keys() == before.keys()
        assert rows(store.read("RatingClicks")) == [(5, 1, 9000), (5, 77, 9002)]
    # One bucket is what a batch of one user reads.
    mine = [b for b in before if after[b] != before[b]]
    pruned = store.read("Rating", buckets=[int(mine[0])])
    assert 0 < len(pruned.inputFiles()) and len(set(pruned.collect())) < len(expected) / 4
    assert "PartitionFilters: [isnotnull(bucket_of_8" in pruned._jdf.queryExecution().toString()
    assert not store.exists("RatingStaged") and store.versions("Rating") == [1]
    assert rows(ingest.store_ratings(store, frame([], RATING))) == expected


def test_a_dead_update_is_finished(spark, tmp_path, frame):
    store = TableStore(spark, str(tmp_path), buckets=4)
    stored = [(u, 1, 3.0, u) for u in range(40)]
    store.overwrite("Rating", frame(stored, RATING))
    finish, store.finish = store.finish, lambda name: None
    ingest.store_ratings(store, frame([(7, 1, 1.0, 900)], RATING))
    assert rows(store.read("Rating")) == stored and store.exists("RatingStaged")
    store.finish = finish
    # It died between the removal of an old bucket and the move of the new one.
    touched = [f for f in store.names(store.path("RatingStaged")) if "=" in f]
    store.remove(f"{store.path('Rating')}/{touched[0]}")
    assert rows(ingest.store_ratings(store, frame([(8, 1, 2.0, 901)], RATING))) == sorted(
        [r for r in stored if r[0] not in (7, 8)] + [(7, 1, 1.0, 7), (8, 1, 2.0, 8)])
    # What was staged for a version that has been replaced is dropped.
    store.finish = lambda name: None
    ingest.store_ratings(store, frame([(7, 1, 5.0, 902)], RATING))
    store.finish = finish
    store.overwrite("Rating", frame(stored, RATING))
    assert rows(ingest.store_ratings(store, frame([(9, 2, 5.0, 903)], RATING))) == sorted([*stored, (9, 2, 5.0, 903)])


def test_a_table_in_other_buckets_is_laid_out_anew(spark, tmp_path, frame):
    TableStore(spark, str(tmp_path), buckets=4).overwrite("Rating", frame([(1, 1, 3.0, 5)], RATING))
    store = TableStore(spark, str(tmp_path), buckets=3)
    assert rows(store.read("Rating", buckets=[0, 1, 2])) == [(1, 1, 3.0, 5)]
    assert rows(ingest.store_ratings(store, frame([(1, 1, 2.0, 6), (None, 4, 2.0, 6)], RATING)).filter("uid = 1")) == [(1, 1, 2.0, 5)]
    frame([(1, 1, 3.0, 5)], RATING).write.parquet(f"{tmp_path}/plain/Rating/v00000001")
    plain = TableStore(spark, f"{tmp_path}/plain")
    assert rows(ingest.store_ratings(plain, frame([(1, 1, 2.0, 6)], RATING))) == [(1, 1, 2.0, 5)]
