from conftest import rows
from marquee.operators.online import recent_ratings
from marquee.plans import ingest, jobs
from marquee.sources import streams
from marquee.sources.tables import TableStore
from marquee.streaming import history, rating_log
from marquee.streaming.live import LiveLists
from test_similarity import small_index

RATING = "uid int, mid int, score double, timestamp int"


def lines_of(ratings):
    return [f"INFO MOVIE_RATING_PREFIX:{u}|{m}|{s}|{t}" for u, m, s, t in ratings]


def feed(folder, name, ratings):
    folder.mkdir(exist_ok=True)
    (folder / name).write_text("\n".join(["noise"] + lines_of(ratings)) + "\n")


RATINGS = [(1, m, 3.0 + (m % 3), t) for t, m in enumerate([1, 2, 4, 6, 1, 5])] + [(2, 6, 2.0, 3), (3, 99, 5.0, 9)]


def run(spark, tmp_path, name, chunks, frame):
    handler = LiveLists(spark, str(tmp_path / name), lambda: small_index(frame))
    logs = tmp_path / f"{name}-logs"
    for i, chunk in enumerate(chunks):
        feed(logs, f"{i}.log", chunk)
        ratings = rating_log.ratings_from_log(streams.log_folder_source(spark, str(logs)))
        streams.run_available(handler.writer(ratings, str(tmp_path / f"{name}-checkpoint")))
    return handler


def lists(df):
    return {r.uid: [(x.mid, x.score) for x in r.recs] for r in df.collect()}


def test_many_batches_equal_one(spark, tmp_path, frame):
    ordered = sorted(RATINGS, key=lambda r: r[3])
    once = lists(run(spark, tmp_path, "one", [ordered], frame).latest())
    many = lists(run(spark, tmp_path, "many", [ordered[:3], ordered[3:6], ordered[6:]], frame).latest())
    assert once == many and once[3] == [] and once[2] != []


def test_replayed_batch_changes_nothing(spark, tmp_path, frame):
    handler = run(spark, tmp_path, "replay", [RATINGS], frame)
    before, history_rows = lists(handler.latest()), rows(handler.history())
    handler(frame(RATINGS, RATING), 0)
    assert lists(handler.latest()) == before and rows(handler.history()) == history_rows


def test_merged_batches_change_nothing(spark, tmp_path, frame):
    make = lambda name, **options: LiveLists(spark, str(tmp_path / name), lambda: small_index(frame), **options)
    plain, merging = make("plain"), make("merging", compact_every=2)
    for number, rating in enumerate(sorted(RATINGS, key=lambda r: r[3])):
        for handler in (plain, merging):
            handler(frame([rating], RATING), number)
    merging(frame([rating], RATING), number)  # a replay
    merging.compact(6)
    assert rows(merging.history()) == rows(plain.history())
    assert lists(merging.latest()) == lists(plain.latest())
    assert rows(merging.history(before=3)) == rows(plain.history(before=3))
    left = sorted(p.name for p in (tmp_path / "merging" / "history").iterdir() if p.is_dir())
    assert left == [f"batch_id={n}" for n in range(4, 8)]
    assert merging.merged.versions("history") == merging.merged.versions("lists") == [4, 6]


def test_stored_ratings_count_as_seen(spark, tmp_path, frame):
    stored = frame([(1, 2, 4.0, 0), (1, 3, 4.0, 0)], RATING)
    handler = LiveLists(spark, str(tmp_path), lambda: small_index(frame), lambda: stored)
    handler(frame([(1, 1, 5.0, 7)], RATING), 0)
    assert {m for m, _ in lists(handler.latest())[1]} == {4, 5, 6}


def test_an_ingested_click_counts_once(spark, tmp_path, frame):
    store = TableStore(spark, str(tmp_path / "store"))
    jobs.store_similar(store, "MovieRecs", small_index(frame))
    store.overwrite("Rating", frame([(1, 10, 2.0, 100), (1, 20, 3.0, 50), (2, 10, 1.0, 70)], RATING))
    handler = jobs.live_lists(store, str(tmp_path / "live"), "MovieRecs")
    clicks = frame([(1, 10, 5.0, 5000), (1, 30, 4.0, 6000)], RATING)
    untouched = [(1, 10, 2.0, 100), (1, 10, 5.0, 5000), (1, 20, 3.0, 50), (1, 30, 4.0, 6000), (2, 10, 1.0, 70)]
    handler(clicks, 0)
    assert rows(handler.history()) == untouched
    ingest.store_ratings(store, clicks)
    assert rows(store.read("Rating").filter("mid = 10")) == [(1, 10, 5.0, 100), (2, 10, 1.0, 70)]
    once = [(1, 10, 5.0, 5000), (1, 20, 3.0, 50), (1, 30, 4.0, 6000), (2, 10, 1.0, 70)]
    assert rows(handler.history()) == once
    handler(clicks, 1)  # the same clicks again
    assert rows(handler.history()) == once
    # A click that the ingest has stored before the live job sees it, and a second one on the same movie.
    ingest.store_ratings(store, frame([(1, 10, 1.0, 7000)], RATING))
    assert rows(handler.history()) == sorted([*once, (1, 10, 1.0, 7000)])
    handler(frame([(1, 10, 1.0, 7000)], RATING), 2)
    assert rows(handler.history()) == sorted([*once, (1, 10, 1.0, 7000)])
    assert rows(store.read("RatingClicks")) == [(1, 10, 7000), (1, 30, 6000)]


def test_a_batch_reads_the_stored_ratings_once(spark, tmp_path, frame):
    read = spark.sparkContext.accumulator(0)

    def counted(batches):
        for batch in batches:
            read.add(batch.num_rows)
            yield batch

    # Rows that repeat stay, of repeated clicked ones the greatest score; nothing is equal to a null.
    stored = frame([(1, 2, 4.0, 0), (1, 2, 4.0, 0), (1, 3, 1.0, 5), (1, 3, 2.0, 6), (1, 4, None, 7), (1, 5, 3.0, None),
                    (1, None, 3.0, 8), (None, 3, 3.0, 9), (2, 3, 5.0, 9), (1, 6, 1.0, 20)], RATING)
    clicks = frame([(1, 3, 50), (1, 3, 60), (1, 4, 70), (1, 6, 20), (1, None, 80), (None, 3, 90), (2, 3, None)], "uid int, mid int, timestamp int")
    handler = LiveLists(spark, str(tmp_path), lambda: small_index(frame), lambda: stored.mapInArrow(counted, RATING),
                        load_clicks=lambda: clicks)
    handler(frame([(1, 1, 5.0, 100), (1, 6, 4.0, 20)], RATING), 0)
    assert read.value == stored.count()
    assert not list((tmp_path / "held").glob("*"))
    order = lambda r: [(v is None, v or 0) for v in r]
    of_one = [(1, 1, 5.0, 100), (1, 2, 4.0, 0), (1, 2, 4.0, 0), (1, 3, 2.0, 50), (1, 3, 2.0, 60), (1, 4, None, 70),
              (1, 5, 3.0, None), (1, 6, 4.0, 20), (1, None, 3.0, 8)]
    known = handler.history(users=frame([(1,)], "uid int"))
    assert sorted(map(tuple, known.collect()), key=order) == sorted(of_one, key=order)
    everyone = [*of_one, (None, 3, 3.0, 9), (2, 3, 5.0, None)]
    assert sorted(map(tuple, handler.history().collect()), key=order) == sorted(everyone, key=order)


def test_history_state_is_bounded_and_equals_batch(spark, tmp_path, frame):
    ratings = [(1, i, 3.0, 100 + i) for i in range(45)] + [(1, 44, 1.0, 500), (2, 7, 4.0, 5)]
    logs, out = tmp_path / "logs", tmp_path / "out"

    def keep(df, batch_id):
        df.write.mode("overwrite").parquet(f"{out}/batch_id={batch_id}")

    for i in range(0, len(ratings), 16):
        feed(logs, f"{i}.log", ratings[i:i + 16])
        stream = history.recent_ratings_stream(
            rating_log.ratings_from_log(streams.log_folder_source(spark, str(logs)))
        )
        streams.run_available(
            stream.writeStream.outputMode("update").foreachBatch(keep)
            .option("checkpointLocation", str(tmp_path / "checkpoint"))
        )
    state = spark.read.parquet(str(out))
    newest = state.filter("uid = 1").agg({"version": "max"}).first()[0]
    held = state.filter(f"uid = 1 and version = {newest}")
    assert held.count() == 40
    batch = recent_ratings(frame(ratings, RATING)).filter("uid = 1")
    assert rows(held.filter("position <= 20"), "uid", "position", "mid", "score") == rows(batch)


def test_log_filter_job(spark, tmp_path):
    feed(tmp_path / "logs", "a.log", RATINGS)
    lines = streams.log_folder_source(spark, str(tmp_path / "logs"))
    sink = lambda m: streams.folder_sink(streams.keyed(m), str(tmp_path / "out"), str(tmp_path / "c"))
    streams.run_available(jobs.log_filter(lines, sink))
    got = spark.read.parquet(str(tmp_path / "out"))
    assert got.count() == len(RATINGS) and {r.key for r in got.collect()} == {"logProcessor"}


def test_replayed_events_are_dropped(spark, tmp_path, frame):
    frame([(1, 10), (1, 10), (2, 20)], "event_id int, s int").selectExpr(
        "event_id", "timestamp_seconds(s) AS ts"
    ).coalesce(1).write.parquet(str(tmp_path / "in"))
    events = streams.table_folder_source(spark, str(tmp_path / "in"), "event_id int, ts timestamp")
    unique = rating_log.without_replays(events, "event_id", "ts", "1 hour")
    streams.run_available(streams.folder_sink(unique, str(tmp_path / "out"), str(tmp_path / "c")))
    assert rows(spark.read.parquet(str(tmp_path / "out")), "event_id") == [(1,), (2,)]


def test_real_time_job_on_stored_tables(spark, tmp_path, frame):
    store = TableStore(spark, str(tmp_path / "store"))
    jobs.store_similar(store, "MovieRecs", small_index(frame))
    store.overwrite("Rating", frame([(1, 2, 4.0, 0)], RATING))
    feed(tmp_path / "logs", "a.log", [(1, 1, 5.0, 7)])
    lines = streams.log_folder_source(spark, str(tmp_path / "logs"))
    handler, writer = jobs.live_recommendations(store, lines, str(tmp_path / "live"), str(tmp_path / "c"))
    streams.run_available(writer)
    jobs.refresh_stream_recs(store, handler)
    assert {m for m, _ in lists(store.read("StreamRecs"))[1]} == {3, 4, 5, 6}
