import datetime

from pyspark.sql import functions as F

from conftest import rows
from marquee.functions import scalars as S
from marquee.functions import text as X
from marquee.streaming import rating_log


def values(frame, column, inputs, kind="string"):
    df = frame([(i, v) for i, v in enumerate(inputs)], f"i int, v {kind}")
    return [r[0] for r in df.orderBy("i").select(column).collect()]


def test_rating_payload(frame):
    lines = [
        "x MOVIE_RATING_PREFIX: 1|2|3.0|4 ",
        "MOVIE_RATING_PREFIX:1|2|3.0|4 MOVIE_RATING_PREFIX:5|6|1.0|7",
        "MOVIE_RATING_PREFIX:",
        "nothing here",
    ]
    assert values(frame, S.rating_payload("v"), lines) == ["1|2|3.0|4", "1|2|3.0|4", "", None]


def test_log_line_of_a_real_session(frame):
    line = "2019-04-04 11:28:09,123 INFO --- web.ratings : MOVIE_RATING_PREFIX:2018522823|106471|5.0|1554349689"
    df = rating_log.ratings_from_log(frame([(line,)], "value string"))
    assert rows(df) == [(2018522823, 106471, 5.0, 1554349689)]


def test_bad_messages_are_kept_apart(frame):
    messages = frame([("1|2|3.0|4",), ("1|2|good|4",), ("1|2",), ("",)], "value string")
    assert rows(rating_log.parse_messages(messages)) == [(1, 2, 3.0, 4)]
    assert rows(rating_log.bad_messages(messages)) == [("",), ("1|2",), ("1|2|good|4",)]


def test_milliseconds_become_seconds(frame):
    assert values(frame, S.as_epoch_seconds("v"), [1554349689, 1554349689123, 0], "long") == [1554349689, 1554349689, 0]


def test_yearmonth_at_the_month_border(spark, frame):
    utc = lambda *a: int(datetime.datetime(*a, tzinfo=datetime.timezone.utc).timestamp())
    stamps = [utc(2009, 12, 14, 3), utc(2009, 12, 31, 23, 59, 59), utc(2010, 1, 1), -1]
    before = spark.conf.get("spark.sql.session.timeZone")
    try:
        spark.conf.set("spark.sql.session.timeZone", "America/Los_Angeles")
        assert values(frame, S.yearmonth("v"), stamps, "int") == [200912, 200912, 201001, 196912]
    finally:
        spark.conf.set("spark.sql.session.timeZone", before)


def test_genre_match_is_a_substring_test(frame):
    df = frame([("Warrior|Drama",), ("drama",), ("",)], "g string")
    found = df.select("g", S.matched_genres("g", ["War", "DRAMA"]).alias("m"))
    assert rows(found) == [("", []), ("Warrior|Drama", ["War", "DRAMA"]), ("drama", ["DRAMA"])]


def test_thresholds_are_strict_and_ignore_nan(frame):
    got = values(frame, S.over("v", 0.6), [0.6, 0.61, float("nan"), None], "double")
    assert got == [False, True, False, False]


def test_bins_and_stars(frame):
    assert values(frame, S.half_star_bin("v"), [0.0, 0.25, 0.74, 5.0], "double") == [0, 1, 1, 10]
    assert values(frame, S.stars_to_score("v"), [1.0, 7.5, 10.0], "double") == [0.5, 3.75, 5.0]


def test_cosine(frame):
    df = frame([([1.0, 0.0], [1.0, 0.0]), ([3.0, 4.0], [4.0, 3.0]), ([0.0, 0.0], [1.0, 1.0])], "a array<double>, b array<double>")
    assert [r[0] for r in df.select(F.round(S.cosine("a", "b"), 6)).collect()] == [1.0, 0.96, None]


def test_history_items(frame):
    df = frame([(["260:5.0", " 31 : 2.5 "],)], "items array<string>")
    (row,) = df.select(S.history_items("items").alias("r")).collect()
    assert [tuple(i) for i in row.r] == [(260, 5.0), (31, 2.5)]


def test_recs_are_ranked_by_score_then_mid(frame):
    df = frame([([(3, 1.0), (1, 2.0), (2, 2.0)],)], "recs array<struct<mid:int,score:double>>")
    (row,) = df.select(S.rank_recs("recs", 2).alias("r")).collect()
    assert [tuple(i) for i in row.r] == [(1, 2.0), (2, 2.0)]


def test_blank_tokens_keep_empty_pieces(frame):
    assert values(frame, X.blank_tokens("v"), ["", "A  b"]) == [[""], ["a", "", "b"]]


def test_deletion_neighbourhood(frame):
    assert sorted(values(frame, X.deletion_neighbourhood("v", 1), ["abc"])[0]) == ["ab", "abc", "ac", "bc"]
    assert sorted(values(frame, X.deletion_neighbourhood("v", 2), ["ab"])[0]) == ["", "a", "ab", "b"]
    assert values(frame, X.deletion_neighbourhood("v", 0), ["ab"]) == [["ab"]]


def test_hash_bucket_is_stable(frame):
    got = values(frame, X.term_bucket("v", 50), ["action", "drama", "action"])
    assert got[0] == got[2] and all(0 <= b < 50 for b in got)


def test_unit_of_an_epoch_number(frame):
    assert values(frame, S.as_epoch_seconds("v", "millis"), [1554349689123, 90_000_000_000], "long") == [1554349689, 90_000_000]
    assert values(frame, S.as_epoch_seconds("v", "seconds"), [1554349689], "long") == [1554349689]
