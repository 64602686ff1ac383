"""Recent ratings of each user as bounded streaming state."""

import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql.streaming.state import GroupStateTimeout

from marquee.operators.online import HISTORY_KEPT

STATE = "items array<struct<timestamp:int,mid:int,score:double>>"
OUTPUT = "uid int, position int, mid int, score double, timestamp int, version long"
NEWEST = ["timestamp", "mid", "score"]


def recent_ratings_stream(ratings: DataFrame, kept=HISTORY_KEPT) -> DataFrame:
    """(uid, position, mid, score, timestamp, version): history of every user touched by a batch.

    State per user is at most ``kept`` ratings, newest first. ``version`` grows by the number of ratings
    seen, so the row set with the greatest version is the current history of a user.
    Only ``kept`` rows of a user are held at a time, however many arrive.
    """
    schema = f"{STATE}, version long"

    def push(key, batches, state):
        items, version = state.get if state.exists else ([], 0)
        held = pd.DataFrame([tuple(i) for i in items], columns=NEWEST)
        for pdf in batches:
            version += len(pdf)
            rows = [frame for frame in (held, pdf[NEWEST]) if len(frame)]
            held = pd.concat(rows).sort_values(NEWEST, ascending=False).head(kept)
        state.update((list(held.itertuples(index=False, name=None)), version))
        yield pd.DataFrame({
            "uid": pd.Series([key[0]] * len(held), dtype="int32"),
            "position": pd.Series(range(1, len(held) + 1), dtype="int32"),
            "mid": held["mid"].astype("int32").to_numpy(),
            "score": held["score"].astype("float64").to_numpy(),
            "timestamp": held["timestamp"].astype("int32").to_numpy(),
            "version": pd.Series([version] * len(held), dtype="int64"),
        })

    return ratings.groupBy("uid").applyInPandasWithState(
        push, OUTPUT, schema, "update", GroupStateTimeout.NoTimeout
    )
