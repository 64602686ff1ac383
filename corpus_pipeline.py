"""The corpus pipeline: each stage reads what its predecessor kept, written as Parquet.

``STAGES`` lists (name, function); a function takes (spark, docs, sf_dir) and returns a frame. Stages
keep extra columns of ``docs``, whatever their names; all but the last return the columns of ``docs``.
"""

from pyspark.sql import functions as F

from marquee.llm import curriculum, packing, quality, simhash, substrings
from marquee.llm.frames import shielded, table
from marquee.session import written

KNOWN = ("doc_id", "text", "lang", "source", "n_chars")


def good_quality(spark, docs, sf_dir):
    """Documents that the positive-unlabelled classifier scores below its threshold go.

    Null and empty texts are scored like others. Without labels every document stays.
    """
    rows, restore = shielded(docs, KNOWN)
    model = quality.train(rows, table(spark, sf_dir, "labels"))
    return restore(quality.score(rows, model).filter("predicted = 1"))


def near_duplicates(spark, docs, sf_dir):
    """One document of each group stays, the one with the smallest doc_id; repeated rows count once.

    Null and empty texts have the same fingerprint, so one of them stays.
    """
    rows, restore = shielded(docs, KNOWN)
    return restore(simhash.keep_one(rows, shingle=3, distance=3))


def repeated_passages(spark, docs, sf_dir):
    """Repeated passages of 35 words go; documents that held nothing else go with them.

    Texts without a repeat, null and empty ones too, stay as they are.
    """
    rows, restore = shielded(docs, KNOWN)
    parsed = substrings.remove_repeats(rows, window=35)
    cut = F.col("n_removed") > 0
    parsed = parsed.filter(~cut | (F.col("kept") != "")).withColumn("text", F.col("kept"))
    if "n_chars" in docs.columns:
        parsed = parsed.withColumn("n_chars", F.when(cut, F.length("kept").cast("long")).otherwise(F.col("n_chars")))
    return restore(parsed)


def target_weights(spark, docs, sf_dir):
    """Documents in training order, as often as the mix reads them (at most twice).

    Documents without words, and those that the mix does not reach, go.
    """
    rows, restore = shielded(docs, KNOWN)
    return restore(curriculum.training_rows(rows))


def sequences(spark, docs, sf_dir):
    """Training sequences of several lengths with the ids, places and texts of their pieces."""
    return packing.pack(docs, with_text=True)


STAGES = [
    ("quality classifier", good_quality),
    ("SimHash near-dedup", near_duplicates),
    ("substring dedup", repeated_passages),
    ("mixing sources to target weights", target_weights),
    ("best-fit packing", sequences),
]

# A learned classifier, connected components and greedy packing are beyond SQL; tests/llm compares the
# stages with brute force.
ORACLE_SQL = None


def run(spark, sf_dir):
    docs = table(spark, sf_dir, "documents")
    for number, (_, stage) in enumerate(STAGES):
        docs = stage(spark, docs, sf_dir)
        if number + 1 < len(STAGES):
            docs = written(docs, f"stage{number}")
    return docs
