"""The pipeline on the smallest table, and each stage on odd rows and clashing columns."""

import corpus_pipeline as pipeline
import pytest
from marquee.session import written

FOLDER = "/root/testdata/sf0.001"
COLUMNS = (
    "doc_id long, text string, lang string, source string, n_chars long, n_words long, kept string, score string, size int, "
    "u1 int, u2 int, print int, root int, row int, position int, pass int, taken int, words int, predicted int, _extra0 int"
)


def test_stages_keep_columns_and_run_to_the_end(spark):
    docs = spark.read.parquet(f"{FOLDER}/documents.parquet")
    columns, counts = docs.columns, [docs.count()]
    for number, (_, stage) in enumerate(pipeline.STAGES):
        docs = written(stage(spark, docs, FOLDER), "test")
        counts.append(docs.count())
        assert number == len(pipeline.STAGES) - 1 or docs.columns == columns
    assert counts[0] >= counts[1] >= counts[2] >= counts[3] > 0
    rows = docs.collect()
    assert all(len(t.encode().split()) == n for r in rows for t, n in zip(r.texts, r.sizes))
    again = pipeline.run(spark, FOLDER).collect()
    assert sorted(map(str, again)) == sorted(map(str, rows))


@pytest.fixture(scope="module")
def odd(spark):
    extra = (7, "k", "s", *range(1, 13))
    plain = "a quiet day in the old town with a walk along the river and a look at the boats"
    rows = [(i, f"{plain} number {i} and more of it {i * i}", "en", "s1", 9, *extra) for i in range(12)]
    rows += [rows[3], (None, None, None, None, None, *[None] * 15), (50, "", None, "s2", 0, *extra), (51, "x " * 5000, "en", None, 1, *extra)]
    return spark.createDataFrame(rows, COLUMNS)


@pytest.mark.parametrize("number", range(4))
def test_stages_on_odd_rows(spark, odd, number):
    stage = pipeline.STAGES[number][1]
    found = stage(spark, odd, FOLDER)
    assert found.columns == odd.columns and found.dtypes == odd.dtypes
    extras = {tuple(r)[5:] for r in odd.collect()}
    rows = found.collect()
    assert rows and all(tuple(r)[5:] in extras for r in rows)
    assert stage(spark, odd.limit(0), FOLDER).count() == 0


def test_packing_stage_on_odd_rows(spark, odd):
    assert sum(len(r.doc_ids) for r in pipeline.sequences(spark, odd, FOLDER).collect()) == odd.count()
    assert pipeline.sequences(spark, odd.limit(0), FOLDER).count() == 0
