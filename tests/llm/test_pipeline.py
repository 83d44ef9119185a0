"""The pipeline's stages on a small table."""

import os

import pytest

import corpus_pipeline as pipeline
from daysync.llm import minhash
from daysync.llm.common import scratch, stored

WORDS = [f"word{k}" for k in range(60)]
CLEAN = " ".join(WORDS)


@pytest.fixture(scope="module")
def docs(spark):
    rows = [
        (1, CLEAN + ".", "en", "s", 1), (2, CLEAN.upper() + ".", "en", "s", 1), (3, CLEAN + " end.", "en", "s", 1),
        (4, "mail a.b@mail.example.com today", "en", None, None), (5, None, None, None, None), (None, "text without id", "en", "s", 15),
        (6, "tail " + " ".join(reversed(WORDS)), "en", "s", 1),
    ]
    return spark.createDataFrame(rows, "doc_id long, text string, lang string, source string, n_chars long")


def _ids(df):
    return sorted((r["doc_id"] for r in df.collect()), key=lambda k: (k is None, k))


def _tables(spark):
    shared = spark.conf.get("spark.checkpoint.dir")
    return set(os.listdir(shared)) if os.path.isdir(shared) else set()


def test_tables_of_a_scratch_are_deleted(spark):
    before = _tables(spark)
    with pytest.raises(ZeroDivisionError), scratch(spark):
        lasting = stored(spark.range(3), lasting=True)
        with scratch(spark):
            stored(spark.range(5))
        assert stored(spark.range(4)).count() == 4 and len(_tables(spark) - before) == 2
        1 / 0  # noqa: B018
    assert len(_tables(spark) - before) == 1 and lasting.count() == 3
    stored(spark.range(2))
    assert len(_tables(spark) - before) == 2


def test_stages_take_effect_and_keep_clean_rows(spark, docs):
    names = [n for n, _ in pipeline.STAGES]
    assert names == ["quality", "exact_dedup", "near_dedup", "pii", "packing"]
    exact = pipeline.drop_copies(spark, docs, "")
    assert exact.columns == docs.columns and _ids(exact) == [2, 3, 4, 5, 6, None]
    near = pipeline.drop_near_copies(spark, exact, "")
    assert near.columns == docs.columns and _ids(near) == [2, 4, 5, 6, None]
    clean = pipeline.redact(spark, near, "")
    assert clean.columns == docs.columns
    rows = {r["doc_id"]: r for r in clean.collect()}
    assert rows[4]["text"] == "mail <EMAIL> today" and rows[4]["n_chars"] == len("mail <EMAIL> today")
    assert rows[5]["text"] is None and rows[None]["text"] == "text without id"
    packed = pipeline.pack(spark, clean, "")
    assert _ids(packed) == [2, 4, 5, 6, None]


def test_stages_take_empty_tables(spark, docs):
    for _, stage in pipeline.STAGES[1:]:
        assert stage(spark, docs.limit(0), "").collect() == []


def test_run_on_the_smallest_tables(spark):
    folder = "/root/testdata/sf0.001"
    given = spark.read.parquet(f"{folder}/documents.parquet")
    step = pipeline.keep_quality(spark, given, folder)
    labels = {r["doc_id"]: r["quality"] for r in spark.read.parquet(f"{folder}/labels.parquet").collect()}
    kept = {r["doc_id"] for r in step.collect()}
    assert sum((k in kept) == bool(q) for k, q in labels.items()) >= 0.95 * len(labels)
    before = _tables(spark)
    out = pipeline.run(spark, folder)
    assert len(_tables(spark) - before) == len(pipeline.STAGES)
    near = {r["id"] for r in minhash.near_duplicates(pipeline.drop_copies(spark, step, folder)).where("kept").collect()}
    assert {r["doc_id"] for r in out.collect()} == near
    sizes = {r["sequence_id"]: r["n"] for r in out.groupBy("sequence_id").agg({"length": "sum"}).toDF("sequence_id", "n").collect()}
    assert max(sizes.values()) <= 2048
