"""Stages of the corpus pipeline by rows: null ids, repeated rows, one id with different texts."""

import random

import corpus_pipeline
from merkmal.session import scratch_path

SCHEMA = "doc_id long, text string, n_chars long"
WORDS = [a + b for a in "bdfklmnprst" for b in ("a", "e", "io", "u")]


def text(rng, n):
    return " ".join(rng.choice(WORDS) for _ in range(n))


def both(spark, rows):
    """The rows as a table in memory and as a stored one of several files."""
    frame = spark.createDataFrame([(i, t, len(t or "")) for i, t in rows], SCHEMA)
    path = scratch_path(spark, "rows")
    frame.repartition(5).write.parquet(path)
    return [frame, spark.read.parquet(path)]


def listed(frame):
    return sorted(((r["doc_id"], r["text"]) for r in frame.collect()), key=str)


def test_one_row_of_each_group_of_near_copies_stays(spark):
    rng = random.Random(8)
    a, b, c, d = (text(rng, 80) for _ in range(4))
    near = a.rsplit(" ", 1)[0] + " end"
    rows = [(9, a), (4, near), (None, a), (None, near), (1, b), (1, b), (1, c), (None, d), (None, d), (2, b), (None, None), (None, None), (3, " ")]
    expected = sorted([(4, near), (1, b), (1, c), (None, d), (None, None), (None, None), (3, " ")], key=str)
    for frame in both(spark, rows):
        assert listed(corpus_pipeline.near_copies(spark, frame, "")) == expected
        assert corpus_pipeline.near_copies(spark, frame.filter("doc_id = -1"), "").count() == 0


def test_contaminated_rows_go_and_clean_ones_of_the_same_id_stay(spark):
    rng = random.Random(9)
    item = text(rng, 15)
    clean, bad = [text(rng, 30) for _ in range(3)], text(rng, 10) + " " + item
    folder = scratch_path(spark, "sf")
    spark.createDataFrame([(1, item)], "item_id long, text string").write.parquet(f"{folder}/benchmark.parquet")
    rows = [(1, clean[0]), (1, bad), (None, bad), (None, clean[1]), (2, clean[2]), (2, clean[2]), (3, bad), (None, None)]
    for frame in both(spark, rows):
        assert listed(corpus_pipeline.benchmark_passages(spark, frame, folder)) == sorted([r for r in rows if r[1] != bad], key=str)
        assert corpus_pipeline.benchmark_passages(spark, frame.filter("doc_id = -1"), folder).count() == 0
