"""Helpers of the package."""

import pyarrow as pa

import corpus_pipeline
from shelfpair.llm.common import BATCH, SLICE, Recent, fresh, set_aside, slices, small_batches, smallest_by_hash, without
from shelfpair.llm.language import Network


def test_sample_is_bounded_and_the_same_in_any_partitions(spark):
    rows = spark.range(3000).selectExpr("id AS doc_id", "id % 7 AS v")
    samples = [sorted(r.doc_id for r in smallest_by_hash(rows.repartition(n), "doc_id", 40, of).collect()) for n in (1, 9) for of in (3000, 10**9, 1)]
    assert len(samples[0]) == 40 and all(s == samples[0] for s in samples)
    assert smallest_by_hash(rows.limit(5), "doc_id", 40, 10**6).count() == 5
    assert smallest_by_hash(rows.limit(0), "doc_id", 40, 0).count() == 0


def test_memory_is_bounded_and_keeps_what_is_asked_for():
    recent = Recent(10)
    for k in range(100):
        recent.turn()
        values, unknown = recent.known(["often", k])
        for i in unknown:
            recent.now[["often", k][i]] = str(i)
        assert (0 in unknown) == (k == 0)
        assert len(recent.now) + len(recent.before) <= 24
    assert recent.known([])[0] == []


def test_clashing_names(spark):
    df = spark.createDataFrame([(1, 2, 3)], "a int, Score int, own_Score int")
    assert fresh("score", df) == "score_" and without(df, "score").columns == ["a", "own_Score"]
    own, restored = set_aside(df, "score")
    assert "Score" not in own.columns and restored(own.selectExpr("*", "9 AS score")).collect() == df.collect()
    assert restored(own).columns == df.columns


def test_workers_turn_few_rows_into_objects_at_a_time():
    texts = [None, "", "1 2", *[f"some words and number {k} " * (k % 90) for k in range(3 * SLICE + 2)]]
    batch = pa.RecordBatch.from_pydict({"text": texts})
    pieces = list(slices([batch, batch.slice(0, 0)]))
    assert [p.num_rows for p in pieces] == [SLICE] * 3 + [5] and [t for p in pieces for t in p.column(0).to_pylist()] == texts
    network = Network(["de", "en"])
    assert network.predict(t for t in texts) == network.predict(texts)  # one by one, in the same matrix products
    assert network.predict(texts)[0][:3] == ["und"] * 3


def test_rows_of_the_pipeline_travel_in_small_batches(spark):
    key = "spark.sql.execution.arrow.maxRecordsPerBatch"
    before = spark.conf.get(key)

    def counted(batches):
        for batch in batches:
            yield pa.RecordBatch.from_arrays([pa.array([batch.num_rows])], ["n"])

    try:
        docs = spark.range(0, 3 * BATCH, 1, 1).selectExpr("id AS doc_id", "concat('text ', id) AS text")
        for more in ("10000", "0"):
            spark.conf.set(key, more)
            kept = corpus_pipeline.private_data(spark, docs, "")
            sizes = [r.n for r in kept.mapInArrow(counted, "n long").collect()]
            assert sum(sizes) == 3 * BATCH and max(sizes) <= BATCH
        spark.conf.set(key, "70")
        small_batches(spark)
        assert spark.conf.get(key) == "70"
    finally:
        spark.conf.set(key, before)
