"""Files, snapshots, streaming and plan shapes."""

import pytest
from pyspark.sql import functions as F

from shelfpair.catalog.views import view
from shelfpair.operators import blocking
from shelfpair.plans import reports
from shelfpair.schemas import PAIRS, PRODUCTS
from shelfpair.session import ensure_checkpoint_dir
from pyspark.sql.types import StructType

from shelfpair.operators import parsing
from shelfpair.sources import files, snapshots, tables
from shelfpair.streaming.incremental import read_table, start_incremental
from tests.conftest import SMALL


def test_csv_keeps_quotes_and_blanks(spark, tmp_path):
    rows = [(1, "AH", 'Lay\'s "Naturel", 225g', "Nivea ", "Chips", 225.0, "g", 1.99, True)]
    df = spark.createDataFrame(rows, PRODUCTS)
    files.write_csv(df, f"{tmp_path}/p")
    assert [tuple(r) for r in files.read_products_csv(spark, f"{tmp_path}/p").collect()] == rows
    assert files.csv_header(spark, f"{tmp_path}/p") == PRODUCTS.fieldNames()


def test_required_columns(spark):
    df = spark.range(1).withColumn("title", F.lit("x"))
    with pytest.raises(ValueError, match="main_category"):
        tables.require_columns(df)


def test_copy_text(spark, tmp_path):
    text = "1\t10\t20\tidentical\t0.950\t2024-01-01 00:00:00\t\\N\n\\N\t11\t21\tsimilar\t0.750\t\\N\t\\N\n\\.\n"
    (tmp_path / "copy.tsv").write_text(text)
    rows = files.read_copy_text(spark, str(tmp_path / "copy.tsv")).orderBy("source_product_id").collect()
    assert [(r.id, r.source_product_id, float(r.similarity_score)) for r in rows] == [(1, 10, 0.95), (None, 11, 0.75)]
    assert rows[0].created_at.year == 2024 and rows[1].created_at is None


def test_copy_text_keeps_awkward_values(spark, tmp_path):
    values = [None, "", "\\N", "\\.", "a\tb", "a\nb\r\n", "\\", "\\\\n", "\\t", '"q"', " x ", "\b\f\v"]
    rows = [(k, v, "end") for k, v in enumerate(values)]
    schema = StructType.fromDDL("n int, v string, w string")
    files.write_copy_text(spark.createDataFrame(rows, schema), f"{tmp_path}/c")
    assert sorted(map(tuple, files.read_copy_text(spark, f"{tmp_path}/c", schema).collect())) == rows
    (tmp_path / "d").write_text("1\ta\\tb\\\\n\t\\N\n2\t\tx\n\\.\n")
    assert sorted(map(tuple, files.read_copy_text(spark, f"{tmp_path}/d", schema).collect())) == [(1, "a\tb\\n", None), (2, "", "x")]


def test_logs_split_at_answers(spark, tmp_path):
    """A log is read in parts, also with a very long answer, and its answers keep their order."""
    long = "\n".join(f"{k}={k + 1} (similar)" for k in range(100_000))
    answers = ["1=2 (identical)", long, "3=4 (similar)\n5=6 (similar)"]
    text = "".join(f"10:00 INFO    LLM response ({len(a)} chars): {a}\n10:01 INFO    done\n" for a in answers)
    (tmp_path / "run.log").write_text("start\n" + text)
    with_parts = spark.conf.get("spark.sql.files.maxPartitionBytes")
    spark.conf.set("spark.sql.files.maxPartitionBytes", "300k")
    try:
        logs = files.read_logs(spark, str(tmp_path))
        assert logs.rdd.getNumPartitions() > 3
        found = parsing.log_answers(logs).orderBy("path", "block_no").collect()
    finally:
        spark.conf.set("spark.sql.files.maxPartitionBytes", with_parts)
    assert [r.response_text for r in found] == answers


def test_tables_in_folders(spark, tmp_path):
    rows = spark.range(6).selectExpr("id AS n", "CAST(id % 2 AS INT) AS half")
    snapshots.write_table(rows, f"{tmp_path}/t", "half", "n")
    assert {tuple(r) for r in snapshots.read_table(spark, f"{tmp_path}/t", rows.schema).collect()} == {(i, i % 2) for i in range(6)}
    with pytest.raises(Exception, match="PATH_ALREADY_EXISTS"):
        snapshots.write_table(rows, f"{tmp_path}/t")


def test_lines_that_do_not_fit_are_rejected(spark, tmp_path):
    schema = StructType.fromDDL("id bigint, title string, price double")
    (tmp_path / "a.csv").write_text('id,title,price\n1,"two\nlines, ""quoted""",1.5\nx,bad id,2\n2,short\n3,,\n4,plain,2.5,extra\n')
    rows, rejected = files.read_checked_csv(spark, str(tmp_path), schema)
    assert sorted(map(tuple, rows.collect())) == [(1, 'two\nlines, "quoted"', 1.5), (3, None, None)]
    assert sorted(r.line for r in rejected.collect()) == ["2,short", "4,plain,2.5,extra", "x,bad id,2"]


def test_cache(spark):
    cache = spark.createDataFrame([("k1", "old"), ("k2", "old")], "cache_key string, v string")
    fresh = spark.createDataFrame([("k2", "new"), ("k3", "new")], "cache_key string, v string")
    assert {tuple(r) for r in snapshots.add_to_cache(cache, fresh).collect()} == {("k1", "old"), ("k2", "new"), ("k3", "new")}
    hits, misses = snapshots.split_by_cache(fresh.select("cache_key"), cache)
    assert [r.cache_key for r in hits.collect()] == ["k2"] and [r.cache_key for r in misses.collect()] == ["k3"]


def test_stream_over_two_arrivals(spark, tmp_path):
    def product(i, shop):
        return (i, shop, f"{shop} melk", "b", "zuivel", 1.0, "l", 1.0, True)

    def answer(prompts):
        return prompts.map(lambda p: "1=2 (identical)\n1=3 (similar)")

    for n, rows in enumerate([[product(1, "AH"), product(2, "PLUS")], [product(3, "JUMBO")]]):
        spark.createDataFrame(rows, PRODUCTS).coalesce(1).write.mode("append").parquet(f"{tmp_path}/in")
        start_incremental(spark, f"{tmp_path}/in", f"{tmp_path}/tables", f"{tmp_path}/state", answer).awaitTermination()
        pairs = read_table(spark, f"{tmp_path}/tables/pairs", PAIRS)
        assert {(r.source_product_id, r.target_product_id) for r in pairs.collect()} == ({(1, 2)} if n == 0 else {(1, 2), (1, 3)})


def test_stream_rewrites_only_parts_with_arrivals(spark, tmp_path):
    """Products of many blocks; one of them moves, then goes: its pair stays, then goes, and other parts are left alone."""
    def product(i, category, active=True):
        return (i, ["AH", "PLUS"][i % 2], f"melk {category}", "b", category, 1.0, "l", 1.0, active)

    def answer(prompts):
        return prompts.map(lambda p: "\n".join(f"{k}={k + 1} (identical)" for k in range(0, 40, 2)))

    def arrive(rows):
        spark.createDataFrame(rows, PRODUCTS).coalesce(1).write.mode("append").parquet(f"{tmp_path}/in")
        start_incremental(spark, f"{tmp_path}/in", f"{tmp_path}/tables", f"{tmp_path}/state", answer).awaitTermination()
        files = {f.parent.name: sorted(x.name for x in f.parent.glob("part-*")) for f in (tmp_path / "tables" / "products").rglob("part-*")}
        pairs = read_table(spark, f"{tmp_path}/tables/pairs", PAIRS).collect()
        return files, {(r.source_product_id, r.target_product_id) for r in pairs}

    before, pairs = arrive([product(i, f"c{i // 2}") for i in range(20)])
    assert pairs == {(k, k + 1) for k in range(0, 20, 2)}
    after, pairs = arrive([product(0, "c9")])
    assert pairs == {(k, k + 1) for k in range(0, 20, 2)}
    assert 0 < sum(before[p] != after[p] for p in before) <= 2
    _, pairs = arrive([product(0, "c9", active=False)])
    assert pairs == {(k, k + 1) for k in range(2, 20, 2)}
    assert read_table(spark, f"{tmp_path}/tables/products", PRODUCTS).count() == 20


def plan(df) -> str:
    return df._jdf.queryExecution().executedPlan().toString()


def test_plans_have_no_nested_loops_and_push_filters_down(spark):
    products, pairs = view(spark, SMALL, "products"), view(spark, SMALL, "product_equivalence")
    for df in (blocking.unmatched_ids(products, pairs), blocking.live_pairs(pairs, products), reports.match_coverage(products, pairs)):
        text = plan(df)
        assert "NestedLoop" not in text and "Cartesian" not in text
    stored = f"{ensure_checkpoint_dir(spark)}/plan-products"
    products.write.mode("overwrite").parquet(stored)
    text = plan(blocking.block_inventory(spark.read.schema(PRODUCTS).parquet(stored)))
    assert "IsNotNull(main_category)" in text and "EqualTo(is_active,true)" in text
    assert "title" not in text.split("ReadSchema")[1].split(">")[0]
