"""Every stage of the pipeline against a brute-force version of its own input."""

import numpy as np
import pytest
import public_tokenizers as P
from tokenizers import Tokenizer

import corpus_pipeline
from shelfpair.llm.language import train
from shelfpair.llm.pii import KEY_SETTING, replace_in
from tests.conftest import SMALL
from tests.llm.test_jaccard import brute_jaccard
from tests.llm.test_text_operators import brute_quality, check_packed


KEY = b"a key for tests"


@pytest.fixture(scope="module")
def stages(spark):
    """Input and output of each stage."""
    spark.conf.set(KEY_SETTING, KEY.decode())
    docs, out = spark.read.parquet(f"{SMALL}/documents.parquet"), {}
    for name, stage in corpus_pipeline.STAGES:
        after = stage(spark, docs, SMALL).cache()
        out[name] = (docs, after)
        docs = after
    yield out
    spark.conf.unset(KEY_SETTING)


def ids(df):
    return sorted(r.doc_id for r in df.select("doc_id").collect())


def test_columns_stay(stages):
    for name, (before, after) in stages.items():
        if name != "packing":
            assert after.columns == before.columns and after.dtypes == before.dtypes


def test_language_stage(stages):
    before, after = stages["language"]
    rows = before.collect()
    langs, scores = train(before).predict([r.text for r in rows])
    assert ids(after) == sorted(r.doc_id for r, lang, s in zip(rows, langs, scores) if lang != "und" and s >= 0.4)


def test_quality_stage(stages, duck):
    before, after = stages["quality"]
    trusted = {d for (d,) in duck.execute("select doc_id from labels where quality = 1 and toxic = 0").fetchall()}
    want = brute_quality([(r.doc_id, r.text) for r in before.collect()], trusted)
    assert ids(after) == sorted(d for d, facts in want.items() if facts[-1])
    assert len(ids(after)) < before.count()


def test_near_copies_stage(stages):
    before, after = stages["near_copies"]
    groups = brute_jaccard([(r.doc_id, r.text) for r in before.collect()])
    assert ids(after) == sorted(set(groups.values()))
    assert len(ids(after)) < before.count()


def test_private_data_stage(stages):
    before, after = stages["private_data"]
    want = {r.doc_id: replace_in(r.text, KEY)[0] for r in before.collect()}
    assert {r.doc_id: r.text for r in after.collect()} == want
    assert all(r.n_chars == len(r.text) for r in after.collect())


def test_packing_stage_and_run(spark, stages):
    before, after = stages["packing"]
    tokenizer = Tokenizer.from_file(P.path("word_bpe_49k.json"))
    check_packed(after.collect(), [(r.doc_id, r.text) for r in before.collect()], tokenizer)
    plain = lambda df: sorted(tuple(r) for r in df.select("doc_id", "start", "length", "ids_crc32", "doc_tokens").collect())
    assert plain(corpus_pipeline.run(spark, SMALL)) == plain(after)


def test_stages_on_an_empty_table(spark, tmp_path):
    docs = spark.read.parquet(f"{SMALL}/documents.parquet").limit(0)
    for name, stage in corpus_pipeline.STAGES:
        docs = stage(spark, docs, SMALL)
        assert docs.count() == 0, name


def test_stages_on_odd_rows(spark):
    schema = spark.read.parquet(f"{SMALL}/documents.parquet").schema.add("score", "string").add("facts", "integer")
    text = " ".join(f"word{k % 37} the and of" for k in range(30))
    rows = [(1, text, "en", None, None, "x", 1), (1, text, "en", None, None, "x", 1), (2, text, None, "s", 3, None, 2), (3, None, "en", "s", 0, "z", 3), (None, text, None, None, None, None, None)]
    docs = spark.createDataFrame(rows, schema)
    for name, stage in corpus_pipeline.STAGES[:-1]:
        docs = stage(spark, docs, SMALL)
        assert docs.columns == schema.names, name
    assert np.isin([r.doc_id for r in docs.collect()], [1, None]).all()
