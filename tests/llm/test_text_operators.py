"""Language, quality, packing and byte BPE against brute force, libraries and held-out rows."""

import base64
import hashlib
import math
import re
import zlib
from collections import Counter

import numpy as np
import public_tokenizers as P
import pytest
import tiktoken
import xxhash
from hypothesis import given, settings
from hypothesis import strategies as st
from tokenizers import Tokenizer

import corpus_pipeline
from shelfpair.llm import queries
from shelfpair.llm.bytebpe import ByteEncoder, decode, encode
from shelfpair.llm.language import DIMS, FILTERS, WIDTHS, WINDOW, Network, held_out, identify, keep_known, train, windows_of
from shelfpair.llm.packing import WordEncoder, cut, pack, with_checksums, write_buckets
from shelfpair.llm.quality import BUCKETS, judge
from tests.conftest import SMALL

ODD = [
    None, "", " ", "\n\n", "a", "  two  spaces \n x", "it's we'll THE'S", "tab\tnbsp em sep\x1cx\x85y", "<|endoftext|> <|startoftext|>x",
    "é ́x İSTANBUL ΣΑΣ Σ", "\x01 a\x01b \x01\x01", "日本語 текст ελληνικά 🎉🎉", "x" * 5000, "ab" * 300 + "  " * 40, "1234567 ٣٤ ²½", "end \n",
    "\x1c\x1d a   b", "a\r\n\r\nb", "'s 't", ",'s ''re",
]


def docs_frame(spark, texts):
    return spark.createDataFrame([(i, t, None) for i, t in enumerate(texts)], "doc_id long, text string, lang string")


# packing


@pytest.fixture(scope="module")
def word_tokenizer():
    return Tokenizer.from_file(P.path("word_bpe_49k.json"))


def test_chunks_encode_as_whole_texts(word_tokenizer):
    coder = WordEncoder(P.path("word_bpe_49k.json"), most=5)
    for _ in range(2):
        got = [np.frombuffer(coder.encode(t), "<u4").tolist() for t in ODD]
        assert got == [word_tokenizer.encode(t or "", add_special_tokens=False).ids for t in ODD]


@settings(max_examples=60, deadline=None)
@given(st.text(max_size=60))
def test_any_text_encodes_alike(text):
    coder = WordEncoder(P.path("word_bpe_49k.json"))
    want = Tokenizer.from_file(P.path("word_bpe_49k.json")).encode(text, add_special_tokens=False).ids
    assert np.frombuffer(coder.encode(text), "<u4").tolist() == want


def test_cut_is_the_binary_form():
    for n in [1, 2, 3, 2047, 2048, 2049, 6000, 8192]:
        lengths = cut(n)
        assert sum(lengths) == n and lengths == sorted(lengths, reverse=True)
        assert all(x & (x - 1) == 0 and x <= 2048 for x in lengths) and len(set(x for x in lengths if x < 2048)) == len([x for x in lengths if x < 2048])


def check_packed(rows, texts, tokenizer):
    by_doc = {}
    for r in rows:
        by_doc.setdefault(r.doc_id, []).append(r)
    assert len({r.sequence_id for r in rows}) == len(rows) and all(r.offset == 0 for r in rows)
    for doc_id, text in texts:
        ids = np.array([*tokenizer.encode(text or "", add_special_tokens=False).ids, 1], "<u4")
        at = 0
        for r in sorted(by_doc[doc_id], key=lambda r: r.start):
            assert r.start == at and r.doc_tokens == len(ids) and r.length & (r.length - 1) == 0 and r.length <= 2048
            assert r.ids_crc32 == zlib.crc32(ids[at : at + r.length].tobytes())
            at += r.length
        assert at == len(ids)


def test_packing_query_on_a_whole_table(spark, duck, word_tokenizer):
    rows = queries.op2_packing(spark, SMALL).collect()
    check_packed(rows, duck.execute("select doc_id, text from documents").fetchall(), word_tokenizer)


def test_packing_odd_rows(spark, word_tokenizer, tmp_path):
    docs = docs_frame(spark, ODD).withColumnRenamed("lang", "ids")
    packed = pack(docs)
    check_packed(with_checksums(packed).collect(), list(enumerate(ODD)), word_tokenizer)
    assert pack(docs.limit(0)).count() == 0
    assert pack(docs.unionAll(docs)).count() == 2 * packed.count()
    write_buckets(packed, str(tmp_path / "buckets"))
    back = spark.read.parquet(str(tmp_path / "buckets"))
    assert back.count() == packed.count() and back.where("bucket <> size(ids)").count() == 0


def test_packing_stage_keeps_tokens_in_buckets(spark, word_tokenizer):
    docs = docs_frame(spark, [*ODD, *["some words of a text " * k for k in range(1, 40)]])
    texts = {r.doc_id: r.text for r in docs.collect()}
    packed = corpus_pipeline.packing(spark, docs, SMALL)
    rows = packed.collect()
    check_packed(rows, texts.items(), word_tokenizer)
    back = {}
    for r in sorted(rows, key=lambda r: r.start):
        assert r.bucket == r.length == len(r.ids)
        back.setdefault(r.doc_id, []).extend(r.ids)
    assert back == {d: [*word_tokenizer.encode(t or "", add_special_tokens=False).ids, 1] for d, t in texts.items()}
    for part in packed.select("bucket").rdd.glom().collect():
        assert [r.bucket for r in part] == sorted(r.bucket for r in part)


# byte BPE


@pytest.fixture(scope="module")
def byte_reference():
    with open(P.path("byte_bpe_multi_50k.tiktoken"), "rb") as lines:
        ranks = {base64.b64decode(a): int(b) for a, b in map(bytes.split, lines)}
    return tiktoken.Encoding("own", pat_str=P.PATTERN, mergeable_ranks=ranks, special_tokens={})


@pytest.fixture(scope="module")
def byte_encoder():
    return ByteEncoder(P.path("byte_bpe_multi_50k.tiktoken"), P.PATTERN, most=50)


def test_trees_merge_like_the_library(byte_encoder, byte_reference):
    for _ in range(2):
        got = [np.frombuffer(b, "<i4").tolist() for b in byte_encoder.encode(ODD)]
        assert got == [byte_reference.encode_ordinary(t or "") for t in ODD]


@settings(max_examples=150, deadline=None)
@given(st.one_of(st.text(max_size=80), st.text("aeinthr 's\n.é", max_size=200)))
def test_any_text_merges_like_the_library(byte_encoder, byte_reference, text):
    assert np.frombuffer(byte_encoder.encode([text])[0], "<i4").tolist() == byte_reference.encode_ordinary(text)


def test_short_and_long_trees_agree(byte_encoder):
    rng = np.random.default_rng(1)
    pieces = [bytes(rng.choice(list(b"aeinthrs"), int(n))) for n in rng.integers(1, 65, 300)]
    merger = byte_encoder.merger
    many = [np.frombuffer(x, "<i4").tolist() for x in merger.merge(pieces)]
    assert many == [[merger.ranks[p]] if p in merger.ranks else merger.merge_long(p) for p in pieces]


def test_byte_query_on_a_whole_table(spark, duck, byte_reference):
    want = set()
    for doc_id, text in duck.execute("select doc_id, text from documents").fetchall():
        ids = byte_reference.encode_ordinary(text or "")
        want.add((doc_id, len(ids), hashlib.sha256(",".join(map(str, ids)).encode()).hexdigest(), hashlib.sha256((text or "").encode()).hexdigest()))
    assert {tuple(r) for r in queries.op6_byte_bpe(spark, SMALL).collect()} == want


def test_byte_bpe_odd_rows(spark):
    docs = docs_frame(spark, ODD).withColumnRenamed("lang", "decoded")
    coded = encode(docs)
    assert coded.columns == ["doc_id", "decoded", "ids"]
    back = decode(coded)
    assert {r.doc_id: bytes(r.decoded) for r in back.collect()} == {i: (t or "").encode() for i, t in enumerate(ODD)}
    assert encode(docs.limit(0)).count() == 0


# quality


def brute_facts(text):
    text = text or ""
    words = [w for w in re.split("[\x20\x09-\x0d]+", text) if w]
    windows = [tuple(words[i : i + 8]) for i in range(len(words) - 7)]
    seen = Counter(windows)
    covered = {k for i, w in enumerate(windows) if seen[w] > 1 for k in range(i, i + 8)}
    lines = [x for x in text.split("\n") if re.search("[^\x20\x09-\x0d]", x)]
    return words, (len(words), sum(map(len, words)), sum(c in "#*$%&|<>" for c in text), len(lines) - len(set(lines)), len(covered))


def bucket(*parts):
    seed = 42
    for part in parts:
        seed = xxhash.xxh64_intdigest(part.encode(), seed)
    signed = seed - (1 << 64) if seed >> 63 else seed
    return signed % BUCKETS


def brute_quality(rows, trusted, threshold=-0.1):
    grams = []
    for _, text in rows:
        words = brute_facts(text)[0]
        grams.append([bucket(w) for w in words] + [bucket(a, b) for a, b in zip(words, words[1:])])
    raw, target = Counter(g for x in grams for g in x), Counter(g for (d, _), x in zip(rows, grams) if d in trusted for g in x)
    scale = sum(target.values()) / max(1, sum(raw.values()))
    ratio = {b: math.log((target[b] + 10) / (raw[b] * scale + 10)) for b in raw}
    out = {}
    for (doc_id, text), x in zip(rows, grams):
        facts = brute_facts(text)[1]
        failed = facts[0] < 20 or 100 * facts[4] > 30 * facts[0]
        score = sum(ratio[b] for b in x) / len(x) if x else None
        out[doc_id] = (*facts, failed, score, not failed and score >= threshold)
    return out


def same(got, want):
    assert got.keys() == want.keys()
    for key in want:
        *a, k, s = got[key]
        *b, t, m = want[key]
        assert a == b and k == m and (s == t if t is None else abs(s - t) < 1e-9), (key, got[key], want[key])


def test_quality_query_on_a_whole_table(spark, duck):
    rows = duck.execute("select doc_id, text from documents").fetchall()
    trusted = {d for (d,) in duck.execute("select doc_id from labels where quality = 1 and toxic = 0").fetchall()}
    got = {r.doc_id: tuple(r)[1:] for r in queries.op4_quality(spark, SMALL).collect()}
    same(got, brute_quality(rows, trusted))
    assert {v[-2] for v in got.values()} == {True, False}


def test_quality_odd_rows(spark):
    texts = [*ODD, "a b c d e f g h " * 3, "x " + "a b c d e f g h i j k l m n o p q r s t " * 2, "one\ntwo\n one\ntwo\n \n \n", "#*$%&|<> ## a"]
    docs = docs_frame(spark, texts).withColumnRenamed("lang", "score").selectExpr("*", "1 as facts", "2 as ratio_of_bucket", "3 as trusted")
    labels = spark.createDataFrame([(20, 1, 0), (20, 1, 0), (0, 1, None), (3, 0, 0), (None, 1, 0)], "doc_id long, quality int, toxic int")
    found = judge(docs, labels)
    assert found.columns[:5] == ["doc_id", "text", "facts", "ratio_of_bucket", "trusted"]
    same({r.doc_id: tuple(r)[5:] for r in found.collect()}, brute_quality(list(enumerate(texts)), {20, 0}))
    assert judge(docs.limit(0), labels.limit(0)).count() == 0
    assert judge(docs, labels.limit(0)).where("score <> 0").count() == 0


def test_unlabelled_texts_are_judged_like_labelled_ones(spark):
    """Clean texts stay whether or not they are labelled; texts full of symbols or capitals go."""
    folder = "/root/testdata/sf0.01"
    rows = queries.op4_quality(spark, folder).join(spark.read.parquet(f"{folder}/documents.parquet").select("doc_id", "text"), "doc_id")
    rows = rows.join(spark.read.parquet(f"{folder}/labels.parquet"), "doc_id", "left").where("not base_failed").collect()
    junk = lambda r: r.n_symbols > 0.05 * len(r.text) or sum(w.isupper() for w in r.text.split()) > 0.5 * r.n_words
    for group in ([r for r in rows if r.quality is None], [r for r in rows if r.quality is not None]):
        clean = [r.kept for r in group if not junk(r)]
        dirty = [r.kept for r in group if junk(r)]
        assert sum(clean) / len(clean) > 0.98 and sum(dirty) / len(dirty) < 0.15


def test_quality_runs_no_python(spark):
    plan = queries.op4_quality(spark, SMALL)._jdf.queryExecution().executedPlan().toString()
    assert "Python" not in plan and "Arrow" not in plan


# language


def test_fold_follows_the_definition(spark):
    rows = [(i,) for i in [*range(50), None]]
    got = spark.createDataFrame(rows, "doc_id long").select("doc_id", held_out(__import__("pyspark").sql.functions.col("doc_id")).alias("h")).collect()
    assert all(r.h == (r.doc_id is not None and zlib.crc32(str(r.doc_id).encode()) % 4 == 2) for r in got)


def test_languages_of_held_out_documents(spark):
    rows = queries.op1_language(spark, "/root/testdata/sf0.01")
    langs = spark.read.parquet("/root/testdata/sf0.01/documents.parquet").select("doc_id", "lang")
    held = rows.where("held_out").join(langs, "doc_id").collect()
    assert len(held) > 200 and sum(r.lang == r.lang_pred for r in held) / len(held) > 0.97
    assert all(0 <= r.score <= 1 for r in held)


def test_gradients_match_differences():
    rng = np.random.default_rng(2)
    network = Network(["a", "b", "c"])
    for key in network.p:
        network.p[key] = network.p[key].astype(np.float64)
    windows, target = rng.integers(0, 256, (5, 256)).astype(np.uint8), np.array([0, 1, 2, 1, 0])

    def loss():
        return -np.log(network.probabilities(windows)[np.arange(5), target]).mean()

    found = network._gradients(windows, target)
    for key, values in network.p.items():
        for index in [np.unravel_index(np.abs(found[key]).argmax(), values.shape)]:
            kept = values[index]
            values[index] = kept + 1e-6
            up = loss()
            values[index] = kept - 1e-6
            down = loss()
            values[index] = kept
            assert abs((up - down) / 2e-6 - found[key][index]) < 1e-6


def plain_network(network, window):
    """Probabilities of one window by plain loops over filters, positions and classes."""
    p = {name: values.astype(float) for name, values in network.p.items()}
    pooled = []
    for k, width in enumerate(WIDTHS):
        for f in range(k * FILTERS, (k + 1) * FILTERS):
            best = -math.inf
            for at in range(len(window) - max(WIDTHS) + 1):
                total = 0.0
                for j in range(width):
                    for d in range(DIMS):
                        total += p["embedding"][window[at + j], d] * p["filters"][j * DIMS + d, f]
                best = max(best, total)
            pooled.append(max(0.0, best + p["bias"][f]))
    logits = [sum(x * p["out"][f, c] for f, x in enumerate(pooled)) + p["shift"][c] for c in range(len(network.classes))]
    odds = [math.exp(x - max(logits)) for x in logits]
    return [x / sum(odds) for x in odds]


def test_predictions_by_plain_loops(spark, duck):
    docs = spark.read.parquet(f"{SMALL}/documents.parquet")
    network = train(docs, epochs=2)
    rows = [(d, t) for d, t in duck.execute("select doc_id, text from documents order by length(text), doc_id limit 40").fetchall()]
    found = {r.doc_id: r for r in identify(docs, network).collect()}
    for doc_id, text in rows:
        if not text or not any(c.isalpha() for c in text):
            assert (found[doc_id].lang_pred, found[doc_id].score) == ("und", 0.0)
            continue
        windows = windows_of(text)
        sizes = [min(WINDOW, len(text.encode()) - k * WINDOW) for k in range(len(windows))]
        odds = [plain_network(network, w) for w in windows]
        mean = [sum(o[c] * n for o, n in zip(odds, sizes)) / sum(sizes) for c in range(len(network.classes))]
        assert found[doc_id].lang_pred == network.classes[mean.index(max(mean))] and abs(found[doc_id].score - max(mean)) < 1e-3


def test_a_rare_language_is_learned(spark):
    rows = [(i, " ".join(["the", "cat", "and", "dog"][(i + j) % 4] for j in range(20)), "en") for i in range(6000)]
    rows += [(10_000 + i, "żółw święty łódź " * (3 + i % 3), "pl") for i in range(150)]
    docs = spark.createDataFrame(rows, "doc_id long, text string, lang string")
    network = train(docs, per_lang=200, epochs=12)
    assert network.classes == ["en", "pl"]
    assert network.predict(["święty żółw łódź i żółw", "the dog and the cat"])[0] == ["pl", "en"]


def test_language_odd_rows(spark):
    train_rows = [(i, ("the cat and the dog " if i % 2 else "le chat et le chien ") * (i % 5 + 1), "en" if i % 2 else "fr") for i in range(200)]
    docs = spark.createDataFrame(train_rows, "doc_id long, text string, lang string")
    network = train(docs)
    odd = spark.createDataFrame([(None, t, None, 1, 2) for t in [None, "", "12 34 !!", "the dog and the cat " * 4000, "le chien"]], "doc_id long, text string, lang string, score int, extra int")
    got = identify(odd, network)
    assert got.columns == ["doc_id", "text", "lang", "extra", "lang_pred", "score"]
    assert [r.lang_pred for r in got.collect()] == ["und", "und", "und", "en", "fr"]
    assert {(r.lang_pred, r.score) for r in identify(docs.limit(3), train(docs.limit(0))).collect()} == {("und", 0.0)}
    assert windows_of("é" * 300).shape == (3, 256)
    mixed = docs.selectExpr("*", "doc_id as score").unionByName(odd.selectExpr("doc_id", "text", "lang", "cast(score as long) score"))
    left = keep_known(mixed)
    assert left.columns == mixed.columns and left.count() == 202
