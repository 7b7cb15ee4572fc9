"""Archives: exact round trips, revisits, and the order of the merged index."""

import base64
import gzip
import hashlib
from collections import defaultdict

import numpy as np
import pytest

from shelfpair.llm import queries
from shelfpair.llm.warc import archive_and_index, merge_runs, parse_record, read_archives, record_at, records, url_key, write_archives
from tests.conftest import SMALL


def brute(rows, least=0):
    digest = {}
    firsts = defaultdict(list)
    for n, (page_id, html) in enumerate(rows):
        data = (html or "").encode()
        digest[n] = (len(data), base64.b32encode(hashlib.sha1(data).digest()).decode())
        firsts[digest[n][1]].append(page_id)
    out = []
    for n, (page_id, _) in enumerate(rows):
        ids = [p for p in firsts[digest[n][1]] if p is not None]
        again = digest[n][0] >= least and ids and page_id != min(ids)
        out.append((page_id, *digest[n], "revisit" if again else "response", min(ids) if again else None))
    return out


def key(row):
    return tuple((x is not None, x) if not isinstance(x, str) else (True, x) for x in row)


def test_query_on_a_whole_table(spark, duck):
    rows = duck.execute("select page_id, html from pages").fetchall()
    got = [tuple(r) for r in queries.op10_warc(spark, SMALL).select("page_id", "payload_bytes", "payload_digest", "record_type", "refers_to").collect()]
    assert sorted(got) == sorted(brute(rows))


@pytest.mark.parametrize("least", [0, 5])
def test_odd_rows_and_global_order(spark, least):
    bodies = [None, "", "a\r\n\r\nb", "WARC/1.1\r\nContent-Length: 3\r\n\r\nabc\r\n\r\n", "é🎉", "same text", "same text", "x" * 300_000]
    rows = [(p, f"http://h{p % 3}.example.com/{'hot' if p % 2 else p}", bodies[p % len(bodies)]) for p in range(60)]
    rows += [(None, None, "same text"), (None, "http://bad:port/", "alone"), (5, "line\r\nbreak", "same text"), (-7, "HTTP://WWW.Example.com", "")]
    pages = spark.createDataFrame([(*r, 1, "f") for r in rows], "page_id long, url string, html string, payload_bytes int, file string")
    got = archive_and_index(pages, least_bytes=least, per_file=7).collect()
    plain = [(r.page_id, r.payload_bytes, r.payload_digest, r.record_type, r.refers_to) for r in got]
    assert sorted(plain, key=key) == sorted(brute([(p, h) for p, _, h in rows], least), key=key)
    order = [(r.url_key, r.captured, r.page_id is not None, r.page_id or 0) for r in got]
    assert order == sorted(order)
    assert len({(r.file, r.offset) for r in got}) == len(rows)


def test_empty_table(spark):
    pages = spark.createDataFrame([], "page_id long, url string, html string")
    assert records(pages).count() == 0 and archive_and_index(pages).count() == 0


def test_loser_tree():
    rng = np.random.default_rng(4)
    for k in [0, 1, 2, 3, 5, 8, 13]:
        runs = [sorted((int(x), i) for x in rng.integers(0, 20, rng.integers(0, 30))) for i in range(k)]
        assert list(merge_runs(runs, lambda x: x[0])) == sorted((x for run in runs for x in run), key=lambda x: x[0])


def test_url_keys():
    assert url_key("https://www.a.example.com:8080/p?q=1#f") == "com,example,a:8080)/p?q=1"
    assert url_key("http://a.example.com") == "com,example,a)/" and url_key(None) == ""


def test_seeking_reading_in_parts_and_other_readers(spark, tmp_path):
    import random

    draw = random.Random(7)
    pages = spark.createDataFrame([(p, f"http://h/{p}", "".join(draw.choices("abcdefgh <>é", k=draw.randrange(4000)))) for p in range(300)] + [(999, "http://h/copy", "x"), (1000, None, "x")], "page_id long, url string, html string")
    folder = f"{tmp_path}/archives"
    write_archives(records(pages.coalesce(1)), folder, 200)
    files = {f.name: f.read_bytes() for f in (tmp_path / "archives").glob("part-*")}
    size, spark_size = "spark.sql.files.maxPartitionBytes", spark.conf.get("spark.sql.files.maxPartitionBytes")
    spark.conf.set(size, "50k")
    try:
        read = read_archives(spark, folder)
        got = read.collect()
    finally:
        spark.conf.set(size, spark_size)
    assert len(got) == 302 and max(map(len, files.values())) > 4 * 50_000
    for r in got:  # seek by file and offset
        capture = parse_record(r.file, r.offset, record_at(files[r.file], r.offset))
        assert capture[5] == r.page_id and capture[7] == r.payload_digest
    whole = b"".join(gzip.decompress(data) for data in files.values())  # a reader that knows members only
    assert whole.count(b"WARC/1.1\r\n") == 302 and whole.endswith(b"\r\n\r\n")
    again = whole[whole.index(b"WARC-Type: revisit") :]
    assert b"WARC-Refers-To-Target-URI: http://h/copy\r\n" in again and b"WARC-Refers-To-Date: 2020-01-01T00:16:39Z" in again


def test_damage_is_noticed():
    body = b"HTTP/1.1 200 OK\r\nContent-Length: 1\r\n\r\nx"
    record = b"WARC/1.1\r\nWARC-Type: response\r\nWARC-Date: d\r\nWARC-Payload-Digest: sha1:AA\r\nContent-Length: %d\r\n\r\n%b\r\n\r\n" % (len(body), body)
    with pytest.raises(ValueError, match="payload"):
        parse_record("f", 0, gzip.compress(record))
