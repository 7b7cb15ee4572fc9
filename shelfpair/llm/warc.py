"""WARC archives of pages, revisit records for equal payloads, and a merged index of capture histories."""

from __future__ import annotations

import base64
import gzip
import hashlib
import uuid
from collections.abc import Iterator
from itertools import pairwise
from urllib.parse import urlsplit

import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from shelfpair.llm.common import let
from shelfpair.session import ensure_checkpoint_dir, stored

BASE32 = "ABCDEFGHIJKLMNOPQRSTUVWXYZ234567"
PROFILE = "http://netpreserve.org/warc/1.1/revisit/identical-payload-digest"
CRLF = "\r\n"
CAPTURES = (
    "file string, offset long, url string, url_key string, captured string, page_id long, "
    "payload_bytes long, payload_digest string, record_type string, refers_to long"
)
ORDER = ("url_key", "captured", "page_id")


def payload_digest(payload: Column) -> Column:
    """Bare upper-case base32 SHA-1 of the UTF-8 bytes: 5 hexadecimal digits make 4 characters."""

    def characters(hexadecimal: Column) -> Column:
        out = []
        for k in range(8):
            value = F.conv(F.substring(hexadecimal, 5 * k + 1, 5), 16, 10).cast("int")
            for shift in (15, 10, 5, 0):
                out.append(F.substring(F.lit(BASE32), F.shiftright(value, shift).bitwiseAND(F.lit(31)) + 1, F.lit(1)))
        return F.concat(*out)

    return let(F.sha1(payload.cast("binary")), characters)


def records(pages: DataFrame, least_bytes: int = 0) -> DataFrame:
    """(page_id, url, payload, payload_bytes, payload_digest, record_type, refers_to, refers_to_url) of every row of ``pages``.

    The payload is the html (null: empty). Of rows with equal payloads of at least ``least_bytes`` bytes, the one with the
    smallest page_id is the response and the others revisit it; smaller ones are all responses. Rows that repeat the
    smallest page_id are responses too. Rows without page_id revisit the response, and are responses if no id is there.
    Further columns are ignored.

    The digests alone are grouped first; payloads move once, to meet the result. Both sides of that join are plain scans,
    so adaptive execution splits the group of a hot payload.
    """
    page_id = F.col("page_id").cast("long")
    named = F.when(page_id.isNotNull(), F.struct(page_id.alias("page_id"), F.col("url").cast("string").alias("url")))
    slim = pages.select(named.alias("page"), payload_digest(F.coalesce("html", F.lit(""))).alias("payload_digest"))
    firsts = slim.groupBy("payload_digest").agg(F.min("page").alias("first"))
    firsts = stored(firsts.select("payload_digest", F.col("first.page_id").alias("first"), F.col("first.url").alias("first_url")))
    payload = F.coalesce(F.col("html"), F.lit(""))
    rows = pages.select(
        F.col("page_id").cast("long").alias("page_id"),
        F.col("url").cast("string").alias("url"),
        payload.alias("payload"),
        F.octet_length(payload).cast("long").alias("payload_bytes"),
        payload_digest(payload).alias("payload_digest"),
    )
    again = (F.col("payload_bytes") >= least_bytes) & ~F.coalesce(F.col("page_id") == F.col("first"), F.col("first").isNull())
    return rows.join(firsts, "payload_digest").select(
        *rows.columns,
        F.when(again, "revisit").otherwise("response").alias("record_type"),
        F.when(again, F.col("first")).alias("refers_to"),
        F.when(again, F.col("first_url")).alias("refers_to_url"),
    )


def capture_time(page_id: Column) -> Column:
    """A stand-in for the time of capture, which the table of pages does not have: seconds after 2020 began."""
    return F.timestamp_seconds(F.lit(1_577_836_800) + F.pmod(F.coalesce(page_id, F.lit(0)), F.lit(1 << 31)))


#: What stands after each record: a gzip member of no bytes. It cannot occur within a member but by a chance of one in 2 ** 160,
#: so files can be read from any place, record by record.
BETWEEN = b"\x1f\x8b\x08\x00\x00\x00\x00\x00\x00\xff\x03" + b"\x00" * 9
TEXT = {"lineSep": BETWEEN.decode("latin-1"), "encoding": "ISO-8859-1"}


def write_archives(found: DataFrame, folder: str, per_file: int = 4000) -> None:
    """Write ``found`` (as from ``records``) as WARC 1.1 files of at most ``per_file`` records, each a gzip member of its own.

    A record is one value of Spark's text writer, whose separator is a gzip member too, so Spark's own writer and
    committer do the work: a lost task leaves no half file. Line ends in a url are percent-encoded. No task holds a
    file: a record is the largest thing in memory, at writing and at reading.
    """
    line = lambda *parts: F.concat(*[F.lit(p) if isinstance(p, str) else p for p in parts], F.lit(CRLF))
    maybe = lambda known, value: F.when(known.isNotNull(), value).otherwise("")
    own = F.expr("uuid()")
    encoded = lambda name: F.replace(F.replace(F.col(name), F.lit("\r"), F.lit("%0D")), F.lit("\n"), F.lit("%0A"))
    stamp = lambda name: F.date_format(F.to_utc_timestamp(capture_time(F.col(name)), F.current_timezone()), "yyyy-MM-dd'T'HH:mm:ss'Z'")
    http = F.concat(
        F.lit(f"HTTP/1.1 200 OK{CRLF}Content-Type: text/html; charset=utf-8{CRLF}"),
        line("Content-Length: ", F.col("payload_bytes").cast("string")),
        F.lit(CRLF),
    )
    response = F.col("record_type") == "response"
    body = F.concat(http, F.when(response, F.col("payload")).otherwise(""))
    length = F.octet_length(http) + F.when(response, F.col("payload_bytes")).otherwise(0)
    value = F.concat(
        F.lit(f"WARC/1.1{CRLF}"),
        line("WARC-Type: ", F.col("record_type")),
        line("WARC-Record-ID: <urn:uuid:", own, ">"),
        line("WARC-Date: ", stamp("page_id")),
        maybe(F.col("url"), line("WARC-Target-URI: ", encoded("url"))),
        line("WARC-Payload-Digest: sha1:", F.col("payload_digest")),
        maybe(F.col("page_id"), line("Page-ID: ", F.col("page_id").cast("string"))),
        maybe(F.col("refers_to"), line("WARC-Profile: ", PROFILE)),
        maybe(F.col("refers_to_url"), line("WARC-Refers-To-Target-URI: ", encoded("refers_to_url"))),
        maybe(F.col("refers_to"), line("WARC-Refers-To-Date: ", stamp("refers_to"))),
        maybe(F.col("refers_to"), line("Refers-To-Page-ID: ", F.col("refers_to").cast("string"))),
        F.lit(f"Content-Type: application/http; msgtype=response{CRLF}"),
        line("Content-Length: ", length.cast("string")),
        F.lit(CRLF),
        body,
        F.lit(CRLF * 2),
    )

    def packed(batches):
        for batch in batches:
            members = [gzip.compress(record.as_py().encode(), 1, mtime=0) for record in batch.column(0)]
            yield pa.RecordBatch.from_arrays([pa.array(members, pa.binary())], ["member"])

    members = found.select(value.alias("value")).mapInArrow(packed, "member binary")
    members.select(F.col("member").cast("string")).write.options(**TEXT, maxRecordsPerFile=per_file).text(folder)


def url_key(url: str | None) -> str:
    """Sort-friendly form: host labels from the top down, then port, path and query; no scheme, `www.` or fragment."""
    if not url:
        return ""
    try:
        parts = urlsplit(url.strip())
        host, port = parts.hostname or "", parts.port
    except ValueError:
        return url
    labels = host.removeprefix("www.").split(".")
    tail = (parts.path or "/") + (f"?{parts.query}" if parts.query else "")
    return ",".join(reversed(labels)) + (f":{port}" if port not in (None, 80, 443) else "") + ")" + tail


def _fields(block: bytes) -> dict[str, str]:
    lines = block.decode().split(CRLF)[1:]
    return {name.lower(): value for name, value in (line.split(": ", 1) for line in lines if ": " in line)}


def parse_record(name: str, offset: int, member: bytes) -> tuple:
    """The capture in one gzip member, as a tuple in the order of CAPTURES; the payload of a response must match its digest."""
    data = gzip.decompress(member)
    head = data.index(b"\r\n\r\n")
    warc = _fields(data[:head])
    begin = head + 4
    end = begin + int(warc["content-length"])
    split = data.index(b"\r\n\r\n", begin, end)
    size, digest = int(_fields(data[begin:split])["content-length"]), warc["warc-payload-digest"].removeprefix("sha1:")
    if warc["warc-type"] == "response":
        payload = data[split + 4 : end]
        if len(payload) != size or base64.b32encode(hashlib.sha1(payload).digest()).decode() != digest:
            raise ValueError(f"{name} at {offset}: the payload does not match its record")
    if data[end:] != b"\r\n\r\n":
        raise ValueError(f"{name} at {offset}: the record does not end where it should")
    number = lambda key: int(warc[key]) if key in warc else None
    url = warc.get("warc-target-uri")
    return name, offset, url, url_key(url), warc["warc-date"], number("page-id"), size, digest, warc["warc-type"], number("refers-to-page-id")


def record_at(data: bytes, offset: int) -> bytes:
    """The gzip member that begins at ``offset`` of a file, as the index names it."""
    return data[offset : data.index(BETWEEN, offset)]


def _sort_key(capture: tuple) -> tuple:
    page = capture[5]
    return capture[3], capture[4], page is not None, page or 0, capture[0], capture[1]


def _columns(rows: list[tuple], schema: pa.Schema) -> pa.RecordBatch:
    return pa.RecordBatch.from_arrays([pa.array([r[k] for r in rows], f.type) for k, f in enumerate(schema)], schema=schema)


ARROW = pa.schema(
    [("file", pa.string()), ("offset", pa.int64()), ("url", pa.string()), ("url_key", pa.string()), ("captured", pa.string()),
     ("page_id", pa.int64()), ("payload_bytes", pa.int64()), ("payload_digest", pa.string()), ("record_type", pa.string()), ("refers_to", pa.int64())]
)


def read_archives(spark, folder: str) -> DataFrame:
    """Captures of all archives in ``folder``, stored; those of one range of a file come out as one run, by url key and time.

    Files are read in ranges, record by record. A record's offset is its place in its range, plus the bytes of the ranges
    before it; there are as many sums as ranges.
    """
    place = [F.col("_metadata.file_path").alias("path"), F.col("_metadata.file_block_start").alias("start")]
    rows = spark.read.options(**TEXT, pathGlobFilter="part-*").text(folder).select(*place, F.col("value").cast("binary").alias("member"))
    extent = pa.field("extent", pa.int64())

    def run(batches):
        ranges: dict[tuple, list[tuple]] = {}
        ends: dict[tuple, int] = {}
        for batch in batches:
            for path, start, member in zip(*batch.columns):
                key, member = (path.as_py(), start.as_py()), member.as_py()
                offset = ends.get(key, 0)
                ends[key] = offset + len(member) + len(BETWEEN)
                if member:
                    ranges.setdefault(key, []).append((*parse_record(key[0].rsplit("/", 1)[-1], offset, member), key[1], len(member) + len(BETWEEN)))
        schema = ARROW.append(pa.field("start", pa.int64())).append(extent)
        for found in ranges.values():
            yield _columns(sorted(found, key=_sort_key), schema)

    parsed = stored(rows.mapInArrow(run, CAPTURES + ", start long, extent long"))
    before = Window.partitionBy("file").orderBy("start").rowsBetween(Window.unboundedPreceding, -1)  # the ranges of one file
    sums = parsed.groupBy("file", "start").agg(F.sum("extent").alias("bytes"))
    sums = sums.select("file", "start", F.coalesce(F.sum("bytes").over(before), F.lit(0)).alias("before"))
    return parsed.join(sums, ["file", "start"]).select(*[F.col("offset") + F.col("before") if f.name == "offset" else F.col(f.name) for f in ARROW]).toDF(*ARROW.names)


def merge_runs(runs: list[list], key) -> Iterator:
    """Merge sorted runs by a loser tree.

    Inner nodes hold the run that lost there, so the next winner needs one comparison on each level from its leaf to the
    root. An exhausted run loses against all; equal keys come from the earlier run first.
    """
    k = len(runs)
    if k == 0:
        return
    at = [0] * k
    end = (1,)
    keys = [(0, key(run[0]), i) if run else end for i, run in enumerate(runs)]
    losers = [-1] * k
    winner = -1
    for leaf in range(k):  # play the leaves in one by one; a free node waits for its second player
        player, node = leaf, (leaf + k) // 2
        while node > 0 and losers[node] >= 0:
            if keys[losers[node]] < keys[player]:
                losers[node], player = player, losers[node]
            node //= 2
        if node > 0:
            losers[node] = player
        else:
            winner = player
    while keys[winner] is not end:
        run = runs[winner]
        yield run[at[winner]]
        at[winner] += 1
        keys[winner] = (0, key(run[at[winner]]), winner) if at[winner] < len(run) else end
        player, node = winner, (winner + k) // 2
        while node > 0:
            if keys[losers[node]] < keys[player]:
                losers[node], player = player, losers[node]
            node //= 2
        winner = player


def merged_index(captures: DataFrame, range_rows: int = 50_000) -> DataFrame:
    """``captures`` in global order of url key, time and page_id, as capture histories.

    Ranges of the whole key of about ``range_rows`` rows are dealt to the partitions, so a url with very many captures spreads
    over several, and no task holds more than its range. Each gets a slice of every run and merges the slices by a loser
    tree; runs were sorted where they were read, and a slice is sorted again only if the shuffle did not keep its order.
    """
    parts = max(1, -(-captures.count() // range_rows))
    ranged = captures.repartitionByRange(parts, *[F.col(name).asc_nulls_first() for name in ORDER])

    def run(batches):
        runs: dict[str, list[tuple]] = {}
        for batch in batches:
            for row in zip(*[column.to_pylist() for column in batch.columns]):
                runs.setdefault(row[0], []).append(row)
        for run in runs.values():
            if any(_sort_key(a) > _sort_key(b) for a, b in pairwise(run)):
                run.sort(key=_sort_key)
        block = []
        for capture in merge_runs([runs[name] for name in sorted(runs)], _sort_key):
            block.append(capture)
            if len(block) == 4096:
                yield _columns(block, ARROW)
                block = []
        if block:
            yield _columns(block, ARROW)

    return ranged.mapInArrow(run, CAPTURES)


def archive_and_index(pages: DataFrame, folder: str | None = None, least_bytes: int = 0, per_file: int = 4000) -> DataFrame:
    """Write ``pages`` as archives into ``folder`` (default: a new one in the shared folder), read them back, merge the index."""
    spark = pages.sparkSession
    folder = folder or f"{ensure_checkpoint_dir(spark)}/warc-{uuid.uuid4().hex}"
    write_archives(records(pages, least_bytes), folder, per_file)
    return merged_index(stored(read_archives(spark, folder)))
