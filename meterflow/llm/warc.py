"""WARC archives with an external merge of their capture indexes.

1. Equal payloads are found by SHA-1 and length; the smallest page id of each
   is the response, the others become revisit records.
2. Every record is a gzip member of its own.  Spark's text writer lays the
   members into archive files, so any shared file system and Spark's commit
   protocol serve; the line separator is an empty gzip member, which leaves
   the files valid for every reader of compressed archives.
3. The archives are read back, split at the same separator, and parsed.
4. Each reading task sorts its captures by (URL key, time): a run.  The key
   space is cut into ranges, and each range merges its slices of all runs
   with a loser tree, which gives globally ordered capture histories.
"""

from __future__ import annotations

import base64
import datetime as dt
import gzip
import hashlib
import uuid
import zlib
from urllib.parse import quote, urlsplit

import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from meterflow.llm.components import settle
from meterflow.session import scratch_path

#: An empty gzip member.
SEPARATOR = gzip.compress(b"", mtime=0)
#: Capture time of page 0; the pages carry none, so page n is taken n seconds later.
START = dt.datetime(2024, 1, 1)
#: Captures in a range of the merge, on average (some hundred bytes each).
RANGE_ROWS = 200_000
REVISIT = "http://netpreserve.org/warc/1.1/revisit/identical-payload-digest"

CAPTURE = ("page_id long, url string, payload_bytes long, payload_digest string, record_type string, refers_to long, "
           "url_key string, captured_at string, archive string, offset long, size long")


def payload_digest(payload: bytes) -> str:
    return base64.b32encode(hashlib.sha1(payload).digest()).decode()


def record_id(page_id: int) -> str:
    return f"<urn:uuid:{uuid.uuid5(uuid.NAMESPACE_URL, f'page:{page_id}')}>"


def url_key(url: str | None) -> str:
    """Sort-friendly key: host labels reversed, then path and query, in lower case."""
    try:
        u = urlsplit(url or "")
        host = ",".join(reversed((u.hostname or "").removeprefix("www.").split(".")))
    except ValueError:
        return (url or "").lower()
    return f"{host}){u.path or '/'}{'?' + u.query if u.query else ''}".lower()


def warc_record(page_id: int | None, url: str | None, payload: bytes, refers_to: int | None, offset: int) -> bytes:
    """One WARC/1.1 record; a revisit carries the HTTP header alone."""
    kind = "response" if refers_to is None else "revisit"
    http = f"HTTP/1.1 200 OK\r\nContent-Type: text/html; charset=utf-8\r\nContent-Length: {len(payload)}\r\n\r\n".encode()
    block = http + payload if refers_to is None else http
    when = START + dt.timedelta(seconds=(page_id or 0) % 2**31)
    head = [("WARC-Type", kind), ("WARC-Record-ID", record_id(page_id) if page_id is not None else f"<urn:uuid:{uuid.uuid5(uuid.NAMESPACE_URL, hashlib.sha1(payload).hexdigest())}>"),
            ("WARC-Date", f"{when:%Y-%m-%dT%H:%M:%SZ}"), ("WARC-Payload-Digest", f"sha1:{payload_digest(payload)}"),
            ("Content-Type", "application/http; msgtype=response"), ("Content-Length", len(block)), ("X-Archive-Offset", offset)]
    if url is not None:
        head.append(("WARC-Target-URI", quote(url, safe="!#$%&'()*+,/:;=?@[]~-._")))
    if page_id is not None:
        head.append(("X-Page-ID", page_id))
    if refers_to is not None:
        head += [("WARC-Profile", REVISIT), ("WARC-Refers-To", record_id(refers_to)), ("X-Refers-To-Page-ID", refers_to)]
    return b"WARC/1.1\r\n" + "".join(f"{k}: {v}\r\n" for k, v in head).encode() + b"\r\n" + block + b"\r\n\r\n"


def parse_record(raw: bytes) -> tuple[dict[str, str], dict[str, str], bytes]:
    """Record header, HTTP header and payload."""
    head, _, rest = raw.partition(b"\r\n\r\n")
    fields = dict(x.split(": ", 1) for x in head.decode().split("\r\n")[1:])
    block = rest[: int(fields["Content-Length"])]
    http, _, payload = block.partition(b"\r\n\r\n")
    return fields, dict(x.split(": ", 1) for x in http.decode().split("\r\n")[1:]), payload


def _members(batches):
    offset = 0
    for b in batches:
        out = []
        for page, url, html, first in zip(*(b.column(c).to_pylist() for c in ("page_id", "url", "html", "first"))):
            m = gzip.compress(warc_record(page, url, html or b"", first, offset), 4, mtime=0)
            offset += len(m) + len(SEPARATOR)
            out.append(m)
        yield pa.RecordBatch.from_arrays([pa.array(out, pa.binary())], ["member"])


def _parsed(batches):
    for b in batches:
        rows = []
        for m, name in zip(b.column("member").to_pylist(), b.column("archive").to_pylist()):
            if not m:
                continue
            fields, http, payload = parse_record(zlib.decompress(m, 31))
            digest = fields["WARC-Payload-Digest"].removeprefix("sha1:")
            size = int(http["Content-Length"])
            if fields["WARC-Type"] == "response" and (size != len(payload) or digest != payload_digest(payload)):
                raise ValueError(f"{name}: record {fields['WARC-Record-ID']} does not match its digest")
            page, refers, url = fields.get("X-Page-ID"), fields.get("X-Refers-To-Page-ID"), fields.get("WARC-Target-URI")
            rows.append((page and int(page), url, size, digest, fields["WARC-Type"], refers and int(refers), url_key(url),
                         fields["WARC-Date"], name, int(fields["X-Archive-Offset"]), len(m)))
        kinds = [pa.int64(), pa.string(), pa.int64(), pa.string(), pa.string(), pa.int64(), pa.string(), pa.string(), pa.string(), pa.int64(), pa.int64()]
        names = [x.split()[0] for x in CAPTURE.split(", ")]
        cols = list(zip(*rows)) or [[]] * len(kinds)
        yield pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(cols, kinds)], names)


def write_archives(pages: DataFrame, path: str, least_bytes: int = 0) -> None:
    """Write one record per row of ``pages`` (``page_id``, ``url``, ``html``).

    Payloads of at least ``least_bytes`` that equal an earlier page's become
    revisits.  A null html is an empty payload; a null url has no target; a
    row with a null id is always a response and never referred to; rows that
    repeat the smallest id are all responses.
    """
    p = pages.select(F.col("page_id").cast("long").alias("page_id"), F.col("url").cast("string").alias("url"),
                     F.coalesce(F.col("html").cast("string"), F.lit("")).cast("binary").alias("html"))
    p = p.withColumn("sha", F.sha1("html")).withColumn("n", F.octet_length("html"))
    # only payloads that occur twice: a small table of a known size spares the pages a shuffle
    first = p.groupBy("sha", "n").agg(F.min("page_id").alias("lead"), F.count("*").alias("c")).where("c > 1").drop("c")
    typed = p.join(settle(first, "payloads"), ["sha", "n"], "left").select(
        "page_id", "url", "html", F.expr(f"CASE WHEN n >= {int(least_bytes)} AND page_id <> lead THEN lead END").alias("first"))
    (typed.mapInArrow(_members, "member binary").select(F.col("member").cast("string").alias("value"))
     .write.option("maxRecordsPerFile", 0)  # one file for each task, as the offsets say
     .option("encoding", "ISO-8859-1").option("lineSep", SEPARATOR.decode("latin-1")).text(path))


def read_archives(spark, path: str) -> DataFrame:
    """Captures in the archives under ``path``; a response whose payload and digest differ raises."""
    lines = spark.read.option("encoding", "ISO-8859-1").option("lineSep", SEPARATOR.decode("latin-1")).text(path)
    return lines.select(F.col("value").cast("binary").alias("member"), F.col("_metadata.file_name").alias("archive")).mapInArrow(_parsed, CAPTURE)


class LoserTree:
    """Merge of sorted lists: inner nodes hold the losers, so each step replays one path to the root."""

    def __init__(self, runs: list[list]):
        self.runs, self.at, k = runs, [0] * len(runs), len(runs)
        self.tree = [-1] * max(k, 1)
        for i in range(k):
            self._replay(i)

    def _less(self, a: int, b: int) -> bool:
        """Whether run ``a`` comes before run ``b``; ended runs come last, ties go to the lower run."""
        if self.at[a] >= len(self.runs[a]):
            return False
        if self.at[b] >= len(self.runs[b]):
            return True
        x, y = self.runs[a][self.at[a]], self.runs[b][self.at[b]]
        return (x, a) < (y, b)

    def _replay(self, run: int) -> None:
        node = (run + len(self.runs)) // 2
        while node > 0:
            other = self.tree[node]
            if other == -1:  # still building: wait here for the sibling
                self.tree[node] = run
                return
            if self._less(other, run):
                self.tree[node], run = run, other
            node //= 2
        self.tree[0] = run

    def __iter__(self):
        while self.runs:
            run = self.tree[0]
            if self.at[run] >= len(self.runs[run]):
                return
            yield self.runs[run][self.at[run]]
            self.at[run] += 1
            self._replay(run)


def _run_ids(batches):
    for b in batches:
        yield b.append_column("run", pa.array([TaskContext.get().partitionId()] * len(b), pa.int32()))


def _merge_runs(batches):
    """A range of keys: its slices of all runs lie one after the other, each sorted."""
    held = [b for b in batches if len(b)]
    if not held:
        return
    t = pa.Table.from_batches(held).combine_chunks()
    runs: dict[int, list] = {}
    pages = t.column("page_id").to_pylist()
    for i, row in enumerate(zip(t.column("run").to_pylist(), t.column("url_key").to_pylist(), t.column("captured_at").to_pylist(), pages)):
        runs.setdefault(row[0], []).append((row[1], row[2], row[3] is not None, row[3] or 0, i))
    order = [r[-1] for r in LoserTree(list(runs.values()))]
    yield from t.take(pa.array(order, pa.int64())).drop_columns(["run"]).to_batches(10_000)


def merged_index(captures: DataFrame) -> DataFrame:
    """Captures in global order of (``url_key``, ``captured_at``, ``page_id``), nulls first.

    Runs are sorted where the archives were read; ranges of keys, cut by page
    id too so that one URL can't fill a task, are merged side by side.  There
    are as many ranges as keep each at about ``RANGE_ROWS`` captures, so a
    task's memory does not grow with the index.
    """
    key = ["url_key", "captured_at", "page_id"]
    runs = settle(captures.sortWithinPartitions(*key).mapInArrow(_run_ids, f"{CAPTURE}, run int"), "capture-runs")
    parts = max(int(captures.sparkSession.conf.get("spark.sql.shuffle.partitions")), -(-runs.count() // RANGE_ROWS))
    return runs.repartitionByRange(parts, *key).sortWithinPartitions("run", *key).mapInArrow(_merge_runs, CAPTURE)


def op8_warc(spark, sf_dir: str) -> DataFrame:
    path = scratch_path(spark, "warc")
    write_archives(spark.read.parquet(f"{sf_dir}/pages.parquet"), path)
    index = merged_index(read_archives(spark, path))
    return index.select("page_id", "payload_bytes", "payload_digest", "record_type", "refers_to")


# base32 of the hexadecimal SHA-1: five hexadecimal digits are four letters
ORACLE_OP8 = """
WITH p AS (
  SELECT page_id, coalesce(html, '') AS h, sha1(coalesce(html, '')) AS x, min(page_id) OVER (PARTITION BY coalesce(html, '')) AS lead
  FROM pages)
SELECT page_id, strlen(h)::BIGINT AS payload_bytes,
  array_to_string([substr('ABCDEFGHIJKLMNOPQRSTUVWXYZ234567',
    1 + ((('0x' || substr(x, 5 * (i // 4) + 1, 5))::INTEGER >> (15 - 5 * (i % 4))::INTEGER) & 31), 1) FOR i IN range(32)], '') AS payload_digest,
  CASE WHEN page_id = lead THEN 'response' ELSE 'revisit' END AS record_type,
  CASE WHEN page_id <> lead THEN lead END AS refers_to
FROM p
"""
