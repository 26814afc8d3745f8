"""WARC archives and their capture index.

Each task writes its records into archives and leaves the archive's index lines as a run sorted by URL key and
timestamp. The runs are dealt by key ranges and each range merges its slices of the runs with a loser tree, so that the
index as a whole is ordered and every URL's captures stand together.
"""

from __future__ import annotations

import base64
import datetime
import hashlib
import uuid
import zlib
from collections.abc import Callable, Iterator
from typing import Any

import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from kindred.llm.common import fresh_path, stored  # noqa: F401  callers store their own runs

#: An archive is closed once it has so many bytes; a reader takes it from start to end.
ROLL = 48 << 20
#: Bytes that are inflated at once (what follows a member in its last slice is copied), and that a reader's stream holds.
SLICE, AHEAD = 1 << 14, 1 << 20
#: Records, and bytes of their payloads, after which a reader hands on what it has.
HELD_ROWS, HELD_BYTES = 4096, 4 << 20
#: Index lines that one range merges, and lines that are drawn from a piece at once.
RANGE_ROWS, STEP = 100_000, 256
EPOCH = datetime.datetime(2024, 1, 1, tzinfo=datetime.timezone.utc)
PROFILE = "http://netpreserve.org/warc/1.1/revisit/identical-payload-digest"
INDEX = "urlkey string, timestamp string, page_id long, archive string, start long, bytes long, run string"
RECORDS = "page_id long, url string, payload_bytes long, payload_digest string, record_type string, refers_to long, archive string, start long, html string"


def url_key(url: str | None) -> str:
    """com,example,www)/path?query: the key that keeps a domain's captures together."""
    rest = (url or "").partition("://")[2]
    cut = min([i for c in "/?#" if (i := rest.find(c)) >= 0], default=len(rest))
    host = rest[:cut].lower().rpartition("@")[2]
    return ",".join(reversed(host.split("."))) + ")" + (rest[cut:].partition("#")[0] or "/")


def sha1_base32(payload: bytes) -> str:
    return base64.b32encode(hashlib.sha1(payload).digest()).decode()


def _urn(name: str) -> str:
    return f"<urn:uuid:{uuid.uuid5(uuid.NAMESPACE_URL, name)}>"


def record(page_id: int | None, url: str | None, date: str, payload: bytes, refers_to: int | None, place: str = "") -> bytes:
    """One record as its own gzip member. A revisit has the response's headers without its payload.

    A page without an id gets its record id from `place`, where it is written.
    """
    uri = "".join(c if " " < c < "\x7f" else "".join(f"%{b:02X}" for b in c.encode()) for c in url or "")
    block = f"HTTP/1.1 200 OK\r\nContent-Type: text/html; charset=utf-8\r\nContent-Length: {len(payload)}\r\n\r\n".encode()
    kind = "response" if refers_to is None else "revisit"
    if refers_to is None:
        block += payload
    head = [
        "WARC/1.1", f"WARC-Type: {kind}", f"WARC-Record-ID: {_urn(f'page/{page_id}' if page_id is not None else f'place/{place}')}", f"WARC-Date: {date}", f"WARC-Target-URI: {uri}",
        f"WARC-Payload-Digest: sha1:{sha1_base32(payload)}",
    ]
    if page_id is not None:
        head.append(f"X-Page-ID: {page_id}")
    if refers_to is not None:
        head += [f"WARC-Refers-To: {_urn(f'page/{refers_to}')}", f"WARC-Profile: {PROFILE}", f"X-Refers-To-Page-ID: {refers_to}"]
    head += ["Content-Type: application/http;msgtype=response", f"Content-Length: {len(block)}"]
    raw = "\r\n".join(head).encode() + b"\r\n\r\n" + block + b"\r\n\r\n"
    deflate = zlib.compressobj(6, zlib.DEFLATED, 31)
    return deflate.compress(raw) + deflate.flush()


def members(file: Any) -> Iterator[tuple[int, bytes]]:
    """(start, record) of each gzip member of an open file, of which only a slice and a record are held."""
    start, data = 0, file.read(SLICE)
    while data:
        inflate, out, at = zlib.decompressobj(31), [], start
        while data and not inflate.eof:
            out.append(inflate.decompress(data))
            at += len(data) - len(inflate.unused_data)
            data = inflate.unused_data or file.read(SLICE)
        yield start, b"".join(out)
        start = at


def parse(raw: bytes) -> dict[str, Any]:
    """A record's fields; raises ValueError if its length or digest is wrong."""
    head, _, body = raw.partition(b"\r\n\r\n")
    lines = head.decode().split("\r\n")
    fields = {k.lower(): v for k, _, v in (line.partition(": ") for line in lines[1:])}
    block = body[: int(fields["content-length"])]
    if body[len(block) :] != b"\r\n\r\n" or len(block) != int(fields["content-length"]):
        raise ValueError(f"bad record length in {fields.get('warc-record-id')}")
    http, _, payload = block.partition(b"\r\n\r\n")
    size = int(dict(x.split(": ", 1) for x in http.decode().split("\r\n")[1:])["Content-Length"])
    digest = fields["warc-payload-digest"].removeprefix("sha1:")
    if fields["warc-type"] == "response" and (len(payload) != size or sha1_base32(payload) != digest):
        raise ValueError(f"bad payload in {fields['warc-record-id']}")
    refers, page_id = fields.get("x-refers-to-page-id"), fields.get("x-page-id")
    return {"page_id": None if page_id is None else int(page_id), "url": fields["warc-target-uri"], "payload_bytes": size, "payload_digest": digest, "record_type": fields["warc-type"], "refers_to": None if refers is None else int(refers), "payload": payload}


def with_first_copies(pages: DataFrame, least: int = 0) -> DataFrame:
    """Adds first_id: the smallest page_id with an equal payload of at least `least` bytes, null if this is the one.

    Only ids and digests are grouped; the payloads move once, dealt by page_id and digest.
    """
    sha = lambda: F.sha1(F.coalesce("html", F.lit("")).cast("binary")).alias("sha")
    slim = pages.select("page_id", sha(), F.octet_length(F.coalesce("html", F.lit(""))).alias("size"))
    firsts = slim.filter((F.col("size") >= least) & F.col("page_id").isNotNull()).groupBy("sha", "size").agg(F.min("page_id").alias("first_id"))
    copies = slim.groupBy("sha", "size").agg(F.count(F.lit(1)).alias("copies")).filter("copies > 1").drop("copies")
    known = slim.join(copies, ["sha", "size"], "left_semi").join(firsts, ["sha", "size"])
    # A null id comes after all others, so that it revisits a page that has one.
    revisits = known.filter(F.col("page_id").isNull() | (F.col("page_id") > F.col("first_id"))).select(F.coalesce("page_id", F.lit(-1)).alias("key"), F.col("page_id").isNull().alias("lost"), "sha", "first_id").distinct()
    own = pages.withColumns({"sha": sha(), "key": F.coalesce("page_id", F.lit(-1)), "lost": F.col("page_id").isNull()})
    return own.join(revisits, ["key", "lost", "sha"], "left").drop("sha", "key", "lost")


def _schema(fields: str) -> pa.Schema:
    kinds = {"string": pa.string(), "long": pa.int64(), "int": pa.int32()}
    return pa.schema([(name, kinds[kind]) for name, kind in (x.split() for x in fields.split(", "))])


def _batch(rows: list[tuple], schema: pa.Schema) -> pa.RecordBatch:
    columns = zip(*rows, strict=True) if rows else [()] * len(schema)
    return pa.RecordBatch.from_arrays([pa.array(c, f.type) for c, f in zip(columns, schema, strict=True)], schema=schema)


def kept(df: DataFrame, work: Callable, fields: str, name: str) -> DataFrame | None:
    """df.mapInArrow(work, fields) as a table in the shared folder, written by the workers themselves; None without rows.

    Spark's writer makes a folder and sets rights for every task. On a disk without Hadoop's native library each of these
    is a process that the executor starts, thousands for some hundred small partitions. `work` must give the same rows for
    the same partition: a task that runs again writes the same file over the first one, under a temporary name (that
    Spark passes over) until it is whole.
    """
    path, schema = fresh_path(df.sparkSession, name), _schema(fields)

    def write(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        from pyarrow import fs, parquet

        store, root = fs.FileSystem.from_uri(path)
        context = TaskContext.get()
        part, file, rows = f"part-{context.partitionId():06d}.parquet", None, 0
        for batch in work(batches):
            if file is None and len(batch):
                store.create_dir(root, recursive=True)
                file = parquet.ParquetWriter(f"{root}/_{part}.{context.taskAttemptId()}", schema, compression="zstd", filesystem=store)
            if len(batch):
                file.write_batch(batch)
                rows += len(batch)
        if file is not None:
            file.close()
            store.move(f"{root}/_{part}.{context.taskAttemptId()}", f"{root}/{part}")
        yield pa.RecordBatch.from_pydict({"n_rows": pa.array([rows], pa.int64())})

    written = df.mapInArrow(write, "n_rows long").agg(F.sum("n_rows")).first()[0]
    return df.sparkSession.read.schema(fields).parquet(path) if written else None


def _sorted_pages(pages: DataFrame) -> DataFrame:
    rows = pages.select(F.col("page_id").cast("long").alias("page_id"), "url", "html", F.col("first_id").cast("long").alias("first_id"))
    return rows.sortWithinPartitions("page_id", "url", "html")


def write_archives(pages: DataFrame, folder: str, roll: int = ROLL) -> DataFrame:
    """Writes rows of page_id, url, html, first_id and returns the index runs."""
    return _sorted_pages(pages).mapInArrow(_writer(folder, roll), INDEX)


def _writer(folder: str, roll: int = ROLL) -> Callable:
    """Writes a task's rows into archives and gives each archive's index lines.

    File names and contents depend on the partition's rows alone: a task that runs again writes the same archives over
    the first ones, under a temporary name until each is whole. A null page_id has the date of page 0.
    """
    schema = _schema(INDEX)

    def write(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        from pyarrow import fs

        store, root = fs.FileSystem.from_uri(folder)
        store.create_dir(root, recursive=True)
        context = TaskContext.get()
        number, file, lines, at, name = 0, None, [], 0, ""
        attempt = f"{context.taskAttemptId()}"

        def close() -> pa.RecordBatch:
            file.close()
            store.move(f"{root}/{name}.{attempt}.open", f"{root}/{name}")
            return _batch(sorted(lines, key=_order), schema)

        for batch in batches:
            for i in range(len(batch)):  # a row at a time: html is held once
                page_id, url, html, first = (batch.column(c)[i].as_py() for c in range(4))
                if file is None:
                    name = f"part-{context.partitionId():06d}-{number:05d}.warc.gz"
                    file, lines, at, number = store.open_output_stream(f"{root}/{name}.{attempt}.open", compression=None), [], 0, number + 1
                date = (EPOCH + datetime.timedelta(seconds=(page_id or 0) % 10**9)).strftime("%Y-%m-%dT%H:%M:%SZ")
                data = record(page_id, url, date, (html or "").encode(), first, f"{name}/{at}")
                file.write(data)
                lines.append((url_key(url), date, page_id, name, at, len(data), name))
                at += len(data)
                if at >= roll:
                    yield close()
                    file = None
        if file is not None:
            yield close()

    return write


def parsed(file: Any, name: str, texts: bool = True) -> Iterator[pa.RecordBatch]:
    """The records of an open archive in batches of at most HELD_ROWS rows and about HELD_BYTES of payload."""
    schema, rows, held = _schema(RECORDS), [], 0
    for start, raw in members(file):
        x = parse(raw)
        payload = x.pop("payload")
        html = payload.decode() if texts and x["record_type"] == "response" else None
        rows.append((*(x[k] for k in ("page_id", "url", "payload_bytes", "payload_digest", "record_type", "refers_to")), name, start, html))
        held += len(payload) if texts else 0
        if held > HELD_BYTES or len(rows) == HELD_ROWS:
            yield _batch(rows, schema)
            rows, held = [], 0
    if rows:
        yield _batch(rows, schema)


def read_archives(spark: SparkSession, folder: str, texts: bool = True) -> DataFrame:
    """A row per record, its length and digest checked. Without `texts`, html is null and payloads stay in the workers.

    Spark deals the archives' paths, and the workers read them as streams: no task holds an archive.
    """

    def read(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        from pyarrow import fs

        store, root = fs.FileSystem.from_uri(folder)
        for batch in batches:
            for path in batch.column(0).to_pylist():
                name = path.rpartition("/")[2]
                with store.open_input_stream(f"{root}/{name}", compression=None, buffer_size=AHEAD) as file:
                    yield from parsed(file, name, texts)

    return spark.read.format("binaryFile").option("pathGlobFilter", "*.warc.gz").load(folder).select("path").mapInArrow(read, RECORDS)


def _order(line: tuple) -> tuple:
    """The order of index lines: urlkey, timestamp, page_id (null last), archive, start."""
    return line[0], line[1], line[2] is None, line[2] or 0, line[3], line[4]


class LoserTree:
    """Merges sorted iterators: each step replays one path of the tree, comparing the new head with stored losers."""

    def __init__(self, runs: list[Iterator]) -> None:
        self.runs = runs
        self.k = max(1, len(runs))
        self.heads = [next(r, None) for r in runs] or [None]
        self.tree = [-1] * self.k
        for i in range(self.k):
            self._replay(i)

    def _before(self, a: int, b: int) -> bool:
        """Whether run a's head comes first; ended runs come last, and equal heads in the order of their runs."""
        x, y = self.heads[a], self.heads[b]
        if x is None or y is None:
            return y is None and (x is not None or a < b)
        return (x, a) < (y, b)

    def _replay(self, winner: int) -> None:
        node = (winner + self.k) // 2
        while node > 0:
            other = self.tree[node]
            if other < 0:  # while the tree is built: the first to come here waits for its opponent
                self.tree[node] = winner
                return
            if self._before(other, winner):
                self.tree[node], winner = winner, other
            node //= 2
        self.tree[0] = winner

    def __iter__(self) -> Iterator:
        while (head := self.heads[self.tree[0]]) is not None:
            yield head
            winner = self.tree[0]
            self.heads[winner] = next(self.runs[winner], None)
            self._replay(winner)


def _ascending(table: pa.Table) -> list[tuple[int, int]]:
    """(start, end) of the pieces of table that are in order: blocks of several runs arrive one after the other."""
    cuts, before = [0], None
    for at in range(0, len(table), STEP):
        for i, line in enumerate(_lines(table, at, at + STEP), at):
            if before is not None and line[0] < before:
                cuts.append(i)
            before = line[0]
    return list(zip(cuts, [*cuts[1:], len(table)], strict=True))


def _lines(table: pa.Table, start: int, end: int) -> Iterator[tuple]:
    """(order, index line) of rows, read STEP at a time."""
    for at in range(start, min(end, len(table)), STEP):
        part = table.slice(at, min(STEP, end - at))
        for row in zip(*(c.to_pylist() for c in part.columns), strict=True):
            yield _order(row), row


def merge_runs(runs: DataFrame, range_rows: int = RANGE_ROWS) -> DataFrame:
    """The index lines with `position`, their gapless place (from 0) in the order of urlkey, timestamp and page_id.

    Lines are dealt by ranges of the whole key, as many as the number of lines asks for, so a task's share is bounded and
    one URL with very many captures is split too. A range keeps its share as Arrow columns, and the loser tree draws
    lines from its sorted pieces a few at a time. Runs must be a stored table. An empty index stays empty.
    """
    names = [x.split()[0] for x in INDEX.split(", ")]
    fields = f"{INDEX}, range int, place long"
    schema = _schema(fields)

    def merge(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held = list(batches)
        if not held:
            return
        table = pa.Table.from_batches(held)
        merged = LoserTree([_lines(table, a, b) for a, b in _ascending(table)])
        part, out, place = TaskContext.get().partitionId(), [], 0
        for _, row in merged:
            out.append((*row, part, place))
            place += 1
            if len(out) == 10_000:
                yield _batch(out, schema)
                out = []
        yield _batch(out, schema)

    ranges = max(1, -(-runs.count() // range_rows))
    keys = ["urlkey", "timestamp", F.asc_nulls_last("page_id"), "archive", "start"]
    merged = kept(runs.select(*names).repartitionByRange(ranges, *keys), merge, fields, "index")
    if merged is None:
        return runs.select(*names, F.lit(0).cast("long").alias("position"))
    before = Window.orderBy("range").rowsBetween(Window.unboundedPreceding, -1)  # a row for each range
    starts = merged.groupBy("range").agg(F.count(F.lit(1)).alias("n")).select("range", F.coalesce(F.sum("n").over(before), F.lit(0)).alias("first"))
    return merged.join(starts, "range").select(*names, (F.col("first") + F.col("place")).alias("position"))


def archive(pages: DataFrame, folder: str | None = None, least: int = 0, texts: bool = True) -> tuple[DataFrame, DataFrame]:
    """(records read back, merged index) of archives written for pages (page_id, url, html); html is null without `texts`.

    A null html is an empty payload, a null url an empty URI. A row with a null page_id has a record too: it revisits a
    page with an equal payload if one has an id, and is a response otherwise. Rows that repeat a page_id with its
    smallest-id payload are responses each. Other columns are ignored.
    """
    spark = pages.sparkSession
    folder = folder or fresh_path(spark, "warc")
    runs = kept(_sorted_pages(with_first_copies(pages.select("page_id", "url", "html"), least)), _writer(folder), INDEX, "runs")
    if runs is None:
        return spark.createDataFrame([], RECORDS), spark.createDataFrame([], f"{INDEX}, position long")
    return read_archives(spark, folder, texts), merge_runs(runs)


def op4_warc_index(spark: SparkSession, sf_dir: str) -> DataFrame:
    records, index = archive(spark.read.parquet(f"{sf_dir}/pages.parquet").select("page_id", "url", "html"), texts=False)
    found = records.select("page_id", "payload_bytes", "payload_digest", "record_type", "refers_to", "archive", "start")
    return found.join(index.select("archive", "start", "urlkey", "timestamp", "position"), ["archive", "start"]).select("page_id", "payload_bytes", "payload_digest", "record_type", "refers_to", "urlkey", "timestamp", "position")


OP4_SQL = """
WITH own AS (
  SELECT row_number() OVER () AS row, page_id, url, coalesce(html, '') AS payload, sha1(coalesce(html, '')) AS sha,
         strlen(coalesce(html, '')) AS payload_bytes
  FROM pages
), firsts AS (
  SELECT sha, payload_bytes, min(page_id) AS first_id FROM own GROUP BY ALL
), parsed AS (
  SELECT o.*, first_id,
         CASE WHEN page_id IS NULL OR page_id > first_id THEN first_id END AS refers_to,
         CASE WHEN position('://' IN url) > 0 THEN substr(url, position('://' IN url) + 3) ELSE '' END AS rest,
         strftime(TIMESTAMP '2024-01-01' + to_seconds(coalesce(page_id, 0) % 1000000000), '%Y-%m-%dT%H:%M:%SZ') AS timestamp
  FROM own o JOIN firsts USING (sha, payload_bytes)
), split AS (
  SELECT *, lower(regexp_replace(regexp_extract(rest, '^([^/?#]*)', 1), '^.*@', '')) AS host, regexp_extract(rest, '^[^/?#]*([^#]*)', 1) AS tail FROM parsed
), keyed AS (
  SELECT *, array_to_string(list_reverse(string_split(host, '.')), ',') || ')' || CASE WHEN tail = '' THEN '/' ELSE tail END AS urlkey FROM split
)
SELECT page_id, payload_bytes,
       array_to_string(list_transform(range(32), lambda i: substr('ABCDEFGHIJKLMNOPQRSTUVWXYZ234567',
         1 + ((('0x' || substr(sha, 1 + 10 * (i // 8), 10))::BIGINT >> (35 - 5 * (i % 8))) & 31)::INTEGER, 1)), '') AS payload_digest,
       CASE WHEN refers_to IS NULL THEN 'response' ELSE 'revisit' END AS record_type, refers_to, urlkey, timestamp,
       row_number() OVER (ORDER BY urlkey, timestamp, page_id NULLS LAST, row) - 1 AS position
FROM keyed
"""
