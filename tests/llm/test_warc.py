import gzip
import io
import os
import random

import pyarrow as pa
import pytest
from helpers import connection, have_data, same

from kindred.llm import warc


def pages(spark, rows):
    return spark.createDataFrame(rows, "page_id long, url string, html string")


def brute(rows, least=0):
    first = {}
    for p, _, h in sorted(rows, key=lambda r: (r[0] is None, r[0] or 0)):
        first.setdefault(h or "", p)
    out = []
    for p, _, h in rows:
        data = (h or "").encode()
        original = first[h or ""] if len(data) >= least else p
        out.append((p, len(data), warc.sha1_base32(data), "response" if original == p else "revisit", None if original == p else original))
    return sorted(out, key=str)


@pytest.mark.parametrize("least", [0, 3])
def test_round_trip_and_order(spark, tmp_path, least):
    r = random.Random(1)
    rows = [(i, f"http://h{r.randrange(4)}.example.com/p{r.randrange(3)}?x#y", r.choice(["<p>ä</p>", "", None, "ab", f"<b>{i}</b>" * 50])) for i in range(200)]
    records, index = warc.archive(pages(spark, rows).repartition(5), f"file://{tmp_path}/w", least)
    got = sorted(((x["page_id"], x["payload_bytes"], x["payload_digest"], x["record_type"], x["refers_to"]) for x in records.collect()), key=str)
    assert got == brute(rows, least)
    html = {x["page_id"]: x["html"] for x in records.collect() if x["record_type"] == "response"}
    assert all(html[p] == (h or "") for p, _, h in rows if p in html)
    lines = index.orderBy("position").collect()
    assert [x["position"] for x in lines] == list(range(200))
    keys = [(x["urlkey"], x["timestamp"], x["page_id"]) for x in lines]
    assert keys == sorted(keys)
    for x in lines[:20]:  # the index leads to the record
        with open(f"{tmp_path}/w/{x['archive']}", "rb") as f:
            f.seek(x["start"])
            assert warc.parse(gzip.decompress(f.read(x["bytes"])))["page_id"] == x["page_id"]


def test_archives_roll(spark, tmp_path):
    rows = [(i, "http://a/b", "x" * 1000 + str(i)) for i in range(20)]
    runs = warc.stored(warc.write_archives(warc.with_first_copies(pages(spark, rows)).coalesce(1), f"file://{tmp_path}/w", roll=200), "runs")
    assert runs.select("archive").distinct().count() > 5
    assert warc.read_archives(spark, f"file://{tmp_path}/w").count() == 20


def test_loser_tree():
    r = random.Random(3)
    for k in range(9):
        runs = [sorted(r.randrange(20) for _ in range(r.randrange(8))) for _ in range(k)]
        assert list(warc.LoserTree([iter(x) for x in runs])) == sorted(sum(runs, []))


def test_url_keys():
    assert warc.url_key("https://User@WWW.Example.com:80/A?b=1#c") == "com:80,example,www)/A?b=1"
    assert warc.url_key(None) == ")/" and warc.url_key("http://a.b") == "b,a)/"


@pytest.mark.parametrize("range_rows", [7, 40, 100_000])
def test_ranges_are_merged_from_any_pieces(spark, range_rows):
    r = random.Random(2)
    lines = [(f"k{r.randrange(6)}", f"2024-{r.randrange(10, 13)}", r.choice([None, r.randrange(9)]), f"a{i % 5}", i, 1, f"a{i % 5}") for i in range(300)]
    runs = warc.stored(spark.createDataFrame(sorted(lines, key=lambda x: (x[6], *warc._order(x))), warc.INDEX).repartition(4), "runs")
    got = [tuple(x)[:7] for x in warc.merge_runs(runs, range_rows).orderBy("position").collect()]
    assert got == sorted(lines, key=warc._order)


class Counted(io.BytesIO):
    """A file that knows how much of it has been read and refuses to be read at once."""

    def read(self, size=-1):
        assert 0 <= size <= warc.AHEAD
        return super().read(size)


def test_archives_are_read_as_streams():
    texts = [random.Random(i).randbytes(40_000).hex() if i % 3 == 0 else "ä" * i for i in range(40)]
    date = "2024-01-01T00:00:00Z"
    written = [warc.record(i, f"http://a/{i}", date, t.encode(), None) for i, t in enumerate(texts)]
    starts = [sum(map(len, written[:i])) for i in range(40)]
    file, got = Counted(b"".join(written)), []
    for start, raw in warc.members(file):
        assert file.tell() <= start + len(written[len(got)]) + warc.SLICE  # nothing beyond the slice that the record ends in
        got.append((start, warc.parse(raw)["payload"].decode()))
    assert got == list(zip(starts, texts, strict=True))
    assert list(warc.members(Counted(b""))) == []


def test_a_reader_holds_few_records(monkeypatch):
    monkeypatch.setattr(warc, "HELD_ROWS", 8)
    monkeypatch.setattr(warc, "HELD_BYTES", 1000)
    date = "2024-01-01T00:00:00Z"
    revisits = b"".join(warc.record(i, "http://a/", date, b"x" * 600, 0) for i in range(1, 31))  # they bring no payload
    responses = b"".join(warc.record(i, "http://a/", date, b"x" * 600, None) for i in range(10))
    assert [len(b) for b in warc.parsed(Counted(revisits), "a")] == [8, 8, 8, 6]
    assert [len(b) for b in warc.parsed(Counted(responses), "a")] == [2] * 5
    slim = list(warc.parsed(Counted(responses), "a", texts=False))
    assert [len(b) for b in slim] == [8, 2] and all(b.column("html").null_count == len(b) for b in slim)


def test_archives_do_not_pass_through_rows(spark, tmp_path):
    rows = [(i, f"http://a/{i}", ["x", "<p>ä</p>" * i, None][i % 3]) for i in range(30)]
    records, _ = warc.archive(pages(spark, rows), f"file://{tmp_path}/w")
    assert "content" not in records._jdf.queryExecution().executedPlan().toString()
    slim = warc.read_archives(spark, f"file://{tmp_path}/w", texts=False)
    assert sorted(records.drop("html").collect()) == sorted(slim.drop("html").collect())
    assert slim.filter("html IS NOT NULL").isEmpty() and records.filter("html IS NULL").count() == sum(brute(rows)[i][3] == "revisit" for i in range(30))


def test_kept_tables_are_written_by_workers(spark):
    def work(batches):
        for b in batches:
            odd = [i for i in b.column(0).to_pylist() if i % 2 and i < 75]
            yield pa.record_batch({"name": pa.array([str(i) if i % 3 else None for i in odd], pa.string()), "n": pa.array(odd, pa.int64())})

    got = warc.kept(spark.range(0, 100, 1, 4), work, "name string, n long", "t")
    want = [(str(i) if i % 3 else None, i) for i in range(1, 75, 2)]
    assert [tuple(r) for r in got.orderBy("n").collect()] == want
    folder = os.path.dirname(got.inputFiles()[0].removeprefix("file:").replace("//", "/"))
    assert sorted(os.listdir(folder)) == [f"part-{i:06d}.parquet" for i in range(3)]  # the fourth task has no rows; Spark's writer leaves more
    with open(f"{folder}/_part-000003.parquet.7", "wb") as f:
        f.write(b"what a task that failed has left")
    assert [tuple(r) for r in spark.read.parquet(f"file://{folder}").orderBy("n").collect()] == want
    assert warc.kept(spark.range(0), work, "name string, n long", "t") is None


def test_a_task_that_fails_half_way_leaves_nothing_to_read(spark):
    def work(batches):
        for b in batches:
            yield pa.record_batch({"n": b.column(0)})
            if b.column(0)[0].as_py() >= 50:
                raise OSError("no room")

    root = warc.fresh_path(spark, "x").rpartition("/")[0].removeprefix("file://")
    before = set(os.listdir(root)) if os.path.isdir(root) else set()
    with pytest.raises(Exception, match="no room"):
        warc.kept(spark.range(0, 100, 1, 2), work, "n long", "half")
    (name,) = set(os.listdir(root)) - before
    assert not [f for f in os.listdir(f"{root}/{name}") if f.startswith("part-000001")]


def test_damage_is_noticed():
    raw = gzip.decompress(warc.record(1, "http://a/", "2024-01-01T00:00:00Z", b"hello", None))
    with pytest.raises(ValueError):
        warc.parse(raw.replace(b"hello", b"jello"))


def test_edges(spark, tmp_path):
    records, index = warc.archive(pages(spark, []), f"file://{tmp_path}/e")
    assert records.count() == 0 and index.count() == 0
    big = 2**53 + 1
    rows = [(1, None, None, "x"), (1, None, None, "x"), (None, "u", "h", "x"), (None, "u", "h", "x"), (None, "u", "", "x"), (big, "a\r\nb", "é" * 100_000, "x"), (big + 2, "b", "é" * 100_000, "x")]
    df = spark.createDataFrame(rows, "page_id long, url string, html string, archive string")
    records, index = warc.archive(df, f"file://{tmp_path}/f")
    got = sorted(((r["page_id"], r["payload_bytes"], r["record_type"], r["refers_to"]) for r in records.collect()), key=str)
    want = [(1, 0, "response", None)] * 2 + [(None, 1, "response", None)] * 2 + [(None, 0, "revisit", 1), (big, 200_000, "response", None), (big + 2, 200_000, "revisit", big)]
    assert got == sorted(want, key=str) and index.count() == 7


@pytest.mark.skipif(not have_data(), reason="no test tables")
def test_query(spark, sf):
    same(warc.op4_warc_index(spark, sf), connection(sf), warc.OP4_SQL)
