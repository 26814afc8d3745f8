"""URL filter: sorted digest array.

Rules (host, path, verdict) become one array of sorted 64-bit xxhash keys with their full strings beside it, and their
hosts another. The file is memory-mapped on each executor; the keys of a batch's host suffixes, and then of the path
prefixes under hosts that rules name, are probed with one vectorised binary search each, and a hit counts only if the
stored string equals the probed one.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass
from typing import BinaryIO

import numpy as np
import pandas as pd
import xxhash
from pyspark import SparkFiles
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from kindred.llm.common import column_name, fresh_path

UPPER, LOWER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"
#: Rule files over this size are not sent to executors whole.
FILE_LIMIT = 256 << 20

#: The rules of the query.
RULES = [
    ("com", "/en/", "block"),
    ("example.com", "/en/7", "allow"),
    ("net", "/de/", "allow"),
    ("example.net", "/de/8", "block"),
    ("org", "/es/", "block"),
]


@dataclass(frozen=True)
class Rule:
    host: str
    path: str
    verdict: str

    @property
    def text(self) -> str:
        return self.host + self.path


def host_of(url: Column) -> Column:
    rest = _after_scheme(url)
    return F.coalesce(F.translate(F.regexp_extract(rest, r"^([^/?#]*)", 1), UPPER, LOWER), F.lit(""))


def path_of(url: Column) -> Column:
    return F.coalesce(F.regexp_extract(_after_scheme(url), r"^[^/?#]*([^?#]*)", 1), F.lit(""))


def _after_scheme(url: Column) -> Column:
    at = F.instr(url, "://")
    return F.when(at > 0, F.substr(url, at + 3)).otherwise(F.lit(""))


def digest(text: str) -> int:
    return xxhash.xxh64_intdigest(text.encode("utf-8", "surrogatepass"))


class DigestArray:
    """Two sorted arrays of 64-bit keys in one file, opened with mmap: of the rules, and of the rules' hosts.

    Beside each key stands the end of its string; beside a host's key also which lengths the paths of its rules have.
    """

    @staticmethod
    def write(file: BinaryIO, rules: list[Rule]) -> None:
        """Rules with the same (host, path) count once; block wins over allow."""
        chosen: dict[tuple[str, str], Rule] = {}
        lengths: dict[str, set[int]] = {}
        for r in rules:
            lengths.setdefault(r.host, set()).add(len(r.path))
            if (r.host, r.path) not in chosen or r.verdict == "block":
                chosen[r.host, r.path] = r
        rows = sorted((digest(f"{r.host}\0{r.path}"), f"{r.host}\0{r.path}".encode(), r.verdict) for r in chosen.values())
        hosts = sorted((digest(h), h.encode(), sorted(n)) for h, n in lengths.items())
        ends = lambda xs: np.cumsum([0, *xs]).astype(np.int64).tobytes()
        keys = lambda xs: np.array([x[0] for x in xs], dtype=np.uint64).tobytes()
        file.write(np.array([len(rows), len(hosts), sum(len(x[1]) for x in rows), sum(len(x[1]) for x in hosts), sum(len(x[2]) for x in hosts)], dtype=np.int64).tobytes())
        file.write(keys(rows) + ends(len(x[1]) for x in rows) + keys(hosts) + ends(len(x[1]) for x in hosts) + ends(len(x[2]) for x in hosts))
        file.write(np.array([n for x in hosts for n in x[2]], dtype=np.int64).tobytes())
        file.write(bytes(x[2] == "block" for x in rows) + b"".join(x[1] for x in rows) + b"".join(x[1] for x in hosts))

    def __init__(self, path: str) -> None:
        raw = np.memmap(path, dtype=np.uint8, mode="r")
        n, m, rule_bytes, host_bytes, k = (int(x) for x in raw[:40].view(np.int64))
        at = 40

        def take(count: int, kind: type) -> np.ndarray:
            nonlocal at
            out = raw[at : at + count * np.dtype(kind).itemsize].view(kind)
            at += count * np.dtype(kind).itemsize
            return out

        self.keys, self.ends = take(n, np.uint64), take(n + 1, np.int64)
        self.host_keys, self.host_ends, self.length_ends = take(m, np.uint64), take(m + 1, np.int64), take(m + 1, np.int64)
        self.lengths, self.blocks = take(k, np.int64), take(n, np.uint8)
        self.strings, self.hosts = take(rule_bytes, np.uint8), take(host_bytes, np.uint8)

    @staticmethod
    def probe(texts: list[str], keys: np.ndarray, ends: np.ndarray, strings: np.ndarray) -> np.ndarray:
        """The place of each text in an array, or -1; a key counts only with the stored string."""
        out = np.full(len(texts), -1, dtype=np.int64)
        if not len(keys) or not texts:
            return out
        wanted = np.fromiter(map(digest, texts), dtype=np.uint64, count=len(texts))
        at = np.searchsorted(keys, wanted)
        for i in np.flatnonzero(keys[np.minimum(at, len(keys) - 1)] == wanted):
            text, k = texts[i].encode("utf-8", "surrogatepass"), int(at[i])
            while k < len(keys) and keys[k] == wanted[i]:  # two strings may share a key
                if strings[ends[k] : ends[k + 1]].tobytes() == text:
                    out[i] = k
                    break
                k += 1
        return out

    def judge(self, hosts: list[str], paths: list[str]) -> tuple[list[str | None], list[str | None]]:
        """Per url the longest fitting rule and its verdict; null where none fits.

        The suffixes of the distinct hosts are probed first; paths are cut only for hosts that rules name, and only to
        the lengths that those rules have.
        """
        suffixes: list[str] = []
        of: dict[str, range] = {}
        for host in dict.fromkeys(hosts):
            labels, start = host.split("."), len(suffixes)
            suffixes += [".".join(labels[k:]) for k in range(len(labels))]
            of[host] = range(start, len(suffixes))
        known = self.probe(suffixes, self.host_keys, self.host_ends, self.hosts).tolist()
        named = {host: [i for i in r if known[i] >= 0] for host, r in of.items()}
        texts, owner = [], []
        for i, (host, path) in enumerate(zip(hosts, paths, strict=True)):
            for j in named[host]:
                at = known[j]
                for n in self.lengths[self.length_ends[at] : self.length_ends[at + 1]].tolist():
                    if n > len(path):
                        break
                    texts.append(f"{suffixes[j]}\0{path[:n]}")
                    owner.append(i)
        best: dict[int, tuple[tuple[int, int, str], int]] = {}
        found = self.probe(texts, self.keys, self.ends, self.strings)
        for j in np.flatnonzero(found >= 0):
            host, _, path = texts[j].partition("\0")
            rank = (len(host) + len(path), len(host), host)
            if owner[j] not in best or rank > best[owner[j]][0]:
                best[owner[j]] = rank, int(found[j])
        rules: list[str | None] = [None] * len(hosts)
        verdicts: list[str | None] = [None] * len(hosts)
        for i, (_, k) in best.items():
            rules[i] = self.strings[self.ends[k] : self.ends[k + 1]].tobytes().decode("utf-8", "surrogatepass").replace("\0", "", 1)
            verdicts[i] = "block" if self.blocks[k] else "allow"
        return rules, verdicts


def judge_urls(urls: DataFrame, rules: list[Rule], url: str = "url", default: str = "allow", limit: int = FILE_LIMIT) -> DataFrame:
    """Adds host, path, rule and verdict to rows with a url.

    The longest rule (host and path together; among equals the one with the longer host) wins. A null url, or one
    without ://, has an empty host and path. A url that no rule fits is not in the list: it gets `default` and a null
    rule. Empty tables give empty results; repeated rows are judged alike; columns of the input named like a result
    column are replaced.

    Rule lists up to `limit` bytes are shipped as a file and memory-mapped. Larger ones are joined with the candidate
    keys by digest and string instead.
    """
    spark = urls.sparkSession
    parsed = urls.withColumns({"host": host_of(F.col(url)), "path": path_of(F.col(url))})
    if sum(len(r.text) + 32 for r in rules) > limit:
        return _joined(parsed, rules, default)
    name = _ship(spark, rules)

    @F.pandas_udf("rule string, verdict string")
    def judged(batches: Iterator[tuple[pd.Series, pd.Series]]) -> Iterator[pd.DataFrame]:
        array = DigestArray(SparkFiles.get(name))
        for hosts, paths in batches:
            r, v = array.judge(hosts.tolist(), paths.tolist())
            yield pd.DataFrame({"rule": r, "verdict": v}, dtype="object")

    found = column_name(parsed, "judged")
    out = parsed.withColumn(found, judged("host", "path"))
    return out.withColumns({"rule": F.col(found)["rule"], "verdict": F.coalesce(F.col(found)["verdict"], F.lit(default))}).drop(found)


def _joined(parsed: DataFrame, rules: list[Rule], default: str) -> DataFrame:
    """The same by an equi-join on (digest, host, path) of every host suffix and path prefix of distinct urls."""
    spark = parsed.sparkSession
    listed = spark.createDataFrame([(r.host, r.path, r.verdict) for r in rules], "rule_host string, rule_path string, verdict string")
    listed = listed.groupBy("rule_host", "rule_path").agg(F.max("verdict").alias("verdict")).withColumn("digest", F.xxhash64("rule_host", "rule_path"))
    labels = F.split("host", r"\.")
    suffixes = F.transform(F.sequence(F.lit(1), F.size(labels)), lambda i: F.array_join(F.slice(labels, i, F.size(labels)), "."))
    lengths = F.array(*(F.lit(n) for n in sorted({len(r.path) for r in rules})))
    keys = parsed.select("host", "path").distinct().withColumn("rule_host", F.explode(suffixes)).withColumn("n", F.explode(lengths)).filter(F.col("n") <= F.length("path"))
    keys = keys.withColumn("rule_path", F.substr("path", F.lit(1), F.col("n"))).withColumn("digest", F.xxhash64("rule_host", "rule_path"))
    rank = F.struct(F.length("rule_host") + F.length("rule_path"), F.length("rule_host"), "rule_host")
    found = column_name(parsed, "judged")
    best = keys.join(listed, ["digest", "rule_host", "rule_path"]).groupBy("host", "path").agg(F.max_by(F.struct(F.concat("rule_host", "rule_path").alias("rule"), "verdict"), rank).alias(found))
    out = parsed.join(best, ["host", "path"], "left")
    return out.withColumns({"rule": F.col(found)["rule"], "verdict": F.coalesce(F.col(found)["verdict"], F.lit(default))}).drop(found)


def _ship(spark: SparkSession, rules: list[Rule]) -> str:
    """Writes the file to the shared folder, from where Spark fetches it to each executor, anew when one is lost."""
    from pyarrow import fs

    path = f"{fresh_path(spark, 'rules')}.bin"
    store, place = fs.FileSystem.from_uri(path if "://" in path or path.startswith("file:") else f"file://{path}")
    store.create_dir(place.rpartition("/")[0], recursive=True)
    with store.open_output_stream(place, compression=None) as f:
        DigestArray.write(f, rules)
    spark.sparkContext.addFile(path)
    return path.rpartition("/")[2]


def op2_url_filter(spark: SparkSession, sf_dir: str) -> DataFrame:
    pages = spark.read.parquet(f"{sf_dir}/pages.parquet").select("page_id", "url")
    return judge_urls(pages, [Rule(*r) for r in RULES]).select("page_id", "host", "path", "rule", "verdict")


OP2_SQL = """
WITH parsed AS (
  SELECT page_id,
         CASE WHEN position('://' IN url) > 0 THEN substr(url, position('://' IN url) + 3) ELSE '' END AS rest
  FROM pages
), split AS (
  SELECT page_id,
         coalesce(translate(regexp_extract(rest, '^([^/?#]*)', 1), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '') AS host,
         coalesce(regexp_extract(rest, '^[^/?#]*([^?#]*)', 1), '') AS path
  FROM parsed
), rules(rule_host, rule_path, verdict) AS (
  VALUES ('com', '/en/', 'block'), ('example.com', '/en/7', 'allow'), ('net', '/de/', 'allow'),
         ('example.net', '/de/8', 'block'), ('org', '/es/', 'block')
), fits AS (
  SELECT page_id, host, path, rule_host || rule_path AS rule, verdict,
         row_number() OVER (PARTITION BY page_id, host, path ORDER BY length(rule_host || rule_path) DESC NULLS LAST, length(rule_host) DESC) AS k
  FROM split LEFT JOIN rules
    ON (host = rule_host OR ends_with(host, '.' || rule_host)) AND starts_with(path, rule_path)
)
SELECT page_id, host, path, rule, coalesce(verdict, 'allow') AS verdict FROM fits WHERE k = 1
"""
