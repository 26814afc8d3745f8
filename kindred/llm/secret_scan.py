"""Secret scan: candidates by format and context, then a random forest that removes false positives.

Candidates are strings of known credential formats, values of 8 characters or more that are assigned to names such as
token or password, and runs of 20 or more that mix letters and digits. A random forest, trained from labelled findings,
judges each by its length, its character transitions, how much of it dictionary words cover, whether it stands in a path
or URL, and the words before and behind it.
"""

from __future__ import annotations

import bisect
import hashlib
import json
import math
import os
import random
import re
from collections import Counter
from collections.abc import Iterator, Sequence
from dataclasses import dataclass
from functools import lru_cache

import numpy as np
import pyarrow as pa
from pyspark.ml.classification import RandomForestClassificationModel, RandomForestClassifier
from pyspark.ml.functions import array_to_vector, vector_to_array
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from kindred.llm.common import column_name, freeing, local_table

TREES, DEPTH, SEED, THRESHOLD = 40, 8, 5, 0.5
#: Labelled findings that the forest and its tables are fitted on at most; more are sampled by hash.
FIT_ROWS = 20_000

#: Public credential formats.
FORMATS = [
    ("aws_access_key", r"(?<![A-Za-z0-9])(?:AKIA|ASIA)[0-9A-Z]{16}(?![A-Za-z0-9])"),
    ("github_token", r"(?<![A-Za-z0-9])gh[pousr]_[A-Za-z0-9]{36,255}"),
    ("slack_token", r"(?<![A-Za-z0-9])xox[abprs]-[A-Za-z0-9-]{10,}"),
    ("google_api_key", r"(?<![A-Za-z0-9])AIza[0-9A-Za-z_-]{35}"),
    ("jwt", r"(?<![A-Za-z0-9])eyJ[A-Za-z0-9_-]{8,}\.[A-Za-z0-9_-]{8,}\.[A-Za-z0-9_-]{8,}"),
    ("private_key", r"-----BEGIN [A-Z ]*PRIVATE KEY-----[A-Za-z0-9+/=\s]{16,}-----END [A-Z ]*PRIVATE KEY-----"),
]
FORMAT = re.compile("|".join(f"(?P<{n}>{p})" for n, p in FORMATS))
NAME = re.compile(r"(?:token|secret|passw(?:or)?d|pwd|api[_-]?key|access[_-]?key|private[_-]?key|credential)s?", re.I)
#: What may follow a name up to its sign; a run is read once, however many names it holds.
TAIL = re.compile(r"[\w.-]*+")
#: A quoted value is taken whole; one without quotes by its usual symbols, or else up to a space, quote or bracket.
ASSIGNED = re.compile(r"""["']?\s*+(?:=>|:=|=|:)\s*+(?:"([^\s"]{8,})"|'([^\s']{8,})'|`([^\s`]{8,})`|["'`]?(?:([A-Za-z0-9+/_.~$!@%^&*#-]{8,}={0,2})|((?![=:>])[^\s"'`<>]{8,})))""")
RUN = re.compile(r"[A-Za-z0-9+/_-]{20,}={0,2}")
SECRET_WORDS = ("token", "secret", "password", "passwd", "pwd", "key", "credential", "auth", "bearer", "private", "api")
HARMLESS_WORDS = ("sha", "sha1", "sha256", "md5", "commit", "checksum", "digest", "hash", "uuid", "guid", "id", "etag", "revision", "integrity", "example", "build", "file", "src", "href", "data")
#: The word list for coverage: a public vocabulary's whole words of four letters or more. The path is a parameter.
WORD_LIST, LEAST_WORD = "word_bpe_49k.json", 4
#: Texts of the corpus that labelled findings are set into, and characters around a finding.
CONTEXTS, AROUND = 400, 60
FEATURES = ["length", "digits", "upper", "lower", "symbols", "classes", "entropy", "transitions", "alternations", "coverage", "hex", "uuid", "path", "url", "assigned", "known_format", "secret_word", "harmless_word", "repeats", "sequence"]
WORDS = LETTERS = re.compile(r"[a-z]+")
UUID = re.compile(r"[0-9a-f]{8}-[0-9a-f]{4}-[0-9a-f]{4}-[0-9a-f]{4}-[0-9a-f]{12}", re.I)


@lru_cache(maxsize=2)
def dictionary(path: str = WORD_LIST) -> frozenset[str]:
    """Whole words of a vocabulary file (a name that public_tokenizers knows, or a path): some 30,000."""
    import public_tokenizers as known

    with open(path if os.path.sep in path else known.path(path), encoding="utf-8") as f:
        words = json.load(f)["model"]["vocab"]
    return frozenset(w for x in words if x.endswith("</w>") and len(w := x.removesuffix("</w>")) >= LEAST_WORD and w.isascii() and w.isalpha())


def covered(text: str, words: frozenset[str]) -> int:
    """How many characters of lower-cased text the longest words from the left cover."""
    total = 0
    for m in LETTERS.finditer(text):
        run, at = m[0], 0
        while at <= len(run) - LEAST_WORD:
            n = next((k for k in range(min(16, len(run) - at), LEAST_WORD - 1, -1) if run[at : at + k] in words), 0)
            total += n
            at += n or 1
    return total


def candidates(text: str) -> list[tuple[int, int, str]]:
    """(start, end, kind) in order, without overlaps: known formats first, then assignments, then runs."""
    found: list[tuple[int, int, str]] = []
    if "-" in text or "_" in text or "AKIA" in text or "ASIA" in text or "AIza" in text or "eyJ" in text:  # every format holds one
        found += [(*m.span(), m.lastgroup) for m in FORMAT.finditer(text)]
    read = -1
    for m in NAME.finditer(text):
        if m.end() > read:
            read = TAIL.match(text, m.end()).end()
            if v := ASSIGNED.match(text, read):
                found.append((*v.span(v.lastindex), "assigned"))
    for m in RUN.finditer(text):
        s = m[0]
        if any(c.isdigit() for c in s) and any(c.isalpha() for c in s):
            found.append((*m.span(), "run"))
    rank = {"assigned": 1, "run": 2}
    out: list[tuple[int, int, str]] = []  # in order and without overlaps at any time
    for x in sorted(found, key=lambda x: (rank.get(x[2], 0), x[0], -x[1])):
        at = bisect.bisect_left(out, x)
        if (at == 0 or out[at - 1][1] <= x[0]) and (at == len(out) or x[1] <= out[at][0]):
            out.insert(at, x)
    return out


def entropy(s: str) -> float:
    return -sum(n / len(s) * math.log2(n / len(s)) for n in Counter(s).values()) if s else 0.0


class Transitions:
    """Mean log odds of a string's character pairs among labelled secrets against the other findings."""

    def __init__(self, secrets: list[str], others: list[str]) -> None:
        count = [np.ones((128, 128)), np.ones((128, 128))]
        for table, texts in zip(count, (secrets, others), strict=True):
            for s in texts:
                codes = np.minimum(np.frombuffer(s.encode("utf-32-le", "surrogatepass"), dtype=np.uint32), 127)
                np.add.at(table, (codes[:-1], codes[1:]), 1)
        self.odds = np.log(count[0] / count[0].sum()) - np.log(count[1] / count[1].sum())

    def score(self, s: str) -> float:
        codes = np.minimum(np.frombuffer(s.encode("utf-32-le", "surrogatepass"), dtype=np.uint32), 127)
        return float(self.odds[codes[:-1], codes[1:]].mean()) if len(codes) > 1 else 0.0


def features(text: str, start: int, end: int, kind: str, transitions: Transitions, words: frozenset[str] | None = None) -> list[float]:
    s = text[start:end]
    n = max(1, len(s))
    before, after = text[max(0, start - 48) : start], text[end : end + 24]
    near = WORDS.findall(before.lower())[-4:] + WORDS.findall(after.lower())[:2]
    kinds = ["d" if c.isdigit() else "u" if c.isupper() else "l" if c.islower() else "s" for c in s]
    count = Counter(kinds)
    low = s.lower()
    known = covered(low, dictionary() if words is None else words)
    step = np.diff(np.array([ord(c) for c in s])) if len(s) > 1 else np.zeros(1)
    return [
        float(n), count["d"] / n, count["u"] / n, count["l"] / n, count["s"] / n, float(len(count)), entropy(s), transitions.score(s),
        sum(a != b for a, b in zip(kinds, kinds[1:], strict=False)) / n, known / n,
        float(all(c in "0123456789abcdefABCDEF" for c in s)), float(bool(UUID.search(s))),
        float("/" in s or "\\" in s or before.endswith(("/", "\\", "./")) or after.startswith(("/", "\\"))),
        float(bool(re.search(r"(?:https?://|www\.)\S*$", before)) or s.startswith(("http", "www"))),
        float(kind == "assigned"), float(kind not in ("assigned", "run")),
        float(any(w in SECRET_WORDS for w in near)), float(any(w in HARMLESS_WORDS for w in near)),
        float(np.mean(step == 0)), float(np.mean(np.abs(step) == 1)),
    ]


def labelled_findings(n: int = 1500, seed: int = SEED, contexts: Sequence[str] = ()) -> list[tuple[str, int, int, str, int]]:
    """(text, start, end, kind, is_secret): findings made from a seed and set into pieces of the given texts.

    About half are credentials in known formats or assigned at random; the others are checksums, identifiers, paths,
    placeholders, names and encoded data, which scanners report falsely, and strings of the texts themselves that are
    candidates without a name or format. Without contexts, made-up words surround them.
    """
    r = random.Random(seed)
    letters, hexa = "abcdefghijklmnopqrstuvwxyzABCDEFGHIJKLMNOPQRSTUVWXYZ", "0123456789abcdef"
    alnum = letters + "0123456789"
    syllables = ["an", "er", "tion", "ing", "re", "on", "at", "en", "nd", "ti", "es", "or", "te", "of", "ed", "is", "it", "al", "ar", "st", "to", "nt", "ou", "ea", "hi"]
    pick = lambda chars, k: "".join(r.choice(chars) for _ in range(k))
    vocabulary = sorted(dictionary())
    word = lambda: r.choice(vocabulary) if r.random() < 0.5 else "".join(r.choice(syllables) for _ in range(r.randint(1, 4)))

    def prose(k: int) -> str:
        if contexts and r.random() < 0.8:
            t = r.choice(contexts)
            at = r.randrange(max(1, len(t) - AROUND))
            piece = t[at : at + r.randint(8 * k // 2, 8 * k)]
            if not candidates(piece) and not NAME.search(piece):
                return piece
        return " ".join(word() for _ in range(r.randint(2, k)))

    def secret() -> tuple[str, str, str]:
        kind = r.randrange(7)
        name = r.choice(["token", "secret", "api_key", "API-KEY", "access_key", "client_secret", "auth_token", "TOKEN"])
        tie, quote = r.choice([" = ", "=", ": ", " := ", "="]), r.choice(['"', "'", ""])
        if kind == 0:
            value = pick(hexa, r.choice([32, 40, 48, 64]))
        elif kind == 1:
            value = pick(alnum, r.randint(20, 48))
        elif kind == 2:
            value = pick(alnum + "+/", r.randint(28, 60)) + r.choice(["", "=", "=="])
        elif kind == 3:
            return prose(8) + " ", r.choice(["AKIA", "ASIA"]) + pick("ABCDEFGHIJKLMNOPQRSTUVWXYZ234567", 16), " " + prose(4)
        elif kind == 4:
            return prose(8) + " ", r.choice(["ghp_", "gho_", "ghs_"]) + pick(alnum, 36), " " + prose(4)
        elif kind == 5:
            return prose(5) + " Authorization: Bearer ", "eyJ" + pick(alnum, 20) + "." + pick(alnum, 40) + "." + pick(alnum + "-_", 43), " " + prose(3)
        else:
            name = r.choice(["password", "passwd", "pwd", "db_password"])
            value = pick(alnum + "!@%*", r.randint(10, 20))
        return f"{prose(8)} {name}{tie}{quote}", value, f"{quote} {prose(5)}"

    def other() -> tuple[str, str, str]:
        kind = r.randrange(10)
        if kind == 0:
            return f"{prose(6)} {r.choice(['sha256:', 'sha1 ', 'md5: ', 'commit ', 'checksum = ', 'digest: ', 'etag: '])}", pick(hexa, r.choice([32, 40, 64])), " " + prose(4)
        if kind == 1:
            u = pick(hexa, 32)
            return f"{prose(6)} {r.choice(['uuid=', 'id: ', 'guid ', ''])}", f"{u[:8]}-{u[8:12]}-{u[12:16]}-{u[16:20]}-{u[20:]}", " " + prose(4)
        if kind == 2:
            return prose(6) + r.choice([" /", " ./", " src/", " https://"]), "/".join(word() for _ in range(4)) + f"/{word()}{r.randint(1, 99)}/{word()}-{word()}", " " + prose(3)
        if kind == 3:
            value = r.choice(["your-token-here", "changeme1234", "xxxxxxxxxxxxxxxx", "EXAMPLE_KEY_1234567890", "placeholder-secret", "<token>aaaaaaaa", "1234567890123456", "abcdefgh12345678", "dummy_password_1", "password123", "test-token-value"])
            return f"{prose(6)} {r.choice(['token', 'secret', 'password', 'api_key'])}{r.choice([' = ', '=', ': '])}", value, " " + prose(4)
        if kind == 4:
            return prose(6) + " ", "-".join(word() for _ in range(6)) + f"-{r.randint(2, 2030)}", " " + prose(4)
        if kind == 5:
            return prose(6) + " ", "_".join(word() for _ in range(5)) + f"_v{r.randint(1, 9)}", r.choice(["(", ".", " "]) + prose(3)
        if kind == 6:
            return f"{prose(5)} data:image/png;base64,", pick(alnum + "+/", r.randint(40, 90)), " " + prose(3)
        if kind == 7:
            return f"{prose(4)} {r.choice(['token', 'password', 'secret', 'key'])}: ", word() + word() + word() + word(), " " + prose(6)
        if kind == 8:
            return prose(6) + " ", f"{word()}{word()}{word()}{word()}{word()}{word()}{r.randint(1, 9)}", " " + prose(4)
        return f"{prose(5)} build ", f"{r.randint(2000, 2030)}{r.randint(10, 12)}{r.randint(10, 28)}T{r.randint(100000, 235959)}Z{pick('0123456789', 8)}", " " + prose(3)

    rows = []
    for i in range(n):
        a, value, b = (secret if i % 2 else other)()
        text = a + value + b
        kind = next((k for s, e, k in candidates(text) if s < len(a) + len(value) and e > len(a)), "run")
        rows.append((text, len(a), len(a) + len(value), kind, i % 2))
    return rows


@dataclass
class SecretFilter:
    """A fitted forest and the transition table that its features need."""

    transitions: Transitions
    forest: RandomForestClassificationModel

    @staticmethod
    def fit(spark: SparkSession, labelled: DataFrame, fit_rows: int = FIT_ROWS) -> SecretFilter:
        """labelled: text, start, end, kind, is_secret (0 or 1). At most fit_rows of them, chosen by hash, are used."""
        clean = labelled.filter("text is not null and is_secret is not null")
        rows = clean.orderBy(F.xxhash64("text", "start"), "text", "start").limit(fit_rows).collect()
        table = Transitions([r["text"][r["start"] : r["end"]] for r in rows if r["is_secret"]], [r["text"][r["start"] : r["end"]] for r in rows if not r["is_secret"]])
        data = local_table(spark, [(features(r["text"], r["start"], r["end"], r["kind"], table), float(r["is_secret"])) for r in rows], "x array<double>, label double")
        forest = RandomForestClassifier(numTrees=TREES, maxDepth=DEPTH, seed=SEED, featuresCol="features", labelCol="label")
        return SecretFilter(table, forest.fit(data.select(array_to_vector("x").alias("features"), "label").coalesce(1)))

    @staticmethod
    def default(spark: SparkSession, docs: DataFrame | None = None, text: str = "text", contexts: int = CONTEXTS) -> SecretFilter:
        """Fitted on made findings, set into at most `contexts` texts of docs (those with the smallest hashes)."""
        found: list[str] = []
        if docs is not None:
            t = F.col(text)
            h = F.xxhash64(t)  # says which texts, and where in a text the piece begins
            known = docs.filter(F.length(t) > 0)
            # Tasks send a few hashes first, and pieces of the chosen texts alone after that.
            least = [r["h"] for r in known.select(h.alias("h")).distinct().orderBy("h").limit(contexts).collect()]
            if least:
                piece = F.substring(t, F.pmod(h, F.length(t)).cast("int") + 1, F.lit(10 * AROUND))
                some = known.filter(h <= least[-1]).groupBy(h.alias("h")).agg(F.min(piece).alias("t"))
                found = [r["t"] for r in some.orderBy("h").collect()]  # at most `contexts` rows
        return SecretFilter.fit(spark, local_table(spark, labelled_findings(contexts=found), "text string, start long, end long, kind string, is_secret int"))


FOUND = "doc_id long, start long, end long, kind string, secret_sha256 string, text_md5 string, x array<double>"


def scan(docs: DataFrame, judge: SecretFilter, id_col: str = "doc_id", text: str = "text", threshold: float = THRESHOLD) -> DataFrame:
    """doc_id, start, end (characters), kind, secret_sha256, text_md5, score, is_secret: a row for every candidate.

    Candidates that the forest gives less than `threshold` stay in the result with is_secret false. Null and empty
    texts have none; rows with a null id keep it; repeated rows give repeated results. The secret itself is not
    returned: `redact` takes it out of the text. text_md5 names the text among those that share an id.
    """
    table = judge.transitions
    kinds = {"long": pa.int64(), "string": pa.string(), "array<double>": pa.list_(pa.float64())}
    schema = pa.schema([(name, kinds[kind]) for name, kind in (c.split() for c in FOUND.split(", "))])

    def found(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        words = dictionary()
        for batch in batches:
            rows = []
            for i in range(len(batch)):
                t = batch.column(1)[i].as_py()
                spans = candidates(t)
                name = hashlib.md5(t.encode("utf-8", "surrogatepass")).hexdigest() if spans else ""
                for a, b, kind in spans:
                    digest = hashlib.sha256(t[a:b].encode("utf-8", "surrogatepass")).hexdigest()
                    rows.append((batch.column(0)[i].as_py(), a, b, kind, digest, name, features(t, a, b, kind, table, words)))
            columns = zip(*rows, strict=True) if rows else [()] * len(schema)
            yield pa.RecordBatch.from_arrays([pa.array(c, f.type) for c, f in zip(columns, schema, strict=True)], schema=schema)

    asked = docs.select(F.col(id_col).cast("long").alias("doc_id"), F.col(text).alias("text")).filter("text is not null")
    scored = judge.forest.transform(asked.mapInArrow(freeing(found), FOUND).withColumn("features", array_to_vector("x")))
    score = F.round(vector_to_array("probability")[1], 6)
    return scored.select("doc_id", "start", "end", "kind", "secret_sha256", "text_md5", score.alias("score"), (score >= threshold).alias("is_secret"))


def redact(docs: DataFrame, findings: DataFrame, mark: str = "[SECRET]", id_col: str = "doc_id", text: str = "text") -> DataFrame:
    """docs with their confirmed secrets replaced and n_chars set anew; all other columns and rows stay as they are.

    findings: what scan() gave for docs. They are matched by id and text, so null ids, and several texts of one id, are
    changed as well. A text's findings are gathered in its row, so they are bounded by its length.
    """
    own, other, md5, spans = (column_name(docs, c) for c in ("own_md5", "found_id", "found_md5", "spans"))
    found = findings.filter("is_secret").groupBy(F.col("doc_id").alias(other), F.col("text_md5").alias(md5)).agg(F.sort_array(F.collect_set(F.struct("start", "end")), asc=False).alias(spans))
    joined = docs.withColumn(own, F.md5(F.col(text).cast("binary"))).join(found, F.col(id_col).cast("long").eqNullSafe(F.col(other)) & (F.col(own) == F.col(md5)), "left")
    # From the last to the first, so that places before a mark stay right.
    cut = F.aggregate(spans, F.col(text), lambda t, x: F.concat(F.substring(t, F.lit(1), x["start"].cast("int")), F.lit(mark), F.substring(t, x["end"].cast("int") + 1, F.length(t))))
    hit = F.col(spans).isNotNull()
    out = joined.withColumn(text, F.when(hit, cut).otherwise(F.col(text)))
    if "n_chars" in docs.columns:
        out = out.withColumn("n_chars", F.when(hit, F.length(text).cast(docs.schema["n_chars"].dataType)).otherwise(F.col("n_chars")))
    return out.select(*docs.columns)


def op10_secret_scan(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet").select("doc_id", "text")
    return scan(docs, SecretFilter.default(spark, docs))
