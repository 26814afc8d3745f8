"""Writers of result files."""

from __future__ import annotations

import json
import zipfile
from pathlib import Path

from pyspark.sql import DataFrame
from pyspark.sql import functions as F


def write_tsv(rows: DataFrame, path: str, order: str, single: bool = False) -> None:
    """Tab-separated with a header, sorted as a whole by ranges; empty strings stay empty, nothing is quoted."""
    out = rows.orderBy(order)
    out = out.coalesce(1) if single else out
    out.write.mode("overwrite").option("sep", "\t").option("header", True).option("emptyValue", "").option("nullValue", "").option("quote", "").csv(path)


def write_candidate_pairs(wide: DataFrame, path: str, single: bool = True) -> None:
    """wide: source1_entity_id and candidate_entity_ids, as per_anchor() makes it."""
    write_tsv(wide.select("source1_entity_id", "candidate_entity_ids"), path, "source1_entity_id", single)


def write_matches(wide: DataFrame, path: str, single: bool = True) -> None:
    write_tsv(wide.select("source1_entity_id", "matched_entity_ids"), path, "source1_entity_id", single)


def write_report(row: DataFrame, path: str) -> dict:
    """One-row frames as JSON on the driver."""
    first = row.first()
    data = first.asDict(recursive=True) if first else {}
    Path(path).write_text(json.dumps(data, indent=2, sort_keys=True))
    return data


def write_csv(rows: DataFrame, path: str) -> None:
    rows.write.mode("overwrite").option("header", True).csv(path)


def markdown(rows: DataFrame, limit: int | None = None) -> str:
    """A report table in order of the first column, whole unless `limit` says otherwise. Reports are small by nature."""
    cells = lambda xs: "| " + " | ".join("" if x is None else str(x).replace("|", "\\|") for x in xs) + " |"
    ordered = rows.orderBy(rows.columns[0])
    body = [cells(r) for r in (ordered if limit is None else ordered.limit(limit)).collect()]
    return "\n".join([cells(rows.columns), cells(["-"] * len(rows.columns)), *body]) + "\n"


def write_profile(profiles: dict[str, DataFrame], path: str) -> None:
    """One Markdown report of several profile tables, written on the driver."""
    Path(path).write_text("\n".join(f"## {name}\n\n{markdown(rows)}" for name, rows in profiles.items()))


def write_ids(ids: DataFrame, path: str) -> None:
    ids.select(F.col(ids.columns[0]).cast("string")).orderBy(ids.columns[0]).write.mode("overwrite").text(path)


def bundle(paths: list[str], target: str) -> None:
    """Packs finished result files of the driver into one archive."""
    with zipfile.ZipFile(target, "w", zipfile.ZIP_DEFLATED) as z:
        for p in paths:
            for f in sorted(Path(p).rglob("*")) if Path(p).is_dir() else [Path(p)]:
                if f.is_file() and not f.name.startswith((".", "_")):
                    z.write(f, f"{Path(p).name}/{f.name}" if Path(p).is_dir() else f.name)
