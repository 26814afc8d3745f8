import pytest

from kindred.operators.refine import empty_candidates
from kindred.sources import sinks, tables


def test_source_reader(spark, tmp_path):
    path = tmp_path / "s.tsv"
    path.write_text('entity_id\tbusiness_name\tbusiness_address\tcountry\nS1-1\t"Unclosed\t1 Main\tUS\nS1-2\tNA\t\tnull\n')
    rows = [tuple(r) for r in tables.read_source(spark, str(path)).collect()]
    assert rows == [("S1-1", '"Unclosed', "1 Main", "US"), ("S1-2", "NA", "", "null")]
    assert [r[0] for r in tables.read_entity_ids(spark, str(path)).collect()] == ["S1-1", "S1-2"]
    assert tables.read_source(spark, str(path), use=["country"]).columns == ["country"]
    assert tables.count_rows(spark, str(path)) == 2


def test_raw_lines(spark, tmp_path):
    path = tmp_path / "s.tsv"
    path.write_bytes(b"entity_id\tbusiness_name\tbusiness_address\tcountry\r\nS1-1\ta\tb\tc\textra\r\nS1-2\ttoo few\r\n")
    assert [tuple(r) for r in tables.read_lines(spark, str(path)).collect()] == [("S1-1", "a", "b", "c")]


def lines(spark, rows):
    return spark.createDataFrame(rows, "source1_entity_id string, matched_entity_ids string")


def test_truth(spark):
    good = lines(spark, [("S1-1", "S2-1, S3-4"), ("S1-2", ""), ("S1-3", None)])
    assert [tuple(r) for r in tables.parse_truth(good).orderBy("s1_id").collect()] == [("S1-1", ["S2-1", "S3-4"]), ("S1-2", []), ("S1-3", [])]
    for bad in ([("S1-1", "S2-1,S2-1")], [("X-1", "S2-1")], [("S1-1", "S1-4")], [("S1-1", "S2-1,,S2-2")], [("S1-1", ""), ("S1-1", "")]):
        with pytest.raises(ValueError):
            tables.parse_truth(lines(spark, bad))
    ids = spark.createDataFrame([("S1-1",)], "entity_id string")
    pool = spark.createDataFrame([("S2-1",)], "entity_id string")
    assert {r["rule"] for r in tables.truth_violations(good, ids, pool).collect()} == {"unknown_s1_id", "unknown_target"}
    with pytest.raises(ValueError):
        tables.parse_truth(spark.createDataFrame([("a", "b")], "x string, y string"))


def test_sinks(spark, tmp_path):
    wide = spark.createDataFrame([("S1-2", ""), ("S1-1", "S2-1,S3-1")], "source1_entity_id string, candidate_entity_ids string")
    sinks.write_candidate_pairs(wide, str(tmp_path / "c"))
    (part,) = (tmp_path / "c").glob("part-*")
    assert part.read_text() == "source1_entity_id\tcandidate_entity_ids\nS1-1\tS2-1,S3-1\nS1-2\t\n"
    sinks.bundle([str(tmp_path / "c")], str(tmp_path / "z.zip"))
    assert (tmp_path / "z.zip").stat().st_size > 0
    assert sinks.write_report(wide.limit(1), str(tmp_path / "r.json"))


def test_empty_baseline(spark):
    assert empty_candidates(spark.createDataFrame([("S1-1",)], "entity_id string")).first()["candidates"] == []
    with pytest.raises(ValueError):
        empty_candidates(spark.createDataFrame([("S1-1",)], "x string"))


def test_reports(spark, tmp_path):
    df = spark.createDataFrame([("b", 2), ("a|", None)], "k string, n int")
    assert sinks.markdown(df) == "| k | n |\n| - | - |\n| a\\| |  |\n| b | 2 |\n"
    sinks.write_profile({"one": df}, str(tmp_path / "p.md"))
    assert (tmp_path / "p.md").read_text().startswith("## one")
    sinks.write_csv(df, str(tmp_path / "c"))
    assert spark.read.option("header", True).csv(str(tmp_path / "c")).count() == 2
