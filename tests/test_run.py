import hashlib
import random

from kindred.operators import diagnostics, metrics
from kindred.plans.pipeline import one_anchor_per_target
from kindred.plans.run import main, run_linkage, train_model
from kindred.sources.sinks import write_ids


def write_sources(folder, prefix, n, seed, countries=("US", "INDIA")):
    r = random.Random(seed)
    words = ["alpha", "beta", "gamma", "delta", "omega", "royal", "green", "river", "stone", "cloud", "maple", "north"]
    files, truth = {1: [], 2: [], 3: []}, []
    for i in range(n):
        name = " ".join(r.choice(words) for _ in range(3)) + f" {r.choice(['foods', 'tools', 'labs'])}{i}"
        address, country = f"{r.randrange(1, 999)} {r.choice(words)} street {r.choice(words)}ville", r.choice(countries)
        files[1].append((f"S1-{i}", name.title(), address, country))
        mine = []
        for s in (2, 3):
            if r.random() < 0.7:
                other = name.upper() + r.choice([" Inc.", " Ltd", ""])
                files[s].append((f"S{s}-{i}", other, address.replace("street", r.choice(["st", "street"])), country))
                mine.append(f"S{s}-{i}")
        truth.append((f"S1-{i}", ",".join(mine)))
    for s, rows in files.items():
        (folder / f"{prefix}_source{s}.tsv").write_text("entity_id\tbusiness_name\tbusiness_address\tcountry\n" + "".join("\t".join(x) + "\n" for x in rows))
    (folder / f"{prefix}_ground_truth.tsv").write_text("source1_entity_id\tmatched_entity_ids\n" + "".join("\t".join(x) + "\n" for x in truth))
    return dict(truth)


def result(folder, name):
    (part,) = (folder / name).glob("part-*")
    return part.read_text()


def test_train_link_check(spark, tmp_path, capsys):
    write_sources(tmp_path, "train", 60, 1)
    truth = write_sources(tmp_path, "test", 25, 2, ("US", "INDIA", "FRANCE"))
    sweep = train_model(spark, str(tmp_path), str(tmp_path / "m"), "logistic").collect()
    assert len(sweep) == 19 and max(r["macro_f05"] for r in sweep) > 0.9
    out = run_linkage(spark, str(tmp_path), str(tmp_path / "m"), str(tmp_path / "o"))
    assert out["n_pairs"] > 0 and (tmp_path / "o/results.zip").exists()
    lines = [x.split("\t") for x in result(tmp_path / "o", "matching_results").splitlines()]
    assert lines[0] == ["source1_entity_id", "matched_entity_ids"] and [x[0] for x in lines[1:]] == sorted(truth)
    right = sum(sorted(filter(None, x[1].split(","))) == sorted(filter(None, truth[x[0]].split(","))) for x in lines[1:])
    assert right >= 20
    before = {n: hashlib.sha256(result(tmp_path / "o", n).encode()).digest() for n in ("candidate_pairs", "matching_results")}
    run_linkage(spark, str(tmp_path), str(tmp_path / "m"), str(tmp_path / "o"), archive=False)
    assert before == {n: hashlib.sha256(result(tmp_path / "o", n).encode()).digest() for n in before}
    assert main(["check", "--folder", str(tmp_path), "--output", str(tmp_path / "o")]) == 0 and "right" in capsys.readouterr().out


def test_one_anchor_per_target(spark):
    m = spark.createDataFrame([("S1-2", "S2-1", 0.9), ("S1-1", "S2-1", 0.9), ("S1-3", "S2-1", 0.8), ("S1-3", "S2-2", 0.8)], "s1_id string, target_id string, prob double")
    assert sorted((r["s1_id"], r["target_id"]) for r in one_anchor_per_target(m).collect()) == [("S1-1", "S2-1"), ("S1-3", "S2-2")]


def test_experiments_and_diagnostics(spark):
    from helpers import entities

    from kindred.operators.normalize import normalized

    a = normalized(entities(spark, [("S1-1", "Alpha Foods", "1 Oak Road", "US"), ("S1-2", "Beta", "", "US")]))
    t = normalized(entities(spark, [("S2-1", "Alpha Foods", "1 Oak Road", "US"), ("S3-1", "Gamma", "1 Oak Road", "US")]))
    truth = spark.createDataFrame([("S1-1", ["S2-1", "S3-1"]), ("S1-2", [])], "s1_id string, targets array<string>")
    got = {r["experiment"]: r for r in diagnostics.run_experiments(a, t, truth).collect()}
    assert set(got) == set(diagnostics.EXPERIMENTS) and got["EXP-001"]["recall"] == 0.5 and got["EXP-002"]["recall"] == 1.0
    cands = spark.createDataFrame([("S1-1", "S2-1", 1.0), ("S1-1", "S3-1", 0.2)], "s1_id string, target_id string, score double")
    d = metrics.candidate_diagnostics(truth, cands).first()
    assert (d["mean"], d["max"], d["zero_share"], d["n_pairs"], d["at_least_25"]) == (1.0, 2, 0.5, 2, 1)


def test_ids_file(spark, tmp_path):
    write_ids(spark.createDataFrame([("S1-2",), ("S1-1",)], "entity_id string").coalesce(1), str(tmp_path / "ids"))
    assert "".join(p.read_text() for p in sorted((tmp_path / "ids").glob("part-*"))) == "S1-1\nS1-2\n"
