from helpers import entities

from kindred.operators import blocking, blockwise, refine
from kindred.operators.normalize import normalized
from kindred.plans import registry

COLUMNS = ["s1_id", "target_id", "strategies", "first_rank"]


def _same(a, b):
    return a.exceptAll(b).isEmpty() and b.exceptAll(a).isEmpty()


def test_pairs_and_scores_are_those_of_joins(spark, sf):
    p = registry._pipe(spark, sf)
    pairs = blocking.retrieve(p.anchors, p.targets).cache()
    assert pairs.count() > 100 and _same(pairs, p.raw_pairs().select(COLUMNS))
    scored = refine.pair_scores(refine.with_views(pairs, p.anchors, p.targets)).select(*COLUMNS, "score")
    assert _same(scored, p.scored_pairs())
    assert _same(refine.top_k(scored, 3), refine.top_k(blockwise.scored_pairs(p.anchors, p.targets, k=3), 3))
    registry.close()


def test_odd_names_hot_queries_and_aliases(spark, monkeypatch):
    monkeypatch.setattr(blockwise, "QUERIES_AT_ONCE", 3)  # the block of one name goes to several places
    names = [("Foo Foo dba Foo Foo", "1 a"), ("Bar t/a Foo Foo", ""), ("é", "7 é"), ("ab", ""), ("", "12 High St 12"), ("M/S Foo Foo", None), ("x" * 90, "5 5 5"), ("\U0001d4b3 Foo Foo", "1 a"), (None, None)]
    q = normalized(entities(spark, [(f"S1-{i}", *names[i % len(names)], ["US", "", None][i % 3]) for i in range(60)]))
    t = normalized(entities(spark, [(f"S2-{i}", *names[i % len(names)], ["US", ""][i % 2]) for i in range(30)]))
    pairs = blocking.retrieve(q, t).cache()
    assert pairs.count() > 50 and _same(pairs, blockwise.pairs(q, t))
    assert _same(refine.pair_scores(refine.with_views(pairs, q, t)).select(*COLUMNS, "score"), blockwise.scored_pairs(q, t))


def test_no_pair_is_shuffled_with_its_records(spark, sf):
    """Only candidates are dealt by anchor; before, each pair carried all views of both records through two joins."""
    p = registry._pipe(spark, sf)
    plan = p.candidates()._jdf.queryExecution().optimizedPlan().toString()
    assert "t_name_grams" not in plan and "MapInArrow" in plan
    registry.close()
