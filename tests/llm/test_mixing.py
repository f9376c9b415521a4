from collections import defaultdict

from tallyroll.llm import mixing


def test_targets_reach_their_limits_and_share_the_rest(docs_of):
    rows = [(i, "w " * 10, "en", s) for i, s in enumerate(["a"] * 10 + ["b"] * 100 + ["c"] * 400 + [None] * 30 + ["é"] * 5)]
    plan = mixing.mix_plan(docs_of(rows)).collect()
    targets = {r["source"]: r["target"] for r in plan}
    sizes = defaultdict(int)
    for r in plan:
        sizes[r["source"]] += r["size"]
    # weights a 5, b 2, c 1, é 5, NULL 2; all words 5450, to share 8175
    assert {s: targets[s] for s in ("a", "b", "é", None)} == {"a": 200, "b": 2000, "é": 100, None: 600}
    assert targets["c"] == 8175 - 2900
    taken = defaultdict(int)
    for r in plan:
        taken[r["source"]] += r["size"] * r["copies"]
        assert 0 <= r["copies"] <= 2
    for s, target in targets.items():
        assert abs(taken[s] - target) <= 20
    assert sum(taken.values()) <= 8175


def test_given_documents_come_near_their_targets(documents):
    plan = mixing.mix_plan(documents).collect()
    taken, longest, target = defaultdict(int), defaultdict(int), {}
    for r in plan:
        taken[r["source"]] += r["size"] * r["copies"]
        longest[r["source"]] = max(longest[r["source"]], r["size"])
        target[r["source"]] = r["target"]
    assert all(abs(taken[s] - target[s]) <= longest[s] + 1 for s in target)
    again = mixing.mix_plan(documents.repartition(11)).collect()
    assert sorted(map(tuple, plan)) == sorted(map(tuple, again))


def test_mix_takes_rows_as_often_as_planned(documents):
    plan = {r["doc_id"]: r["copies"] for r in mixing.mix_plan(documents).collect()}
    mixed = mixing.mix(documents)
    assert mixed.columns == documents.columns
    counts = {r["doc_id"]: r["count"] for r in mixed.groupBy("doc_id").count().collect()}
    assert counts == {d: n for d, n in plan.items() if n}


def test_awkward_rows(awkward, no_docs):
    plan = mixing.mix_plan(awkward).collect()
    assert sum(r["n"] for r in plan) == awkward.count()
    assert mixing.mix(awkward).columns == awkward.columns
    assert mixing.mix(awkward).count() == sum(r["n"] * r["copies"] for r in plan)
    assert mixing.mix_plan(no_docs).collect() == []
    assert mixing.mix(no_docs).count() == 0
