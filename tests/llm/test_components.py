"""Components of links: within one task, over several, and how many Spark jobs a small table takes."""

from __future__ import annotations

import random

import pytest

from tessella.llm import minhash, partenum


def plain(links):
    least = {}

    def root(x):
        while least.setdefault(x, x) != x:
            x = least[x]
        return x

    for a, b in links:
        x, y = root(a), root(b)
        least[max(x, y)] = min(x, y)
    return {x: root(x) for x in least if root(x) != x}


def links_of(kind):
    rng = random.Random(5)
    if kind == "chain":
        ids = [rng.randrange(-(1 << 62), 1 << 62) for _ in range(700)]
        return list(zip(ids, ids[1:]))
    if kind == "star":
        return [(k, 900) for k in range(900)] + [(2000, k + 1001) for k in range(300)]
    if kind == "random":
        return [(rng.randrange(2000), rng.randrange(2000)) for _ in range(1100)] + [(7, 7)]
    return []


@pytest.mark.parametrize("most", [100, 500_000])
@pytest.mark.parametrize("kind", ["chain", "star", "random", "none"])
def test_components(spark, monkeypatch, kind, most):
    monkeypatch.setattr(minhash, "TASK_LINKS", most, raising=False)
    links = links_of(kind)
    found = minhash.components(spark.createDataFrame(links, "a long, b long"))
    rows = [tuple(r) for r in found.select("id", "comp").collect()]
    assert len(rows) == len(dict(rows)) and dict(rows) == plain(links)


def test_small_components_take_few_jobs(spark):
    """Each star is some ten shuffles; plans and tasks of dozens of them filled the driver."""
    links = spark.createDataFrame(links_of("chain"), "a long, b long")
    spark.sparkContext.setJobGroup("few-components", "")
    try:
        minhash.components(links).collect()
        assert len(spark.sparkContext.statusTracker().getJobIdsForGroup("few-components")) <= 3
    finally:
        spark.sparkContext._jsc.sc().clearJobGroup()


def test_similar_sets_take_small_batches(spark):
    """Texts and the pairs of full sets reach the Python workers in small batches where the session sets nothing."""
    setting = "spark.sql.execution.arrow.maxBytesPerBatch"
    spark.conf.unset(setting)
    try:
        text = " ".join(f"w{k}" for k in range(40))
        docs = spark.createDataFrame([(1, text), (2, text + " end"), (3, "something else")], "doc_id long, text string")
        found = {r["doc_id"]: r["component_id"] for r in partenum.similar_sets(docs).collect()}
        assert found == {1: 1, 2: 1, 3: 3}
        assert int(spark.conf.get(setting)) <= 4 << 20
    finally:
        spark.conf.unset(setting)
