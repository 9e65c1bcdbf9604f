"""What the driver holds while it plans and trains stays small."""

import tracemalloc

import numpy as np
import pytest

from soukwise.llm import graph, toxicity


def _stored(spark, tmp_path, edges):
    spark.createDataFrame(edges, "a bigint, b bigint").write.parquet(f"{tmp_path}/edges")
    return spark.read.parquet(f"{tmp_path}/edges")


def test_a_round_reads_its_edges_four_times(spark, tmp_path):
    edges = _stored(spark, tmp_path, [(2, 1), (3, 2), (4, 3)])
    plan = graph._star(graph._star(edges, large=True), large=False)._jdf.queryExecution().optimizedPlan()
    assert len([line for line in plan.toString().split("\n") if "Relation [" in line]) == 4


@pytest.mark.parametrize("edges, most", [([(2, 1), (3, 1), (9, 8), (5, 5)], 1), ([], 1), ([(2, 1), (3, 2), (4, 3), (5, 4)], 3)])
def test_settled_edges_are_not_stored_again(spark, tmp_path, monkeypatch, edges, most):
    stored = []
    usual = graph.materialise
    monkeypatch.setattr(graph, "materialise", lambda df: stored.append(1) or usual(df))
    found = {r["id"]: r["label"] for r in graph.components(_stored(spark, tmp_path, edges)).collect()}
    smallest = {5: 5, 8: 8, 9: 8} if len(edges) == 4 and (9, 8) in edges else {}
    assert found == {x: smallest.get(x, 1) for e in edges for x in e}
    assert len(stored) <= most


def test_training_holds_little_beside_its_embeddings(monkeypatch):
    monkeypatch.setattr(toxicity, "STEPS", 2)
    table = toxicity.BUCKETS * toxicity.WIDTH * 4
    tracemalloc.start()
    toxicity.embedded(["good words here", "bad words there"] * 4, np.array([0, 1] * 4))
    peak = tracemalloc.get_traced_memory()[1]
    tracemalloc.stop()
    # The embeddings, their two moments and their slope, and one more.
    assert peak < 5 * table
