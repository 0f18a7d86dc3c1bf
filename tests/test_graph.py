"""The dependency graph of models and checks, and the builds that stay."""

import os
import threading
import time

import pytest

from evstar.plans import build as gate
from evstar.plans.graph import Task, ordered, run_tasks
from test_gate import T0, catalogs, payload  # noqa: F401
from test_models import raw_events


def test_order_and_cycles():
    order = ordered({"c": ["a", "b"], "b": ["a"], "a": [], "d": []})
    assert order.index("a") < order.index("b") < order.index("c")
    with pytest.raises(ValueError, match="cycle: .*a.*b"):
        ordered({"a": ["b"], "b": ["c"], "c": ["a"]})
    with pytest.raises(KeyError, match="not declared"):
        ordered({"a": ["x"]})


def test_independent_tasks_run_at_once_and_descendants_of_a_failed_one_not(spark):
    together, ran = threading.Barrier(2, timeout=20), []

    def meet(name):
        def run():
            together.wait()  # only if both are running
            spark.range(10).count()
            ran.append(name)

        return run

    def fail():
        raise RuntimeError("bad")

    tasks = [Task("a", (), meet("a")), Task("b", (), meet("b")), Task("f", ("a",), fail), Task("g", ("f",), lambda: ran.append("g")), Task("h", ("g", "b"), lambda: ran.append("h")), Task("i", ("b",), lambda: "value")]
    out = run_tasks(spark, tasks)
    assert sorted(ran) == ["a", "b"] and str(out["f"].error) == "bad"
    assert out["g"].skipped_for == ("f",) and out["h"].skipped_for == ("g",) and out["i"].result == "value"


def test_needs_are_met_before_a_task_runs(spark):
    done = {}

    def run(name):
        def go():
            time.sleep(0.02)
            done[name] = time.perf_counter()

        return go

    needs = {f"t{k}": tuple(f"t{j}" for j in range(k) if (k * j) % 3 == 1) for k in range(12)}
    run_tasks(spark, [Task(n, of, run(n)) for n, of in needs.items()], workers=4)
    assert all(done[n] > done[d] for n, of in needs.items() for d in of)


def test_models_beside_a_failing_one_are_built(spark, tmp, catalogs):  # noqa: F811
    raw = raw_events(spark, [("e1", "order", T0, payload("O1", status="pending"), 1, T0)])
    with pytest.raises(gate.BuildFailed, match="skipped: fact_orders"):
        gate.build(spark, raw, *catalogs, f"{tmp}/wh")
    (built,) = os.listdir(f"{tmp}/wh/builds")
    names = set(os.listdir(f"{tmp}/wh/builds/{built}"))
    assert {"dim_customers", "dim_products", "dim_date"} <= names and "fact_orders" not in names


def test_old_builds_are_removed(spark, tmp, catalogs, monkeypatch):  # noqa: F811
    ids = []
    for n in range(4):
        raw = raw_events(spark, [("e1", "order", T0, payload(f"O{n}"), 1, T0)])
        ids.append(gate.build(spark, raw, *catalogs, f"{tmp}/wh").build_id)
    assert gate.prune_builds(spark, f"{tmp}/wh", keep=2) == ids[:2]
    assert sorted(os.listdir(f"{tmp}/wh/builds")) == ids[2:]
    assert "staging" not in os.listdir(f"{tmp}/wh/builds/{ids[2]}") and "staging" in os.listdir(f"{tmp}/wh/builds/{ids[3]}")
    assert [r.order_id for r in gate.read_mart(spark, f"{tmp}/wh", "fact_orders").collect()] == ["O3"]
