"""Running tasks by their dependencies (Q-GATE).

Tasks declare what they need. Those whose needs are met run at once, each in
a thread with a scheduler pool of its own, so that Spark shares the cluster
among their jobs. What needs a failed task is skipped, the rest goes on.
"""

from __future__ import annotations

from collections.abc import Callable, Iterable
from concurrent.futures import FIRST_COMPLETED, Future, ThreadPoolExecutor, wait
from dataclasses import dataclass
from graphlib import CycleError, TopologicalSorter

from pyspark import inheritable_thread_target
from pyspark.sql import SparkSession

#: Tasks whose jobs run at once, at most.
WORKERS = 8


@dataclass(frozen=True)
class Task:
    name: str
    needs: tuple[str, ...]
    run: Callable[[], object]


@dataclass
class Outcome:
    """``result`` of a task that ran, ``error`` of one that failed, or the
    names it was skipped for."""

    result: object = None
    error: Exception | None = None
    skipped_for: tuple[str, ...] = ()

    @property
    def ok(self) -> bool:
        return self.error is None and not self.skipped_for


def ordered(needs: dict[str, Iterable[str]]) -> list[str]:
    """The names, each after all it needs; a name that is needed and not
    there, and a cycle, are errors."""
    for name, of in needs.items():
        for n in of:
            if n not in needs:
                raise KeyError(f"{name} needs {n}, which is not declared")
    try:
        return list(TopologicalSorter(needs).static_order())
    except CycleError as error:
        raise ValueError("cycle: " + " -> ".join(reversed(error.args[1]))) from None


def run_tasks(spark: SparkSession, tasks: Iterable[Task], workers: int = WORKERS) -> dict[str, Outcome]:
    """Run all tasks; their outcomes by name, in an order that respects the
    needs."""
    by_name = {t.name: t for t in tasks}
    needs = {t.name: t.needs for t in by_name.values()}
    order, out = ordered(needs), {}
    sorter = TopologicalSorter(needs)
    sorter.prepare()

    def in_pool(task: Task) -> object:
        spark.sparkContext.setLocalProperty("spark.scheduler.pool", task.name)
        return task.run()

    with ThreadPoolExecutor(workers) as threads:
        running: dict[Future, str] = {}
        while sorter.is_active():
            for name in sorter.get_ready():
                failed = tuple(n for n in needs[name] if not out[n].ok)
                if failed:
                    out[name] = Outcome(skipped_for=failed)
                    sorter.done(name)
                else:
                    running[threads.submit(inheritable_thread_target(spark)(in_pool), by_name[name])] = name
            if running:
                for future in wait(running, return_when=FIRST_COMPLETED).done:
                    name = running.pop(future)
                    error = future.exception()
                    if error is not None and not isinstance(error, Exception):
                        raise error
                    out[name] = Outcome(error=error) if error else Outcome(result=future.result())
                    sorter.done(name)
    return {name: out[name] for name in order}
