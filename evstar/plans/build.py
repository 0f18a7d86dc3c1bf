"""Build gate (Q-GATE): models and their data-quality checks as a dependency
graph (:mod:`evstar.plans.graph`). Independent models and checks run at once;
what needs a model with a failing check is skipped, and the build fails loudly.

Every build writes its models to a folder of its own,
``{warehouse}/builds/{build id}``: staging models for the time of the build,
marts to stay. Reading them back cuts their lineage, so a lost executor never
recomputes the upstream chain. Once all checks have run, the build is
published by one more entry in ``{warehouse}/published``; readers
(:func:`read_mart`) follow the last entry, so they see a whole build or the
one before it, never a half-written table. Builds before the last few are removed.
"""

from __future__ import annotations

import datetime as dt
import uuid
from collections.abc import Callable, Iterable
from dataclasses import dataclass, field

from pyspark.errors import AnalysisException
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from ..functions.calendar import date_spine_covering
from ..operators import quality as q
from ..storage import Folders
from . import marts, staging
from .graph import Task, run_tasks


@dataclass(frozen=True)
class Check:
    """One declared test instance on a model column."""

    model: str
    column: str
    test: str
    args: dict = field(default_factory=dict)

    @property
    def name(self) -> str:
        return f"{self.test}:{self.model}.{self.column}"


def _pair(model: str, column: str) -> list[Check]:
    return [Check(model, column, "unique"), Check(model, column, "not_null")]


def _rel(model: str, column: str, to: str, to_field: str) -> Check:
    return Check(model, column, "relationships", {"to": to, "field": to_field})


# The declared tests of the project (36 instances).
CHECKS: list[Check] = [
    *_pair("stg_orders", "event_id"),
    *_pair("stg_orders", "order_id"),
    Check("stg_orders", "customer_id", "not_null"),
    _rel("stg_orders", "customer_id", "stg_customers", "customer_id"),
    Check("stg_orders", "product_id", "not_null"),
    _rel("stg_orders", "product_id", "stg_products", "product_id"),
    Check("stg_orders", "quantity", "accepted_range", {"min_value": 1}),
    Check("stg_orders", "total_amount", "accepted_range", {"min_value": 0}),
    Check("stg_orders", "order_status", "accepted_values", {"values": ["completed", "cancelled"]}),
    Check("stg_orders", "total_amount", "total_matches"),
    *_pair("stg_products", "product_id"),
    Check("stg_products", "unit_price", "accepted_range", {"min_value": 0, "inclusive": False}),
    *_pair("stg_customers", "customer_id"),
    Check("stg_customers", "email", "not_null"),
    *_pair("dim_customers", "customer_key"),
    *_pair("dim_customers", "customer_id"),
    *_pair("dim_products", "product_key"),
    *_pair("dim_products", "product_id"),
    *_pair("dim_date", "date_key"),
    *_pair("fact_orders", "order_id"),
    Check("fact_orders", "customer_key", "not_null"),
    _rel("fact_orders", "customer_key", "dim_customers", "customer_key"),
    Check("fact_orders", "product_key", "not_null"),
    _rel("fact_orders", "product_key", "dim_products", "product_key"),
    Check("fact_orders", "order_date_key", "not_null"),
    _rel("fact_orders", "order_date_key", "dim_date", "date_key"),
]

@dataclass(frozen=True)
class Model:
    """A model, the models it reads, and how it is built from these."""

    name: str
    kind: str
    needs: tuple[str, ...]
    build: Callable[[dict[str, DataFrame]], DataFrame]


def _given(given: str, build: Callable[[dict[str, DataFrame]], DataFrame]) -> Callable[[dict[str, DataFrame]], DataFrame]:
    return lambda m: m[given] if given in m else build(m)


def declared_models(order_type: str = "order", calendar_from_orders: bool = False) -> list[Model]:
    """The project's models over raw tables; the date dimension is given, or
    sized to the staged orders."""
    orders = ("stg_orders", "view", (), _given("staged_orders", lambda m: staging.stg_orders(m["raw_events"], order_type)))
    spine = lambda m: marts.dim_date(spine=date_spine_covering(m["stg_orders"], "ordered_at"))
    return [
        Model("stg_products", "view", (), _given("staged_products", lambda m: staging.stg_products(m["raw_products"]))),
        Model("stg_customers", "view", (), _given("staged_customers", lambda m: staging.stg_customers(m["raw_customers"]))),
        Model(*orders),
        Model("dim_customers", "table", ("stg_customers",), lambda m: marts.dim_customers(m["stg_customers"])),
        Model("dim_products", "table", ("stg_products",), lambda m: marts.dim_products(m["stg_products"])),
        Model("dim_date", "table", ("stg_orders",) if calendar_from_orders else (), spine if calendar_from_orders else lambda m: m["calendar"]),
        Model(
            "fact_orders",
            "table",
            ("stg_orders", "dim_customers", "dim_products"),
            lambda m: marts.fact_orders(m["stg_orders"], m["dim_customers"], m["dim_products"]),
        ),
    ]


def run_check(check: Check, models: dict[str, DataFrame]) -> q.Violations:
    """Violations of one declared check against built ``models``."""
    df = models[check.model]
    name = check.name
    if check.test == "unique":
        return q.unique(df, check.column, name=name)
    if check.test == "not_null":
        return q.not_null(df, check.column, name=name)
    if check.test == "relationships":
        return q.relationships(df, check.column, models[check.args["to"]], check.args["field"], name=name)
    if check.test == "accepted_values":
        return q.accepted_values(df, check.column, check.args["values"], name=name)
    if check.test == "accepted_range":
        return q.accepted_range(df, check.column, name=name, **check.args)
    if check.test == "total_matches":
        return q.singular(name, q.total_mismatch(df))
    raise ValueError(f"unknown test {check.test!r}")


_ROW_LEVEL = {"not_null", "accepted_range", "total_matches"}


def _row_violation(check: Check) -> Column:
    if check.test == "not_null":
        return F.col(check.column).isNull()
    if check.test == "accepted_range":
        return q.range_violation(check.column, **check.args)
    return q.total_violation()


def _named_counts(counts: DataFrame, checks: list[Check]) -> DataFrame:
    """``(check, failures)`` rows from one row of columns ``c0, c1, ...``."""
    pairs = [F.struct(F.lit(c.name).alias("check"), F.col(f"c{i}").alias("failures")) for i, c in enumerate(checks)]
    return counts.select(F.inline(F.array(*pairs)))


def failures_frame(checks: Iterable[Check], models: dict[str, DataFrame]) -> DataFrame:
    """``(check, failures)`` for many checks as one DataFrame (one job).

    The row-level checks of a model (not-null, range, total tolerance) are
    counted together in one aggregate pass over it, and so are its unique
    checks, over one exchange of (check, value) pairs; each other grouped
    check (accepted values, relationships) is its own branch.
    """
    checks = list(checks)
    frames: list[DataFrame] = []
    for model in dict.fromkeys(c.model for c in checks):
        row_level = [c for c in checks if c.model == model and c.test in _ROW_LEVEL]
        if row_level:
            counts = models[model].agg(
                *[F.count_if(_row_violation(c)).cast("long").alias(f"c{i}") for i, c in enumerate(row_level)]
            )
            frames.append(_named_counts(counts, row_level))
        unique = [c for c in checks if c.model == model and c.test == "unique"]
        if unique:
            values = models[model].select(
                F.inline(F.array(*[F.struct(F.lit(i).alias("i"), F.col(c.column).cast("string").alias("v")) for i, c in enumerate(unique)]))
            )
            repeated = values.filter("v is not null").groupBy("i", "v").agg(F.count(F.lit(1)).alias("n")).filter("n > 1")
            counts = repeated.agg(*[F.count_if(F.col("i") == i).cast("long").alias(f"c{i}") for i in range(len(unique))])
            frames.append(_named_counts(counts, unique))
    frames += [run_check(c, models).failures_frame() for c in checks if c.test not in _ROW_LEVEL | {"unique"}]
    # Same two columns everywhere: union by position, pairwise, so each
    # step analyses a small plan instead of an ever longer chain.
    while len(frames) > 1:
        frames = [frames[i].union(frames[i + 1]) if i + 1 < len(frames) else frames[i] for i in range(0, len(frames), 2)]
    return frames[0]


def materialize(df: DataFrame, path: str) -> DataFrame:
    """Write ``df`` as a Parquet table at ``path`` and return a scan of it:
    later jobs read stored columns, with pruning and filter
    pushdown, and never recompute the lineage after a lost executor."""
    df.write.mode("overwrite").parquet(path)
    return df.sparkSession.read.parquet(path)


def build_models(
    spark: SparkSession, models: dict[str, DataFrame], declared: list[Model], path_of: Callable[[Model], str]
) -> dict[str, DataFrame]:
    """Write the declared models, those that do not need each other at once,
    and add scans of them to ``models``."""

    def task(m: Model) -> Task:
        def run() -> None:
            models[m.name] = materialize(m.build(models), path_of(m))

        return Task(m.name, m.needs, run)

    for outcome in run_tasks(spark, map(task, declared)).values():
        if outcome.error:
            raise outcome.error
    return models


class BuildFailed(RuntimeError):
    """A data-quality check returned rows."""


_PUBLISHED = "build_id string"
#: Published builds that stay, for readers that began on an older one.
KEPT_BUILDS = 5


def _warehouse_path(warehouse: str, *parts: str) -> str:
    return "/".join([warehouse.rstrip("/"), *parts])


def publish(spark: SparkSession, warehouse: str, build_id: str) -> None:
    """Make a build the one that readers see."""
    spark.createDataFrame([(build_id,)], _PUBLISHED).coalesce(1).write.mode("append").parquet(
        _warehouse_path(warehouse, "published")
    )


def published_build(spark: SparkSession, warehouse: str) -> str | None:
    """The id of the last published build (ids sort by time)."""
    try:
        return spark.read.schema(_PUBLISHED).parquet(_warehouse_path(warehouse, "published")).agg(F.max("build_id")).first()[0]
    except AnalysisException:  # nothing published yet
        return None


def read_mart(spark: SparkSession, warehouse: str, model: str) -> DataFrame:
    """A mart of the last published build."""
    build_id = published_build(spark, warehouse)
    if build_id is None:
        raise FileNotFoundError(f"no published build in {warehouse}")
    return spark.read.parquet(_warehouse_path(warehouse, "builds", build_id, model))


@dataclass
class BuildResult:
    models: dict[str, DataFrame]
    results: list[tuple[str, int]]
    build_id: str = ""

    @property
    def failed(self) -> list[tuple[str, int]]:
        return [(n, f) for n, f in self.results if f > 0]


def build(
    spark: SparkSession,
    raw_events: DataFrame,
    raw_products: DataFrame,
    raw_customers: DataFrame,
    warehouse: str,
    calendar: DataFrame | None = None,
    checks: list[Check] = CHECKS,
    fail_fast: bool = True,
    order_type: str = "order",
    staged_orders: DataFrame | None = None,
    staged_products: DataFrame | None = None,
    staged_customers: DataFrame | None = None,
) -> BuildResult:
    """Build every model and test it; what reads a model with failures is
    not built.

    ``calendar`` is the date dimension to publish (default: the fixed
    calendar range). ``staged_orders`` is an already staged orders table
    (see :mod:`evstar.streaming.stage`) used instead of deduplicating all raw
    events again; ``staged_products`` / ``staged_customers`` likewise replace
    the latest-snapshot views (see :mod:`evstar.plans.catalog_state`).
    Marts are read with :func:`read_mart`. A build that stops at a failing
    check publishes nothing; one that only reports (``fail_fast=False``)
    publishes whatever the checks say.
    """
    build_id = f"{dt.datetime.now(dt.timezone.utc):%Y%m%dT%H%M%S%f}-{uuid.uuid4().hex[:8]}"
    models: dict[str, DataFrame] = {
        "raw_events": raw_events,
        "raw_products": raw_products,
        "raw_customers": raw_customers,
        "calendar": calendar if calendar is not None else marts.dim_date(spark),
    }
    for name, df in (
        ("staged_orders", staged_orders),
        ("staged_products", staged_products),
        ("staged_customers", staged_customers),
    ):
        if df is not None:
            models[name] = df
    counts: dict[str, int] = {}
    declared = declared_models(order_type)

    def model_task(m: Model) -> Task:
        def run() -> None:
            folder = "staging/" + m.name if m.kind == "view" else m.name
            models[m.name] = materialize(m.build(models), _warehouse_path(warehouse, "builds", build_id, folder))

        # a model waits for the checks of what it reads
        return Task(m.name, tuple(n for d in m.needs for n in (d, f"checks of {d}")), run)

    def check_task(m: Model) -> Task:
        own = [c for c in checks if c.model == m.name]
        others = dict.fromkeys(c.args["to"] for c in own if c.test == "relationships")

        def run() -> None:
            if own:  # one job per model; one small row back per check
                counts.update((r["check"], int(r["failures"])) for r in failures_frame(own, models).collect())
            failing = [(c.name, counts[c.name]) for c in own if counts[c.name]]
            if failing and fail_fast:
                listed = ", ".join(f"{c} ({n} failing)" for c, n in failing)
                raise BuildFailed(f"model {m.name}: {listed}")

        return Task(f"checks of {m.name}", (m.name, *others), run)

    outcomes = run_tasks(spark, [t for m in declared for t in (model_task(m), check_task(m))])
    errors = [o.error for o in outcomes.values() if o.error]
    for error in errors:
        if not isinstance(error, BuildFailed):
            raise error
    if errors:
        skipped = [m.name for m in declared if outcomes[m.name].skipped_for]
        raise BuildFailed("; ".join(map(str, errors)) + (f"; skipped: {', '.join(skipped)}" if skipped else ""))
    publish(spark, warehouse, build_id)
    prune_builds(spark, warehouse)
    results = [(c.name, counts[c.name]) for m in declared for c in checks if c.model == m.name]
    return BuildResult(models, results, build_id)


def prune_builds(spark: SparkSession, warehouse: str, keep: int = KEPT_BUILDS) -> list[str]:
    """Remove the builds before the last ``keep`` published ones, failed ones
    among them, and the staging copies of all but the last; the builds
    removed."""
    folders = Folders(spark)
    published = spark.read.schema(_PUBLISHED).parquet(_warehouse_path(warehouse, "published")).distinct()
    last = [r[0] for r in published.orderBy(F.col("build_id").desc()).limit(keep).collect()]
    removed = []
    for build_id in folders.names(_warehouse_path(warehouse, "builds")):
        if build_id < min(last):  # ids sort by time
            folders.remove(_warehouse_path(warehouse, "builds", build_id))
            removed.append(build_id)
        elif build_id < max(last):
            folders.remove(_warehouse_path(warehouse, "builds", build_id, "staging"))
    return removed
