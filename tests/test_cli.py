import json
import os

from evstar.__main__ import main
from evstar.plans.pipeline import Layout
from evstar.streaming.ingest import ingest
from helpers import land, message_rows, order, stream


def test_cli_snapshot_load_build_inspect(spark, tmp, capsys):
    root = f"{tmp}/deploy"
    layout = Layout(root)
    os.makedirs(f"{tmp}/exports")
    with open(f"{tmp}/exports/products.json", "w") as f:
        json.dump([{"product_id": "P1", "product_name": "Lamp", "category": "Home", "unit_price": 10.0}], f, indent=2)
    with open(f"{tmp}/exports/customers.json", "w") as f:
        json.dump([{"customer_id": "C1", "full_name": "Ann", "email": "a@x.org", "city": "Oslo",
                    "country": "Norway", "signup_date": "2025-01-02"}], f, indent=2)
    assert main(["snapshot", "--root", root, "--name", "products", "--file", f"{tmp}/exports/products.json", "--date", "2026-09-01"]) == 0
    assert main(["snapshot", "--root", root, "--name", "customers", "--file", f"{tmp}/exports/customers.json", "--date", "2026-09-01"]) == 0

    land(spark, message_rows([order("e1", "O1"), order("e1", "O1"), "junk"]), f"{tmp}/topic")
    ingest(stream(spark, f"{tmp}/topic"), layout.lake, layout.dead_letter, layout.checkpoint("ingest")).awaitTermination()
    assert main(["load", "--root", root]) == 0
    assert main(["build", "--root", root]) == 0
    out = capsys.readouterr().out
    assert "loaded 2 rows" in out and "PASS unique:fact_orders.order_id (0)" in out

    assert main(["inspect-lake", "--root", root]) == 0
    out = capsys.readouterr().out
    assert "files=1 rows=2 events=1 repeated=1" in out and "payload\tstring" in out and "order\t2" in out


def test_cli_run_with_substituted_topic(spark, tmp, capsys, monkeypatch):
    import evstar.__main__ as cli

    root = f"{tmp}/deploy"
    layout = Layout(root)
    from test_pipeline import write_catalogs

    write_catalogs(spark, layout)
    land(spark, message_rows([order("e1", "O1"), order("e2", "O2", "C2", "P2"), "junk"]), f"{tmp}/topic")
    monkeypatch.setattr(cli, "_topic_stream", lambda spark_, args: stream(spark_, f"{tmp}/topic"))
    assert main(["run", "--root", root, "--calendar-from-data", "--incremental-staging", "--incremental-catalogs"]) == 0
    out = capsys.readouterr().out
    assert out.count("PASS ") == 36 and "FAIL" not in out
    assert main(["ingest", "--root", root]) == 0  # nothing new: drains and stops
    assert spark.read.parquet(layout.lake).count() == 2


def test_cli_inspect_topic_with_substituted_read(spark, capsys, monkeypatch):
    import evstar.__main__ as cli

    rows = [(b"C1", 0), (b"C1", 0), (b"P7", 1), (b"P7", 2), (None, 1)]
    df = spark.createDataFrame(rows, "key binary, partition int")
    monkeypatch.setattr(cli.topic, "read_topic", lambda *a, **k: df)
    assert main(["inspect-topic"]) == 0
    out = capsys.readouterr().out
    assert "keys=2 keyless=1" in out and "  0\t2\n  1\t2\n  2\t1\n" in out and "P7\t[1, 2]" in out


def test_reports_print_every_row(spark, capsys, monkeypatch):
    import evstar.__main__ as cli

    df = spark.range(60).selectExpr("cast(concat('K', id div 2) as binary) as key", "cast(id % 2 as int) as partition")
    monkeypatch.setattr(cli.topic, "read_topic", lambda *a, **k: df)
    assert main(["inspect-topic"]) == 0
    out = capsys.readouterr().out
    assert out.count("[0, 1]") == 30


def test_batch_rule_only_for_a_query_that_keeps_running(monkeypatch):
    from types import SimpleNamespace

    import evstar.__main__ as cli

    seen = []
    monkeypatch.setattr(cli.topic, "read_topic", lambda spark, servers, name, **k: seen.append(k))
    args = dict(bootstrap_servers="b", topic="t", min_partitions=None, max_rows_per_batch=10)
    for extra in ({"continuous": True}, {"continuous": False}, {}):
        cli._topic_stream(None, SimpleNamespace(**args, **extra))
    assert [k["flush_rows"] for k in seen] == [cli.topic.FLUSH_ROWS, None, None]


def test_a_broken_export_does_not_replace_a_snapshot(spark, tmp):
    import pytest

    from evstar.sources.catalogs import read_snapshots

    good, record = f"{tmp}/good.json", {"product_id": "P1", "product_name": "Lamp", "category": "Home", "unit_price": 10.0}
    with open(good, "w") as f:
        json.dump([record], f)
    args = ["snapshot", "--root", f"{tmp}/deploy", "--name", "products", "--date", "2026-09-01", "--file"]
    assert main([*args, good]) == 0
    for text in (json.dumps([record])[:40], "[]", '[{"product_name": "no id"}]', '[{"product_id": "P1", "unit_price": "ten"}]'):
        with open(f"{tmp}/bad.json", "w") as f:
            f.write(text)
        with pytest.raises(Exception):
            main([*args, f"{tmp}/bad.json"])
    rows = read_snapshots(spark, Layout(f"{tmp}/deploy").catalogs, "products").collect()
    assert [r.product_name for r in rows] == ["Lamp"]
