"""The generalised LR repair against every edit script, and whole
conversations against a plain statement of the rules."""

import hashlib
import random
import re
import zlib
from itertools import product

import pytest
from hypothesis import given, settings
from hypothesis import strategies as st
from pyspark.sql import functions as F
from pyspark.sql import types as T

from conftest import SF_SMALL
from evstar.llm.conversation_repair import damage, repair_conversations
from evstar.llm.queries import op11_conversation_repair
from evstar.llm.role_parser import MUST_DELETE, RoleParser, Table, _codes

SCHEMA = "conv_id long, turn long, role string, text string"


def parse(classes):
    p = RoleParser().start()
    for c in classes:
        p.step(c)
    return p.finish()


def exhaustive(classes):
    """The least (cost, audit) over all edit scripts with at most two
    inserts before each row and at the end."""
    best = None
    todo = [(0, "", 0, "")]
    while todo:
        cost, audit, at, roles = todo.pop()
        if not re.fullmatch(r"s?(ua)*u?", roles) or (best and cost > best[0]):
            continue
        if at == len(classes) and re.fullmatch(r"(s?(ua)+)?", roles):
            best = min(best or (cost, audit), (cost, audit))
        if not audit.endswith("II"):
            todo += [(cost + 3, audit + "I", at, roles + r) for r in "ua"]
        if at < len(classes):
            c = classes[at]
            todo.append((cost + 4, audit + "D", at + 1, roles))
            if c != MUST_DELETE:
                extra = 3 if c.isupper() else 0
                todo.append((cost + extra, audit + "K", at + 1, roles + c.lower()))
                todo += [(cost + 3 + extra, audit + "R", at + 1, roles + r) for r in "ua"]
    return best


def chain(classes):
    """The same by a plain automaton, row by row with whole audits."""
    insert = {0: [(0, 0), (2, 1), (3, 2)], 1: [(1, 0), (2, 1), (3, 2)], 2: [(2, 0), (3, 1)], 3: [(3, 0), (2, 1)]}
    keep = {(0, "s"): 1, (0, "u"): 2, (1, "u"): 2, (3, "u"): 2, (2, "a"): 3}
    change = {0: 2, 1: 2, 3: 2, 2: 3}
    live = {0: (0, "")}
    for c in classes:
        new = {}
        for q, (cost, audit) in live.items():
            for q2, n in insert[q]:
                base, said = cost + 3 * n, audit + "I" * n
                moves = [(q2, 4, "D")]
                if c != MUST_DELETE:
                    extra = 3 if c.isupper() else 0
                    moves.append((change[q2], 3 + extra, "R"))
                    if (q2, c.lower()) in keep:
                        moves.append((keep[q2, c.lower()], extra, "K"))
                for to, more, edit in moves:
                    new[to] = min(new.get(to, (1 << 60, "")), (base + more, said + edit))
        live = new
    return min((cost + 3 * n, audit + "I" * n) for q, (cost, audit) in live.items() for q2, n in insert[q] if q2 in (0, 3))


def test_every_short_sequence_against_all_edit_scripts():
    for n in range(4):
        for classes in product("suaxSU-", repeat=n):
            assert parse(classes) == exhaustive(classes), classes


@given(st.text(alphabet="suaxSUAX-", max_size=60))
@settings(max_examples=400, deadline=None, derandomize=True)
def test_longer_sequences_against_the_automaton(classes):
    assert parse(classes) == chain(classes)


@pytest.mark.parametrize("unit", ["a", "u", "s", "x", "-", "ua", "A", "uua", "s-"])
def test_long_runs_of_one_pattern(unit):
    classes = (unit * 3000)[:3001]
    assert parse(classes) == chain(classes)


def test_configurations_stay_few_and_rows_cost_four_bytes():
    parser, rng = RoleParser(), random.Random(3)
    run = parser.start()
    for _ in range(200_000):
        run.step(rng.choice("suaxSUAX-"))
    assert len(parser._of) < 2_000 and run.made.itemsize * len(run.made) == 800_000
    assert len(run.finish()[1]) >= 200_000


def test_table_and_codes():
    table = Table()
    assert len(table.states) == 10 and table.follow["P"] == {"$", "u"}
    with pytest.raises(ValueError):
        Table([("S", "a"), ("S", "A"), ("A", "a")])
    texts = {"KKD", "KKRK", "KKRR", "KKRRI"}
    codes = _codes(texts)
    for a, b in product(texts, repeat=2):
        for x, y in product(["", "D", "K", "IK"], repeat=2):
            assert (a + x < b + y) == (codes[a] + x < codes[b] + y)


def plain(rows):
    """The contract, one conversation at a time."""
    out = {}
    for conv in {r[0] for r in rows}:
        kept = []
        for c, turn, role, text in rows:
            if c != conv:
                continue
            role, text = (" " if v is None else v for v in (role, text))
            kind = zlib.crc32(f"{' ' if c is None else c}:{' ' if turn is None else turn}".encode()) % 20
            if kind == 0:
                continue
            text = {1: "", 2: re.sub("[.!?]", "", text)}.get(kind, text)
            role = "user" if kind == 4 else role
            kept += [(turn, role, text)] * (2 if kind == 3 else 1)
        sha = lambda r: hashlib.sha256(f"{'-' if conv is None else f'+{conv}'}:{len(r[1])}:{r[1]}{r[2]}".encode()).digest()
        kept.sort(key=lambda r: (r[0] is not None, r[0] or 0, r[1], sha(r)))
        faults, classes, seen = [], [], set()
        for _, role, text in kept:
            last = re.sub(r"[\x20\x09-\x0D]", "", text)[-1:]
            fault = "blank" if not last else "duplicate" if (role, text) in seen else "truncated" if last not in ".!?" else ""
            seen.add((role, text))
            faults.append(fault)
            c = role[:1] if role[:1] in ("s", "u", "a") else "x"
            classes.append("-" if fault in ("blank", "duplicate") else c.upper() if fault else c)
        turns = {r[0] for r in kept} - {None}
        illegal = sum((a[1][:1] + b[1][:1]) not in ("su", "ua", "au") for a, b in zip(kept, kept[1:]))
        cost, audit = chain(classes)
        lines, at = [], 0
        for e in audit:
            expected = "assistant" if lines and lines[-1][0] == "u" else "user"
            if e == "I":
                lines.append(f"{expected}:")
                continue
            _, role, text = kept[at]
            at += 1
            if e != "D":
                lines.append(f"{role if e == 'K' else expected}:{text}")
        gaps = max(turns) - min(turns) + 1 - len(turns) if turns else 0
        counts = [faults.count(f) for f in ("blank", "duplicate", "truncated")]
        out[conv] = (gaps, *counts, illegal, cost, audit, hashlib.sha256("\n".join(lines).encode()).hexdigest())
    return out


def got(df):
    return {r[0]: tuple(r)[1:] for r in df.collect()}


def test_whole_table_against_the_rules(spark):
    table = spark.read.parquet(f"{SF_SMALL}/conversations.parquet")
    rows = [tuple(r) for r in table.select("conv_id", "turn", "role", "text").collect()]
    result = op11_conversation_repair(spark, SF_SMALL)
    assert result.columns[1:] == ["gaps", "blank", "duplicate", "truncated", "illegal", "cost", "audit", "repaired_sha256"]
    assert got(result) == plain(rows)


def awkward(seed, n):
    rng = random.Random(seed)
    texts = ["Yes.", "No", "", " \t", None, "Why?", "é!", "\x0b.", "long " * 2000 + "."]
    roles = ["user", "assistant", "system", "tool", "", None, "User"]
    return [(rng.choice([None, 1, 2, 3]), rng.choice([None, *range(12)]), rng.choice(roles), rng.choice(texts)) for _ in range(n)]


@pytest.mark.parametrize("seed", [1, 2])
def test_nulls_ties_and_repeats(spark, seed):
    rows = awkward(seed, 120)
    df = spark.createDataFrame(rows, SCHEMA).withColumn("kind", F.lit("x")).withColumn("digest", F.lit(1)).withColumn("salt", F.lit(2))
    assert got(repair_conversations(df.repartition(3))) == plain(rows)


def test_a_conversation_that_holds_most_rows(spark):
    rng = random.Random(5)
    rows = [(7, t, rng.choice(["user", "assistant", "assistant"]), f"Line {t % 400}.") for t in range(3000)]
    rows += [(c, t, "user", "Hello.") for c in range(20) for t in range(3)]
    assert got(repair_conversations(spark.createDataFrame(rows, SCHEMA).repartition(4))) == plain(rows)


def test_everything_dropped_and_empty_table(spark):
    dropped = next((c, t) for c in range(1000) for t in range(5) if zlib.crc32(f"{c}:{t}".encode()) % 20 == 0)
    df = spark.createDataFrame([(*dropped, "user", "Hi.")], SCHEMA)
    assert got(repair_conversations(df)) == {dropped[0]: (0, 0, 0, 0, 0, 0, "", hashlib.sha256(b"").hexdigest())}
    empty = spark.createDataFrame([], SCHEMA)
    assert repair_conversations(empty).collect() == [] and damage(empty).collect() == []


def test_other_id_types_and_no_planted_faults(spark):
    schema = T.StructType([T.StructField("conv_id", T.StringType()), T.StructField("turn", T.IntegerType()), T.StructField("role", T.StringType()), T.StructField("text", T.StringType())])
    df = spark.createDataFrame([("a", 0, "system", "Be brief."), ("a", 1, "user", "Hi."), ("a", 2, "assistant", "Hello."), (None, 0, "assistant", "Yes.")], schema)
    rows = {r["conv_id"]: r for r in repair_conversations(df, planted=False).collect()}
    assert (rows["a"]["audit"], rows["a"]["cost"]) == ("KKK", 0)
    assert rows["a"]["repaired_sha256"] == hashlib.sha256(b"system:Be brief.\nuser:Hi.\nassistant:Hello.").hexdigest()
    assert (rows[None]["audit"], rows[None]["cost"]) == ("IK", 3)


def test_texts_move_once_and_no_join_on_them(spark):
    plan = op11_conversation_repair(spark, SF_SMALL)._jdf.queryExecution().executedPlan().toString()
    assert "CartesianProduct" not in plan and "NestedLoop" not in plan and plan.count("SortMergeJoin") <= 1
