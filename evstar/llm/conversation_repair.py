"""Repair of conversation structure.

Rows of a conversation come by turn (nulls first), then role, then a digest of
role and text; rows equal in all of these are interchangeable. A row's class
(its role, and whether it must go or is cut short) is small, so the parse
works on narrow rows: one exchange by conversation, sorted, streamed through
the generalised LR parser of :mod:`role_parser`, which holds four bytes a row.
Repeats are found before that by a grouped minimum over digests, joined back
with a salt, so that a text repeated in a third of all rows is no hot key.

Texts move once: rows meet their conversation's audit in one exchange by
conversation and are hashed as they stream by. A SHA-256 over a whole
conversation has to be taken in order, so a conversation ends in one task, which
holds its audit (part of the result) and one row at a time.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator

import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from .common import ROWS_AT_A_TIME, stored, texts_of
from .role_parser import DELETE, INSERT, KEEP, MUST_DELETE, RoleParser

WHITE = " \t\n\x0b\x0c\r"
LEGAL = {"su", "ua", "au"}
FREE_ROLES = {"u": "user", "a": "assistant"}
#: Keys that a repeated text's rows are spread over.
SALTS = 16
COUNTS = ["gaps", "blank", "duplicate", "truncated", "illegal", "cost"]


def _text(c: str) -> Column:
    return F.coalesce(F.col(c).cast("string"), F.lit(" "))


def damage(conversations: DataFrame) -> DataFrame:
    """``conv_id, turn, role, text`` with faults planted by the remainder of
    crc32(``conv_id:turn``) by 20: 0 drops a row, 1 empties its text, 2 removes
    ``.!?``, 3 repeats it, 4 makes its role ``user``. Nulls count as one space
    (``conv_id`` and ``turn`` stay null in the result)."""
    kind = F.crc32(F.concat(_text("conv_id"), F.lit(":"), _text("turn")).cast("binary")) % 20
    rows = conversations.select("conv_id", F.col("turn").cast("long").alias("turn"), _text("role").alias("role"), _text("text").alias("text"), kind.alias("kind"))
    text = F.when(F.col("kind") == 1, "").when(F.col("kind") == 2, F.translate("text", ".!?", "")).otherwise(F.col("text"))
    role = F.when(F.col("kind") == 4, "user").otherwise(F.col("role"))
    copies = F.explode(F.sequence(F.lit(1), F.when(F.col("kind") == 3, 2).otherwise(1)))
    return rows.filter("kind <> 0").select("conv_id", "turn", role.alias("role"), text.alias("text"), copies.alias("copy")).drop("copy")


def _digest() -> Column:
    """Of conversation, role and text."""
    conv = F.coalesce(F.concat(F.lit("+"), F.col("conv_id").cast("string")), F.lit("-"))
    return F.unhex(F.sha2(F.concat(conv, F.lit(":"), F.length("role").cast("string"), F.lit(":"), F.col("role"), F.col("text")), 256))


def _narrow(rows: DataFrame) -> DataFrame:
    """What the parse needs of a row: its place, class and faults."""
    end = F.rtrim(F.col("text"), F.lit(WHITE))
    initial = F.substring("role", 1, 1)
    return rows.select(
        "conv_id",
        "turn",
        "role",
        _digest().alias("digest"),
        F.when(initial.isin("s", "u", "a"), initial).otherwise("x").alias("initial"),
        (end == "").alias("blank"),
        (~F.substring(end, -1, 1).isin(".", "!", "?")).alias("cut"),
    )


def _with_repeats(rows: DataFrame) -> DataFrame:
    """``rows`` with ``repeat``: an earlier turn has the same role and text."""
    place = F.struct(F.col("turn").isNotNull().alias("named"), "turn")
    first = rows.groupBy("digest").agg(F.min(place).alias("first"), F.count(F.lit(1)).alias("n")).filter("n > 1")
    first = first.select(F.col("digest").alias("of"), "first", F.explode(F.sequence(F.lit(0), F.lit(SALTS - 1))).alias("part"))
    salted = rows.withColumn("salt", F.pmod(F.monotonically_increasing_id(), F.lit(SALTS)).cast("int"))
    joined = salted.join(first, (F.col("digest") == F.col("of")) & (F.col("salt") == F.col("part")), "left")
    return joined.select(*rows.columns, F.coalesce(F.col("first") < place, F.lit(False)).alias("repeat"))


class _Scan:
    """Counts and parse of one conversation, row by row."""

    def __init__(self, conv_id: object, parser: RoleParser) -> None:
        self.conv_id, self.parse = conv_id, parser.start()
        self.low = self.high = self.turn = None
        self.distinct = self.blank = self.duplicate = self.truncated = self.illegal = 0
        self.last = self.place = None

    def row(self, turn: int | None, digest: bytes, initial: str, blank: bool, cut: bool, repeat: bool) -> None:
        if turn is not None and turn != self.turn:
            self.low = turn if self.low is None else self.low
            self.high = self.turn = turn
            self.distinct += 1
        repeat = repeat or self.place == (turn, digest)
        self.place = (turn, digest)
        if self.last is not None and self.last + initial not in LEGAL:
            self.illegal += 1
        self.last = initial
        if blank:
            self.blank += 1
        elif repeat:
            self.duplicate += 1
        elif cut:
            self.truncated += 1
            initial = initial.upper()
        self.parse.step(MUST_DELETE if blank or repeat else initial)

    def result(self) -> tuple:
        gaps = self.high - self.low + 1 - self.distinct if self.distinct else 0
        cost, audit = self.parse.finish()
        return self.conv_id, gaps, self.blank, self.duplicate, self.truncated, self.illegal, cost, audit


def _parsed(rows: DataFrame) -> DataFrame:
    """Counts and audit of every conversation that has rows."""
    ordered = rows.repartition("conv_id").sortWithinPartitions(
        "conv_id", F.col("turn").asc_nulls_first(), "role", "digest"
    )
    kind = rows.schema["conv_id"]
    schema = T.StructType([kind, *[T.StructField(c, T.LongType()) for c in COUNTS], T.StructField("audit", T.StringType())])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        parser, scan, done, id_type = RoleParser(), None, [], None

        def flush() -> pa.RecordBatch:
            columns = list(zip(*done)) or [[]] * len(schema)
            types = [id_type, *[pa.int64()] * len(COUNTS), pa.string()]
            done.clear()
            return pa.record_batch([pa.array(c, t) for c, t in zip(columns, types)], names=schema.fieldNames())

        for batch in batches:
            id_type = batch.schema.field(0).type
            columns = [batch.column(batch.schema.get_field_index(c)).to_pylist() for c in ("conv_id", "turn", "digest", "initial", "blank", "cut", "repeat")]
            for conv_id, *row in zip(*columns):
                if scan is None or conv_id != scan.conv_id:
                    if scan is not None:
                        done.append(scan.result())
                    scan = _Scan(conv_id, parser)
                scan.row(*row)
            if len(done) > ROWS_AT_A_TIME:
                yield flush()
        if scan is not None:
            done.append(scan.result())
            yield flush()

    return ordered.mapInArrow(run, schema)


class _Repair:
    """The repaired text of one conversation, hashed as its rows come."""

    def __init__(self, conv_id: object, parser: RoleParser) -> None:
        self.conv_id, self.parser = conv_id, parser
        self.counts: tuple = (0,) * len(COUNTS)
        self.audit, self.at, self.node, self.lines = "", 0, 0, 0
        self.sha = hashlib.sha256()

    def _line(self, role: str, text: str) -> None:
        self.sha.update((("\n" if self.lines else "") + role + ":" + text).encode("utf-8", "surrogatepass"))
        self.lines += 1
        self.node = self.parser.advance(self.node, role[:1])

    def _inserts(self) -> None:
        while self.audit[self.at : self.at + 1] == INSERT:
            self.at += 1
            self._line(FREE_ROLES[self.parser.free_role(self.node)], "")

    def row(self, role: str, text: str) -> None:
        self._inserts()
        edit = self.audit[self.at]
        self.at += 1
        if edit == KEEP:
            self._line(role, text)
        elif edit != DELETE:
            self._line(FREE_ROLES[self.parser.free_role(self.node)], text)

    def result(self) -> tuple:
        self._inserts()
        return self.conv_id, *self.counts, self.audit, self.sha.hexdigest()


def repair_conversations(conversations: DataFrame, planted: bool = True) -> DataFrame:
    """One row per ``conv_id``: ``gaps, blank, duplicate, truncated, illegal,
    cost, audit, repaired_sha256``. ``planted`` plants faults first.

    - A null ``conv_id`` is a conversation; null roles and texts are one
      space, so such a text is blank; null turns come first and count in no gap.
    - Rows of one turn come by role, then by digest; of equal rows all but
      one are duplicates.
    - A conversation without rows after the damage has zeros, an empty audit
      and the hash of the empty text; an empty table gives an empty result.
    - Roles whose initial is none of s, u, a can be changed or deleted only.
    - Other columns are ignored.
    """
    own = conversations.select("conv_id", "turn", "role", "text")
    rows = damage(own) if planted else own.select("conv_id", F.col("turn").cast("long").alias("turn"), _text("role").alias("role"), _text("text").alias("text"))
    narrow = stored(_narrow(rows), "conversation-rows")
    parsed = _parsed(_with_repeats(narrow))
    none = lambda c, t: F.lit(None).cast(t).alias(c)
    no_counts = [none(c, "long") for c in COUNTS]
    ids = own.select("conv_id").distinct().select(
        "conv_id", F.lit(0).alias("kind"), none("turn", "long"), none("role", "string"), none("digest", "binary"), none("text", "string"), *no_counts
    )
    found = parsed.select(
        "conv_id", F.lit(1).alias("kind"), none("turn", "long"), none("role", "string"), none("digest", "binary"), F.col("audit").alias("text"), *COUNTS
    )
    lines = rows.select("conv_id", F.lit(2).alias("kind"), "turn", "role", _digest().alias("digest"), "text", *no_counts)
    together = ids.unionByName(found).unionByName(lines).repartition("conv_id").sortWithinPartitions(
        "conv_id", "kind", F.col("turn").asc_nulls_first(), "role", "digest"
    ).drop("digest", "turn")
    schema = T.StructType(
        [own.schema["conv_id"], *[T.StructField(c, T.LongType()) for c in COUNTS], T.StructField("audit", T.StringType()), T.StructField("repaired_sha256", T.StringType())]
    )

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        parser, repair, done, id_type = RoleParser(), None, [], None

        def flush() -> pa.RecordBatch:
            columns = list(zip(*done)) or [[]] * len(schema)
            types = [id_type, *[pa.int64()] * len(COUNTS), pa.string(), pa.string()]
            done.clear()
            return pa.record_batch([pa.array(c, t) for c, t in zip(columns, types)], names=schema.fieldNames())

        for batch in batches:
            id_type = batch.schema.field(0).type
            index = batch.schema.get_field_index
            convs, kinds, roles = (batch.column(index(c)).to_pylist() for c in ("conv_id", "kind", "role"))
            for start, texts in texts_of(batch, "text"):
                for k, text in enumerate(texts, start):
                    if kinds[k] == 0:
                        if repair is not None:
                            done.append(repair.result())
                        repair = _Repair(convs[k], parser)
                    elif kinds[k] == 1:
                        repair.counts = tuple(batch.column(index(c))[k].as_py() for c in COUNTS)
                        repair.audit = text
                    else:
                        repair.row(roles[k], text)
            if len(done) > ROWS_AT_A_TIME:
                yield flush()
        if repair is not None:
            done.append(repair.result())
            yield flush()

    return together.mapInArrow(run, schema)
