"""Event envelope: validation, field extraction and serialisation.

Cost per message, all JVM-side: one strict parse (``try_parse_json``) to
decide validity, one key scan (``json_object_keys``) for presence, and one
``from_json`` pass that returns the four envelope fields as text.

JSON parsers stop after the first value, so a text like ``{...} x`` would
pass. The strict parse therefore reads the text as the first of two array
elements, the second being the text's own digest: anything after the first
value moves, breaks or hides the digest.
"""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

# The keys every event must carry (sorted, as reported) and
# the quarantine error texts.
ENVELOPE_FIELDS = ["event_id", "event_timestamp", "event_type", "payload"]
ERR_EMPTY = "empty message"
ERR_UTF8 = "invalid UTF-8"
ERR_JSON = "invalid JSON"
ERR_NOT_OBJECT = "message is not a JSON object"
ERR_MISSING_PREFIX = "missing fields: "

_ENVELOPE_SCHEMA = "event_id string, event_type string, event_timestamp string, payload string"


def _col(c: str | Column) -> Column:
    return F.col(c) if isinstance(c, str) else c


def message_text(value: str | Column) -> Column:
    """Message bytes (BINARY from a topic) or text as STRING, unvalidated."""
    return _col(value).cast("string")


def _closed(value: str | Column) -> Column:
    """VARIANT of the array ``[message, digest of the message]``; NULL when
    the text is not exactly one JSON value."""
    text = message_text(value)
    digest = F.md5(text.cast("binary"))
    parsed = F.try_parse_json(F.concat(F.lit("["), text, F.lit(',"'), digest, F.lit('"]')))
    return F.when(F.try_variant_get(parsed, "$[1]", "string") == digest, parsed)


def parse_envelope(value: str | Column) -> Column:
    """VARIANT of the message, NULL when it is not exactly one JSON value.

    Strict: text after the value, NaN literals and duplicate keys count as
    invalid JSON.
    """
    return F.try_variant_get(_closed(value), "$[0]", "variant")


def message_keys(value: str | Column) -> Column:
    """Top-level keys of a JSON object; NULL for any other JSON value."""
    return F.json_object_keys(message_text(value))


def missing_fields(value: str | Column, fields: list[str] = ENVELOPE_FIELDS) -> Column:
    """Required keys absent from the message, in ``fields`` order. A key
    holding JSON null is present; a non-object misses them all."""
    keys = F.coalesce(message_keys(value), F.array().cast("array<string>"))
    return F.array_except(F.array(*[F.lit(f) for f in fields]), keys)


def message_error(value: str | Column, fields: list[str] = ENVELOPE_FIELDS) -> Column:
    """Why a message is rejected, or NULL when it is a valid event.

    Order of checks: no value, undecodable bytes, not (strict) JSON, not an
    object, required keys missing (reported sorted, Python-list style).
    """
    text = message_text(value)
    missing = missing_fields(value, sorted(fields))
    listed = F.concat(
        F.lit("["),
        F.array_join(F.transform(missing, lambda x: F.concat(F.lit("'"), x, F.lit("'"))), ", "),
        F.lit("]"),
    )
    return (
        F.when(_col(value).isNull(), F.lit(ERR_EMPTY))
        .when(~F.is_valid_utf8(text), F.lit(ERR_UTF8))
        .when(_closed(value).isNull(), F.lit(ERR_JSON))
        .when(
            F.size(missing) > 0,
            F.when(message_keys(value).isNull(), F.lit(ERR_NOT_OBJECT)).otherwise(
                F.concat(F.lit(ERR_MISSING_PREFIX), listed)
            ),
        )
    )


def parse_fields(value: str | Column) -> Column:
    """STRUCT of the four envelope fields as text, from one ``from_json`` pass."""
    return F.from_json(message_text(value), _ENVELOPE_SCHEMA)


def envelope_columns(value: str | Column, fields: str | Column | None = None) -> list[Column]:
    """The four envelope fields as STRING columns (F1).

    ``fields`` is a column already holding :func:`parse_fields` (so the
    text is decoded once however many fields are read); by default it is
    computed here. Non-string values are kept as their JSON text. The
    payload is kept as JSON text whatever its type: objects and arrays in
    their original key order, a string with its quotes, ``null`` for a JSON
    null; a number passes through a double, and one beyond its range becomes
    the string ``"Infinity"``. Unknown top-level keys are dropped.
    """
    env = parse_fields(value) if fields is None else (F.col(fields) if isinstance(fields, str) else fields)
    text = env["payload"]
    null_payload = text.isNull() & F.array_contains(message_keys(value), "payload")
    # from_json gives a string payload without its quotes: put them back.
    kind = F.schema_of_variant(F.try_variant_get(_closed(value), "$[0].payload", "variant"))
    quoted = F.to_json(F.struct(text.alias("p")))
    payload = F.when(kind == "STRING", F.substr(quoted, F.lit(6), F.length(quoted) - 6)).otherwise(text)
    return [
        env["event_id"].alias("event_id"),
        env["event_type"].alias("event_type"),
        env["event_timestamp"].alias("event_timestamp"),
        F.when(null_payload, F.lit("null")).otherwise(payload).alias("payload"),
    ]


def quarantine_value(value: str | Column) -> Column:
    """Lossy text of the raw message for the dead-letter record."""
    return F.make_valid_utf8(message_text(value))


def envelope_json(event_id: Column, event_type: Column, event_timestamp: Column, payload: Column) -> Column:
    """Serialise an event envelope to JSON text for publishing.

    ``payload`` is a STRUCT, MAP or VARIANT column.
    """
    return F.to_json(
        F.struct(
            event_id.alias("event_id"),
            event_type.alias("event_type"),
            event_timestamp.alias("event_timestamp"),
            payload.alias("payload"),
        )
    )
