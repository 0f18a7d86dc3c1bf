"""Key columns: hashed surrogate keys and topic message keys."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

# Fixed values (must equal the reference's for identical keys): the
# surrogate-key convention hashes each part cast to string, NULL replaced by
# this token, parts joined by "-", with MD5 over the joined text.
SURROGATE_NULL_TOKEN = "_dbt_utils_surrogate_key_null_"
SURROGATE_SEPARATOR = "-"


def _col(c: str | Column) -> Column:
    return F.col(c) if isinstance(c, str) else c


def surrogate_key(*cols: str | Column) -> Column:
    """MD5 hex of the key parts, NULL-safe and order-sensitive.

    ``surrogate_key("customer_id")`` == ``md5(coalesce(cast(customer_id as
    string), '<token>'))``. Pure JVM expression: no shuffle, codegen'd.
    """
    if not cols:
        raise ValueError("surrogate_key needs at least one column")
    parts = [F.coalesce(_col(c).cast("string"), F.lit(SURROGATE_NULL_TOKEN)) for c in cols]
    joined = parts[0] if len(parts) == 1 else F.concat_ws(SURROGATE_SEPARATOR, *parts)
    return F.md5(joined)


def message_key(customer_id: str | Column = "customer_id", product_id: str | Column = "product_id") -> Column:
    """Topic key (F17): the customer when present and non-empty, else the product.

    Same customer -> same key -> same topic partition -> ordered events.
    """
    return F.coalesce(F.nullif(_col(customer_id), F.lit("")), _col(product_id))


def stable_uuid(*cols: str | Column) -> Column:
    """UUID-formatted id (8-4-4-4-12 hex) derived from the row's content.

    Unlike ``uuid()``, a retried task produces the same id for the same
    row, so a re-published row keeps its id and the staging dedup can
    recognise it. Rows with equal content share an id.
    """
    h = surrogate_key(*cols)
    return F.concat_ws(
        "-",
        F.substring(h, 1, 8),
        F.substring(h, 9, 4),
        F.substring(h, 13, 4),
        F.substring(h, 17, 4),
        F.substring(h, 21, 12),
    )
