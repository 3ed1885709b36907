"""Identifiers and message keys."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F


def padded_id(prefix: str, number: Column, width: int) -> Column:
    """``CUST`` and 7 become ``CUST00007``; longer numbers are kept whole."""
    digits = number.cast("string")
    padded = F.when(F.length(digits) < width, F.lpad(digits, width, "0")).otherwise(digits)
    return F.concat(F.lit(prefix), padded)


def conform_id(source: Column, prefix: str, width: int) -> Column:
    """Re-pad the trailing digits of an id to the canonical width.

    Ids without trailing digits pass through.
    """
    digits = F.regexp_extract(source, r"(\d+)$", 1)
    return F.when(F.length(digits) > 0, padded_id(prefix, digits, width)).otherwise(source)


def id_prefix(source: Column, length: int = 8) -> Column:
    """The first characters of an identifier, upper-cased: a short id cut from a longer one."""
    return F.upper(F.substring(source, 1, length))


def title_name(prefix: str, number: Column) -> Column:
    """A display name such as ``Product 7``, its words capitalised."""
    return F.initcap(F.concat_ws(" ", F.lit(prefix), number.cast("string")))


def message_key(op: Column, *ids: Column) -> Column:
    return F.concat_ws("_", op, *[i.cast("string") for i in ids])


def key_op(key: Column) -> Column:
    return F.split_part(key, F.lit("_"), F.lit(1))


def key_id(key: Column) -> Column:
    """What follows the first underscore."""
    return F.regexp_replace(key, r"^[^_]*_", "")


def key_partition(id_: Column, partitions: int) -> Column:
    """Partition by the entity id, so that all versions of one key stay in order.

    MD5 is used because every consumer, whatever its engine, can recompute it.
    """
    prefix = F.conv(F.substring(F.md5(id_.cast("string")), 1, 8), 16, 10).cast("long")
    return (prefix % F.lit(partitions)).cast("int")
