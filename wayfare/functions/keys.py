"""Row-key expressions: hash-salted, md5-prefixed and plain keys."""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column
from pyspark.sql import functions as F

DEFAULT_BUCKETS = 8
_UINT32 = 0xFFFFFFFF


def string_hash32(text: Column) -> Column:
    """The 31-polynomial string hash, kept as an unsigned 32-bit value in a bigint.

    Characters are taken as code points, which equals the usual hash for all
    text of the basic plane (ids, plates and codes are ASCII).
    """
    codes = F.transform(F.split(text, ""), lambda ch: F.ascii(ch).cast("bigint"))
    return F.aggregate(
        codes,
        F.lit(0).cast("bigint"),
        lambda acc, code: (acc * F.lit(31) + code).bitwiseAND(F.lit(_UINT32)),
    )


def salt_bucket(text: Column, buckets: int = DEFAULT_BUCKETS) -> Column:
    return string_hash32(text).bitwiseAND(F.lit(0x7FFFFFFF)) % F.lit(buckets)


def salted_key(text: Column, buckets: int = DEFAULT_BUCKETS) -> Column:
    """Four-digit bucket followed by the first twelve md5 hex digits."""
    bucket = F.lpad(salt_bucket(text, buckets).cast("string"), 4, "0")
    return F.concat(bucket, F.substring(F.md5(text.cast("binary")), 1, 12))


def plain_key(*parts: Column) -> Column:
    return F.concat_ws("", *parts)


def hash_prefixed_key(*parts: Column) -> Column:
    """Two bytes of the 15-bit hash, then the text, as binary."""
    text = plain_key(*parts)
    prefix = F.lpad(F.hex(string_hash32(text).bitwiseAND(F.lit(0x7FFF))), 4, "0")
    return F.concat(F.unhex(prefix), text.cast("binary"))


def md5_prefixed_key(separator: str, length: int, *parts: Column) -> Column:
    """At least 8 and at most 32 md5 digits, then the joined text."""
    text = F.concat_ws(separator, *parts)
    digits = max(8, min(int(length), 32))
    return F.concat_ws(separator, F.substring(F.md5(text.cast("binary")), 1, digits), text)


def joined_key(*parts: Column) -> Column:
    """``a_b_c``: the key of a track point or an order line."""
    return F.concat_ws("_", *parts)


def record_map(columns: list[str]) -> Column:
    """Named columns of a row as a string map, missing values as empty text."""
    pairs = reduce(
        lambda acc, name: acc + [F.lit(name), F.coalesce(F.col(name).cast("string"), F.lit(""))],
        columns,
        [],
    )
    return F.create_map(*pairs)


def record_json(columns: list[str]) -> Column:
    return F.to_json(F.struct(*[F.col(c) for c in columns]))
