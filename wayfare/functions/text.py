"""Text expressions: percent formats, region codes, order keys, cleaning."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

CITY_PREFIX = "075"
ZERO_RATE = "0.0%"

#: Elements removed with all they hold, and tags that stand alone.
UNSAFE_ELEMENTS = ("script", "style", "iframe", "frameset", "object")
UNSAFE_TAGS = ("link", "embed", "base")
#: Attributes that may hold a script address.
ADDRESS_ATTRIBUTES = ("href", "src", "action")


def unsafe_patterns() -> list[str]:
    """Patterns of what runs or loads foreign code, in the order of removal.

    Names end at a word boundary and attributes begin after white space, so
    ``content=`` is no event handler and ``<linked>`` no link.
    """
    elements = [rf"(?is)<\s*{tag}\b[^>]*>.*?<\s*/\s*{tag}\s*>" for tag in UNSAFE_ELEMENTS]
    tags = [rf"(?i)<\s*{tag}\b[^>]*>" for tag in UNSAFE_TAGS]
    value = r"""(?:"[^"]*"|'[^']*'|[^\s>]*)"""
    handler = rf"(?i)\son[a-z]+\s*=\s*{value}"
    script = r"""(?:"\s*javascript:[^"]*"|'\s*javascript:[^']*'|javascript:[^\s>]*)"""
    address = rf"(?i)\s(?:{'|'.join(ADDRESS_ATTRIBUTES)})\s*=\s*{script}"
    return [*elements, *tags, handler, address]


def percent_rounded(part: Column, whole: Column) -> Column:
    """``33.33%`` / ``100.0%``; ``0.0%`` when there is no part."""
    rate = F.round(F.try_divide(part * F.lit(100), whole), 2)
    return F.when(F.coalesce(part, F.lit(0)) == 0, F.lit(ZERO_RATE)).otherwise(
        F.concat(rate.cast("string"), F.lit("%"))
    )


def percent_decimal(part: Column, whole: Column) -> Column:
    """Always two decimals, ``25.00%``; NULL when the whole is zero."""
    exact = F.try_divide(part.cast("decimal(20,0)") * F.lit(100), whole.cast("decimal(20,0)"))
    return F.concat(F.round(exact, 2).cast("decimal(20,2)").cast("string"), F.lit("%"))


def percent_raw(part: Column, whole: Column) -> Column:
    """Unrounded double, ``33.333333333333336%``; NULL when the whole is zero."""
    return F.concat(F.try_divide(part * F.lit(100), whole).cast("string"), F.lit("%"))


def region4(code: Column) -> Column:
    """City part of a six-digit address code; a missing code is the empty region."""
    return F.substring(F.coalesce(code, F.lit("")), 1, 4)


def region6(code4: Column) -> Column:
    return F.concat(code4, F.lit("00"))


def empty_if_null(value: Column) -> Column:
    return F.coalesce(value.cast("string"), F.lit(""))


def order_key(order_id: Column, prefix: str = CITY_PREFIX) -> Column:
    """Add the city prefix to a bare 32-character id; leave every other key as it is."""
    bare = (F.length(order_id) == 32) & ~order_id.startswith(f"{prefix}_")
    return F.when(bare, F.concat(F.lit(f"{prefix}_"), order_id)).otherwise(order_id)


def bare_order_id(key: Column, prefix: str = CITY_PREFIX) -> Column:
    return F.regexp_replace(key, f"^{prefix}_", "")


def strip_unsafe_html(html: Column) -> Column:
    for pattern in unsafe_patterns():
        html = F.regexp_replace(html, pattern, "")
    return html


def json_field(document: Column, name: str, default: str = "") -> Column:
    """One JSON field as text; missing or null gives the default."""
    return F.coalesce(F.get_json_object(document, f"$.{name}"), F.lit(default))
