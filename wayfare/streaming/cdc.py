"""Change-data capture: envelopes to entity rows, newest image per id.

An envelope is JSON text in ``value``: ``table``, ``type`` (insert when missing),
``ts`` and ``data``. ``offset`` of the message breaks ties of ``ts``.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from wayfare.functions import keys as rowkeys
from wayfare.operators.latest import newest_per
from wayfare.operators.pinning import pin
from wayfare.sources import schema as sc

# Source tables; order tables are matched by prefix (they are sharded by name).
ORDER_TABLE, RENTER_TABLE, DRIVER_TABLE, ALLIANCE_TABLE = (
    "order_info", "renter_info", "driver_info", "opt_alliance_business",
)
TABLE_COLUMNS = {
    ORDER_TABLE: sc.CDC_ORDER, RENTER_TABLE: sc.CDC_RENTER, DRIVER_TABLE: sc.CDC_DRIVER,
    ALLIANCE_TABLE: sc.CDC_ALLIANCE,
}
DELETE_MODES = ("keep", "drop", "ignore")


def route(table: Column) -> Column:
    """Entity of a table name, NULL when nobody wants it."""
    target = F.when(table.startswith(ORDER_TABLE), F.lit(ORDER_TABLE))
    for name in (RENTER_TABLE, DRIVER_TABLE, ALLIANCE_TABLE):
        target = target.when(table == name, F.lit(name))
    return target


def with_reason(messages: DataFrame) -> DataFrame:
    """Every message with its opened fields and the reason it cannot be applied, NULL for a good one.

    The envelope is read once and its ``data`` once; whether a message is JSON at all
    is only asked where no field was found. Data spelled as text is read as an object.
    """
    read = messages.select("value", "offset", F.json_tuple("value", "table", "type", "ts", "data").alias("source_table", "_type", "_ts", "_text"))
    read = pin(read, data=F.from_json("_text", "map<string,string>"))
    table, entity = F.coalesce("source_table", F.lit("")), route(F.col("source_table"))
    known_id = F.coalesce(F.try_element_at("data", F.lit("id_")), F.lit(""))
    found = F.coalesce("source_table", "_type", "_ts", "_text").isNotNull()
    reason = (
        F.when(~found & F.get_json_object("value", "$").isNull(), F.lit("not_json"))
        .when(table == "", F.lit("no_table"))
        .when(entity.isNull(), F.lit("unknown_table"))
        .when(F.col("_text").isNull(), F.lit("no_data"))
        .when(known_id == "", F.lit("no_id"))
    )
    opened = {"entity": entity, "op": F.coalesce("_type", F.lit("insert")), "id": known_id, "ts": F.col("_ts").try_cast("bigint"), "reason": reason}
    return pin(read, **opened).drop("_type", "_ts", "_text")


OPENED = ("entity", "source_table", "op", "id", "ts", "offset", "data")


def split(marked: DataFrame) -> tuple[DataFrame, DataFrame]:
    """Opened messages to apply, and the others with their reason; every message is in one of them."""
    return marked.where(F.col("reason").isNull()).select(*OPENED), marked.where(F.col("reason").isNotNull()).select("value", "offset", "reason")


def quarantine(messages: DataFrame) -> DataFrame:
    return split(with_reason(messages))[1]


def parse(messages: DataFrame) -> DataFrame:
    """The opened form of every message that can be applied; ``quarantine`` has the others."""
    return split(with_reason(messages))[0]


def entity_rows(parsed: DataFrame, entity: str) -> DataFrame:
    """Rows of one entity with its columns; missing or null fields are empty text."""
    cells = [
        F.coalesce(F.try_element_at("data", F.lit(c)), F.lit("")).alias(c) for c in TABLE_COLUMNS[entity]
    ]
    return parsed.where(F.col("entity") == entity).select("id", "op", "ts", "offset", *cells)


def newest_images(rows: DataFrame, deletes: str = "keep") -> DataFrame:
    """Newest image per id.

    ``keep``: a delete counts as any other image; ``drop``: an id whose newest
    change is a delete disappears; ``ignore``: only inserts and updates count.
    """
    if deletes not in DELETE_MODES:
        raise ValueError(f"unknown delete mode {deletes!r}")
    if deletes == "ignore":
        rows = rows.where(F.col("op").isin("insert", "update"))
    values = [c for c in rows.columns if c not in ("id", "ts", "offset")]
    images = newest_per(rows, ["id"], ["ts", "offset"], values)
    if deletes == "drop":
        images = images.where(F.col("op") != "delete")
    return images


def images_by_mode(rows: DataFrame) -> DataFrame:
    """Newest images under every delete mode, with ``mode``, from one aggregation of the changes."""
    values = [c for c in rows.columns if c not in ("id", "ts", "offset")]
    change = F.struct("ts", "offset", *values)
    both = rows.groupBy("id").agg(
        F.max(change).alias("any"), F.max(F.when(F.col("op").isin("insert", "update"), change)).alias("kept"),
    )
    images = F.array(
        F.struct(F.lit("keep").alias("mode"), F.col("any").alias("image")),
        F.struct(F.lit("drop").alias("mode"), F.when(F.col("any.op") != "delete", F.col("any")).alias("image")),
        F.struct(F.lit("ignore").alias("mode"), F.col("kept").alias("image")),
    )
    return both.select("id", F.inline(images)).where(F.col("image").isNotNull()).select("mode", "id", "image.*")


def apply(messages: DataFrame, entity: str, deletes: str = "keep") -> DataFrame:
    """Current table of one entity, with its salted row key (salted once)."""
    images = newest_images(entity_rows(parse(messages), entity), deletes)
    return images.select(
        rowkeys.salted_key(F.col("id")).alias("rowkey"), "id", F.col("op").alias("operator_type"),
        *TABLE_COLUMNS[entity],
    )


def typed_alliance_roles(alliances: DataFrame) -> DataFrame:
    """Partner companies with their comma list of roles as an array."""
    return alliances.withColumn("alliance_role", F.split("alliance_role", ","))
