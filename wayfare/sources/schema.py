"""Entities: column lists, DDL of the raw text layer, typed layer.

The raw layer holds text only and writes a missing cell as ``''``. ``typed``
turns empty text into NULL and casts with ``try_cast``, so a bad cell becomes
NULL instead of failing the job under ANSI rules.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

# Column names and order of each entity.
ORDER = {
    "id": "string", "create_time": "timestamp", "pay_all": "double", "open_lng": "double",
    "open_lat": "double", "begin_address_code": "string", "charge_mileage": "double",
    "city_name": "string", "vehicle_license": "string", "driver_id": "string",
    "driver_name": "string", "cancel": "int", "close_gps_time": "timestamp",
}
RENTER = {
    "id": "string", "create_time": "timestamp", "last_login_city": "string",
    "last_logon_time": "timestamp", "city_name": "string",
}
DRIVER = {
    "id": "string", "create_time": "timestamp", "register_city": "string", "driver_name": "string",
    "mobile": "string", "driver_type": "string", "cancel_count": "int", "driver_management_id": "string",
}
ALLIANCE = {
    "id_": "string", "alliance_name": "string", "organization_code": "string", "alliance_role": "string",
    "linkman": "string", "contact_number": "string", "create_user": "string", "create_time": "timestamp",
    "update_user": "string", "update_time": "timestamp", "state": "string", "del_state": "string",
}
HOT_AREA = {"create_time": "timestamp", "open_lat": "double", "open_lng": "double", "begin_address_code": "string"}
STATION_ORDER = {
    "order_id": "string", "city_id": "string", "starting_lng": "double", "starting_lat": "double",
}
GPS_POINT = {
    "driver_id": "string", "order_id": "string", "epoch": "bigint", "lng": "double", "lat": "double",
    "is_end": "boolean",
}
# The 24 tab-separated fields of an order line.
ORDER_LINE = (
    "order_id", "product_id", "city_id", "district", "county", "type", "combo_type", "traffic_type",
    "passenger_count", "driver_product_id", "start_dest_distance", "arrive_time", "departure_time",
    "pre_total_fee", "normal_time", "bubble_trace_id", "product_1level", "dest_lng", "dest_lat",
    "starting_lng", "starting_lat", "year", "month", "day",
)
# Change-data columns per table (beside table, operation and id).
CDC_ORDER = (
    "pay_all", "pay_normal", "create_time", "open_lng", "open_lat", "begin_address_code",
    "charge_mileage", "city_name", "vehicle_license", "driver_id", "driver_name", "cancel", "state",
    "order_type", "work_flow", "close_gps_time", "cancel_time", "pay_time",
)
CDC_RENTER = ("create_time", "last_login_city", "last_logon_time", "city_name")
CDC_DRIVER = (
    "create_time", "register_city", "driver_name", "mobile", "driver_type", "cancel_count",
    "driver_management_id",
)
CDC_ALLIANCE = (
    "alliance_name", "organization_code", "alliance_role", "linkman", "contact_number", "create_user",
    "create_time", "update_user", "update_time", "state", "del_state",
)
# Domain codes.
CANCEL_CODES = {0: "none", 1: "user", 2: "driver", 3: "timeout"}
CITY_CODES = {"chengdu": "075", "xian": "233", "haikou": "125"}

ENTITIES = {
    "order": ORDER, "renter": RENTER, "driver": DRIVER, "alliance": ALLIANCE, "hot_area": HOT_AREA,
    "station_order": STATION_ORDER,
}
DEFAULT_FAMILY = "MM"


def raw_ddl(entity: str) -> str:
    return ", ".join(f"{name} string" for name in ENTITIES[entity])


def raw_schema(ddl: str | None) -> T.StructType:
    """Schema of a raw table from its DDL; one ``id`` column when none is given."""
    return T.StructType.fromDDL(ddl) if ddl else T.StructType.fromDDL("id string")


def null_as_empty(df: DataFrame) -> DataFrame:
    """Raw layer: every column text, missing cells as empty text."""
    return df.select(*[F.coalesce(F.col(c).cast("string"), F.lit("")).alias(c) for c in df.columns])


def _typed_cell(name: str, kind: str) -> Column:
    cell = F.nullif(F.col(name), F.lit(""))
    return (cell if kind == "string" else cell.try_cast(kind)).alias(name)


def typed(raw: DataFrame, entity: str) -> DataFrame:
    """Typed layer of a raw text frame; columns it lacks are left out."""
    kinds = ENTITIES[entity]
    return raw.select(*[_typed_cell(n, k) for n, k in kinds.items() if n in raw.columns])


def stringify(df: DataFrame) -> DataFrame:
    """Serving shape: every column cast to string."""
    return df.select(*[F.col(c).cast("string").alias(c) for c in df.columns])


def null_default(df: DataFrame, defaults: dict[str, object]) -> DataFrame:
    return df.fillna(defaults)
