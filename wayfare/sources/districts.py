"""District lists from a nested district tree or from GeoJSON."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

_DISTRICT = "name string, citycode string, level string, polyline string"
TREE_DDL = f"districts array<struct<{_DISTRICT}, districts array<struct<{_DISTRICT}>>>>"
GEOJSON_DDL = (
    "type string, features array<struct<properties: struct<name: string>, "
    "geometry: struct<type: string, coordinates: array<array<array<array<double>>>>>>>"
)


def flatten_tree(documents: DataFrame, city_code: str | None = None) -> DataFrame:
    """Documents (one JSON text in ``value``) to ``citycode, name, polygon``.

    A node of level city is replaced by its children, a node of level district
    is kept when it has a polygon. With a city code, only that city's.
    """
    top = documents.select(F.explode(F.from_json("value", TREE_DDL)["districts"]).alias("d"))
    below = F.when(F.col("d.level") == "city", F.col("d.districts")).when(
        F.col("d.level") == "district",
        F.array(F.struct(*[F.col(f"d.{c}").alias(c) for c in ("name", "citycode", "level", "polyline")])),
    )
    flat = top.select(F.explode(below).alias("d")).where(
        (F.col("d.level") == "district") & F.col("d.polyline").isNotNull()
    )
    if city_code:
        flat = flat.where(F.col("d.citycode") == city_code)
    return flat.select(
        F.col("d.citycode").alias("citycode"), F.col("d.name").alias("name"), F.col("d.polyline").alias("polygon")
    )


def read_documents(spark: SparkSession, path: str) -> DataFrame:
    """Whole files as documents, without a byte-order mark."""
    text = spark.read.option("wholetext", True).text(path)
    return text.select(F.regexp_replace("value", "^\ufeff", "").alias("value"))


def flatten_geojson(documents: DataFrame) -> DataFrame:
    """FeatureCollections of MultiPolygons to ``citycode, name, polygon``.

    Each ring becomes one part of the polygon text; parts combine even-odd.
    """
    features = documents.select(F.explode(F.from_json("value", GEOJSON_DDL)["features"]).alias("f"))
    rings = F.flatten(F.col("f.geometry.coordinates"))
    ring_text = F.transform(
        rings,
        lambda ring: F.array_join(
            F.transform(ring, lambda p: F.concat_ws(",", p[0].cast("string"), p[1].cast("string"))), ";"
        ),
    )
    return features.select(
        F.lit(None).cast("string").alias("citycode"),
        F.col("f.properties.name").alias("name"),
        F.array_join(ring_text, "|").alias("polygon"),
    )
