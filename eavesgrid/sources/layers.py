"""Reading footprint layers and their attribute tables."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from ..functions.geometry import BBOX, from_wkt
from ..operators.preprocessing import with_geometry

CORRUPT = "_corrupt_record"


def read_layer(
    spark: SparkSession,
    path: str,
    schema: T.StructType | str | None = None,
    fmt: str = "parquet",
    wkt: str | None = None,
    srid: int | None = None,
    on_bad: str = "keep",
) -> DataFrame:
    """A layer with ``geom``, the bbox columns and ``is_box``.

    ``wkt`` names a text column to parse; without it the file has ``geom`` already.  Rows that cannot be parsed are
    kept with a NULL geometry, dropped, or make the job fail: ``on_bad`` = keep, drop or raise.
    """
    if on_bad not in ("keep", "drop", "raise"):
        raise ValueError(f"on_bad must be keep, drop or raise, got {on_bad!r}")
    reader = spark.read
    if fmt == "csv":
        if schema is None:
            raise ValueError("a CSV layer needs a schema")
        schema = T.StructType.fromDDL(schema) if isinstance(schema, str) else schema
        with_bad = T.StructType([*schema.fields, T.StructField(CORRUPT, T.StringType())])
        df = reader.schema(with_bad).option("header", True).option("mode", "PERMISSIVE").option("escape", '"').option(
            "columnNameOfCorruptRecord", CORRUPT
        ).csv(path)
    else:
        df = (reader.schema(schema) if schema is not None else reader).format(fmt).load(path)
    if wkt is None and "geom" not in df.columns:
        raise ValueError(f"the file at {path} has no geometry column")
    if wkt is not None:
        df = df.withColumn("geom", from_wkt(F.col(wkt))).drop(wkt)
    return finish_layer(df, srid, on_bad)


def finish_layer(df: DataFrame, srid: int | None = None, on_bad: str = "keep") -> DataFrame:
    """bbox, rectangle flag and coordinate system of a frame that has ``geom``."""
    if on_bad == "drop":
        df = df.where(F.col("geom").isNotNull())
    elif on_bad == "raise":
        message = F.lit("a row has no valid geometry")
        df = df.withColumn("geom", F.when(F.col("geom").isNull(), F.raise_error(message)).otherwise(F.col("geom")))
    if not set(BBOX) <= set(df.columns) or "is_box" not in df.columns:
        df = with_geometry(df)
    return set_srid(df, srid) if srid is not None else df


def set_srid(df: DataFrame, srid: int) -> DataFrame:
    return df.withMetadata("geom", {"srid": srid})


def srid_of(df: DataFrame) -> int | None:
    return df.schema["geom"].metadata.get("srid")


def same_srid(left: DataFrame, right: DataFrame) -> None:
    """Fail early when two layers declare different coordinate systems."""
    a, b = srid_of(left), srid_of(right)
    if a is not None and b is not None and a != b:
        raise ValueError(f"layers use different coordinate systems: {a} and {b}")


ROOF_COLUMNS = ("batiment_groupe_id", "mat_toit_txt")


def scan_roof_csv(spark: SparkSession, path: str) -> DataFrame:
    """The two roof columns of a comma-separated file with a header, bound by name in any order.

    The header is read first, so that the scan itself can run with an explicit all-string schema and only parse the
    two columns.
    """
    header = spark.read.option("header", True).option("inferSchema", False).csv(path)
    missing = [c for c in ROOF_COLUMNS if c not in header.columns]
    if missing:
        raise ValueError(f"the roof file lacks the columns {missing}")
    return header.select(*ROOF_COLUMNS)
