"""From messages to readings."""

from __future__ import annotations

from decimal import Decimal

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from gaugeline.functions.times import event_time, ingest_millis
from gaugeline.functions.values import decode_value, is_string_value
from gaugeline.sources import schemas


def open_stream(
    spark: SparkSession,
    kind: str = "kafka",
    schema: T.StructType | None = None,
    path: str | None = None,
    *,
    per_trigger: int | None,
    **options: str,
) -> DataFrame:
    """A stream of messages: ``kafka`` in production, a file format elsewhere.

    ``per_trigger`` caps the offsets (Kafka) or files of a micro-batch and must be chosen: the state of a batch has to
    fit its time. ``None`` takes all there is. Kafka fails on lost data unless told otherwise.
    """
    if kind == "kafka":
        settings = {"failOnDataLoss": "true", **options}
        if per_trigger is not None:
            settings["maxOffsetsPerTrigger"] = str(per_trigger)
        return spark.readStream.format("kafka").options(**settings).load()
    reader = spark.readStream.format(kind).options(**options)
    if per_trigger is not None:
        reader = reader.option("maxFilesPerTrigger", str(per_trigger))
    if schema is not None:
        reader = reader.schema(schema)
    return reader.load(path)


def _named(message: DataFrame) -> DataFrame:
    return message.withColumnsRenamed({"gatewayId": "gateway_id", "pointId": "point_id"})


def _text(value: str) -> Column:
    return F.col(value).cast("string")


# Readings of one message that the order of arrival tells apart; later ones share a place.
PLACES = 100_000


def topic_order() -> Column:
    """Place of a message in its topics: partition and offset, as one number. Topics and partitions have no
    order of their own; the same messages get the same numbers however they are read."""
    partition = F.pmod(F.xxhash64("topic", "partition"), F.lit(1_000_000_000)).cast("decimal(9,0)")
    offset = F.col("offset").cast("decimal(20,0)")
    return (partition * F.lit(Decimal(10**19)) + offset).cast("decimal(33,0)")


def file_order() -> Column:
    """Place of a row of a Parquet file: when the file was written, the file, and the row in it, as one number."""
    written = F.unix_millis("_metadata.file_modification_time").cast("decimal(13,0)")
    file = F.pmod(F.xxhash64("_metadata.file_path"), F.lit(1_000_000_000)).cast("decimal(9,0)")
    row = F.col("_metadata.row_index").cast("decimal(11,0)")
    return ((written * F.lit(Decimal(10**9)) + file).cast("decimal(22,0)") * F.lit(Decimal(10**11)) + row).cast("decimal(33,0)")


def with_order(messages: DataFrame, order: Column | None = None) -> DataFrame:
    """Adds ``arrival``, the place of a message in its source: ``order``, else that of Kafka's columns, if it has them."""
    if order is None and {"topic", "partition", "offset"} <= set(messages.columns):
        order = topic_order()
    return messages if order is None else messages.withColumn("arrival", order)


def parse_array(
    messages: DataFrame, value: str = "value", schema: T.StructType = schemas.WIRE
) -> DataFrame:
    """A JSON array of readings per message -> one row per reading.

    Where messages have ``arrival`` (see ``with_order``), readings get ``seq``: the message's place, then that in the array.
    """
    items = F.from_json(_text(value), T.ArrayType(schema))
    if "arrival" not in messages.columns:
        return _named(messages.select(F.explode(items).alias("item")).select("item.*"))
    placed = messages.select("arrival", F.posexplode(items).alias("place", "item"))
    place = F.least(F.col("place"), F.lit(PLACES - 1)).cast("decimal(5,0)")
    seq = F.col("arrival") * F.lit(Decimal(PLACES)) + place
    return _named(placed.select(seq.cast("decimal(38,0)").alias("seq"), "item.*"))


def parse_object(
    messages: DataFrame, value: str = "value", schema: T.StructType = schemas.WIRE_WIDE
) -> DataFrame:
    """One JSON object per message -> its fields."""
    return _named(messages.select(F.from_json(_text(value), schema).alias("item")).select("item.*"))


def unreadable(
    messages: DataFrame, value: str = "value", schema: T.DataType = T.ArrayType(schemas.WIRE)
) -> DataFrame:
    """Messages that are not JSON of the wanted shape; ``parse_array`` yields nothing for them."""
    layout = schema.elementType if isinstance(schema, T.ArrayType) else schema
    marked = T.StructType([*layout.fields, T.StructField("_corrupt", T.StringType())])
    wanted = T.ArrayType(marked) if isinstance(schema, T.ArrayType) else marked
    options = {"columnNameOfCorruptRecord": "_corrupt"}
    parsed = F.from_json(_text(value), wanted, options)
    if isinstance(schema, T.ArrayType):
        bad = parsed.isNull() | F.exists(parsed, lambda x: x.isNull() | x["_corrupt"].isNotNull())
    else:
        bad = parsed.isNull() | parsed["_corrupt"].isNotNull()
    return messages.filter(F.coalesce(bad, F.lit(True)))


def clean(readings: DataFrame, mark_ingest: bool = True) -> DataFrame:
    """Decode ``v``, drop text values and unreadable numbers, add ``event_time`` (and ``st``)."""
    typed = readings
    if dict(readings.dtypes)["v"] == "string":
        typed = typed.filter(~is_string_value(F.col("v"))).withColumn("v", decode_value(F.col("v")))
    typed = typed.withColumn("t", F.col("t").try_cast("bigint")).filter("v IS NOT NULL AND t IS NOT NULL")
    typed = typed.withColumn("event_time", event_time(F.col("t")))
    return typed.withColumn("st", ingest_millis()) if mark_ingest and "st" not in typed.columns else typed


def rejected(readings: DataFrame) -> DataFrame:
    """Readings ``clean`` leaves out although they are not text values."""
    raw = F.col("v")
    if dict(readings.dtypes)["v"] != "string":
        return readings.filter(F.col("t").isNull() | raw.isNull())
    return readings.filter(
        F.col("t").isNull()
        | raw.isNull()
        | (~is_string_value(raw) & decode_value(raw).isNull())
    )


def point_filter(readings: DataFrame, points: list[str]) -> DataFrame:
    return readings.filter(F.col("point_id").isin(points))
