"""Key and JSON value, the layout of message topics."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

# Names in the JSON value and the reading columns behind them, in this order.
JSON_FIELDS = {
    "gatewayId": "gateway_id",
    "namespace": "namespace",
    "pointId": "point_id",
    "v": "v",
    "s": "s",
    "t": "t",
}
SHORT_FIELDS = ("pointId", "v", "t")


def keyed_json(readings: DataFrame, fields: Sequence[str] = tuple(JSON_FIELDS)) -> DataFrame:
    """``key`` = point, ``value`` = the reading as JSON. Works on batches and streams."""
    body = F.struct(*[F.col(JSON_FIELDS[name]).alias(name) for name in fields])
    return readings.select(F.col("point_id").alias("key"), F.to_json(body).alias("value"))


def write_topic(messages: DataFrame, kind: str = "kafka", path: str | None = None, **options: str) -> None:
    """Send ``key, value`` to a topic, or append them to files where there is no broker."""
    writer = messages.write.format(kind).options(**options)
    if kind == "kafka":
        writer.save()
    else:
        writer.mode("append").save(path)
