"""Layouts, declared in one place."""

from __future__ import annotations

from pyspark.sql import types as T

_S, _L, _D = T.StringType(), T.LongType(), T.DoubleType()


def _row(**fields: T.DataType) -> T.StructType:
    return T.StructType([T.StructField(name, kind) for name, kind in fields.items()])


# One reading of a message: typed values arrive as prefixed text.
WIRE = _row(gatewayId=_S, namespace=_S, pointId=_S, t=_L, s=_S, v=_S)

# A message that was cleaned before: numeric value and ingest time.
WIRE_CLEANED = _row(gatewayId=_S, namespace=_S, pointId=_S, t=_L, s=_S, st=_L, v=_D)

# The wide single-object message, all text.
WIRE_WIDE = _row(
    gatewayId=_S, internalSeriesId=_S, namespace=_S, pointId=_S, regions=_S, t=_S, v=_S, s=_S
)

# Rule document; ``instanceParams`` is itself JSON text.
RULE_DOCUMENT = T.StructType(
    [
        T.StructField(
            "data",
            T.ArrayType(
                T.StructType(
                    [
                        T.StructField("instanceParams", _S),
                        T.StructField("points", T.ArrayType(_row(id=_S, uri=_S))),
                    ]
                )
            ),
        )
    ]
)

# Keyed minute table. ``salt`` and ``year`` are partitions.
MINUTE_TABLE = _row(row_key=_S, v=_D, t=_L, st=_L, salt=T.IntegerType(), year=T.IntegerType())
