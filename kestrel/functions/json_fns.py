"""JSON / variant functions."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from .numeric import nan_to_null


def to_payload(df: DataFrame, columns: list[str] | None = None) -> Column:
    """K9: the whole row as JSON text; NaN -> null, null fields kept."""
    cols = columns or df.columns
    fields = []
    for name in cols:
        dtype = df.schema[name].dataType
        value = nan_to_null(F.col(name)) if isinstance(dtype, (T.DoubleType, T.FloatType)) else F.col(name)
        fields.append(value.alias(name))
    return F.to_json(F.struct(*fields), {"ignoreNullFields": "false"})


def json_field(payload: Column | str, path: str, type_name: str = "string") -> Column:
    """Typed field of JSON text via VARIANT; null when absent or of another type."""
    payload = F.col(payload) if isinstance(payload, str) else payload
    return F.try_variant_get(F.try_parse_json(payload), path, type_name)
