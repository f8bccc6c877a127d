"""Values as JSON carries them: ISO dates and times, decimals as floats, nulls kept."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F
from pyspark.sql import types as T


def iso_text(column: Column, data_type: T.DataType) -> Column:
    """ISO text; a time gets its fraction only if it has one, and its offset if zoned."""
    if isinstance(data_type, T.DateType):
        return F.date_format(column, "yyyy-MM-dd")
    whole = F.date_format(column, "yyyy-MM-dd'T'HH:mm:ss")
    fraction = F.date_format(column, ".SSSSSS")
    text = F.concat(whole, F.when(fraction != ".000000", fraction).otherwise(""))
    if isinstance(data_type, T.TimestampType):
        text = F.concat(text, F.date_format(column, "xxx"))
    return text


def json_value(column: Column, data_type: T.DataType) -> Column:
    if isinstance(data_type, T.DecimalType):
        return column.cast("double")
    if isinstance(data_type, (T.DateType, T.TimestampType, T.TimestampNTZType)):
        return iso_text(column, data_type)
    if isinstance(data_type, T.ArrayType):
        return F.transform(column, lambda item: json_value(item, data_type.elementType))
    if isinstance(data_type, T.StructType):
        fields = F.struct(
            *(json_value(column[f.name], f.dataType).alias(f.name) for f in data_type)
        )
        return F.when(column.isNotNull(), fields)
    return column


def json_object(df_schema: T.StructType, columns) -> Column:
    """One JSON text with the given columns, in that order."""
    fields = [json_value(F.col(c), df_schema[c].dataType).alias(c) for c in columns]
    return F.to_json(F.struct(*fields), {"ignoreNullFields": "false"})
