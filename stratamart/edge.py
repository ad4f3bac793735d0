"""Formats at the edge: how results leave the warehouse.

Inside, days are dates and money is decimal.  Reports carry days and times as
text, amounts as doubles, counts as bigint and lists as sorted text.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, functions as F, types as T

from stratamart.functions.columns import day_text, second_text

WHOLE = (T.ByteType, T.ShortType, T.IntegerType)


def present(df: DataFrame) -> DataFrame:
    out = []
    for field in df.schema.fields:
        c, kind = F.col(f"`{field.name}`"), field.dataType
        if isinstance(kind, T.DateType):
            c = day_text(c)
        elif isinstance(kind, (T.TimestampType, T.TimestampNTZType)):
            c = second_text(c)
        elif isinstance(kind, (T.DecimalType, T.FloatType)):
            c = c.cast("double")
        elif isinstance(kind, WHOLE):
            c = c.cast("bigint")
        elif isinstance(kind, T.ArrayType):
            item = F.transform(c, lambda x: F.concat_ws(":", *[x[f] for f in kind.elementType.names])) if isinstance(
                kind.elementType, T.StructType
            ) else c.cast("array<string>")
            c = F.array_join(F.array_sort(item), ",")
        out.append(c.alias(field.name))
    return df.select(*out)
