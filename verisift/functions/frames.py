"""Small frames built from literals, entirely on the JVM side.

Rule lists, orderings and threshold tables are configuration (a handful to a
few hundred rows). ``spark.createDataFrame(list)`` would ship them through a
Python RDD and start Python workers at run time, and building them from
``F.lit`` columns costs one gateway call per value. A single ``VALUES`` query
is one call and resolves to a local relation.
"""

from __future__ import annotations

import math
from functools import lru_cache
from typing import Any, Iterable, Sequence, Union

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import types as T


@lru_cache(maxsize=256)
def _parse(schema: str) -> T.StructType:
    parsed = T._parse_datatype_string(schema)
    if not isinstance(parsed, T.StructType):
        raise TypeError(f"not a struct schema: {schema!r}")
    return parsed


def _sql_literal(v: Any) -> str:
    if v is None:
        return "NULL"
    if isinstance(v, bool):
        return "true" if v else "false"
    if isinstance(v, int):
        return str(v)
    if isinstance(v, float):
        if math.isnan(v) or math.isinf(v):
            return f"double('{v}')"
        return repr(v) + "D"
    text = str(v).replace("\\", "\\\\").replace("'", "\\'")
    return f"'{text}'"


def literal_frame(
    spark: SparkSession, rows: Iterable[Sequence[Any]], schema: Union[str, T.StructType]
) -> DataFrame:
    """A DataFrame holding ``rows`` (tuples in schema order) as literals."""
    st = schema if isinstance(schema, T.StructType) else _parse(schema)
    rows = list(rows)
    cols = ", ".join(
        f"cast(col{i + 1} as {f.dataType.simpleString()}) as `{f.name}`"
        for i, f in enumerate(st.fields)
    )
    if not rows:
        nulls = ", ".join("NULL" for _ in st.fields)
        return spark.sql(f"select {cols} from values ({nulls}) where false")
    values = ", ".join("(" + ", ".join(_sql_literal(v) for v in row) + ")" for row in rows)
    return spark.sql(f"select {cols} from values {values}")


def empty_frame(spark: SparkSession, schema: Union[str, T.StructType]) -> DataFrame:
    return literal_frame(spark, [], schema)
