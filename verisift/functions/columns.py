"""Column-expression helpers shared by every check.

Everything here returns a ``Column`` built from ``pyspark.sql.functions`` so the
expressions stay JVM-side and inside whole-stage codegen. Null semantics follow
SQL three-valued logic on purpose: a predicate that evaluates to NULL neither
selects a row (filter) nor counts it (``count_if``), exactly like ``WHERE``.
"""

from __future__ import annotations

from functools import reduce
from typing import Iterable, Optional, Union

from pyspark.sql import Column
from pyspark.sql import functions as F
from pyspark.sql import types as T

Predicate = Union[str, Column, None]

_INTEGRAL = (T.ByteType, T.ShortType, T.IntegerType, T.LongType)


def qcol(name: str) -> Column:
    """A column by its exact name (back-quoted, so dots or spaces are literal)."""
    return F.col("`" + name.replace("`", "``") + "`")


def sql_str(text: str) -> str:
    """A Spark SQL string literal (default escaping: backslash sequences)."""
    return "'" + str(text).replace("\\", "\\\\").replace("'", "\\'") + "'"


def sql_ident(name: str) -> str:
    return "`" + name.replace("`", "``") + "`"


def as_predicate(pred: Predicate) -> Optional[Column]:
    """A SQL predicate string or a Column; ``None``/empty means "no filter"."""
    if pred is None:
        return None
    if isinstance(pred, Column):
        return pred
    text = pred.strip()
    return F.expr(text) if text else None


def all_of(*preds: Predicate) -> Column:
    """AND of the given predicates, each kept as its own parenthesised term.

    The reference concatenated filter text without parentheses (``a OR b AND
    c``); combining Column objects keeps every caller predicate intact.
    """
    cols = [c for c in (as_predicate(p) for p in preds) if c is not None]
    if not cols:
        return F.lit(True)
    return reduce(lambda a, b: a & b, cols)


def any_of(cols: Iterable[Column]) -> Column:
    cols = list(cols)
    if not cols:
        return F.lit(False)
    return reduce(lambda a, b: a | b, cols)


def is_missing(col: Union[str, Column], check_empty: bool = False) -> Column:
    """NULL, or (with ``check_empty``) a value that is empty after TRIM.

    ``trim`` strips spaces only, like SQL ``TRIM`` with no character list.
    """
    c = F.col(col) if isinstance(col, str) else col
    if check_empty:
        return c.isNull() | (F.trim(c) == F.lit(""))
    return c.isNull()


def not_blank(col: Union[str, Column]) -> Column:
    """``TRIM(col) <> ''`` — NULL for a NULL input (three-valued)."""
    c = F.col(col) if isinstance(col, str) else col
    return F.trim(c) != F.lit("")


def typed(col: Union[str, Column], cast_to: Optional[str]) -> Column:
    """``TRY_CAST(col AS cast_to)``: unparsable text becomes NULL, never an error."""
    c = F.col(col) if isinstance(col, str) else col
    return c.try_cast(cast_to) if cast_to else c


def rate(num: Column, den: Column) -> Column:
    """``num / den * 100`` as double, 0.0 when the denominator is not positive."""
    return F.when(den > 0, num.cast("double") / den * F.lit(100.0)).otherwise(F.lit(0.0))


def pct(num: Column, den: Column, digits: int = 2) -> Column:
    """Rounded percentage with the reference's zero-denominator guard."""
    return F.when(den > 0, F.round(num.cast("double") / den * F.lit(100.0), digits)).otherwise(
        F.lit(0.0)
    )


def count_where(cond: Column) -> Column:
    """Rows for which ``cond`` is TRUE (NULL is not counted)."""
    return F.count_if(cond)


def sum_long(col: Column) -> Column:
    """SUM that is 0 (not NULL) over no rows, as BIGINT."""
    return F.coalesce(F.sum(col), F.lit(0)).cast("bigint")


def key_family(dtype: T.DataType) -> Optional[str]:
    """Type all keys of a fused join are cast to, or None if they must not be fused.

    Integral keys compare exactly as BIGINT and strings as strings. Anything
    else (decimal, float, date, binary...) keeps its own per-rule join so no
    cast can change which values are equal.
    """
    if isinstance(dtype, _INTEGRAL):
        return "bigint"
    if isinstance(dtype, T.StringType):
        return "string"
    return None


def common_key_type(left: T.DataType, right: T.DataType) -> Optional[str]:
    """Cast target under which two key columns can share a fused join.

    Keys of different types (a number against a text) are compared as text, as
    concept codes are: native equality would raise on a text that is no number.
    """
    lf, rf = key_family(left), key_family(right)
    if lf is not None and lf == rf:
        return lf
    if left != right and not (_is_number(left) and _is_number(right)):
        return "string"
    return None


def _is_number(dtype: T.DataType) -> bool:
    return isinstance(dtype, T.NumericType)
