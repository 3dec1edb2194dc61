"""Column expressions. All of them stay in generated JVM code."""

from __future__ import annotations

from collections.abc import Iterable

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

HASH_SPACE = 1 << 24


def require_columns(frame: DataFrame, names: Iterable[str]) -> None:
    """Spark ignores unknown names in rename and drop; this makes them an error."""
    unknown = [name for name in names if name not in frame.columns]
    if unknown:
        raise ValueError(f"no such column: {', '.join(unknown)}; have {', '.join(frame.columns)}")


def named(name: str) -> Column:
    """The column of exactly this name, dots and spaces included."""
    return F.col("`" + name.replace("`", "``") + "`")


def _is_floating(frame: DataFrame, name: str) -> bool:
    return isinstance(frame.schema[name].dataType, (T.DoubleType, T.FloatType))


def is_missing(frame: DataFrame, name: str) -> Column:
    """Null, or NaN where the type has one."""
    column = named(name)
    return column.isNull() | F.isnan(column) if _is_floating(frame, name) else column.isNull()


def missing_to_null(frame: DataFrame, name: str) -> Column:
    column = named(name)
    return F.when(~F.isnan(column), column) if _is_floating(frame, name) else column


def ratio(numerator: str, denominator: str) -> Column:
    """Division that gives null for a missing operand or a zero divisor."""
    return F.try_divide(named(numerator), named(denominator))


def row_text(frame: DataFrame, leave_out: Iterable[str] = ()) -> Column:
    """All columns of a row as one text, in the order of their names; a null is ``\\0``.

    Maps, which have no order, are left out.
    """
    own = sorted(set(frame.columns) - set(leave_out))
    kinds = {field.name: field.dataType.simpleString() for field in frame.schema.fields}
    parts = [
        F.coalesce((named(c) if "<" not in kinds[c] else F.to_json(F.struct(named(c)))).cast("string"), F.lit("\\0"))
        for c in own
        if "map<" not in kinds[c]
    ]
    return F.concat_ws("|", *parts)


def hash_position(key: Column, salt: str = "") -> Column:
    """A key's fixed position in ``[0, HASH_SPACE)``: the first 24 bits of its MD5.

    A missing key has a position too, that of the empty text, so no row is lost.
    """
    text = F.coalesce(key.cast("string"), F.lit(""))
    digest = F.md5(F.concat(F.lit(salt), text) if salt else text)
    return F.conv(F.substring(digest, 1, 6), 16, 10).cast("long")
