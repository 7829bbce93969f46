"""Python values as Spark literals of the type of the column they meet."""

from __future__ import annotations

import datetime as dt
import math
import re
from decimal import Decimal, InvalidOperation
from typing import Any

from pyspark.sql import Column, DataFrame, Row, functions as F, types as T

_PLACEHOLDER = re.compile(r"'(?:[^'\\]|\\.)*'|\"(?:[^\"\\]|\\.)*\"|`[^`]*`|\?")


def column_type(df: DataFrame, name: str) -> T.DataType:
    """Type of a (possibly alias-qualified) column; only the schema is looked at."""
    return df.select(F.col(name)).schema[0].dataType


def _number(text: str, name: str) -> int | float | Decimal:
    try:
        value = Decimal(text.strip())
    except InvalidOperation:
        raise ValueError(f"{text!r} is not a number, but column {name} is numeric") from None
    return int(value) if value == value.to_integral_value() else value


def _fitted(value: int | float | Decimal, dtype: T.DataType) -> int | float | Decimal:
    """A number in a form that does not make Spark convert the column: 8.0 meets a bigint as 8."""
    finite = math.isfinite(value)
    if isinstance(dtype, T.IntegralType) and finite and value == int(value):
        return int(value)
    if isinstance(dtype, T.DecimalType) and isinstance(value, float) and finite:
        return Decimal(repr(value))
    return int(value) if isinstance(value, bool) else value


def _moment(value: Any, dtype: T.DataType, name: str) -> Column:
    text = value.isoformat(sep=" ") if isinstance(value, dt.datetime) else str(value).strip()
    try:
        parsed = dt.datetime.fromisoformat(text)
    except ValueError:
        raise ValueError(f"{text!r} is not a date or time, but column {name} holds {dtype.simpleString()}") from None
    if isinstance(dtype, T.TimestampType) and parsed.tzinfo is None:
        text = parsed.isoformat(sep=" ") + "+00:00"
    return F.lit(text).cast(dtype)


def typed_literal(value: Any, dtype: T.DataType, name: str = "") -> Column:
    """``value`` as a literal that can be compared with a column of type ``dtype``.

    Casting the literal (never the column) keeps the predicate pushable to the scan. A value that cannot take the
    column's type is refused here, before any job starts.
    """
    if isinstance(dtype, T.NumericType):
        if isinstance(value, str):
            return F.lit(_number(value, name))
        if isinstance(value, (int, float, Decimal)):
            return F.lit(_fitted(value, dtype))
        raise ValueError(f"{value!r} cannot be compared with numeric column {name}")
    if isinstance(dtype, T.BooleanType):
        if isinstance(value, (bool, int)) and value in (0, 1):
            return F.lit(bool(value))
        if isinstance(value, str) and value.strip().lower() in ("true", "false", "1", "0"):
            return F.lit(value.strip().lower() in ("true", "1"))
        raise ValueError(f"{value!r} cannot be compared with boolean column {name}")
    if isinstance(dtype, (T.DateType, T.TimestampType, T.TimestampNTZType)):
        return _moment(value, dtype, name)
    if isinstance(dtype, T.StringType):
        return F.lit(value if isinstance(value, str) else str(value))
    return F.lit(value)


def stored_literal(value: Any, dtype: T.DataType, name: str = "") -> Column:
    """``value`` as a literal to be stored in a column of type ``dtype``: the same readings as in predicates, to any depth.

    Text adapts to the type, whole numbers of any Python type fit integers, a moment without an offset is UTC. What does not
    fit is refused before any job starts.
    """
    if value is None:
        return F.lit(None).cast(dtype)
    if isinstance(dtype, T.ArrayType):
        if isinstance(value, (str, bytes, dict)):
            raise ValueError(f"{value!r} is no list, but column {name} is")
        return F.array(*[stored_literal(x, dtype.elementType, name) for x in value]).cast(dtype)
    if isinstance(dtype, T.StructType):
        given = value.asDict() if isinstance(value, Row) else value if isinstance(value, dict) else dict(zip(dtype.names, value))
        return F.struct(*[stored_literal(given.get(f.name), f.dataType, f"{name}.{f.name}").alias(f.name) for f in dtype.fields]).cast(dtype)
    if isinstance(dtype, T.MapType):
        pairs = [stored_literal(x, t, name) for k, v in value.items() for x, t in ((k, dtype.keyType), (v, dtype.valueType))]
        return F.create_map(*pairs).cast(dtype)
    if isinstance(dtype, T.BinaryType):
        return F.lit(bytes(value) if isinstance(value, (bytes, bytearray)) else str(value).encode()).cast(dtype)
    if isinstance(dtype, (T.FloatType, T.DoubleType)) and isinstance(value, str):
        return F.lit(float(value)).cast(dtype)
    if isinstance(dtype, T.IntegralType):
        number = _number(value, name) if isinstance(value, str) else value
        if not isinstance(number, (int, float, Decimal)) or number != int(number):
            raise ValueError(f"{value!r} is not a whole number, but column {name} is {dtype.simpleString()}")
        return F.lit(int(number)).cast(dtype)
    return typed_literal(value, dtype, name).cast(dtype)


def _sql_text(value: Any) -> str:
    if value is None:
        return "NULL"
    if isinstance(value, bool):
        return "true" if value else "false"
    if isinstance(value, float):
        return f"{value!r}D" if value == value and abs(value) != float("inf") else f"double('{value!r}')"
    if isinstance(value, (int, Decimal)):
        return str(value)
    if isinstance(value, dt.datetime):
        return f"timestamp'{value.isoformat(sep=' ')}'" if value.tzinfo else f"timestamp_ntz'{value.isoformat(sep=' ')}'"
    if isinstance(value, dt.date):
        return f"date'{value.isoformat()}'"
    if isinstance(value, str):
        return "'" + value.replace("\\", "\\\\").replace("'", "\\'") + "'"
    raise ValueError(f"cannot bind a value of type {type(value).__name__}")


def bind(text: str, values: tuple) -> Column:
    """Expression text with every ``?`` outside quotes replaced by the next value."""
    remaining = list(values)

    def fill(match: re.Match) -> str:
        if match.group() != "?":
            return match.group()
        if not remaining:
            raise ValueError(f"more placeholders than values in {text!r}")
        return _sql_text(remaining.pop(0))

    bound = _PLACEHOLDER.sub(fill, text) if values else text
    if remaining:
        raise ValueError(f"more values than placeholders in {text!r}")
    return F.expr(bound)
