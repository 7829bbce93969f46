"""Strict conversion of text, number and JSON columns to typed columns.

Every converter is a ``Column`` expression over one column of known type; nothing runs in Python per row. A value that
does not fit raises when the row is read (``on_error="raise"``) or becomes null (``on_error="null"``); null stays null.
Text without an offset is UTC, and no result depends on the session time zone.
"""

from __future__ import annotations

import re
from typing import Mapping, Sequence

from pyspark.sql import Column, DataFrame, functions as F, types as T

from .columns import let
from .literals import column_type

# Text forms accepted besides ISO 8601, tried in this order.
OTHER_DATE_TIME_FORMATS = (
    "M/d/yyyy H:m:s",
    "M/d/yyyy H:m",
    "M/d/yyyy h:m:s a",
    "M/d/yyyy h:m a",
    "M/d/yyyy",
    "yyyy/M/d H:m:s",
    "yyyy/M/d H:m",
    "yyyy/M/d",
    "d MMM yyyy H:m:s",
    "d MMM yyyy",
    "yyyy-M-d H:m:s",
    "yyyy-M-d H:m",
    "yyyy-M-d",
    "d-MMM-yyyy H:m:s",
    "d-MMM-yyyy",
    "MMM d, yyyy H:m:s",
    "MMM d, yyyy",
    "MMMM d, yyyy H:m:s",
    "MMMM d, yyyy",
)

#: ISO with an offset that lacks its colon.
_BARE_OFFSET = r"^(\d{4}-\d{2}-\d{2}[ T].*[+-]\d{2})(\d{2})$"
_BLANKS = " \t\n\x0b\x0c\r\x85\xa0"
_ISO = r"^\d{4}-\d{2}-\d{2}([ T]\d{2}:\d{2}(:\d{2}(\.\d{1,9})?)?)?( ?(Z|z|[+-]\d{2}:\d{2}))?$"
_OFFSET = r"(?i)( ?(Z|UTC|GMT|[+-]\d{2}:\d{2}))$"
_NO_SECONDS = r"^(.{10}[ T]\d{2}:\d{2})((?: ?(?:Z|z|[+-]\d{2}:\d{2}))?)$"
_SECONDS = r"(?::[0-5]\d(?:\.\d{1,7})?)?"
_TIME_24 = rf"^(?:[01]?\d|2[0-3]):[0-5]\d{_SECONDS}$"
_TIME_12 = rf"^(?:0?[1-9]|1[0-2]):[0-5]\d{_SECONDS} ?[AaPp][Mm]$"
_DECIMAL = r"^(?:[+-]?(?:\d[\d,]*(?:\.\d*)?|\.\d+)|(?:\d[\d,]*(?:\.\d*)?|\.\d+)[+-])$"
_DOUBLE = r"^[+-]?(?:\d[\d,]*(?:\.\d*)?|\.\d+)(?:[eE][+-]?\d+)?$"
_DOUBLE_NAMES = r"(?i)^[+-]?(?:nan|infinity)$"
_INTEGER = r"^[+-]?\d+$"
_HEX = "[0-9a-fA-F]"
_UUID = f"{_HEX}{{8}}-{_HEX}{{4}}-{_HEX}{{4}}-{_HEX}{{4}}-{_HEX}{{12}}"
_UUID_FORMS = rf"^(?:{_UUID}|\{{{_UUID}\}}|\({_UUID}\)|{_HEX}{{32}})$"
_MICROS_PER_DAY = 86_400_000_000


class _Target:
    """What to do with a value that does not fit."""

    def __init__(self, kind: str, on_error: str):
        if on_error not in ("raise", "null"):
            raise ValueError(f"on_error is 'raise' or 'null', not {on_error!r}")
        self.kind, self.on_error = kind, on_error

    def refuse(self, value: Column, dtype: T.DataType) -> Column:
        if self.on_error == "null":
            return F.lit(None).cast(dtype)
        shown = F.coalesce(value.cast("string"), F.lit("null"))
        return F.raise_error(F.concat(F.lit(f"not a valid {self.kind}: '"), shown, F.lit("'"))).cast(dtype)

    def checked(self, value: Column, result: Column, dtype: T.DataType) -> Column:
        """``result`` where it is not null; a null result of a non-null value is a value that does not fit."""
        return F.coalesce(result.cast(dtype), F.when(value.isNotNull(), self.refuse(value, dtype)))


def _text(value: Column) -> Column:
    return F.btrim(value.cast("string"), F.lit(_BLANKS))


def _wrong_input(kind: str, dtype: T.DataType) -> ValueError:
    return ValueError(f"a {dtype.simpleString()} column cannot become {kind}")


def to_bool(value: Column, dtype: T.DataType, on_error: str = "raise") -> Column:
    """Numbers: not zero. Text: ``1``, ``0``, ``true``, ``false`` in any case."""
    if isinstance(dtype, T.BooleanType):
        return value
    if isinstance(dtype, (T.FloatType, T.DoubleType)):
        return (value != 0) & ~F.isnan(value)
    if isinstance(dtype, T.NumericType):
        return value != 0
    if not isinstance(dtype, T.StringType):
        raise _wrong_input("bool", dtype)
    text = F.lower(_text(value))
    answer = F.when(text.isin("1", "true"), True).when(text.isin("0", "false"), False)
    return _Target("bool", on_error).checked(value, answer, T.BooleanType())


def _shape(form: str) -> str:
    """The pattern text must have before a date-time format is tried on it: a failed parse is dear, a look is cheap."""
    tokens = {"yyyy": r"\d{4}", "MMMM": "[A-Za-z]{3,9}", "MMM": "[A-Za-z]{3}", "a": "[AaPp][Mm]"}
    parts = [tokens.get(t, r"\d{1,2}" if t.isalpha() else t) for t in re.findall(r"[A-Za-z]+|[^A-Za-z]", form)]
    return rf"^(?:[A-Za-z]{{3,9}}, )?{''.join(parts)}(?: ?(?:Z|UTC|GMT))?$"


def _instant(text: Column) -> Column:
    """Text to an instant, null when no accepted form fits."""
    text = F.regexp_replace(text, _BARE_OFFSET, "$1:$2")
    seconds_added = F.when(text.rlike(_NO_SECONDS), F.regexp_replace(text, _NO_SECONDS, "$1:00$2")).otherwise(text)
    with_offset = (
        F.when(text.rlike(_OFFSET), seconds_added)
        .when(F.length(text) == 10, F.concat(text, F.lit("T00:00:00Z")))
        .otherwise(F.concat(seconds_added, F.lit("Z")))
    )
    plain = F.regexp_replace(text, r"(?i)^[a-z]{3,9}, |( ?(Z|UTC|GMT))$", "")
    found = F.when(text.rlike(_ISO), with_offset.try_cast("timestamp"))
    for form in OTHER_DATE_TIME_FORMATS:
        parsed = F.try_to_timestamp(F.concat(plain, F.lit(" Z")), F.lit(f"{form} X"))
        found = found.when(text.rlike(_shape(form)), parsed)
    return found


def to_timestamp_utc(value: Column, dtype: T.DataType, on_error: str = "raise") -> Column:
    """An instant. An offset in the text is respected; without one the text is UTC."""
    if isinstance(dtype, T.TimestampType):
        return value
    if isinstance(dtype, (T.TimestampNTZType, T.DateType)):
        text = value.cast("string")
        return F.concat(text, F.lit("Z") if isinstance(dtype, T.TimestampNTZType) else F.lit("T00:00:00Z")).cast("timestamp")
    if not isinstance(dtype, T.StringType):
        raise _wrong_input("timestamp", dtype)
    return _Target("timestamp", on_error).checked(value, _instant(_text(value)), T.TimestampType())


def _utc_date(instant: Column) -> Column:
    return F.date_from_unix_date(F.floor(F.unix_micros(instant) / F.lit(_MICROS_PER_DAY)).cast("int"))


def to_date(value: Column, dtype: T.DataType, on_error: str = "raise") -> Column:
    """A date, or the UTC date of a timestamp."""
    if isinstance(dtype, (T.DateType, T.TimestampNTZType)):
        return value.cast("date")
    if isinstance(dtype, T.TimestampType):
        return _utc_date(value)
    if not isinstance(dtype, T.StringType):
        raise _wrong_input("date", dtype)
    return _Target("date", on_error).checked(value, _utc_date(_instant(_text(value))), T.DateType())


def to_time(value: Column, dtype: T.DataType, on_error: str = "raise") -> Column:
    """Time of day as ``HH:mm:ss`` text, with the fraction appended only when there is one."""
    if isinstance(dtype, (T.TimestampType, T.TimestampNTZType)):
        if isinstance(dtype, T.TimestampType):
            micros = F.unix_micros(value)
            seconds = F.pmod(F.floor(micros / F.lit(1_000_000)), F.lit(86_400)).cast("int")
            clock = F.format_string(
                "%02d:%02d:%02d.%06d",
                F.floor(seconds / 3600),
                F.floor(seconds / 60) % 60,
                seconds % 60,
                F.pmod(micros, F.lit(1_000_000)),
            )
            clock = F.when(micros.isNotNull(), clock)
        else:
            clock = F.date_format(value, "HH:mm:ss.SSSSSS")
        return F.regexp_replace(F.regexp_replace(clock, "0+$", ""), r"\.$", "")
    if not isinstance(dtype, T.StringType):
        raise _wrong_input("time", dtype)
    text = _text(value)
    padded = F.when(F.substring(text, 2, 1) == ":", F.concat(F.lit("0"), text)).otherwise(text)
    hour, half = F.substring(padded, 1, 2).try_cast("int") % 12, F.upper(F.right(text, F.lit(2)))
    on_clock = F.lpad(F.when(half == "PM", hour + 12).otherwise(hour).cast("string"), 2, "0")
    body = F.rtrim(F.regexp_replace(padded, "(?i)[ap]m$", ""))
    twelve = F.concat(on_clock, F.substring(body, 3, 20))
    clock = F.when(text.rlike(_TIME_24), padded).when(text.rlike(_TIME_12), twelve)
    whole = (
        F.when(F.length(clock) == 5, F.concat(clock, F.lit(":00")))
        .when(F.length(clock) > 8, F.rtrim(F.rtrim(clock, F.lit("0")), F.lit(".")))
        .otherwise(clock)
    )
    return _Target("time", on_error).checked(value, whole, T.StringType())


def to_decimal(
    value: Column, dtype: T.DataType, on_error: str = "raise", target: T.DecimalType = T.DecimalType(38, 10)
) -> Column:
    """Thousands commas are allowed. Digits the target cannot hold make the value unfit; nothing is rounded away."""
    refuse = _Target(target.simpleString(), on_error)
    if isinstance(dtype, T.BooleanType):
        return value.cast("int").cast(target)
    if isinstance(dtype, T.NumericType):
        return refuse.checked(value, value.try_cast(target), target)
    if not isinstance(dtype, T.StringType):
        raise _wrong_input("decimal", dtype)
    digits = F.regexp_replace(_text(value), ",", "")
    leading = F.regexp_replace(digits, r"^(.*?)([+-])$", "$2$1")
    kept = F.length(F.regexp_extract(leading, r"\.(\d*?)0*$", 1)) <= target.scale
    return refuse.checked(value, F.when(_text(value).rlike(_DECIMAL) & kept, leading.try_cast(target)), target)


def _to_floating(value: Column, dtype: T.DataType, on_error: str, target: T.DataType) -> Column:
    if isinstance(dtype, (T.NumericType, T.BooleanType)):
        return value.cast(target)
    if not isinstance(dtype, T.StringType):
        raise _wrong_input(target.simpleString(), dtype)
    text = _text(value)
    number = F.when(text.rlike(_DOUBLE) | text.rlike(_DOUBLE_NAMES), F.regexp_replace(text, ",", "").try_cast(target))
    return _Target(target.simpleString(), on_error).checked(value, number, target)


def to_double(value: Column, dtype: T.DataType, on_error: str = "raise") -> Column:
    return _to_floating(value, dtype, on_error, T.DoubleType())


def to_float(value: Column, dtype: T.DataType, on_error: str = "raise") -> Column:
    return _to_floating(value, dtype, on_error, T.FloatType())


def _to_integral(value: Column, dtype: T.DataType, on_error: str, target: T.DataType) -> Column:
    refuse = _Target(target.simpleString(), on_error)
    if isinstance(dtype, T.BooleanType):
        return value.cast(target)
    if isinstance(dtype, (T.FractionalType, T.DecimalType)):
        return refuse.checked(value, F.bround(value, 0).try_cast(target), target)
    if isinstance(dtype, T.NumericType):
        return refuse.checked(value, value.try_cast(target), target)
    if not isinstance(dtype, T.StringType):
        raise _wrong_input(target.simpleString(), dtype)
    text = _text(value)
    return refuse.checked(value, F.when(text.rlike(_INTEGER), text.try_cast(target)), target)


def to_int(value: Column, dtype: T.DataType, on_error: str = "raise") -> Column:
    """Whole-number text; a fractional number is rounded half to even."""
    return _to_integral(value, dtype, on_error, T.IntegerType())


def to_long(value: Column, dtype: T.DataType, on_error: str = "raise") -> Column:
    return _to_integral(value, dtype, on_error, T.LongType())


def to_uuid(value: Column, dtype: T.DataType, on_error: str = "raise") -> Column:
    """Lower-case hyphenated text; 32 bare digits, braces and parentheses are accepted."""
    if not isinstance(dtype, T.StringType):
        raise _wrong_input("uuid", dtype)
    text = _text(value)
    bare = F.lower(F.regexp_replace(text, r"[{}()-]", ""))
    made = F.regexp_replace(bare, r"^(.{8})(.{4})(.{4})(.{4})(.{12})$", "$1-$2-$3-$4-$5")
    return _Target("uuid", on_error).checked(value, F.when(text.rlike(_UUID_FORMS), made), T.StringType())


def to_enum(
    value: Column, dtype: T.DataType, members: Sequence[str] | Mapping[str, int], on_error: str = "raise"
) -> Column:
    """The member's name, from its name in any case or from its number (position, when no numbers are given)."""
    numbers = dict(members) if isinstance(members, Mapping) else {name: i for i, name in enumerate(members)}
    by_text = {name.lower(): name for name in numbers}
    if len(by_text) != len(numbers):
        raise ValueError(f"members {list(numbers)} differ only in case")
    by_text.update({str(number): name for name, number in reversed(list(numbers.items()))})
    lookup = F.create_map(*[F.lit(part) for pair in by_text.items() for part in pair])
    if isinstance(dtype, T.StringType):
        key = F.regexp_replace(F.lower(_text(value)), r"^\+?(-?)0*(\d+)$", "$1$2")
    elif isinstance(dtype, T.IntegralType):
        key = value.cast("string")
    else:
        raise _wrong_input("enum", dtype)
    return _Target("enum member", on_error).checked(value, F.try_element_at(lookup, key), T.StringType())


CONVERTERS = {
    "bool": to_bool,
    "timestamp": to_timestamp_utc,
    "date": to_date,
    "time": to_time,
    "double": to_double,
    "float": to_float,
    "int": to_int,
    "long": to_long,
    "uuid": to_uuid,
}
_DECIMAL_KIND = re.compile(r"decimal(?:\((\d+),\s*(\d+)\))?")

Kind = str | Sequence[str] | Mapping[str, int]


def convert_column(value: Column, dtype: T.DataType, kind: Kind, on_error: str = "raise") -> Column:
    """``kind`` is a name in ``CONVERTERS``, ``decimal`` or ``decimal(p,s)``, or the members of an enum."""
    if not isinstance(kind, str):
        return to_enum(value, dtype, kind, on_error)
    if kind == "string":
        return value.cast("string")
    if match := _DECIMAL_KIND.fullmatch(kind):
        target = T.DecimalType(*map(int, match.groups())) if match.group(1) else T.DecimalType(38, 10)
        return to_decimal(value, dtype, on_error, target)
    if kind not in CONVERTERS:
        raise ValueError(f"unknown kind {kind!r}; known are {', '.join(CONVERTERS)}, decimal, decimal(p,s), string")
    return CONVERTERS[kind](value, dtype, on_error)


def fitting_decimal(df: DataFrame, names: Sequence[str]) -> dict[str, T.DecimalType]:
    """For text columns the smallest decimal types that hold all their numbers exactly. One job for all columns.

    Text that is no number doesn't count. A column that needs more than 38 digits is an error.
    """
    sizes = []
    for i, name in enumerate(names):
        if not isinstance(column_type(df, name), T.StringType):
            raise ValueError(f"decimal(*) looks at text; {name} is none")
        text = _text(F.col(name))
        digits = F.when(text.rlike(_DECIMAL), F.regexp_replace(text, r"[,+-]", ""))
        whole = F.length(F.regexp_extract(digits, r"^0*(\d*)", 1))
        sizes += [F.coalesce(F.max(size), F.lit(0)).alias(f"{part}{i}") for part, size in (("w", whole), ("s", F.length(F.regexp_extract(digits, r"\.(\d*?)0*$", 1))))]
    found, types = df.agg(*sizes).first(), {}
    for i, name in enumerate(names):
        whole, scale = found[f"w{i}"], found[f"s{i}"]
        if whole + scale > 38:
            raise ValueError(f"column {name} needs {whole} digits before the point and {scale} behind it, together more than 38")
        types[name] = T.DecimalType(max(1, whole + scale), scale)
    return types


def convert(df: DataFrame, kinds: Mapping[str, Kind], on_error: str = "raise") -> DataFrame:
    """The frame with the named columns converted in place.

    ``decimal`` has ten digits behind the point and ``decimal(p,s)`` what it says; ``decimal(*)`` takes the smallest type
    that holds a text column's numbers exactly, up to 38 digits, which a job finds when the frame is built.
    """
    if wide := [name for name, kind in kinds.items() if kind == "decimal(*)"]:
        found = fitting_decimal(df, wide)
        kinds = {**kinds, **{name: f"decimal({t.precision},{t.scale})" for name, t in found.items()}}
    made = {name: convert_column(F.col(name), column_type(df, name), kind, on_error) for name, kind in kinds.items()}
    return df.withColumns(made)


# ---------------------------------------------------------------- JSON lists

_KINDS_BY_TYPE = {
    T.BooleanType: "bool",
    T.TimestampType: "timestamp",
    T.DateType: "date",
    T.DoubleType: "double",
    T.FloatType: "float",
    T.IntegerType: "int",
    T.LongType: "long",
    T.StringType: "string",
}


def kind_of(dtype: T.DataType) -> str:
    if isinstance(dtype, T.DecimalType):
        return f"decimal({dtype.precision},{dtype.scale})"
    if type(dtype) not in _KINDS_BY_TYPE:
        raise ValueError(f"no conversion to {dtype.simpleString()}")
    return _KINDS_BY_TYPE[type(dtype)]


#: What a JSON value may be where a kind is wanted, as Spark names the types of VARIANT values; null is always taken.
_JSON_TYPES = {
    "bool": r"^(BOOLEAN|BIGINT|DECIMAL|DOUBLE|STRING)",
    "decimal": r"^(BIGINT|DECIMAL|DOUBLE|STRING)",
    "double": r"^(BIGINT|DECIMAL|DOUBLE|STRING)",
    "float": r"^(BIGINT|DECIMAL|DOUBLE|STRING)",
    "int": r"^(BIGINT|STRING)$",
    "long": r"^(BIGINT|STRING)$",
    "timestamp": r"^(BIGINT|STRING)$",
    "date": r"^STRING$",
    "string": r"^STRING$",
}


def _whole_json(text: Column) -> Column:
    """The JSON value that is the whole text, as VARIANT; null where it's not one value.

    The parser stops behind the first value. So the text becomes the first of two items of which the second is its own
    hash: whatever closes the list early or adds to it lacks the second item or makes it another.
    """
    mark = F.xxhash64(text)
    items = F.try_variant_get(F.try_parse_json(F.concat(F.lit("["), text, F.lit(","), mark, F.lit("]"))), "$", "array<variant>")
    return let(items, lambda i: F.when((F.size(i) == 2) & (F.try_variant_get(F.get(i, 1), "$", "bigint") == mark), F.get(i, 0)))


def _json_value(value: Column, dtype: T.DataType, on_error: str) -> Column:
    """One JSON property (VARIANT) as its target type."""
    nothing = value.isNull() | F.is_variant_null(value)
    if isinstance(dtype, T.ArrayType):
        quoted = let(value.cast("string"), lambda text: parse_json_list(text, dtype.elementType, on_error))
        plain = _list_of(value, dtype.elementType, on_error, value.cast("string"))
        return F.when(nothing, F.array().cast(dtype)).when(F.schema_of_variant(value) == "STRING", quoted).otherwise(plain)
    kind = kind_of(dtype)
    allowed = F.schema_of_variant(value).rlike(_JSON_TYPES[kind.partition("(")[0]])
    refused = _Target(f"JSON {kind}", on_error).refuse(value.cast("string"), dtype)
    if kind == "string":
        made = value.cast("string")
    else:
        made = let(value.cast("string"), lambda text: _json_text(text, kind, on_error))
    return F.when(nothing, F.lit(None).cast(dtype)).when(allowed, made).otherwise(refused)


def _json_text(text: Column, kind: str, on_error: str) -> Column:
    """The text of a JSON number, boolean or string as the kind."""
    trimmed = _text(text)
    if kind == "bool":
        number = F.when(trimmed.rlike(_DOUBLE), F.when(trimmed.try_cast("double") != 0, "1").otherwise("0"))
        return to_bool(F.coalesce(number, text), T.StringType(), on_error)
    if kind not in ("timestamp", "date"):
        return convert_column(text, T.StringType(), kind, on_error)
    made = convert_column(F.when(trimmed != "", text), T.StringType(), kind, on_error)
    if kind == "date":
        return made
    seconds = F.when(trimmed.rlike(_INTEGER), trimmed.try_cast("long"))
    return F.when(seconds.isNotNull(), F.timestamp_seconds(seconds)).otherwise(made)


def _list_of(value: Column, element: T.StructType, on_error: str, shown: Column) -> Column:
    """A JSON array (VARIANT) as ``array<element>``; refused where it's not one, or holds what is no object and not null."""
    target = T.ArrayType(element)

    def texts(item: Column) -> Column:
        pairs = F.try_variant_get(item, "$", "map<string,variant>")

        def of(pairs: Column) -> Column:
            def found(name: str) -> Column:
                matching = F.filter(F.map_entries(pairs), lambda e: F.lower(e["key"]) == name.lower())
                return F.coalesce(F.try_element_at(pairs, F.lit(name)), F.try_element_at(matching, F.lit(-1))["value"])

            known = pairs.isNotNull()
            return F.when(known | F.is_variant_null(item), F.struct(known.alias("known"), *[found(f.name).alias(f"f{i}") for i, f in enumerate(element.fields)]))

        return let(pairs, of)

    def typed(found: Column) -> Column:
        made = F.struct(*[_json_value(found[f"f{i}"], f.dataType, on_error).alias(f.name) for i, f in enumerate(element.fields)])
        return F.when(found["known"], made)

    # two passes, so that each property is looked up once however often its conversion reads it
    items = F.transform(F.try_variant_get(value, "$", "array<variant>"), texts)
    refused = _Target("JSON list", on_error).refuse(shown, target)
    return let(items, lambda i: F.when(F.forall(i, lambda x: x.isNotNull()), F.transform(i, typed).cast(target)).otherwise(refused))


def parse_json_list(text: Column, element: T.StructType, on_error: str = "raise") -> Column:
    """JSON array text as ``array<element>``.

    Null, blank, ``[]`` and ``null`` are the empty list. Property names match in any case (the exact one first, then
    the last of several), unknown ones are ignored and missing ones are null; the same name twice in an object is refused, as
    Spark's parser does unless ``spark.sql.variant.allowDuplicateKeys`` is set. The whole list, or an inner one, may be a
    JSON string that holds the array text. The text is one JSON value to its end.

    Values keep their JSON types. Text is asked of strings alone; a number may be quoted; whole numbers have no fraction or
    exponent; true, false, numbers and text such as ``"1"`` are taken for booleans; numbers stand for Unix seconds where a
    timestamp is expected. Anything else, such as an object where text is asked, is refused.
    """
    target = T.ArrayType(element)
    trimmed = F.trim(text)
    inner = let(_whole_json(trimmed), lambda v: F.when(F.schema_of_variant(v) == "STRING", v.cast("string")))

    def read(unwrapped: Column) -> Column:
        empty = text.isNull() | unwrapped.rlike(r"^\s*(\[\s*\]|null)?\s*$")
        value = F.when(unwrapped.rlike(r"^\s*\["), _whole_json(unwrapped))
        return F.when(empty, F.array().cast(target)).otherwise(_list_of(value, element, on_error, text))

    return let(F.when(trimmed.startswith('"'), inner).otherwise(trimmed), read)


def _conformed(value: Column, source: T.DataType, target: T.DataType, on_error: str) -> Column:
    """A value in the shape of ``target``; fields of structs are matched by name, at any depth."""
    if source == target:
        return value
    if isinstance(target, T.ArrayType) and isinstance(source, T.ArrayType):
        return F.transform(value, lambda item: _conformed(item, source.elementType, target.elementType, on_error))
    if isinstance(target, T.ArrayType) and isinstance(source, T.StringType):
        return parse_json_list(value, target.elementType, on_error)
    if isinstance(target, T.StructType) and isinstance(source, T.StructType):
        own = {f.name.lower(): f for f in source.fields}
        fields = []
        for field in target.fields:
            found = own.get(field.name.lower())
            made = F.lit(None).cast(field.dataType) if found is None else _conformed(value[found.name], found.dataType, field.dataType, on_error)
            fields.append(made.alias(field.name))
        return F.when(value.isNotNull(), F.struct(*fields))
    if isinstance(target, (T.ArrayType, T.StructType, T.MapType, T.TimestampNTZType)):
        return value.cast(target)
    return convert_column(value, source, kind_of(target), on_error)


def conform(df: DataFrame, schema: T.StructType, on_error: str = "raise") -> DataFrame:
    """The frame in the shape of ``schema``: columns match in any case, extra ones go, missing ones are null.

    The same holds for the fields of structs and of lists of structs, to any depth. Text and numbers are converted strictly
    to the target type; JSON text becomes a list where the target is an array of structs. A list column the frame lacks is
    an error.
    """
    by_name = {name.lower(): name for name in df.columns}
    made = []
    for target in schema.fields:
        name, dtype = by_name.get(target.name.lower()), target.dataType
        if name is None:
            if isinstance(dtype, T.ArrayType):
                raise ValueError(f"no column for the list {target.name}")
            made.append(F.lit(None).cast(dtype).alias(target.name))
            continue
        made.append(_conformed(F.col(f"`{name}`"), df.schema[name].dataType, dtype, on_error).alias(target.name))
    return df.select(*made)
