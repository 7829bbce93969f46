"""Typed conversion: columns are turned into text first, in the forms other systems write, and converted back."""

from __future__ import annotations

from pyspark.sql import DataFrame, functions as F, types as T

from ..functions.convert import conform, convert, parse_json_list
from ..operators.relational import expression, project
from ..operators.nested import to_json_list
from .catalogue import Catalogue, Data

catalogue = Catalogue()
query = catalogue.query


@query("SELECT doc_id, quality = 1 AS quality, toxic <> 0 AS toxic FROM labels")
def to_bool(t: Data) -> DataFrame:
    text = "case when quality = 1 then 'True' when doc_id % 2 = 0 then 'FALSE' else '0' end"
    return convert(project(t.labels, "doc_id", expression(text, "quality"), "toxic"), {"quality": "bool", "toxic": "bool"})


@query("""SELECT event_id, CASE event_id % 5 WHEN 0 THEN epoch_us(ts) WHEN 1 THEN epoch_us(ts)
                   WHEN 2 THEN epoch_us(ts) - 7200000000 WHEN 3 THEN epoch_us(date_trunc('day', ts))
                   ELSE epoch_us(date_trunc('second', ts)) END AS micros
          FROM events""")
def to_timestamp_utc(t: Data) -> DataFrame:
    text = """case event_id % 5 when 0 then cast(ts as string)
                when 1 then concat(date_format(ts, "yyyy-MM-dd'T'HH:mm:ss.SSSSSS"), '0Z')
                when 2 then concat(cast(ts as string), '+02:00')
                when 3 then date_format(ts, 'yyyy-MM-dd')
                else date_format(ts, 'M/d/yyyy h:mm:ss a') end"""
    converted = convert(project(t.events, "event_id", expression(text, "at")), {"at": "timestamp"})
    return converted.select("event_id", F.unix_micros("at").alias("micros"))


@query("SELECT o_orderkey, CAST(o_orderdate AS DATE) AS day FROM orders")
def to_date(t: Data) -> DataFrame:
    text = """case o_orderkey % 3 when 0 then cast(o_orderdate as string)
                when 1 then date_format(o_orderdate, 'yyyy-MM-dd') else date_format(o_orderdate, 'M/d/yyyy') end"""
    return convert(project(t.orders, "o_orderkey", expression(text, "day")), {"day": "date"})


@query("SELECT event_id, strftime(ts, '%H:%M:%S') AS clock, strftime(ts, '%H:%M:00') AS minute FROM events")
def to_time(t: Data) -> DataFrame:
    clock, minute = "date_format(ts, 'H:mm:ss')", "date_format(ts, 'h:mm a')"
    texts = project(t.events, "event_id", expression(clock, "clock"), expression(minute, "minute"))
    return convert(texts, {"clock": "time", "minute": "time"})


@query("SELECT o_orderkey, CAST(round(o_totalprice * 100) AS BIGINT) AS cents FROM orders")
def to_decimal(t: Data) -> DataFrame:
    texts = project(t.orders, "o_orderkey", expression("format_number(o_totalprice, 2)", "price"))
    typed = convert(texts, {"price": "decimal(18,2)"})
    return typed.select("o_orderkey", (F.col("price") * 100).cast("bigint").alias("cents"))


@query("SELECT l_orderkey, l_linenumber, l_partkey, l_suppkey, l_extendedprice AS price, l_discount AS discount FROM lineitem")
def to_double(t: Data) -> DataFrame:
    keys = ["l_orderkey", "l_linenumber", "l_partkey", "l_suppkey"]
    price, discount = "concat(' ', format_number(l_extendedprice, 2))", "concat(cast(l_discount as string), 'e0')"
    return convert(project(t.lineitem, *keys, expression(price, "price"), expression(discount, "discount")),
                   {"price": "double", "discount": "double"})


@query("SELECT c_custkey AS key, -c_custkey AS negative, c_nationkey AS nation FROM customer")
def to_long(t: Data) -> DataFrame:
    plus, minus = "concat(' +', cast(c_custkey as string), ' ')", "cast(-c_custkey as string)"
    texts = project(
        t.customer, expression(plus, "key"), expression(minus, "negative"), expression("cast(c_nationkey as string)", "nation")
    )
    return convert(texts, {"key": "long", "negative": "long", "nation": "int"})


@query("""SELECT l_orderkey, l_linenumber, l_partkey, l_suppkey, l_quantity,
                 CAST(round_even(l_quantity / 2, 0) AS INTEGER) AS half FROM lineitem""")
def to_int_round(t: Data) -> DataFrame:
    keys = ["l_orderkey", "l_linenumber", "l_partkey", "l_suppkey", "l_quantity"]
    return convert(project(t.lineitem, *keys, expression("l_quantity / 2", "half")), {"half": "int"})


@query("""SELECT c_custkey, substr(h, 1, 8) || '-' || substr(h, 9, 4) || '-' || substr(h, 13, 4) || '-' || substr(h, 17, 4)
                 || '-' || substr(h, 21, 12) AS id FROM (SELECT c_custkey, md5(c_name) AS h FROM customer) AS m""")
def to_uuid(t: Data) -> DataFrame:
    dashed = "regexp_replace(md5(c_name), '^(.{8})(.{4})(.{4})(.{4})', '$1-$2-$3-$4-')"
    text = f"""case c_custkey % 3 when 0 then upper(md5(c_name)) when 1 then concat('{{', {dashed}, '}}') else {dashed} end"""
    return convert(project(t.customer, "c_custkey", expression(text, "id")), {"id": "uuid"})


_EVENT_TYPES = ["click", "error", "purchase", "signup", "view"]


@query("""SELECT event_id, event_type AS kind, CASE event_id % 3 WHEN 0 THEN 'click' WHEN 1 THEN 'error' ELSE 'purchase'
                 END AS from_number FROM events""")
def to_enum(t: Data) -> DataFrame:
    texts = project(t.events, "event_id", expression("upper(event_type)", "kind"), expression("event_id % 3", "from_number"))
    return convert(texts, {"kind": _EVENT_TYPES, "from_number": _EVENT_TYPES})


# ---------------------------------------------------------------- JSON lists

_ELEMENT = T.StructType(
    [
        T.StructField("k", T.LongType()),
        T.StructField("ok", T.BooleanType()),
        T.StructField("at", T.TimestampType()),
        T.StructField("label", T.StringType()),
    ]
)
_JSON = """concat('[', props, ',{"K":', event_id, ',"ok":"TRUE","at":', event_id * 60, ',"label":"', event_type, '"}]')"""
_JSON_ROWS = """SELECT event_id, CAST(json_extract(props, '$.k') AS BIGINT) AS k, CAST(NULL AS BOOLEAN) AS ok,
                       CAST(NULL AS BIGINT) AS seconds, CAST(NULL AS VARCHAR) AS label FROM events
                UNION ALL SELECT event_id, event_id, true, event_id * 60, event_type FROM events"""


def _items(lists: DataFrame) -> DataFrame:
    # every list here has two items; for the plain inline Spark infers a filter that would parse each list twice
    flat = lists.select("event_id", F.inline_outer("items"))
    return flat.select("event_id", "k", "ok", F.unix_seconds("at").alias("seconds"), "label")


@query(_JSON_ROWS)
def json_list(t: Data) -> DataFrame:
    texts = project(t.events, "event_id", expression(_JSON, "items"))
    return _items(texts.withColumn("items", parse_json_list(F.col("items"), _ELEMENT)))


@query(_JSON_ROWS)
def json_list_stringified(t: Data) -> DataFrame:
    quoted = f"""concat('"', replace({_JSON}, '"', '\\\\"'), '"')"""
    texts = project(t.events, "event_id", expression(quoted, "items"))
    return _items(texts.withColumn("items", parse_json_list(F.col("items"), _ELEMENT)))


@query("""SELECT l_orderkey, l_linenumber, CAST(l_orderkey || '.' || lpad((l_partkey * 10 + 1)::VARCHAR, 24, '0') AS DECIMAL(38, 24))::VARCHAR AS amount
          FROM lineitem""")
def to_decimal_wide(t: Data) -> DataFrame:
    """More digits behind the point than a plain decimal has."""
    text = "concat(l_orderkey, '.', lpad(cast(l_partkey * 10 + 1 AS string), 24, '0'))"
    typed = convert(project(t.lineitem, "l_orderkey", "l_linenumber", expression(text, "amount")), {"amount": "decimal(*)"})
    return typed.withColumn("amount", F.col("amount").cast("string"))


@query("""SELECT c_custkey AS Id, c_name AS Name, CAST(c_nationkey AS BIGINT) AS Nation, CAST(NULL AS VARCHAR) AS Note
          FROM customer""")
def typed_result(t: Data) -> DataFrame:
    texts = project(t.customer, ("c_custkey", "ID"), ("c_name", "name"), expression("cast(c_nationkey as string)", "NATION"),
                    "c_acctbal")
    wanted = T.StructType(
        [
            T.StructField("Id", T.LongType()),
            T.StructField("Name", T.StringType()),
            T.StructField("Nation", T.LongType()),
            T.StructField("Note", T.StringType()),
        ]
    )
    return conform(texts, wanted)


@query("""SELECT c_custkey AS "Id", to_json([{Key: c_custkey + 1, Note: NULL, Sub: [{N: c_nationkey, T: upper(c_name)}]}]) AS "Parts"
          FROM customer""")
def typed_result_nested(t: Data) -> DataFrame:
    """Fields of structs in lists by name: reordered, in other case, some too many, some missing, text to be converted."""
    inner = "array(named_struct('t', upper(c_name), 'extra', 1, 'n', cast(c_nationkey as string)))"
    rows = project(
        t.customer,
        ("c_custkey", "id"),
        expression(f"array(named_struct('sub', {inner}, 'unused', 2.5D, 'KEY', cast(c_custkey + 1 as string)))", "parts"),
    )
    inner_type = T.StructType([T.StructField("N", T.IntegerType()), T.StructField("T", T.StringType())])
    part = T.StructType([T.StructField("Key", T.LongType()), T.StructField("Note", T.StringType()), T.StructField("Sub", T.ArrayType(inner_type))])
    wanted = T.StructType([T.StructField("Id", T.LongType()), T.StructField("Parts", T.ArrayType(part))])
    made = conform(rows, wanted)
    return made.select("Id", to_json_list("Parts").alias("Parts"))
