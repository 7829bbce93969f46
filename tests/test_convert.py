from __future__ import annotations

import datetime as dt
from decimal import Decimal

import pytest
from pyspark.sql import functions as F, types as T

from tablewright.functions.convert import conform, convert, convert_column, parse_json_list


def converted(spark, kind, values, dtype="string"):
    df = spark.createDataFrame([(i, v) for i, v in enumerate(values)], f"i int, v {dtype}")
    column = convert_column(F.col("v"), df.schema["v"].dataType, kind, "null")
    if kind == "timestamp":
        column = F.unix_micros(column)
    return [r["x"] for r in df.select("i", column.alias("x")).orderBy("i").collect()]


def micros(*args) -> int:
    return int(dt.datetime(*args, tzinfo=dt.timezone.utc).timestamp() * 1_000_000)


@pytest.mark.parametrize(
    "kind, good, bad",
    [
        ("bool", {"1": True, "0": False, "TRUE": True, " False ": False}, ["yes", "t", "", "2"]),
        ("date", {"2026-07-31": dt.date(2026, 7, 31), "2026-07-31 23:30:00": dt.date(2026, 7, 31),
                  "2026-07-31T23:30:00-02:00": dt.date(2026, 8, 1), "7/4/2026": dt.date(2026, 7, 4)}, ["", "x", "2026-02-30"]),
        ("time", {"1:02": "01:02:00", "13:14:15.5000": "13:14:15.5", "1:02 PM": "13:02:00", "12:30 am": "00:30:00",
                  "23:59:59": "23:59:59"}, ["", "24:00", "13:00 PM", "1:60", "x"]),
        ("decimal(10,2)", {"1,234.50": Decimal("1234.50"), "-5": Decimal(-5), "5-": Decimal(-5), ".5": Decimal("0.5"),
                           "1.230000": Decimal("1.23")}, ["", "1.005", "1e3", "12345678901", ",1", "1.2.3"]),
        ("double", {"1,234.5e2": 123450.0, "-Infinity": float("-inf"), "5.": 5.0}, ["", "x", ".", "1e"]),
        ("float", {"0.5": 0.5}, ["a"]),
        ("long", {"12": 12, " +7 ": 7, "-0": 0}, ["", "1.0", "1,000", "99999999999999999999"]),
        ("int", {"2147483647": 2147483647}, ["2147483648"]),
        ("uuid", {"6F9619FF8B86D011B42D00C04FC964FF": "6f9619ff-8b86-d011-b42d-00c04fc964ff",
                  "{6F9619FF-8B86-D011-B42D-00C04FC964FF}": "6f9619ff-8b86-d011-b42d-00c04fc964ff"},
         ["", "x", "{6F9619FF-8B86-D011-B42D-00C04FC964FF"]),
        (["Red", "Green"], {"red": "Red", "GREEN": "Green", "1": "Green", "01": "Green"}, ["", "2", "blue"]),
        ({"Low": 10, "High": 20}, {"low": "Low", "20": "High"}, ["0", "15"]),
    ],
)
def test_text(spark, kind, good, bad):
    assert converted(spark, kind, [*good, *bad, None]) == [*good.values()] + [None] * (len(bad) + 1)
    df = spark.createDataFrame([(bad[0],)], "v string")
    with pytest.raises(Exception, match="not a valid"):
        convert(df, {"v": kind}).collect()


@pytest.mark.parametrize("zone", ["UTC", "America/New_York", "Asia/Kolkata"])
def test_timestamps_do_not_depend_on_the_session_zone(spark, zone):
    spark.conf.set("spark.sql.session.timeZone", zone)
    try:
        good = {
            "2026-07-31 21:00:00.0000000": micros(2026, 7, 31, 21),
            "2026-07-31 21:30:00": micros(2026, 7, 31, 21, 30),
            "2026-07-31T21:30:00.123": micros(2026, 7, 31, 21, 30, 0, 123000),
            "2026-07-31T21:30:00.1234567Z": micros(2026, 7, 31, 21, 30, 0, 123456),
            "2026-07-31 21:30:00+02:00": micros(2026, 7, 31, 19, 30),
            "2026-07-31T21:30:00.500-05:30": micros(2026, 8, 1, 3, 0, 0, 500000),
            "2026-07-31": micros(2026, 7, 31),
            "2026-07-31 21:30": micros(2026, 7, 31, 21, 30),
            "2024-03-10 02:30:00": micros(2024, 3, 10, 2, 30),
            "7/31/2026 9:30:00 PM": micros(2026, 7, 31, 21, 30),
            "7/31/2026 5:06": micros(2026, 7, 31, 5, 6),
            "Fri, 31 Jul 2026 21:00:00 GMT": micros(2026, 7, 31, 21),
        }
        assert converted(spark, "timestamp", [*good, "", "12:00:00", "2026", "2026-13-01"]) == [*good.values(), *[None] * 4]
        df = spark.sql("select timestamp_ntz'2024-01-02 23:04:05.5' a, timestamp'2024-01-02T23:04:05Z' b, date'2024-01-02' c")
        row = convert(df, {"a": "time", "b": "time"}).first()
        assert (row["a"], row["b"]) == ("23:04:05.5", "23:04:05")
        row = convert(df, {"a": "date", "b": "date", "c": "date"}).first()
        assert set(row) == {dt.date(2024, 1, 2)}
        row = convert(df, {"a": "timestamp", "c": "timestamp"}).select(F.unix_micros("a"), F.unix_micros("c")).first()
        assert tuple(row) == (micros(2024, 1, 2, 23, 4, 5, 500000), micros(2024, 1, 2))
    finally:
        spark.conf.set("spark.sql.session.timeZone", "UTC")


def test_numbers(spark):
    assert converted(spark, "int", [2.5, 3.5, -2.5, 1e12, None], "double") == [2, 4, -2, None, None]
    assert converted(spark, "bool", [0.0, 0.1, float("nan"), None], "double") == [False, True, False, None]
    assert converted(spark, "bool", [0, 5], "int") == [False, True]
    assert converted(spark, ["Red", "Green"], [0, 1, 2], "int") == ["Red", "Green", None]
    assert converted(spark, "decimal(4,1)", [12, 99999], "int") == [Decimal(12), None]


def test_refused_when_built(spark):
    df = spark.createDataFrame([(1, "x")], "n int, s string")
    for kinds, mode in (({"s": "nope"}, "raise"), ({"n": "uuid"}, "raise"), ({"s": ["a", "A"]}, "raise"), ({"s": "int"}, "skip")):
        with pytest.raises(ValueError):
            convert(df, kinds, mode)


TAG = T.StructType([T.StructField("t", T.StringType())])
ELEMENT = T.StructType(
    [
        T.StructField("id", T.LongType()),
        T.StructField("ok", T.BooleanType()),
        T.StructField("at", T.TimestampType()),
        T.StructField("day", T.DateType()),
        T.StructField("amount", T.DecimalType(10, 2)),
        T.StructField("tags", T.ArrayType(TAG)),
    ]
)


def parsed(spark, *texts):
    df = spark.createDataFrame([(i, t) for i, t in enumerate(texts)], "i int, j string")
    out = df.select("i", parse_json_list(F.col("j"), ELEMENT, "null").alias("l")).orderBy("i").collect()
    return [None if r["l"] is None else [x if x is None else x.asDict(True) for x in r["l"]] for r in out]


def test_json_lists(spark):
    full = '[{"ID":1,"ok":1,"at":1700000000,"DAY":"2024-02-03","amount":"1,234.5","tags":[{"t":"a"},{"T":"b"}],"more":[1]}]'
    texts = '[{"id":"2","ok":"false","at":"2023-11-14 22:13:20","amount":2,"tags":"[{\\"t\\":\\"z\\"}]"},null]'
    (one,), (two, nothing) = parsed(spark, full, texts)
    instant = dt.datetime.fromtimestamp(1700000000)
    assert one == {"id": 1, "ok": True, "at": instant, "day": dt.date(2024, 2, 3), "amount": Decimal("1234.5"),
                   "tags": [{"t": "a"}, {"t": "b"}]}
    assert two == {"id": 2, "ok": False, "at": instant, "day": None, "amount": Decimal(2), "tags": [{"t": "z"}]}
    assert nothing is None


def test_empty_and_malformed_json_lists(spark):
    assert parsed(spark, None, "", "  ", "[]", " [ ] ", "null", '"[]"', '""') == [[]] * 8
    assert parsed(spark, '{"id":1}', "garbage", '[{"id":1}', '"x"') == [None] * 4
    doubled = '"[{\\"id\\":5,\\"ok\\":true}]"'
    assert [x["id"] for x in parsed(spark, doubled)[0]] == [5]
    for bad in ('{"id":1}', '[{"id":"x"}]', '[{"ok":"yes"}]'):
        df = spark.createDataFrame([(bad,)], "j string")
        with pytest.raises(Exception, match="not a valid"):
            df.select(parse_json_list(F.col("j"), ELEMENT)).collect()


def test_conform(spark):
    df = spark.createDataFrame([("1", "Ann", '[{"id":7}]', "x")], "ID string, name string, KIDS string, extra string")
    kid = T.StructType([T.StructField("Id", T.IntegerType())])
    wanted = (
        T.StructType().add("Id", T.LongType()).add("Name", T.StringType()).add("Kids", T.ArrayType(kid)).add("Born", T.DateType())
    )
    out = conform(df, wanted)
    assert out.schema == wanted or [f.name for f in out.schema] == ["Id", "Name", "Kids", "Born"]
    assert out.first().asDict(True) == {"Id": 1, "Name": "Ann", "Kids": [{"Id": 7}], "Born": None}
    with pytest.raises(ValueError):
        conform(df.drop("KIDS"), wanted)


def test_json_lists_are_read_to_the_end(spark):
    element = T.StructType([T.StructField("k", T.LongType())])
    texts = ['[{"k":1}]', '[{"k":1}] junk', '[{"k":1}][{"k":2}]', '[{"k":1}],[{"k":2}]', '[{"k":1},]x', ' [ {"k" : 2} ] ', '[{"k":1}', '"[{\\"k\\":3}]"']
    df = spark.createDataFrame([(t,) for t in texts], "t string")
    got = [r[0] for r in df.select(parse_json_list(F.col("t"), element, "null")).collect()]
    assert [g and [e.k for e in g] for g in got] == [[1], None, None, None, None, [2], None, [3]]
    with pytest.raises(Exception, match="JSON list"):
        df.where("t like '%junk'").select(parse_json_list(F.col("t"), element)).collect()


def test_conform_matches_inner_fields_by_name(spark):
    df = spark.sql("select array(named_struct('first', 'A', 'last', 'B', 'flag', 'true')) as people, named_struct('x', '1') as one")
    person = T.StructType([T.StructField("Last", T.StringType()), T.StructField("First", T.StringType()), T.StructField("Flag", T.BooleanType()), T.StructField("Age", T.LongType())])
    wanted = T.StructType([T.StructField("People", T.ArrayType(person)), T.StructField("One", T.StructType([T.StructField("X", T.LongType())]))])
    row = conform(df, wanted).first()
    assert tuple(row.People[0]) == ("B", "A", True, None) and row.One.X == 1
    bad = spark.sql("select array(named_struct('flag', 'yes')) as people, cast(null as struct<x:string>) as one")
    with pytest.raises(Exception, match="bool"):
        conform(bad, wanted).collect()
    assert conform(bad, wanted, "null").first().One is None


def test_general_date_forms(spark):
    forms = {
        "2020-9-7": "2020-09-07 00:00:00", "2020-9-7 5:03": "2020-09-07 05:03:00", "September 7, 2020": "2020-09-07 00:00:00",
        "7-Sep-2020": "2020-09-07 00:00:00", "2020-09-07T10:00:00+0200": "2020-09-07 08:00:00", "Sep 7, 2020": "2020-09-07 00:00:00",
    }
    df = convert(spark.createDataFrame([(t,) for t in forms], "t string"), {"t": "timestamp"})
    assert [r[0] for r in df.selectExpr("cast(t as string)").collect()] == list(forms.values())


def test_json_values_keep_their_types(spark):
    """What closes the list early is refused, and so is a value of another JSON type than asked."""
    element = T.StructType([T.StructField("k", T.StringType()), T.StructField("n", T.LongType()), T.StructField("x", T.DoubleType()), T.StructField("d", T.DateType())])
    good = {
        '[{"k":"1","n":2,"x":0.1,"d":"2024-02-03"}]': ("1", 2, 0.1, dt.date(2024, 2, 3)),
        '[{"K":null,"n":"7","X":"1e3"}]': (None, 7, 1000.0, None),
        '"[{\\"n\\":-5}]"': (None, -5, None, None),
    }
    bad = ['[{"k":"1"}]],"x":[[{"k":"2"}]', '[{"k":"1"}],0] junk', '[{"k":"1"}]] junk', "[1]", '["a"]', '[[{"k":"1"}]]', '"[{}] junk"', '[{"k":"1","k":"2"}]']
    refused = ['[{"k":{"a":1}}]', '[{"k":1}]', '[{"k":true}]', '[{"n":1.0}]', '[{"n":1e3}]', '[{"n":true}]', '[{"x":[1]}]', '[{"d":20240203}]']
    read = lambda text, how: spark.createDataFrame([(text,)], "t string").select(parse_json_list(F.col("t"), element, how)).first()[0]
    for text, want in good.items():
        assert [tuple(e) for e in read(text, "raise")] == [want]
    for text in bad:
        assert read(text, "null") is None
        with pytest.raises(Exception, match="JSON list"):
            read(text, "raise")
    for text in refused:
        assert [tuple(e) for e in read(text, "null")] == [(None,) * 4]
        with pytest.raises(Exception, match="not a valid JSON"):
            read(text, "raise")


def test_decimals_that_fit_their_column(spark):
    df = spark.createDataFrame([("1,234.5000", "-0.0000000000000000000000000001", None), ("-7", "3.", "x"), (" .25 ", None, "00012")], "a string, b string, c string")
    made = convert(df, {"a": "decimal(*)", "b": "decimal(*)", "c": "decimal(*)"}, "null")
    assert [f.dataType for f in made.schema.fields] == [T.DecimalType(6, 2), T.DecimalType(29, 28), T.DecimalType(2, 0)]
    assert [tuple(r) for r in made.collect()] == [
        (Decimal("1234.50"), Decimal("-0.0000000000000000000000000001"), None), (Decimal(-7), Decimal(3), None), (Decimal("0.25"), None, Decimal(12))
    ]
    wide = spark.createDataFrame([("1" * 30,), ("0." + "0" * 11 + "1",)], "a string")
    with pytest.raises(ValueError, match="more than 38"):
        convert(wide, {"a": "decimal(*)"})
    with pytest.raises(ValueError, match="text"):
        convert(spark.range(1), {"id": "decimal(*)"})
    assert convert(df.limit(0), {"a": "decimal(*)"}).schema["a"].dataType == T.DecimalType(1, 0)
