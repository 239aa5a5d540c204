"""Field reading, calendar and sentences."""

import math

import pytest
from pyspark.sql import functions as F
from pyspark.sql import types as T

from burstline.functions.calendar import day_epoch, minute_epoch
from burstline.functions.parsing import filled, parse_failures, parse_fields, quarantined, readable
from burstline.functions.templates import render, render_parsed, template_vars, value_key, variable_names, with_parsed_template
from burstline.schema import BOOLEAN_FIELDS, DOUBLE_FIELDS, FIELD_TYPES, INT_FIELDS, LONG_FIELDS, TEXT_FIELDS, event_schema


def read(spark, field, texts):
    df = spark.createDataFrame([(i, t) for i, t in enumerate(texts)], f"i int, {field} string")
    return [r[field] for r in parse_fields(df).orderBy("i").collect()]


def test_field_counts():
    assert [len(x) for x in (LONG_FIELDS, DOUBLE_FIELDS, INT_FIELDS, BOOLEAN_FIELDS, TEXT_FIELDS)] == [36, 24, 23, 8, 236]
    assert len(FIELD_TYPES) == 327


def test_event_schema():
    schema = event_schema(["eventid", "eventtime", "bytesout", "u_masked", "u_riskscore"])
    assert [f.dataType.simpleString() for f in schema] == ["string", "bigint", "int", "boolean", "double"]


def test_int_text(spark):
    texts = ["5", "+5", "-5", " 5", "5.7", "", "abc", "1e3", "2147483648", None]
    texts += ["5 ", "\t5", "5\x7f", "\x7f5", "+", "-", "--5", "5+", "1_0", "0x1", "5\n", "\u00a05", "1 2", "-2147483649"]
    assert read(spark, "bytesout", texts) == [5, 5, -5] + [None] * 21
    assert read(spark, "bytesout", ["007", "-0", "2147483647", "-2147483648"]) == [7, 0, 2147483647, -2147483648]


def test_long_text(spark):
    assert read(spark, "eventtime", ["9999999999", "9223372036854775808", "+7", "7L"]) == [9999999999, None, 7, None]


def test_double_text(spark):
    texts = ["1.5", "1e3", " 2.5 ", "Infinity", "-Infinity", "inf", "INF", "nan", "abc", "", "1.5d", None]
    got = read(spark, "u_riskscore", texts)
    assert got == [1.5, 1000.0, 2.5, math.inf, -math.inf] + [None] * 5 + [1.5, None]
    assert math.isnan(read(spark, "u_riskscore", ["NaN"])[0])
    assert read(spark, "u_riskscore", ["1e999", " Infinity", "+Infinity", "infinity", " -inf ", "Nan", "1,5", "."]) == (
        [math.inf] * 3 + [None] * 5)


def test_boolean_text(spark):
    texts = ["true", "TRUE", "t", "yes", "1", " true", "x", None]
    assert read(spark, "u_encrypted", texts) == [True, True] + [False] * 5 + [None]


def test_typed_columns_are_kept_or_widened(spark):
    df = spark.createDataFrame([(1, 2, 3.5, True, 7, "u")],
                               "eventtime int, bytesout bigint, customnumber1 float, u_masked boolean, customnumber2 int, other string")
    out = parse_fields(df)
    assert dict(out.dtypes) == {"eventtime": "bigint", "bytesout": "int", "customnumber1": "double",
                                "u_masked": "boolean", "customnumber2": "double", "other": "string"}
    assert tuple(out.first()) == (1, 2, 3.5, True, 7.0, "u")
    wide = spark.createDataFrame([(2**40,)], "bytesout bigint")
    assert parse_fields(wide).first()["bytesout"] is None
    assert {r["field"]: r["failures"] for r in parse_failures(wide).collect()} == {"bytesout": 1}


def test_text_fields_on_request(spark):
    df = spark.createDataFrame([(5,)], "elsewhere int")
    assert parse_fields(df).dtypes == [("elsewhere", "int")]
    assert parse_fields(df, ("elsewhere",)).first()["elsewhere"] == "5"


def test_strict_fields(spark):
    df = spark.createDataFrame([("a", "x"), ("b", "12"), ("c", None), ("d", "")], "eventid string, tenantid string")
    assert [r["eventid"] for r in quarantined(df).orderBy("eventid").collect()] == ["a", "d"]
    assert [(r["eventid"], r["tenantid"]) for r in parse_fields(readable(df)).orderBy("eventid").collect()] == [("b", 12), ("c", None)]
    with pytest.raises(ValueError):
        parse_fields(spark.createDataFrame([("1.0",)], "rg_riskscore string"))


def test_failures_per_field(spark):
    df = spark.createDataFrame([("1", "x", "zz"), ("y", "x", None), (None, "1.5", "true")],
                               "bytesin string, u_riskscore string, u_masked string")
    assert {r["field"]: r["failures"] for r in parse_failures(df).collect()} == {"bytesin": 1, "u_riskscore": 2}


def test_filled(spark):
    df = spark.createDataFrame([(" a ",), ("\t\n ",), ("",), (None,)], "x string")
    assert [r[0] for r in df.select(filled(F.col("x"))).collect()] == ["a", None, None, None]


@pytest.mark.parametrize("session_zone", ["UTC", "America/Los_Angeles"])
def test_day_epoch(spark, session_zone):
    cases = [
        (1522540800000, "America/New_York", 1522468800000),
        (1522540800000, "GMT", 1522540800000),
        (1522540800000, None, 1522540800000),
        (1522540800000 + 86_399_999, None, 1522540800000),
        # clocks went forward on this day: it starts in winter time
        (1520784000000, "America/New_York", 1520744400000),
        (-1, None, -86_400_000),
        (9223372036854775807, "GMT", None),
        (None, "GMT", None),
    ]
    spark.conf.set("spark.sql.session.timeZone", session_zone)
    try:
        df = spark.createDataFrame(cases, "ms long, zone string, want long")
        for row in df.withColumn("got", day_epoch(F.col("ms"), F.col("zone"))).collect():
            assert row["got"] == row["want"], row
    finally:
        spark.conf.set("spark.sql.session.timeZone", "UTC")


def test_minute_epoch(spark):
    df = spark.createDataFrame([(2018, 91, 0, 0), (1970, 1, 0, 1), (2024, 366, 23, 59), (2147483647, 1, 0, 0), (None, 1, 0, 0)], "y int, d int, h int, m int")
    got = [r[0] for r in df.select(minute_epoch(F.col("y"), F.col("d"), F.col("h"), F.col("m"))).collect()]
    assert got == [1522540800000, 60_000, 1735689540000, None, None]


TEMPLATE = 'Account ${accountname!"ACCOUNTNAME"} from ${ipaddress!"UNKNOWN"}'
CASES = [
    (TEMPLATE, "a", "", "Account a from UNKNOWN"),
    (TEMPLATE, None, "1.2.3.4", "Account ACCOUNTNAME from 1.2.3.4"),
    ("${accountname}${ipaddress}", "a", None, "a"),
    ("no variables", "a", "b", "no variables"),
    ("", "a", "b", ""),
    ("cost $5 {x} ${accountname} ${nosuch!\"?\"}!", "a$1", "b", "cost $5 {x} a$1 ?!"),
    ("${ipaddress$COUNT!\"none\"} times", "a", "b", "3 times"),
]


@pytest.mark.parametrize("template, account, ip, want", CASES)
def test_sentences(spark, template, account, ip, want):
    df = spark.createDataFrame([(account, ip, "3", template)], T.StructType([
        T.StructField(n, T.StringType()) for n in ("accountname", "ipaddress", "ipaddress$COUNT", "template")]))
    known = set(df.columns)

    def value_of(name, kind):
        key = value_key(name, kind)
        return F.col(f"`{key}`") if key in known else F.lit(None).cast("string")

    names = ["accountname", "ipaddress", "ipaddress$COUNT"]
    values = F.map_from_arrays(F.array(*map(F.lit, names)), F.array(*[F.col(f"`{n}`") for n in names]))
    parsed = with_parsed_template(df, "template")
    row = parsed.select(render(template, value_of).alias("fixed"), render_parsed(values).alias("by_column")).first()
    assert (row["fixed"], row["by_column"]) == (want, want)


def test_template_variables(spark):
    text = 'a ${x!"d"} ${y$SUM!"e"} ${z} ${bad name} $q'
    assert variable_names(text) == [("x", None), ("y", "SUM"), ("z", None)]
    assert spark.range(1).select(template_vars(F.lit(text))).first()[0] == ["x", "y", "z"]


def test_times_beyond_year_9999(spark):
    """A microsecond epoch taken for milliseconds is a day far off, not an unknown one; what has no day is counted."""
    times = [1522540800000, 1522540800000000, -1522540800000000, 2**63 - 1, None]
    df = spark.createDataFrame([(t,) for t in times], "eventtime long")
    days = [r[0] for r in df.select(day_epoch(F.col("eventtime"), F.lit("GMT"))).collect()]
    assert days == [1522540800000, 1522540800000000 - 1522540800000000 % 86_400_000, -1522540800000000 - (-1522540800000000) % 86_400_000, None, None]
    assert {r["field"]: r["failures"] for r in parse_failures(df).collect()} == {"eventtime": 0, "eventtime.day": 1}


def test_text_fields_become_text(spark):
    df = spark.createDataFrame([(5, 7, 1.5)], "eventcount int, ipaddress long, elsewhere double")
    assert parse_fields(df).dtypes == [("eventcount", "string"), ("ipaddress", "string"), ("elsewhere", "double")]
