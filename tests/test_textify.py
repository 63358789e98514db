import datetime as dt
from decimal import Decimal

from pyspark.sql import types as T

from scoreflow.functions.textify import to_text_columns


def test_edge_values(spark):
    schema = T.StructType(
        [
            T.StructField("d", T.DoubleType()),
            T.StructField("f", T.FloatType()),
            T.StructField("dec", T.DecimalType(10, 4)),
            T.StructField("ntz", T.TimestampNTZType()),
            T.StructField("day", T.DateType()),
            T.StructField("flag", T.BooleanType()),
            T.StructField("arr", T.ArrayType(T.IntegerType())),
            T.StructField("col with space", T.LongType()),
            T.StructField("s", T.StringType()),
        ]
    )
    rows = [
        (0.0, 0.1, Decimal("1.2500"), dt.datetime(2024, 1, 2, 3, 4, 5, 678901), dt.date(2024, 2, 29), True, [1, 2], 7, "x"),
        (-0.0, None, None, None, None, False, None, None, None),
        (float("nan"), None, Decimal("0.0000"), None, None, None, [], -3, ""),
        (float("inf"), None, None, None, None, None, None, None, None),
        (123456.0, None, None, None, None, None, None, None, None),
        (0.5, None, None, None, None, None, None, None, None),
    ]
    out = to_text_columns(spark.createDataFrame(rows, schema)).collect()
    assert all(isinstance(v, (str, type(None))) for r in out for v in r)
    first = out[0]
    assert first["d"] == "0"
    assert first["f"] == "0.10000000149011612"
    assert first["dec"] == "1.25"
    assert first["ntz"] == "2024-01-02 03:04:05"  # NTZ treated as timestamp: no fraction
    assert first["day"] == "2024-02-29"
    assert first["flag"] == "true"
    assert first["arr"] == "[1, 2]"
    assert first["col with space"] == "7"
    assert out[1]["d"] == "-0"
    assert out[1]["f"] is None
    assert out[2]["d"] == "NaN"
    assert out[2]["dec"] == "0"
    assert out[3]["d"] == "∞"
    assert out[4]["d"] == "123456"
    assert out[5]["d"] == "0.5"


def test_ntz_can_keep_fraction(spark):
    df = spark.createDataFrame([(dt.datetime(2024, 1, 2, 3, 4, 5, 600000),)], "t timestamp_ntz")
    assert to_text_columns(df, ntz_as_timestamp=False).first()["t"].startswith("2024-01-02 03:04:05.6")


def test_single_projection(spark):
    df = spark.createDataFrame([(1, 2.0)], "a int, b double")
    plan = to_text_columns(df)._jdf.queryExecution().optimizedPlan().toString()
    assert plan.count("Project") == 1


def test_zoned_timestamp_custom_patterns_and_nulls(spark):
    df = spark.createDataFrame(
        [(dt.datetime(2024, 1, 2, 3, 4, 5), dt.date(2024, 1, 2), 1234.5), (None, None, None)],
        "t timestamp, d date, x double",
    )
    out = to_text_columns(df, date_fmt="dd/MM/yyyy", timestamp_fmt="yyyyMMdd'T'HHmm", number_fmt="0.00").collect()
    assert (out[0]["t"], out[0]["d"], out[0]["x"]) == ("20240102T0304", "02/01/2024", "1234.50")
    assert (out[1]["t"], out[1]["d"], out[1]["x"]) == (None, None, None)
