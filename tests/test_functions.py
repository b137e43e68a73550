"""Unit tables for the column functions."""
import datetime as dt
from decimal import Decimal

import pytest
from pyspark.sql import functions as F

from starloom.functions import (
    blank_to_null,
    date_key,
    full_name,
    lap_time_ms,
    least_positive,
    null_tokens_to_null,
    parse_date_any,
    positions_gained,
    safe_cast,
)

LAP_CASES = [
    ("1:26.572", 86572),
    (" 1:26.572 ", 86572),
    ("1:26.5", 86500),
    ("1:26.57", 86570),
    ("1:26", 86000),
    ("0:59.999", 59999),
    ("12:00.001", 720001),
    ("95", None),
    ("26.572", None),
    ("\\N", None),
    ("", None),
    (None, None),
    ("1:02:03.5", None),
    ("1:", None),
    ("1:75.000", None),
    ("1:26.5721", None),
    ("\t1:26.572", None),
    ("a:bc.def", None),
    ("1:26.572\n", None),
    ("1:26.572\r\n", None),
]


def test_lap_time_ms_table(spark):
    df = spark.createDataFrame([(t,) for t, _ in LAP_CASES], "t string")
    rows = df.select("t", lap_time_ms("t", "zero").alias("z"), lap_time_ms("t", "null").alias("n")).collect()
    for (text, expected), row in zip(LAP_CASES, rows):
        assert row["n"] == expected, text
        assert row["z"] == (expected if expected is not None else 0), text


def test_lap_time_rejects_bad_mode():
    with pytest.raises(ValueError):
        lap_time_ms("x", missing="other")


DATE_CASES = [
    ("2021-03-28", dt.date(2021, 3, 28)),
    ("28-03-2021", dt.date(2021, 3, 28)),
    ("28/03/2021", dt.date(2021, 3, 28)),
    ("03/28/2021", dt.date(2021, 3, 28)),
    ("05/04/2021", dt.date(2021, 4, 5)),  # day-first wins
    ("2021.03.28", None),
    ("", None),
    ("\\N", None),
    (None, None),
]


def test_parse_date_any_table(spark):
    df = spark.createDataFrame([(t,) for t, _ in DATE_CASES], "t string")
    rows = df.select(parse_date_any("t").alias("d"), date_key(parse_date_any("t")).alias("k")).collect()
    for (text, expected), row in zip(DATE_CASES, rows):
        assert row["d"] == expected, text
    assert rows[0]["k"] == 20210328


def test_parse_date_custom_formats(spark):
    df = spark.createDataFrame([("03/28/2021",)], "t string")
    assert df.select(parse_date_any("t", ["yyyy-MM-dd"]).alias("d")).first()["d"] is None


def test_least_positive_and_positions(spark):
    df = spark.createDataFrame(
        [(0, 86572, None, 5, "3"), (0, 0, 0, 0, "1"), (None, None, None, 3, "\\N"),
         (90000, 80000, 85000, 10, "R"), (1, 2, 3, 4, "200")],
        "a int, b int, c int, grid int, fin string")
    rows = df.select(least_positive("a", "b", "c").alias("best"),
                     positions_gained("grid", safe_cast("fin", "tinyint")).alias("gain")).collect()
    assert [r["best"] for r in rows] == [86572, None, None, 80000, 1]
    assert [r["gain"] for r in rows] == [2, None, None, None, None]


def test_text_helpers(spark):
    df = spark.createDataFrame([("  Lewis ", " Hamilton", ""), ("Max", None, "\\N"), (" a", "b ", "VER")],
                               "f string, l string, code string")
    rows = df.select(full_name("f", "l").alias("n"), blank_to_null("code").alias("c"),
                     null_tokens_to_null("code").alias("c2")).collect()
    assert [r["n"] for r in rows] == ["Lewis Hamilton", None, "a b"]
    assert [r["c"] for r in rows] == [None, "\\N", "VER"]
    assert [r["c2"] for r in rows] == [None, None, "VER"]


def test_safe_cast_overflow_and_text(spark):
    df = spark.createDataFrame([("127",), ("128",), ("1.0",), ("x",), ("12345.6789",)], "t string")
    rows = df.select(safe_cast("t", "tinyint").alias("b"), safe_cast("t", "decimal(7,3)").alias("d")).collect()
    assert [r["b"] for r in rows] == [127, None, None, None, None]
    assert rows[4]["d"] is None and rows[0]["d"] == Decimal("127.000")


def test_functions_stay_in_codegen(spark, capsys):
    df = spark.range(10).select("id", F.format_string("%d:%02d.%03d", F.col("id"), F.col("id"), F.col("id")).alias("t"))
    df.select(lap_time_ms("t"), parse_date_any("t"), least_positive("id", "id")).explain()
    plan = capsys.readouterr().out
    assert "WholeStageCodegen" in plan or "*(" in plan
    assert "BatchEvalPython" not in plan and "ArrowEvalPython" not in plan


def test_scale_conf_partitions():
    from starloom.session import scale_conf
    conf = scale_conf(100 * (1 << 40), executors=1000, cores_per_executor=8)
    assert int(conf["spark.sql.shuffle.partitions"]) == 409600
    small = scale_conf(1 << 30, executors=10, cores_per_executor=4)
    assert int(small["spark.sql.shuffle.partitions"]) == 80


def test_date_precheck_never_changes_results(spark):
    from starloom.functions.dates import DEFAULT_DATE_FORMATS
    texts = ["2021-03-28", "12021-03-28", "+12021-03-28", " 2021-03-28", "2021-03-28 ", "2021-3-28",
             "28-3-2021", "28/03/21", "2021/03/28", "2021-02-30", "31/12/1999", "12/31/1999",
             "2021-03-28T10:00", "0001-01-01", "99-99-9999", "", None, "\\N", "28.03.2021"]
    df = spark.createDataFrame([(t,) for t in texts], "t string")
    raw = F.coalesce(*[F.try_to_date("t", f) for f in DEFAULT_DATE_FORMATS])
    rows = df.select("t", parse_date_any("t").eqNullSafe(raw).alias("same"),
                     raw.isNotNull().alias("parsed")).collect()
    assert all(r["same"] for r in rows), [r["t"] for r in rows if not r["same"]]
    assert sum(r["parsed"] for r in rows) >= 5


def test_safe_cast_precheck_never_changes_results(spark):
    texts = ["12", " 12 ", "+7", "-128", "-129", "127", "128", "1.0", "1e3", "abc", "", None, "\\N",
             "R", "99999999999999999999", "0x10", "١٢"]
    df = spark.createDataFrame([(t,) for t in texts], "t string")
    for to in ("tinyint", "smallint", "int", "bigint", "decimal(7,3)"):
        rows = df.select(safe_cast("t", to).alias("a"), F.col("t").try_cast(to).alias("b")).collect()
        assert all(r["a"] == r["b"] for r in rows), (to, [(t, r["a"], r["b"]) for t, r in zip(texts, rows)])


def test_exact_sum_equals_decimal_sum(spark):
    from decimal import Decimal as D
    from starloom.functions import exact_sum
    df = spark.createDataFrame([(1, D("0.10")), (1, D("0.20")), (1, None), (2, D("-5.55")), (3, None),
                                (2, D("99999999.99"))], "g int, v decimal(12,2)")
    got = {r["g"]: r["s"] for r in df.groupBy("g").agg(exact_sum("v", 2).alias("s")).collect()}
    ref = {r["g"]: r["s"] for r in df.groupBy("g").agg(F.sum("v").cast("decimal(18,2)").alias("s")).collect()}
    assert got == ref and got[1] == D("0.30") and got[3] is None


def test_scale_conf_keys_are_known_spark_settings(spark):
    from starloom.session import scale_conf
    known = {r["key"] for r in spark.sql("SET -v").collect()}
    unknown = [k for k in scale_conf(1 << 40) if k not in known]
    assert unknown == []
