"""The distributed order-dependent scans equal their single-window definitions,
including a hot group spanning many partitions and empty partitions."""

import pytest
from pyspark.sql import Window
from pyspark.sql import functions as F

from histmill.operators import ordered
from histmill.operators.ordered import forward_fill, global_islands, grouped_row_number


def _rows(df, cols):
    return sorted((tuple(r[c] for c in cols) for r in df.collect()), key=repr)


def test_grouped_row_number_hot_group(spark):
    data = [(1 if i % 3 else i % 7, i) for i in range(600)] + [(None, i) for i in range(1000, 1010)]
    df = spark.createDataFrame(data, "g int, o int")
    got = grouped_row_number(df, ["g"], ["o"], "rn", partitions=9)
    want = df.withColumn("rn", F.row_number().over(Window.partitionBy("g").orderBy("o")))
    assert _rows(got, ["g", "o", "rn"]) == _rows(want, ["g", "o", "rn"])


def test_forward_fill_single_group_many_partitions(spark):
    data = [("f", i, (i if i % 37 == 0 else None)) for i in range(500)]
    data += [("g", i, None) for i in range(3)] + [("h", 5, 7), ("h", 6, None)]
    df = spark.createDataFrame(data, "f string, n int, v int")
    got = forward_fill(df, ["f"], ["n"], "v", "filled", partitions=11)
    w = Window.partitionBy("f").orderBy("n").rowsBetween(Window.unboundedPreceding, 0)
    want = df.withColumn("filled", F.last("v", ignorenulls=True).over(w))
    assert _rows(got, ["f", "n", "filled"]) == _rows(want, ["f", "n", "filled"])


def test_forward_fill_without_group(spark):
    df = spark.createDataFrame([(i, i if i % 50 == 3 else None) for i in range(400)], "n int, v int")
    got = forward_fill(df, [], ["n"], "v", "filled", partitions=7)
    w = Window.orderBy("n").rowsBetween(Window.unboundedPreceding, 0)
    want = df.withColumn("filled", F.last("v", ignorenulls=True).over(w))
    assert _rows(got, ["n", "filled"]) == _rows(want, ["n", "filled"])


def _opens(prev, cur):
    return prev["u"].isNotNull() & (F.coalesce(cur["u"] != prev["u"], F.lit(False)) | (cur["c"] != prev["c"]))


def test_global_islands_equal_single_window(spark):
    users = ["a", "a", None, "b", "b", "a", None, None, "a"]
    comments = ["x", "x", "x", "x", "y", "y", "y", "z", "z"]
    data = [(i, users[i % 9], comments[(i // 2) % 9]) for i in range(300)]
    df = spark.createDataFrame(data, "t int, u string, c string")
    got = global_islands(df, ["t"], _opens, ["u", "c"], "seq", partitions=13)
    w = Window.orderBy("t")
    flag = F.when(_opens({"u": F.lag("u").over(w), "c": F.lag("c").over(w)}, {"u": F.col("u"), "c": F.col("c")}),
                  1).otherwise(0)
    want = df.withColumn("f", flag).withColumn(
        "seq", 1 + F.sum("f").over(w.rowsBetween(Window.unboundedPreceding, 0)))
    assert _rows(got, ["t", "seq"]) == _rows(want, ["t", "seq"])


def test_plain_path_equals_two_phase(spark):
    data = [(i % 5, i, i if i % 11 == 0 else None) for i in range(200)]
    df = spark.createDataFrame(data, "g int, o int, v int")
    a = grouped_row_number(df, ["g"], ["o"], "rn", partitions=6)
    b = grouped_row_number(df, ["g"], ["o"], "rn")
    assert _rows(a, ["g", "o", "rn"]) == _rows(b, ["g", "o", "rn"])
    c = forward_fill(df, ["g"], ["o"], "v", "f", partitions=6)
    d = forward_fill(df, ["g"], ["o"], "v", "f")
    assert _rows(c, ["g", "o", "f"]) == _rows(d, ["g", "o", "f"])


def test_ordered_scans_shuffle_nothing_after_staging(spark):
    """The stage table is bucketed as its rows lie: windows by partition id need no exchange."""
    df = spark.range(200).selectExpr("id % 7 as g", "id as o", "id % 3 as v")
    plan = ordered.stage_by_range(df, ["g", "o"])._jdf.queryExecution().executedPlan().toString()
    assert "Window" in plan and "Exchange" not in plan


@pytest.mark.parametrize("parts", [1, 4, 9])
def test_group_first_of_groups_that_span_partitions(spark, parts):
    rows = [(None if i % 5 == 4 else i % 5 if i < 40 else 2, i % 3 or None, (i * 37) % 101) for i in range(120)]
    df = spark.createDataFrame(rows, "g int, h int, o int")
    got = ordered.with_group_first(df, ["g", "h"], ["o"], "first", partitions=parts).collect()
    least = {}
    for g, h, o in rows:
        least[g, h] = min(o, least.get((g, h), o))
    assert len(got) == len(rows) and all(r["first"]["o"] == least[r.g, r.h] for r in got)
