from pyspark.sql import functions as F

from slatecast.functions import rates
from slatecast.operators.dedup import latest_wins, top_k
from slatecast.operators.modal import infer_switch, latest_value, modal_value


def test_latest_wins_is_order_independent_and_idempotent(spark):
    rows = [(1, "10", "a"), (1, "20", "b"), (1, "20", "c"), (2, None, "z"), (2, "05", "y")]
    order = [F.col("load").desc_nulls_last()]
    for data in (rows, rows[::-1], rows + rows):
        df = spark.createDataFrame(data, "k int, load string, v string")
        once = latest_wins(df, ["k"], order)
        assert sorted(map(tuple, once.collect())) == [(1, "20", "b"), (2, "05", "y")]
        assert sorted(map(tuple, latest_wins(once, ["k"], order).collect())) == [(1, "20", "b"), (2, "05", "y")]


def test_dedup_limits_before_the_shuffle(spark):
    df = spark.range(100).select((F.col("id") % 3).alias("k"), "id")
    plan = latest_wins(df, ["k"], [F.col("id").desc()])._jdf.queryExecution().executedPlan().toString()
    assert plan.count("WindowGroupLimit") == 2      # partial below the exchange, final above


def test_top_k_ties(spark):
    df = spark.createDataFrame([("d", 1, 0.5), ("d", 2, 0.5), ("d", 3, 0.9)], "day string, id int, p double")
    got = top_k(df, ["day"], [F.col("p").desc(), F.col("id").asc()], 2)
    assert sorted((r["id"], r["rank"]) for r in got.collect()) == [(1, 2), (3, 1)]


def test_modal_latest_switch(spark):
    df = spark.createDataFrame(
        [(1, "R", 1), (1, "L", 2), (2, "R", 1), (2, "R", 2), (2, "L", 3), (3, None, 1)], "p int, s string, t int")
    assert {r["p"]: r["m"] for r in modal_value(df, ["p"], "s", "m").collect()} == {1: "L", 2: "R"}
    assert {r["p"]: r["m"] for r in latest_value(df, ["p"], "s", "t", "m").collect()} == {1: "L", 2: "L", 3: None}
    many = [(1, "L")] * 9 + [(1, "R")] * 1 + [(2, "L")] * 8 + [(2, "R")] * 2 + [(3, "R")] * 4
    sides = spark.createDataFrame(many, "p int, s string")
    assert {r["p"]: r["b"] for r in infer_switch(sides, "p", "s", "b").collect()} == {1: "L", 2: "S", 3: "R"}


def test_rates(spark):
    df = spark.createDataFrame([(1, 0, 10), (3, 4, 0), (0, 10, 5), (10, 10, 5)], "k int, n int, x int")
    lo, hi = rates.wilson("k", "n")
    got = df.select(rates.safe_div("k", "n").alias("r"), lo.alias("lo"), hi.alias("hi"),
                    rates.clip("x", 1, 6).alias("c"), rates.rate("k", "n").alias("q")).collect()
    assert got[0]["r"] is None and got[0]["lo"] is None and got[1]["r"] == 0.75
    assert abs(got[2]["lo"]) < 1e-12 and 0.27 < got[2]["hi"] < 0.28      # 0 of 10
    assert 0.72 < got[3]["lo"] < 0.73 and abs(got[3]["hi"] - 1) < 1e-12   # 10 of 10
    assert [r["c"] for r in got] == [6.0, 1.0, 5.0, 5.0]
    slots = spark.createDataFrame([(100,), (901,), (None,)], "o int").select(rates.lineup_slot("o").alias("s"))
    assert [r["s"] for r in slots.collect()] == [1, 9, None]
