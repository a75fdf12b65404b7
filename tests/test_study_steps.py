"""The steps under the factor studies: how much code a stage holds, what is sorted."""

from conftest import SF

from slatecast.plans import quality, research
from slatecast.plans.warehouse import TABLES, StarWarehouse


def physical(df) -> str:
    return df._jdf.queryExecution().executedPlan().toString()


def test_factor_values_are_rounded_in_one_place(spark):
    names = list(research.FACTORS.values())
    wide = spark.createDataFrame([(2024, 5, 1, *[i / 7 for i in range(len(names))])],
                                 "season int, month int, has_hit int, " + ", ".join(f"{c} double" for c in names))
    long = research.long_form(wide, research.FACTORS)
    # once for the value, once for the control that is kept
    assert long._jdf.queryExecution().optimizedPlan().toString().count("FLOOR(") <= 2
    assert {r["factor"]: r["value"] for r in long.collect()} == {c: round(i / 7, 10) for i, c in enumerate(names)}


def test_long_methods_and_bucket_sorts_are_off(spark):
    StarWarehouse(spark, SF, ())
    # the JVM never compiles a method of more than 8,000 bytes
    assert int(spark.conf.get("spark.sql.codegen.hugeMethodLimit")) <= 8000
    assert int(spark.conf.get("spark.sql.maxConcurrentOutputFileWriters")) >= 1


def test_checks_write_only_the_columns_they_read(spark):
    w = StarWarehouse(spark, SF, TABLES)
    frame = quality.checked(w, "feat_batter_game")
    assert set(frame.columns) == {*quality.UNIQUE["feat_batter_game"], *quality.NOT_NULL["feat_batter_game"],
                                  *quality.LEAK_COLUMNS}
    # read by several checks, so it is built once
    assert "FileScan" in physical(frame) and "Window" not in physical(frame)
    assert quality.leaks(frame).isEmpty()
