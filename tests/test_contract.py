"""The driver contract: keys agree, and twins agree on the smallest tables."""

import glob
import os

import duckdb
import pytest
from conftest import SF

import __spark_entry__ as contract
from scripts.compare import rows_of

NO_TWIN = {"train_scoreboard"}


def test_every_query_has_its_statement():
    assert set(contract.queries()) - set(contract.oracle_sql()) - set(contract.CORPUS) == NO_TWIN
    assert set(contract.oracle_sql()) <= set(contract.queries())


@pytest.fixture(scope="module")
def con():
    c = duckdb.connect()
    for path in glob.glob(f"{SF}/*.parquet"):
        c.execute(f"create view {os.path.basename(path)[:-8]} as select * from '{path}'")
    return c


@pytest.mark.parametrize("name", ["pitch_flags", "int_batter_game", "dim_team", "fct_pitcher_game",
                                  "fct_batter_vs_pitcher", "asof_last_purchase", "price_spearman", "stream_latest"])
def test_twins_agree(spark, con, name):
    mine = contract.queries()[name](spark, SF).toArrow()
    theirs = con.execute(contract.oracle_sql()[name]).to_arrow_table()
    assert sorted(mine.column_names) == sorted(theirs.column_names)
    assert rows_of(mine) == rows_of(theirs)


def test_entry(spark):
    assert contract.entry(spark).columns == ["game_pk", "game_date", "batter_id", "has_hit", "game_idx",
                                             "has_hit_roll10", "eb_hit_per_pa_career"]
