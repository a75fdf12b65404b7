import json

import pytest
from conftest import day
from pyspark.sql import functions as F

from slatecast.schemas import RAW
from slatecast.sources import flatten, readers, sinks
from slatecast.streaming import jobs


def write_json(path, doc):
    path.mkdir(parents=True, exist_ok=True)
    (path / "doc.json").write_text(json.dumps(doc))
    return str(path)


def side(team, probable=None):
    out = {"team": {"id": team, "name": f"Team {team}"}}
    if probable:
        out["probablePitcher"] = {"id": probable, "fullName": f"P{probable}"}
    return out


def game(pk, status, probable=None):
    return {"gamePk": pk, "officialDate": "2024-06-15", "season": "2024", "gameType": "R",
            "status": {"detailedState": status}, "dayNight": "day", "doubleHeader": "N", "gameNumber": 1,
            "venue": {"id": 3, "name": "Park"}, "teams": {"home": side(100, probable), "away": side(200)}}


def test_flatten_documents(spark, tmp_path):
    schedule = write_json(tmp_path / "s", {"dates": [{"games": [game(1, "Final", 77)]},
                                                    {"games": [game(2, "Scheduled")]}], "extra": 1})
    games = flatten.flatten_schedule(flatten.read_documents(spark, schedule, flatten.SCHEDULE))
    assert games.columns == [c for c in RAW["games"].names if c != "load_id"]
    rows = {r["game_pk"]: r for r in games.collect()}
    assert rows[1]["home_probable_pitcher_id"] == 77 and rows[2]["home_probable_pitcher_id"] is None

    def player(pid, order=None, batting=None):
        p = {"person": {"id": pid, "fullName": f"B{pid}"}, "position": {"abbreviation": "CF"}}
        if order is not None:
            p["battingOrder"] = order
        if batting is not None:
            p["stats"] = {"batting": batting}
        return p

    line = {"plateAppearances": 4, "atBats": 3, "hits": 1, "baseOnBalls": 1}
    box = {"home": {"team": {"id": 100}, "players": {"ID1": player(1, "100", line), "ID2": player(2, "101", line),
                                                     "ID3": player(3, "200", {}), "ID4": player(4, None, line)}},
           "away": {"team": {"id": 200}, "players": {"ID5": player(5, "300")}}}
    docs = tmp_path / "b"
    docs.mkdir()
    for pk in (1, 2):
        (docs / f"{pk}.json").write_text(json.dumps({"gamePk": pk, "teams": box}))
    boxes = flatten.read_documents(spark, str(docs), flatten.BOXSCORE)
    lines = flatten.flatten_boxscore_lines(boxes, games)
    assert lines.columns == [c for c in RAW["batting_lines"].names if c != "load_id"]
    got = {r["player_id"]: (r["game_pk"], r["batting_order"], r["is_substitute"], r["walks"], r["is_home"])
           for r in lines.collect()}
    assert got == {1: (1, 100, False, 1, True), 2: (1, 101, True, 1, True), 4: (1, None, False, 1, True)}
    posted = sorted((r["game_pk"], r["player_id"], r["batting_order"]) for r in flatten.flatten_lineups(boxes, games).collect())
    assert posted == [(2, 1, 100), (2, 2, 101), (2, 3, 200), (2, 5, 300)]

    table = write_json(tmp_path / "t", {"asOf": "2024-06-15", "records": [
        {"division": {"id": 5}, "teamRecords": [{"team": {"id": 100, "name": "T"}, "divisionRank": "2",
                                                "wins": 3, "winningPercentage": ".500"}]}]})
    rank = flatten.flatten_standings(flatten.read_documents(spark, table, flatten.STANDINGS)).first()
    assert (rank["division_id"], rank["league_id"], rank["division_rank"], rank["win_pct"]) == (5, None, "2", ".500")
    staff = write_json(tmp_path / "c", {"season": 2024, "team": {"id": 100, "name": "T"}, "roster": [
        {"person": {"id": 9, "fullName": "M"}, "job": "Manager", "jobId": "MNGR"}]})
    assert flatten.flatten_coaches(flatten.read_documents(spark, staff, flatten.COACHES)).first()["person_id"] == 9


def test_pitch_reader_pins_types(spark, tmp_path):
    (tmp_path / "p.csv").write_text("game_pk,game_date,zone,launch_speed,events,extra\n"
                                    "7,2024-05-01 00:00:00,5.0,bad,single,x\n8,2024-05-02,,NaN,,y\n")
    df = readers.read_pitches(spark, str(tmp_path / "p.csv"), "csv")
    assert df.columns == RAW["pitches"].names
    rows = {r["game_pk"]: r for r in df.collect()}
    assert (rows[7]["zone"], rows[7]["launch_speed"], rows[7]["game_date"], rows[7]["pitch_type"]) == (5, None, "2024-05-01", None)
    assert rows[8]["launch_speed"] is None and rows[8]["events"] is None


def test_war_reader(spark, tmp_path):
    body = "".join(f"{i},n{i},2024,1,T,L,{i},1,0.5,{i}.5,{'x' if i % 2 else i}\n" for i in range(1, 11))
    (tmp_path / "w.txt").write_text("mlb_ID,name_common,year_ID,stint_ID,team_ID,lg_ID,PA,G,WAR,salary,mixed\n" + body
                                    + "NULL,old,2019,1,T,L,5,1,1,1,1\n11,gap,2023,1,T,L,NULL,1,NULL,NULL,z\n")
    war = readers.read_war(spark, str(tmp_path / "w.txt"), 2020, 2024)
    kinds = dict(war.dtypes)
    assert war.count() == 11 and kinds["salary"] == "double" and kinds["mixed"] == "string" and kinds["mlb_id"] == "bigint"
    assert [tuple(r) for r in war.filter("mlb_id = 11").select("pa", "war").collect()] == [(None, None)]
    snap = readers.snapshot_war(war, 2024, "2024-06-01")
    assert snap.count() == 10 and snap.first()["snapshot_date"] == "2024-06-01"


def test_appends_cursor_and_window(spark, tmp_path):
    path = str(tmp_path / "games")
    assert readers.table_or_empty(spark, path, "games").count() == 0
    rows = spark.createDataFrame([(i, f"2024-06-{i:02d}") for i in range(1, 31)], "game_pk long, official_date string")
    sinks.append_raw(rows, path, "games")
    sinks.append_raw(rows.limit(2), path, "games")
    table = readers.table_or_empty(spark, path, "games")
    assert table.count() == 32
    target = rows.filter("game_pk <= 3")
    cut = sinks.incremental_slice(rows, target, "official_date", "2024-07-30").agg(F.min("game_pk"), F.max("game_pk")).first()
    assert tuple(cut) == (3, 24)
    assert sinks.incremental_slice(rows, target, "official_date", "2024-06-10").count() == 7      # to yesterday
    cold = sinks.incremental_slice(rows, target.limit(0), "official_date", "2024-07-30", "2024-06-05", 3)
    assert cold.count() == 4
    assert sinks.reload_window(rows, "official_date", "2024-06-15", 3, 1).count() == 5
    beat = str(tmp_path / "beat")
    for i in range(2):
        sinks.append_heartbeat(spark, beat, f"2024-06-0{i + 1} 00:00:00", "local", "dev")
    assert spark.read.parquet(beat).count() == 2
    report = {r["table"]: r for r in sinks.coverage(spark, {"games": table, "pitches": None}).collect()}
    assert report["pitches"]["state"] == "MISSING" and report["games"]["last_date"] == "2024-06-30"


def test_prediction_log_and_cache(spark, tmp_path):
    row = spark.range(1).select(*[F.lit(None).cast(f.dataType).alias(f.name) for f in RAW["predictions"]])
    for _ in range(2):
        sinks.append_predictions(row, str(tmp_path / "log"))
    assert spark.read.parquet(str(tmp_path / "log")).count() == 2
    with pytest.raises(ValueError):
        sinks.append_predictions(row.drop("p_hit"), str(tmp_path / "log"))
    built = []

    def build(n):
        built.append(n)
        return spark.range(n)

    cache = str(tmp_path / "cache")
    assert sinks.cached_frame(spark, cache, lambda: build(3)).count() == 3
    assert sinks.cached_frame(spark, cache, lambda: build(5)).count() == 3 and built == [3]
    assert sinks.cached_frame(spark, cache, lambda: build(5), refresh=True).count() == 5
    assert sinks.materialize("staging", "stg_demo", spark.range(2)).count() == 2


def test_dedup_stream_restarts_from_its_checkpoint(spark, tmp_path):
    land, out, ck = (str(tmp_path / n) for n in ("land", "out", "ck"))
    schema = spark.createDataFrame([], "k int, v string").schema

    def load(*rows):
        spark.createDataFrame(list(rows), schema).coalesce(1).write.mode("append").parquet(land)
        jobs.drain(jobs.dedup_stream(jobs.landed_stream(spark, land, schema), ["k"]), out, ck)
        return sorted(r["k"] for r in spark.read.parquet(out).collect())

    assert load((1, "a"), (2, "b"), (1, "a")) == [1, 2]
    assert load((2, "b"), (3, "c")) == [1, 2, 3]


def test_late_rows_inside_the_window_only(spark, tmp_path):
    land, out, ck = (str(tmp_path / n) for n in ("land", "out", "ck"))
    schema = spark.createDataFrame([], "k int, d date").schema

    def load(*rows):
        spark.createDataFrame([(k, day(d)) for k, d in rows], schema).coalesce(1).write.mode("append").parquet(land)
        jobs.drain(jobs.late_tolerant(jobs.landed_stream(spark, land, schema), ["k"], "d", 3), out, ck)
        return sorted(r["k"] for r in spark.read.parquet(out).collect())

    assert load((1, "2024-06-10")) == [1]
    assert load((2, "2024-06-08"), (3, "2024-06-01")) == [1, 2]      # two days late kept, nine dropped


def test_latest_stream_rewrites_touched_buckets_only(spark, tmp_path):
    land, ck, root = str(tmp_path / "land"), str(tmp_path / "ck"), tmp_path / "t"
    schema = spark.createDataFrame([], "k int, load string").schema
    table = jobs.BucketedTable(spark, str(root), schema, ["k"], [F.col("load").desc()], buckets=50)
    assert table.current().count() == 0

    def load(rows):
        spark.createDataFrame(rows, schema).coalesce(1).write.mode("append").parquet(land)
        jobs.latest_stream(jobs.landed_stream(spark, land, schema), table, ck)
        return dict(map(tuple, table.current().collect()))

    def files():
        return {p.parent.name: p.name for p in root.glob("_bucket=*/*.parquet")}

    want = {k: "1" for k in range(1000)}
    assert load([(k, "1") for k in range(1000)]) == want
    before = files()
    assert len(before) == 50
    # one in a hundred keys, the earlier of two loads and a key that is new
    change = {k: "3" for k in range(0, 1000, 100)}
    assert load([(k, "3") for k in change] + [(0, "2"), (100, "0"), (5000, "1")]) == {**want, **change, 5000: "1"}
    after = files()
    changed = {b for b in after if after[b] != before.get(b)}
    touched = {r[0] for r in spark.createDataFrame([(k,) for k in [*change, 5000]], "k int").select(
        table._bucket()).collect()}
    assert changed == {f"_bucket={b}" for b in touched} and len(after) == 50      # one file per bucket, old ones gone
    # a replayed batch changes no row
    table.merge(spark.createDataFrame([(0, "2"), (5000, "1")], schema))
    assert dict(map(tuple, table.current().collect())) == {**want, **change, 5000: "1"}
