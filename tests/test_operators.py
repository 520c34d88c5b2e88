"""Operators on rows small enough to work out by hand; sources, sinks, streams and jobs on tiny files."""

import datetime as dt
import gzip
import json
import math
import random
import uuid

import numpy as np
import pytest
from pyspark.sql import DataFrameWriter
from pyspark.sql import functions as F

from duelframe.functions import ids, scalars
from duelframe.operators import joins, known, reports, scan, windows
from duelframe.plans import contextual, jobs, models, ratings
from duelframe.queries.library import PARAMS
from duelframe.sources import scans, sinks
from duelframe.streaming import ledger

D = dt.date
MATCH = "match_id long, match_date date, home_id long, away_id long, home_goals long, away_goals long, competition string"


def params(spark, **over):
    p = {"param_id": "p", "k": 20.0, "home_advantage": 0.0, "margin_weight": 0.0, "idle_days": 10_000, "idle_share": 0.5} | over
    return spark.createDataFrame([tuple(p.values())], PARAMS)


def history(spark, rows, **over):
    out, now = ratings.rating_history(spark.createDataFrame(rows, MATCH), params(spark, **over), f"{spark.conf.get('spark.checkpoint.dir')}/{uuid.uuid4().hex}")
    return {r["match_id"]: r for r in out.collect()}, {r["team"]: r["rating"] for r in now.collect()}


def test_ratings_follow_dates(spark):
    out, _ = history(spark, [(1, D(2020, 1, 1), 1, 2, 1, 0, "c"), (2, D(2020, 1, 2), 1, 3, 0, 0, "c")])
    assert (out[1]["home_pre"], out[1]["away_pre"]) == (1500, 1500) and out[2]["home_pre"] == out[1]["home_post"] == 1510


def test_ratings_same_date_is_one_batch(spark):
    out, now = history(spark, [(1, D(2020, 1, 1), 1, 2, 1, 0, "c"), (2, D(2020, 1, 1), 1, 3, 1, 0, "c")])
    assert out[1]["home_pre"] == out[2]["home_pre"] == 1500 and out[1]["home_post"] == out[2]["home_post"] == now[1] == 1520


def test_ratings_idle_and_draw(spark):
    out, _ = history(spark, [(1, D(2020, 1, 1), 1, 2, 0, 0, "c"), (2, D(2020, 1, 2), 1, 3, 1, 0, "c"), (3, D(2020, 1, 12), 1, 4, 0, 1, "c")], idle_days=10, idle_share=0.5)
    assert out[1]["expected"] == 0.5 and out[1]["delta"] == 0 and out[3]["home_pre"] == 1500 + (out[2]["home_post"] - 1500) * 0.5


def test_decay_weight(spark):
    df = spark.createDataFrame([(D(2019, 7, 5),), (D(2020, 1, 1),)], "d date").select(scalars.decay_weight(F.col("d"), F.lit("2020-01-01").cast("date"), 180.0).alias("w"))
    assert [round(r["w"], 9) for r in df.collect()] == [0.5, 1.0]


def test_time_zones(spark):
    df = spark.createDataFrame([("2026-03-20 12:00:00",), ("2026-04-10 12:00:00",)], "t string").select(scalars.timezone_delta_hours(F.col("t").cast("timestamp"), F.lit("Europe/London"), F.lit("America/New_York")).alias("h"))
    assert [r["h"] for r in df.collect()] == [4.0, 5.0]


def test_features_of_one_team(spark):
    days = [10, 15, 20, 25]
    rows = [(k, 1, dt.datetime(2026, 1, d, 18), float(120 if d == 15 else 90), "c") for k, d in enumerate(days)]
    v = spark.createDataFrame(rows, "visit_id long, team long, kickoff timestamp, minutes double, competition string")
    v = windows.rolling_minutes(windows.rolling_match_counts(windows.rest_time(v, "team", "kickoff", "visit_id"), "team", "kickoff"), "team", "kickoff", "minutes", 7)
    v = windows.sequence_in_competition(windows.short_rest_streak(v, "team", ["kickoff", "visit_id"], "rest_days"), "team", "competition", "kickoff")
    third = v.filter("visit_id = 2").first()
    assert (third["rest_hours"], third["rest_days"], third["matches_7d"], third["matches_14d"], third["minutes_7d"], third["streak"], third["sequence_number"]) == (120, 5, 1, 2, 120, 2, 3)


def rank(spark, rows):
    m = spark.createDataFrame([("g", *r) for r in rows], "grp string, home_id long, away_id long, home_goals long, away_goals long")
    table = reports.group_standings(m.withColumns({"match_id": F.monotonically_increasing_id(), "match_date": F.lit("2026-01-01").cast("date"), "competition": F.col("grp")})).withColumnRenamed("competition", "grp")
    return [r["team"] for r in windows.rank_with_tiebreaks(table, m, 4).orderBy("position").collect()]


def test_tied_pair_goes_by_their_own_match(spark):
    assert rank(spark, [(1, 2, 1, 0), (2, 3, 9, 0), (3, 1, 1, 0), (4, 3, 0, 0), (4, 1, 0, 1), (4, 2, 0, 2)])[:2] == [1, 2]


def test_three_tied_go_by_difference_among_them(spark):
    a, b, c, d = 1, 2, 3, 4
    assert rank(spark, [(a, b, 1, 0), (b, c, 4, 0), (c, a, 2, 0), (a, d, 1, 0), (b, d, 1, 0), (c, d, 1, 0)]) == [b, a, c, d]


def test_conflicting_keys(spark):
    df = spark.createDataFrame([(1, "a", "x"), (2, "a", "x"), (3, "b", "x"), (4, "b", "y")], "n long, k string, v string")
    got = {r["n"]: r["decision"] for r in windows.dedupe_identical_or_conflict(df, ["k"], F.col("v"), "n").collect()}
    assert got == {1: "keep", 2: "duplicate", 3: "conflict", 4: "conflict"}


def test_param_grid_and_lookup(spark):
    grid = joins.param_grid(spark, k=[20.0, 30.0], home=[0.0, 50.0, 60.0])
    assert grid.count() == 6 and grid.select("param_id").distinct().count() == 6
    rows = spark.createDataFrame([(1, ["C", "A", "B"])], "id long, groups array<string>")
    assert joins.set_keyed_lookup(rows, "groups", spark.createDataFrame([("ABC", "slot")], "key string, slot string"), "key").first()["slot"] == "slot"


def test_table_digest_ignores_order(spark):
    df = spark.range(100).withColumn("x", F.col("id") % 7)
    assert ids.table_digest(df).first() == ids.table_digest(df.orderBy(F.desc("id")).repartition(3)).first() != ids.table_digest(df.withColumn("x", F.col("x") + 1)).first()


def test_permutation_importance(spark):
    df = spark.range(400).select("id", (F.col("id") % 2).cast("double").alias("signal"), (F.col("id") % 5).cast("double").alias("noise"), (F.col("id") % 2).alias("y"))
    scored = lambda x: x.withColumn("log_loss", F.abs(F.col("signal") - F.col("y")))
    got = {r["feature"]: r["increase"] for r in models.permutation_importance(scored, df, ["signal", "noise"], "id").collect()}
    assert got["signal"] > 0.2 and got["noise"] == 0


def test_goal_effects_sum_to_zero(spark):
    rows = [(k, D(2020, 1, 1 + k % 28), k % 4, (k + 1 + k % 3) % 4, (k * 7) % 4, (k * 5) % 3, "c") for k in range(60)]
    _, effects = models.weighted_poisson_goal_fit(spark.createDataFrame(rows, MATCH), "2021-01-01")
    assert all(abs(r["s"]) < 1e-9 for r in effects.filter("kind in ('attack', 'defence')").groupBy("kind").agg(F.sum("effect").alias("s")).collect())


def test_csv_scan(spark, tmp_path):
    (tmp_path / "r.csv").write_text("date,home,away\n2020-01-01, a ,b\n2020-01-02,a\n2020-01-03,a,b,c\n")
    good, bad = scans.csv_scan_strict(spark, str(tmp_path), ["date", "home"])
    assert [(r["date"], r["home"]) for r in good.collect()] == [("2020-01-01", "a")]
    assert sorted(r["reason"] for r in bad.collect()) == ["extra CSV fields", "missing CSV fields"]
    with pytest.raises(ValueError):
        scans.csv_scan_strict(spark, str(tmp_path), ["score"])


def test_csv_scan_of_several_files(spark, tmp_path):
    """Headers of their own, quoted commas and quotes, blank lines, a byte order mark; rows are numbered from 2."""
    (tmp_path / "a.csv").write_text('\ufeffhome,note\n a ,"x, ""y"""\n\nb,c,d\n', encoding="utf-8")
    (tmp_path / "b.csv").write_text("note,home,more\nn,h,m\nonly\n")
    good, bad = scans.csv_scan_strict(spark, str(tmp_path), ["home", "note"])
    assert sorted((r["home"], r["note"], r["more"], r["row_number"]) for r in good.collect()) == [("a", 'x, "y"', None, 2), ("h", "n", "m", 2)]
    assert sorted((r["reason"], r["row_number"], r["payload"]["line"]) for r in bad.collect()) == [("extra CSV fields", 4, "b,c,d"), ("missing CSV fields", 3, "only")]
    (tmp_path / "c.csv").write_text("other\n1\n")
    with pytest.raises(ValueError, match="home"):
        scans.csv_scan_strict(spark, str(tmp_path), ["home", "note"])


def test_csv_scan_of_very_wide_and_unclosed_lines(spark, tmp_path):
    """100,000 quoted fields in a line, marks that the splitting uses itself, quotes in the middle, and quoted line feeds."""
    n = 100_000
    (tmp_path / "a.csv").write_text('home,note\n' + ",".join(['"x, y"'] * n) + "\n" + ",".join(["z"] * n) + '\na\u0001b\u0002e,"c\u0002m,\u0001""d"\n5" x,"open\nrest",1\n"p, q"r,""\n')
    good, bad = scans.csv_scan_strict(spark, str(tmp_path), ["home", "note"])
    assert sorted((r["row_number"], r["home"], r["note"]) for r in good.collect()) == [(4, "a\u0001b\u0002e", 'c\u0002m,\u0001"d'), (7, '"p, q"r', "")]
    assert sorted((r["row_number"], r["reason"]) for r in bad.collect()) == [(2, "extra CSV fields"), (3, "extra CSV fields"), (5, "missing CSV fields"), (6, "unclosed quote")]
    wide = spark.createDataFrame([(",".join(['"x, y"'] * n),)], "line string").select(F.size(scans.fields_of(F.col("line")))).first()[0]
    assert wide == n


@pytest.mark.parametrize("seed", range(3))
def test_csv_fields_by_a_plain_machine(spark, seed):
    rnd = random.Random(seed)
    lines = ["".join(rnd.choice([",", '"', "a", " ", "\u0001", "\u0002", "e", "m"]) for _ in range(rnd.randrange(12))) for _ in range(400)]
    for line, fields in spark.createDataFrame([(x,) for x in lines], "line string").select("line", scans.fields_of(F.col("line"))).collect():
        want, inside = [""], False
        for c in line:
            inside ^= c == '"'
            want = [*want, ""] if c == "," and not inside else [*want[:-1], want[-1] + c]
        assert fields == want


def test_lines_are_numbered_across_splits(spark, tmp_path):
    (tmp_path / "t.txt").write_text("".join(f"line {k}\n" for k in range(1, 4001)))
    most = spark.conf.get("spark.sql.files.maxPartitionBytes")
    try:
        spark.conf.set("spark.sql.files.maxPartitionBytes", "4096")
        rows = scans.numbered_lines(spark, str(tmp_path)).collect()
    finally:
        spark.conf.set("spark.sql.files.maxPartitionBytes", most)
    assert len(rows) == 4000 and all(r["line"] == f"line {r['row_number']}" for r in rows)


def test_match_types(spark):
    names = ["Friendly", "FIFA World Cup", "FIFA World Cup qualification", "UEFA Euro", "UEFA Euro qualification", "Copa America", "Island Games", "High Cup"]
    got = [r[0] for r in spark.createDataFrame([(n,) for n in names], "n string").select(scalars.match_type_classifier(F.col("n"))).collect()]
    assert got == ["friendly", "world_cup", "qualification", "continental", "qualification", "continental", "other", "other"]


def test_json_scans(spark, tmp_path):
    side = lambda h, a: {"home": h, "away": a}
    a = {"matches": [{"id": 1, "utcDate": "2026-06-11T20:00:00Z", "status": "FINISHED", "group": "A", "homeTeam": {"name": "x"}, "awayTeam": {"name": "y"}, "score": {"duration": "REGULAR", "fullTime": side(2, 1)}}, {"id": 1, "utcDate": "2026-06-11T20:00:00Z", "status": "T"}, {"id": 2, "utcDate": "bad", "status": "T"}]}
    b = {"response": [{"fixture": {"id": 9, "date": "2026-06-11T20:00:00+00:00", "status": {"short": "AET"}}, "teams": {"home": {"name": "x"}, "away": {"name": "y"}}, "goals": side(1, 1), "score": {"extratime": side(1, None)}}]}
    (tmp_path / "a.json").write_text(json.dumps(a))
    (tmp_path / "b.json").write_text(json.dumps(b))
    valid, invalid = scans.fault_isolated(scans.json_collection_scan_a(spark, str(tmp_path / "a.json")))
    assert [(r["home_score"], r["stage"]) for r in valid.collect()] == [(2, "A")]
    assert sorted(r["reason"] for r in invalid.collect()) == ["duplicate id", "missing or bad kickoff"]
    other = scans.json_collection_scan_b(spark, str(tmp_path / "b.json"))
    assert other.columns == valid.columns and other.first()["home_extra"] is None and other.first()["home_score"] == 1


def test_histories_and_catalogues(spark, tmp_path):
    spark.range(3).coalesce(1).write.parquet(str(tmp_path / "h/a"))
    spark.range(5, 7).coalesce(1).write.parquet(str(tmp_path / "h/b"))
    rows = scans.history_dir_scan(spark, str(tmp_path / "h")).collect()
    assert len(rows) == 5 and len({r["file_sha256"] for r in rows}) == 2
    (tmp_path / "g").mkdir()
    with gzip.open(tmp_path / "g/x.csv.gz", "wt") as f:
        f.write("id,p\n1, 0.5\n2,\n3,NaN\n")
    got = scans.gzip_csv_history_scan(spark, str(tmp_path / "g"), ["p"]).orderBy("id").collect()
    assert [r["p"] for r in got] == [0.5, None, None] and all(r["config_checksum"] for r in got)
    (tmp_path / "v.csv").write_text("venue_id,aliases\n1,a|b\n2,\n")
    assert scans.catalog_scan(spark, str(tmp_path / "v.csv"), "venue_id", ("aliases",)).filter("venue_id = '1'").first()["aliases"] == ["a", "b"]
    assert scans.category_mapping(spark, {"x": ["a", "b"], "y": ["c"]}).count() == 3
    with pytest.raises(ValueError):
        scans.category_mapping(spark, {"x": ["a"], "y": ["a"]})


def test_snapshots_are_immutable(spark, tmp_path):
    path = str(tmp_path / "snaps")
    df = spark.range(4)
    first = sinks.immutable_snapshot_sink(df, path, "20260101")
    assert sinks.immutable_snapshot_sink(df, path, "20260101") == first
    with pytest.raises(ValueError):
        sinks.immutable_snapshot_sink(df.filter("id > 0"), path, "20260101")
    sinks.immutable_snapshot_sink(df.filter("id > 1"), path, "20260102")
    assert scans.latest_snapshot_scan(spark, path).count() == 2


def test_sinks(spark, tmp_path):
    df = spark.createDataFrame([(1, "scheduled", 0.5), (2, "finished", 0.25), (3, "odd", None)], "id long, status string, p double")
    sinks.status_partitioned_view(df, str(tmp_path / "s"), "id")
    assert {r["status_group"] for r in spark.read.parquet(str(tmp_path / "s")).collect()} == {"pending", "finished", "interrupted"}
    with pytest.raises(ValueError):
        sinks.status_partitioned_view(df.union(df), str(tmp_path / "s2"), "id")
    sinks.csv_sink(df, str(tmp_path / "c"))
    assert spark.read.option("header", True).csv(str(tmp_path / "c")).columns == ["id", "p", "status"]
    assert sinks.gzip_history_sink(df, str(tmp_path / "z")) and not sinks.gzip_history_sink(df.limit(0), str(tmp_path / "z0"))
    digest = sinks.write_if_changed(df.withColumn("cutoff", F.lit(1)), str(tmp_path / "w"), None, "cutoff")
    assert sinks.write_if_changed(df.withColumn("cutoff", F.lit(1)), str(tmp_path / "w"), digest, "cutoff") is None
    assert sinks.manifest_rows(df, "id").count() == 4
    (tmp_path / "pub").mkdir()
    (tmp_path / "pub/a.txt").write_text("fine")
    (tmp_path / "pub/b.txt").write_text("api_key = 123456789012345")
    got = {(r["path"].rsplit("/", 1)[1], r["violation"]) for r in sinks.publish_gate_scan(spark, str(tmp_path / "pub"), ["a.txt", "b.txt"]).collect()}
    assert got == {("b.txt", "key-like text")}
    manifest = spark.createDataFrame([("a.txt", "0"), ("c.txt", "0")], "name string, sha256 string")
    assert sinks.manifest_verify(spark, manifest, str(tmp_path / "pub")).count() == 2


def test_stream_ledger(spark, tmp_path):
    df = spark.createDataFrame([(1, "a"), (2, "b")], "id long, v string")
    schema = df.schema
    run = lambda: ledger.stream_ledger_append(spark.readStream.schema(schema).parquet(str(tmp_path / "in")), str(tmp_path / "ledger"), str(tmp_path / "cp"), "id", ["v"]).awaitTermination()
    df.write.mode("append").parquet(str(tmp_path / "in"))
    run()
    df.union(spark.createDataFrame([(3, "c")], schema)).write.mode("append").parquet(str(tmp_path / "in"))
    run()
    assert sorted(map(tuple, spark.read.parquet(str(tmp_path / "ledger")).collect())) == [(1, "a"), (2, "b"), (3, "c")]
    spark.createDataFrame([(1, "other")], schema).write.mode("append").parquet(str(tmp_path / "in"))
    with pytest.raises(Exception):
        run()


def test_stream_snapshot_changes(spark, tmp_path):
    shape = "id long, status string, at timestamp"
    rows = lambda hour, *xs: spark.createDataFrame([(i, s, dt.datetime(2026, 1, 1, hour)) for i, s in xs], shape)
    run = lambda: ledger.stream_snapshot_changes(spark.readStream.schema(rows(1, (1, "a")).schema).parquet(str(tmp_path / "in")), str(tmp_path / "state"), str(tmp_path / "out"), str(tmp_path / "cp"), "id", ["status"], "at").awaitTermination()
    for batch in (rows(1, (1, "a"), (2, "a")), rows(3, (1, "b"), (2, "a")), rows(2, (1, "z"))):
        batch.write.mode("append").parquet(str(tmp_path / "in"))
        run()
    got = sorted((r["id"], r["field"], r["now"]) for r in spark.read.parquet(str(tmp_path / "out")).collect())
    assert got == [(1, "new", None), (1, "status", "b"), (2, "new", None)]


def test_stream_snapshot_changes_survive_a_failure(spark, tmp_path, monkeypatch):
    """A batch that fails between its differences and its state, and is repeated, writes nothing twice; old states go."""
    shape = "id long, status string, at timestamp"
    out = str(tmp_path / "out")
    run = lambda: ledger.stream_snapshot_changes(spark.readStream.schema(spark.createDataFrame([], shape).schema).parquet(str(tmp_path / "in")), str(tmp_path / "state"), out, str(tmp_path / "cp"), "id", ["status"], "at").awaitTermination()
    for hour in range(1, 6):
        spark.createDataFrame([(1, f"s{hour}", dt.datetime(2026, 1, 1, hour)), (hour, "x", dt.datetime(2026, 1, 1, hour))][: 1 if hour == 1 else 2], shape).write.mode("append").parquet(str(tmp_path / "in"))
        if hour in (1, 3):
            with monkeypatch.context() as m:
                m.setattr(DataFrameWriter, "parquet", lambda self, path, *a, f=DataFrameWriter.parquet, **b: f(self, path, *a, **b) if "/state/" not in path else (_ for _ in ()).throw(OSError("lost")))
                with pytest.raises(Exception, match="lost"):
                    run()
            assert spark.read.parquet(out).count() > 0
        run()
    got = sorted((r["id"], r["field"], r["was"] or "", r["now"] or "") for r in spark.read.parquet(out).collect())
    assert got == sorted([(1, "new", "", "")] + [(1, "status", f"s{h - 1}", f"s{h}") for h in range(2, 6)] + [(h, "new", "", "") for h in range(2, 6)])
    assert len(list((tmp_path / "state").iterdir())) == 2


def test_shared_folder_must_be_named(spark):
    class Session:
        conf = type("C", (), {"get": staticmethod(lambda key, other=None: other)})
        sparkContext = type("S", (), {"getConf": staticmethod(lambda: {})})

    with pytest.raises(ValueError, match="names no folder"):
        ledger.shared_folder(Session)


def test_interval_join_counts_across_stretches(spark):
    at = [dt.datetime(2024, 1, 1) + dt.timedelta(days=d) for d in (0, 3, 6, 7, 7, 20)]
    rows = spark.createDataFrame([(k, 1, t) for k, t in enumerate(at)], "visit_id long, team long, kickoff timestamp")
    want = {k: sum(dt.timedelta(0) < t - u <= dt.timedelta(days=7) for u in at) for k, t in enumerate(at)}
    assert {r.visit_id: r.n for r in joins.interval_self_join(rows, 7).collect()} == want


@pytest.mark.parametrize("near", [1, 2, 16])
def test_previous_by_cutoff_looks_beyond_the_nearest(spark, near, monkeypatch):
    monkeypatch.setattr(known, "NEAR", near)
    monkeypatch.setattr(known, "STRETCH", 32)
    rnd = random.Random(5)
    data = [(k, k % 2, dt.datetime(2024, 1, 1) + dt.timedelta(hours=rnd.randrange(40)), dt.datetime(2024, 1, 1) + dt.timedelta(hours=rnd.randrange(90))) for k in range(60)]
    rows = spark.createDataFrame(data, "visit_id long, team long, kickoff timestamp, cutoff timestamp")
    best = {a[0]: max(((b[2], b[0]) for b in data if b[1] == a[1] and b[2] < a[2] and b[3] <= a[3]), default=(None, None))[1] for a in data}
    assert {r.visit_id: r.previous_id for r in joins.previous_asof_by_cutoff(rows).collect()} == best


def test_known_rows_of_a_hot_key(spark):
    """Latest known rows and sums over known rows against plain Python; one key has most rows, and rows known never or at once."""
    rnd = random.Random(2)
    data = [(i, 0 if rnd.random() < 0.8 else rnd.randrange(4), rnd.randrange(800), rnd.choice([None, 0, rnd.randrange(3000), rnd.randrange(3000)]), float(rnd.randrange(9))) for i in range(1500)]
    rows = known.placed(spark.createDataFrame(data, "id long, team long, t long, cutoff long, v double").repartition(6), "team", "t", "id").checkpoint()
    got = {r["id"]: r["b"] for r in known.with_latest_known(rows, "team", "cutoff", {"id": "id"}, "b").select("id", F.col("b.id").alias("b")).collect()}
    fits = lambda b, a: b[1] == a[1] and b[2] < a[2] and a[3] is not None and b[3] is not None and b[3] <= a[3]
    assert got == {a[0]: max(((b[2], b[0]) for b in data if fits(b, a)), default=(None, None))[1] for a in data}
    asked = rows.filter("cutoff is not null").select(F.col("id").alias("ask_"), F.col("team").alias("key_"), F.greatest(F.lit(0), F.col("floor_") - 50).alias("low_"), F.col("floor_").alias("high_"), F.col("cutoff").alias("cutoff_"))
    sums = {r["ask_"]: (r["n"], r["v"]) for r in known.known_sums(asked, rows, "team", "cutoff", {"n": F.lit(1), "v": F.col("v")}, 50).collect() if r["n"]}
    at = {r["place_"]: r for r in rows.collect()}
    want = {}
    for r in at.values():
        seen = [at[q]["v"] for q in range(max(0, r["floor_"] - 50), r["floor_"]) if r["cutoff"] is not None and at[q]["cutoff"] is not None and at[q]["team"] == r["team"] and at[q]["cutoff"] <= r["cutoff"]]
        want |= {r["id"]: (len(seen), sum(seen))} if seen else {}
    assert sums == want


def test_running_values_are_spread_over_tasks(spark):
    rnd = random.Random(6)
    data = [(k, 1 if k % 9 else k % 4, rnd.randrange(-5, 9), rnd.choice([None, 1.5])) for k in range(600)]
    df = spark.createDataFrame(data, "id long, team long, v long, w double").repartition(5)
    out = scan.running(df, ["team"], [F.col("id")], {"total": F.col("v"), "weight": F.col("w")}, {"top": F.col("v")})
    assert out.columns == ["id", "team", "v", "w", "total", "weight", "top"]
    assert scan.in_order(df, [F.col("team"), F.col("id")]).filter("team = 1").select("task_").distinct().count() > 1
    for r in out.collect():
        before = [x for x in data if x[1] == r["team"] and x[0] <= r["id"]]
        assert r["total"] == sum(x[2] for x in before) and r["top"] == max(x[2] for x in before) and r["weight"] == (sum(x[3] for x in before if x[3]) or None)


def test_one_team_with_all_rows_runs_in_many_tasks(spark):
    """Rest, streaks and flags of a team that has almost all rows, against a plain walk; tasks that hold it are several."""
    rnd = random.Random(7)
    data = [(k, 1 if k % 40 else 2, dt.datetime(2024, 1, 1) + dt.timedelta(hours=rnd.randrange(4000)), rnd.choice([None, 1, 3, 6, 7, 9]), "bad" if k == 77 else "ok") for k in range(700)]
    df = spark.createDataFrame(data, "id long, team long, at timestamp, rest int, source string").repartition(6)
    order = lambda r: (r[2], r[0])
    want = {}
    for team in (1, 2):
        before, streak, seen = None, 0, False
        for k, r in enumerate(sorted((x for x in data if x[1] == team), key=order)):
            streak = streak + 1 if r[3] is not None and r[3] < 7 else 0
            want[r[0]] = ((r[2] - before).total_seconds() / 3600 if before else None, streak, seen)
            before, seen = r[2], seen or r[4] == "bad"
    out = windows.rest_time(windows.short_rest_streak(windows.data_quality_flags(df, "team", ["at", "id"], "source", "bad"), "team", ["at", "id"], "rest"), "team", "at", "id")
    assert {r["id"]: (r["rest_hours"], r["streak"], r["untrusted_before"]) for r in out.collect()} == want
    assert scan.in_order(df, [F.col("team"), F.col("at")]).filter("team = 1").select("task_").distinct().count() > 2


def test_distribution_of_a_hot_group(spark):
    """Exact quartiles where one group has most rows, equal values, and one row alone; without groups too."""
    rnd = random.Random(4)
    data = [(None if k % 50 == 1 else "hot" if k % 10 else f"g{k % 3}", rnd.choice([1.0, 2.5, rnd.random() * 9, -3.0])) for k in range(2000)] + [("one", 7.0), ("hot", float("nan")), ("hot", None), ("hot", float("inf"))]
    df = spark.createDataFrame(data, "g string, v double").repartition(7)
    groups = {}
    for g, v in data:
        if v is not None and math.isfinite(v):
            groups.setdefault(g, []).append(v)
    want = lambda v: (len(v), min(v), *np.quantile(v, [0.25, 0.5, 0.75]), max(v))
    got = {r[0]: tuple(r)[1:] for r in reports.distribution_summary(df, "v", "g").collect()}
    assert set(got) == set(groups) and all(np.allclose(got[g], want(v)) for g, v in groups.items())
    assert np.allclose(tuple(reports.distribution_summary(df, "v").first()), want([v for own in groups.values() for v in own]))


def test_features_do_not_see_what_was_not_known(spark):
    """An earlier match that became known after a match's cutoff is none of its features' business."""
    t = lambda d, h=18: dt.datetime(2026, 1, d, h)
    shape = "match_id long, match_date date, kickoff timestamp, home_id long, away_id long, competition string, site_id long, neutral boolean, extra_time boolean, penalties boolean, trusted boolean, cutoff timestamp"
    row = lambda k, d, cutoff: (k, D(2026, 1, d), t(d), 1, 10 + k, "c", 1, None, False, False, True, cutoff)
    matches = spark.createDataFrame([row(1, 15, t(16, 0)), row(2, 20, t(14, 0)), row(3, 25, t(14, 0)), row(4, 27, t(28, 0))], shape)
    sites = spark.createDataFrame([(1, 1, 0.0, 0.0, 0, "UTC")], "site_id long, country long, latitude double, longitude double, elevation long, zone string")
    hosts = spark.createDataFrame([(1, 1)], "country long, team long")
    got = {r["match_id"]: r for r in contextual.team_rows(matches, sites, hosts).filter("team = 1").collect()}
    assert got[2]["previous_match_id"] is None and got[2]["matches_7d"] == 0 and got[2]["rest_hours"] is None and got[2]["tournament_match_number"] == 1
    assert got[3]["previous_match_id"] == 2 and got[3]["matches_14d"] == 1 and got[3]["minutes_14d"] == 90 and got[3]["tournament_match_number"] == 2
    assert got[4]["previous_match_id"] == 3 and got[4]["matches_14d"] == 3 and got[4]["tournament_match_number"] == 4 and got[4]["minutes_30d"] == 270


def test_historical_ingest_places_each_row_once(spark):
    raw = spark.createDataFrame(
        [(1, "2020-01-01", "A", "B", "1", "0"), (2, "2020-01-01", "A", " B ", "1", "0"), (3, "2020-01-02", "A", "B", "1", "0"), (4, "2020-01-02", "A", "B", "2", "0"), (5, "x", "A", "B", "1", "0"), (6, "2020-01-03", "A", "C", "1", "0"), (7, "2020-01-04", "A", "A2", "1", "0"), (8, "2020-01-05", None, "B", "1", "0")],
        "row_id long, day string, home string, away string, home_score string, away_score string",
    )
    alias = spark.createDataFrame([("A", 1), ("A2", 1), ("B", 2)], "name string, entity long").withColumns({c: F.lit(None).cast("date") for c in ("valid_from", "valid_to")})
    accepted, quarantined = jobs.historical_ingest(raw, alias)
    assert [(r.row_id, r.home_entity, r.away_entity) for r in accepted.collect()] == [(1, 1, 2)]
    assert {r.row_id: (r.stage, r.reason) for r in quarantined.collect()} == {
        2: ("dedupe", "duplicate"), 3: ("dedupe", "conflict"), 4: ("dedupe", "conflict"), 5: ("parse", "invalid day"), 6: ("resolve", "away unresolved"), 7: ("contract", "same teams"), 8: ("parse", "invalid home"),
    }


def test_live_ingest_writes_a_snapshot_once(spark, tmp_path):
    cur = spark.createDataFrame([(1, "v", "scheduled", None)], "id long, venue string, status string, updated timestamp")
    for _ in range(2):
        out = jobs.live_ingest(cur.limit(0), cur, cur, ["venue", "status"], "2024-01-15 00:00:00", 24, str(tmp_path))
        assert {(r.check, r.detail, r.n) for r in out.collect()} == {("change", "new", 1), ("stale", "scheduled", 1)}
    assert spark.read.parquet(f"{tmp_path}/snapshots").count() == 1
    assert spark.read.parquet(f"{tmp_path}/view").first().status_group == "pending"


def test_challenger_needs_exactly_the_official_fixtures(spark):
    official = spark.createDataFrame([(1, 0.5, 0.2, 0.3)], "match_id long, p_home double, p_draw double, p_away double")
    with pytest.raises(ValueError):
        jobs.predict_challenger(official, spark.createDataFrame([(2, 1.0)], "match_id long, load double"), None, 1.0)


def test_param_grid_has_all_combinations(spark):
    rows = joins.param_grid(spark, a=[1, 2], b=[3, 4, 5]).collect()
    assert {(r.a, r.b) for r in rows} == {(float(a), float(b)) for a in (1, 2) for b in (3, 4, 5)} and len({r.param_id for r in rows}) == 6
