"""Windows: rest, rolling counts, streaks, selections, duplicates, ranks with tie-breaks."""

from __future__ import annotations

from collections.abc import Callable
from itertools import count

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from duelframe.operators import scan

DAY = 86_400_000_000


def _micros(kickoff: str) -> Column:
    return F.unix_micros(F.col(kickoff))


def in_stretches(rows: DataFrame, key: str, kickoff: str, days: int, columns: Callable) -> DataFrame:
    """``rows`` with the columns that ``columns`` makes of windows over at most so many days.

    Rows stand in their own stretch of that many days and, as context, in the next one, and windows are by key and
    stretch: a key with very many rows is spread over time. ``columns`` gets a function that makes the window of the
    last days, without the current instant unless told ``including``.
    """
    at = _micros(kickoff)
    part = F.floor(at / (days * DAY))
    both = F.array(F.struct(part.alias("part_"), F.lit(True).alias("own_")), F.when(at.isNotNull(), F.struct((part + 1).alias("part_"), F.lit(False).alias("own_"))))
    dealt = rows.withColumns({"at_": at, "in_": F.explode(F.array_compact(both))}).select("*", "in_.*")

    def last(span: int, including: bool = False):
        return Window.partitionBy(key, "part_").orderBy("at_").rangeBetween(-span * DAY, 0 if including else -1)

    return dealt.withColumns(columns(last)).filter("own_").drop("at_", "in_", "part_", "own_")


def rolling_match_counts(rows: DataFrame, key: str, kickoff: str, days: tuple[int, ...] = (7, 14, 30)) -> DataFrame:
    return in_stretches(rows, key, kickoff, max(days), lambda last: {f"matches_{d}d": F.count("*").over(last(d)) for d in days})


def rolling_minutes(rows: DataFrame, key: str, kickoff: str, minutes: str, *days: int) -> DataFrame:
    """Sum over the window; nothing there is 0, anything unknown there makes it unknown."""

    def made(last: Callable) -> dict[str, Column]:
        unknown = {d: F.count_if(F.col(minutes).isNull()).over(last(d)) for d in days}
        return {f"{minutes}_{d}d": F.when(unknown[d] > 0, None).otherwise(F.coalesce(F.sum(minutes).over(last(d)), F.lit(0.0))) for d in days}

    return in_stretches(rows, key, kickoff, max(days), made)


def rolling_travel(rows: DataFrame, key: str, kickoff: str, distance: str, *days: int) -> DataFrame:
    """Sum of known distances over the window with the current row; null if none is known."""
    return in_stretches(rows, key, kickoff, max(days), lambda last: {f"{distance}_{d}d": F.sum(distance).over(last(d, including=True)) for d in days})


def rest_time(rows: DataFrame, key: str, kickoff: str, tie: str) -> DataFrame:
    """Hours and whole days since the key's previous row."""
    out = scan.lagged(rows, [key], [F.col(kickoff), F.col(tie)], {"previous_": kickoff})
    return out.withColumns({"rest_hours": (_micros(kickoff) - F.unix_micros("previous_")) / 3.6e9, "rest_days": F.datediff(F.col(kickoff), "previous_")}).drop("previous_")


def short_rest_streak(rows: DataFrame, key: str, order: list[str], rest_days: str, limit: int = 7) -> DataFrame:
    """Consecutive rows with short rest; a first row, unknown rest or long rest starts again at 0.

    The streak is how many places a row stands behind the last one that started again.
    """
    keys = [F.col(c) for c in order]
    placed = scan.places(rows, [F.col(key), *keys], "stand_")
    starts = F.when(~F.coalesce(F.col(rest_days) < limit, F.lit(False)), F.col("stand_"))
    out = scan.running(placed, [key], [F.col("stand_")], most={"start_": starts})
    first = out.groupBy(F.col(key).alias("of_key_")).agg(F.min("stand_").alias("begin_"))  # where a first row has a short rest, it counts as one
    met = out.join(first, F.col(key).eqNullSafe(F.col("of_key_")))
    return met.withColumn("streak", (F.col("stand_") - F.coalesce(F.col("start_"), F.col("begin_") - 1)).cast("int")).drop("stand_", "start_", "of_key_", "begin_")


def sequence_in_competition(rows: DataFrame, key: str, competition: str, kickoff: str) -> DataFrame:
    w = Window.partitionBy(key, competition).orderBy(_micros(kickoff)).rangeBetween(Window.unboundedPreceding, -1)
    out = rows.withColumn("sequence_number", F.count("*").over(w) + 1)
    return out.withColumn("first_match", F.col("sequence_number") == 1)


def data_quality_flags(rows: DataFrame, key: str, order: list[str], source: str, untrusted: str) -> DataFrame:
    """Whether any earlier row of the key is from the untrusted source."""
    bad = F.coalesce(F.col(source) == untrusted, F.lit(False)).cast("int")
    out = scan.running(rows, [key], [F.col(c) for c in order], {"bad_": bad})
    return out.withColumn("untrusted_before", F.col("bad_") - bad > 0).drop("bad_")


def dedupe_identical_or_conflict(rows: DataFrame, keys: list[str], payload: Column, order: str) -> DataFrame:
    """Adds ``decision``: keep, duplicate (all of the key are identical), or conflict (all of them go)."""
    marked = rows.withColumn("mark_", payload)
    kinds = marked.groupBy(*keys).agg(F.countDistinct("mark_").alias("kinds_"), F.min(order).alias("first_"))
    out = marked.join(kinds, keys)
    return out.withColumn("decision", F.when(F.col("kinds_") > 1, "conflict").when(F.col(order) == F.col("first_"), "keep").otherwise("duplicate")).drop("mark_", "kinds_", "first_")


def duplicate_keys(rows: DataFrame, keys: list[str]) -> DataFrame:
    return rows.groupBy(*keys).agg(F.count("*").alias("n")).filter("n > 1")


def temporal_order_violations(rows: DataFrame, source: str, seq: str, kickoff: str) -> DataFrame:
    w = Window.partitionBy(source).orderBy(seq)
    return rows.withColumn("before_", F.lag(kickoff).over(w)).filter(F.col(kickoff) < F.col("before_")).drop("before_")


def official_selection(forecasts: DataFrame, least_lead: float = 6.0) -> DataFrame:
    """One forecast a fixture: the latest made early enough, else the earliest; results are never looked at."""
    early = F.col("lead_hours") >= least_lead
    w = Window.partitionBy("fixture_id").orderBy(early.desc(), F.when(early, F.col("created_at")).desc(), F.when(early, F.col("forecast_id")).desc(), "created_at", "forecast_id")
    out = forecasts.withColumn("nth_", F.row_number().over(w)).filter("nth_ = 1").drop("nth_")
    return out.withColumn("rule", F.when(early, "latest_early_enough").otherwise("earliest"))


def ledger_merge(rows: DataFrame, key: str, fingerprint: Column, order: list[str]) -> tuple[DataFrame, DataFrame]:
    """(one row of each key, keys whose rows differ): repeats are no-ops, conflicts are for the caller's gate."""
    marked = rows.withColumn("mark_", fingerprint)
    conflicts = marked.groupBy(key).agg(F.countDistinct("mark_").alias("kinds")).filter("kinds > 1").select(key)
    w = Window.partitionBy(key).orderBy(*order)
    return marked.withColumn("nth_", F.row_number().over(w)).filter("nth_ = 1").drop("nth_", "mark_"), conflicts


def legacy_id_repair(rows: DataFrame, key: str, created: str, stable: Column) -> DataFrame:
    """New ids where rows of one id differ in nothing but a distinct creation time; ``repair`` says so."""
    marked = rows.withColumn("mark_", stable)
    tally = marked.groupBy(key).agg(F.count("*").alias("rows_"), F.countDistinct("mark_").alias("kinds_"), F.countDistinct(created).alias("times_"))
    met = marked.join(tally, key)
    repair = (F.col("rows_") > 1) & (F.col("kinds_") == 1) & (F.col("times_") == F.col("rows_"))
    new = F.substring(F.sha2(F.concat_ws("|", F.col(key).cast("string"), F.unix_micros(created).cast("string")), 256), 1, 24)
    return met.withColumn("repair", repair).withColumn("new_id", F.when(repair, new).otherwise(F.col(key).cast("string"))).drop("mark_", "rows_", "kinds_", "times_")


def ranked(rows: DataFrame, order: list[Column], within: list[str] = ()) -> DataFrame:
    """Adds ``rank_``: places from 1 in the given order, in each group of ``within`` columns.

    Rows are dealt by range of group and order and sorted there, so a group with most of the rows fills many tasks;
    what stands before a task's part of a group comes from one small row for each of them. The dealt rows are
    checkpointed, as numbers in a task hold only for one way of dealing.
    """
    keys = [*(F.col(c) for c in within), *order]
    parts = int(rows.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    placed = rows.repartitionByRange(parts, *keys).sortWithinPartitions(*keys).withColumn("number_", F.monotonically_increasing_id()).checkpoint()
    placed = placed.withColumn("task_", F.shiftright("number_", 33))
    sizes = placed.groupBy("task_", *within).agg(F.min("number_").alias("first_"), F.count("*").alias("n_"))
    before = F.coalesce(F.sum("n_").over(Window.partitionBy(*within).orderBy("task_").rowsBetween(Window.unboundedPreceding, -1)), F.lit(0))
    sizes = sizes.select(F.col("task_").alias("of_task_"), *(F.col(c).alias(f"of_{c}_") for c in within), (before - F.col("first_") + 1).alias("shift_"))
    same = F.col("task_") == F.col("of_task_")
    for c in within:
        same &= F.col(c).eqNullSafe(F.col(f"of_{c}_"))
    return placed.join(sizes, same).withColumn("rank_", F.col("number_") + F.col("shift_")).drop("number_", "task_", "of_task_", "shift_", *(f"of_{c}_" for c in within))


def top_k_with_status(rows: DataFrame, order: list[Column], k: int) -> DataFrame:
    """Rank over all rows by the given order; the first k qualify."""
    placed = ranked(rows, order).withColumn("rank", F.col("rank_").cast("int")).drop("rank_")
    return placed.withColumn("status", F.when(F.col("rank") <= k, "best_third").otherwise("eliminated"))


def _with_size(rows: DataFrame, fold: str) -> DataFrame:
    sizes = rows.groupBy(fold).agg(F.count("*").alias("size_")).withColumnRenamed(fold, "of_fold_")
    return rows.join(sizes, F.col(fold).eqNullSafe(F.col("of_fold_"))).drop("of_fold_")


def temporal_blocks(rows: DataFrame, fold: str, order: list[str], skip: int, blocks: int) -> DataFrame:
    """Skip a fold's first rows and split the rest into near-equal blocks, larger ones first."""
    placed = _with_size(ranked(rows, [F.col(c) for c in order], [fold]), fold).filter(F.col("rank_") > skip)
    at, size = F.col("rank_") - skip - 1, F.col("size_") - skip
    each, larger = F.floor(size / blocks), size % blocks
    inside = F.when(at < larger * (each + 1), F.floor(at / (each + 1))).otherwise(larger + F.floor((at - larger * (each + 1)) / each))
    cut = placed.withColumn("block", (inside + 1).cast("int")).drop("rank_", "size_")
    first = cut.groupBy(fold, "block").agg(F.min(order[0]).alias("block_cutoff")).select(F.col(fold).alias("of_fold_"), F.col("block").alias("of_block_"), "block_cutoff")
    return cut.join(first, F.col(fold).eqNullSafe(F.col("of_fold_")) & (F.col("block") == F.col("of_block_"))).drop("of_fold_", "of_block_")


def ratio_split(rows: DataFrame, fold: str, order: list[str], shares: tuple[float, float] = (0.6, 0.8)) -> DataFrame:
    """The first share of each fold's rows to train, up to the next to tune, the rest to calibration."""
    placed = _with_size(ranked(rows, [F.col(c) for c in order], [fold]), fold)
    place = F.col("rank_") / F.col("size_")
    return placed.withColumn("part", F.when(place <= shares[0], "train").when(place <= shares[1], "tune").otherwise("calibration")).drop("rank_", "size_")


def rank_with_tiebreaks(standings: DataFrame, matches: DataFrame, teams: int | None = None) -> DataFrame:
    """Order inside each group: points; tied teams by points, difference and goals among themselves (each
    criterion that splits starts over on what stays tied), then overall difference and goals, then a hash.

    ``standings``: grp, team, points, difference, scored. ``matches``: grp, home_id, away_id, goals of both.
    Passes go on until no bucket splits, or for as many as a group of ``teams`` can have splits; each is
    checkpointed. Rows stay a few per group.
    """
    ranked = standings.withColumn("bucket", F.rank().over(Window.partitionBy("grp").orderBy(F.desc("points"))).cast("int"))
    sides = matches.select("grp", F.explode(F.array(F.struct(F.col("home_id").alias("team"), F.col("away_id").alias("other"), F.col("home_goals").alias("s"), F.col("away_goals").alias("c")), F.struct(F.col("away_id").alias("team"), F.col("home_id").alias("other"), F.col("away_goals").alias("s"), F.col("home_goals").alias("c")))).alias("x")).select("grp", "x.*")
    points = F.when(F.col("s") > F.col("c"), 3).when(F.col("s") == F.col("c"), 1).otherwise(0)
    for _ in count() if teams is None else range(max(teams - 1, 1)):
        other = ranked.select("grp", F.col("team").alias("other"), F.col("bucket").alias("other_bucket"))
        inside = sides.join(ranked.select("grp", "team", "bucket"), ["grp", "team"]).join(other, ["grp", "other"]).filter("bucket = other_bucket")
        own = inside.groupBy("grp", "team").agg(F.sum(points).alias("h1"), F.sum(F.col("s") - F.col("c")).alias("h2"), F.sum("s").alias("h3"))
        met = ranked.join(own, ["grp", "team"], "left").fillna(0, ["h1", "h2", "h3"])
        w = Window.partitionBy("grp", "bucket")
        # the first criterion that tells the bucket's teams apart
        split = F.when(F.min("h1").over(w) != F.max("h1").over(w), F.col("h1")).when(F.min("h2").over(w) != F.max("h2").over(w), F.col("h2")).when(F.min("h3").over(w) != F.max("h3").over(w), F.col("h3")).otherwise(0)
        met = met.withColumn("key_", split)
        step = F.rank().over(w.orderBy(F.desc("key_"))) - 1
        moved = met.withColumn("step_", step).withColumn("bucket", (F.col("bucket") + F.col("step_")).cast("int")).drop("h1", "h2", "h3", "key_").checkpoint()
        ranked = moved.drop("step_")
        if moved.filter("step_ > 0").isEmpty():
            break
    last = Window.partitionBy("grp").orderBy("bucket", F.desc("difference"), F.desc("scored"), F.xxhash64("team"))
    return ranked.withColumn("position", F.row_number().over(last))
