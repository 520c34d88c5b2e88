"""Joins: names and aliases over time, earlier rows, differences between snapshots, pairings."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from duelframe.functions.ids import derived_id
from duelframe.operators import known

EARLIEST, LATEST = "0001-01-01", "9999-12-31"


def _within(date: Column) -> Column:
    return (date >= F.coalesce("valid_from", F.lit(EARLIEST).cast("date"))) & (date <= F.coalesce("valid_to", F.lit(LATEST).cast("date")))


def temporal_alias_join(names: DataFrame, alias: DataFrame) -> DataFrame:
    """row_id, entity, resolution: the one entity whose alias is valid at the row's date, or why there is none."""
    a = alias.select(F.col("name").alias("alias_name"), "entity", "valid_from", "valid_to")
    hit = names.join(a, (names["name"] == a["alias_name"]) & _within(names["seen"]), "left").groupBy("row_id").agg(F.countDistinct("entity").alias("n"), F.min("entity").alias("one"))
    return hit.select("row_id", F.when(F.col("n") == 1, F.col("one")).alias("entity"), F.when(F.col("n") == 0, "unresolved").when(F.col("n") == 1, "resolved").otherwise("ambiguous").alias("resolution"))


def alias_or_name_fallback(names: DataFrame, alias: DataFrame, catalog: DataFrame) -> DataFrame:
    """Alias first, then the catalogue's own name."""
    by_alias = temporal_alias_join(names, alias)
    c = catalog.select(F.col("name").alias("catalog_name"), F.col("site_id").alias("by_name"))
    return names.join(by_alias, "row_id").join(c, names["name"] == c["catalog_name"], "left").select("row_id", F.coalesce("entity", F.when(F.col("resolution") == "unresolved", F.col("by_name"))).alias("entity"))


def alias_conflicts(alias: DataFrame) -> DataFrame:
    """Pairs of entities that share a name at overlapping times."""
    bounds = alias.select("name", "entity", F.coalesce("valid_from", F.lit(EARLIEST).cast("date")).alias("a"), F.coalesce("valid_to", F.lit(LATEST).cast("date")).alias("b"))
    x, y = bounds.alias("x"), bounds.alias("y")
    return x.join(y, (F.col("x.name") == F.col("y.name")) & (F.col("x.entity") < F.col("y.entity")) & (F.col("x.a") <= F.col("y.b")) & (F.col("y.a") <= F.col("x.b"))).select(F.col("x.name").alias("name"), F.col("x.entity").alias("entity"), F.col("y.entity").alias("other"))


def orphans(catalog: DataFrame, used: DataFrame, key: str) -> DataFrame:
    return catalog.join(used.select(key).distinct(), key, "left_anti")


def alias_window_overlap(names: DataFrame, alias: DataFrame) -> DataFrame:
    """Each name's span of sightings against alias windows; resolved if exactly one entity overlaps."""
    seen = names.groupBy("name").agg(F.count("*").alias("sightings"), F.min("seen").alias("first_seen"), F.max("seen").alias("last_seen"))
    a = alias.select(F.col("name").alias("alias_name"), "entity", F.coalesce("valid_from", F.lit(EARLIEST).cast("date")).alias("a"), F.coalesce("valid_to", F.lit(LATEST).cast("date")).alias("b"))
    hit = seen.join(a, (F.col("name") == F.col("alias_name")) & (F.col("a") <= F.col("last_seen")) & (F.col("b") >= F.col("first_seen")), "left")
    out = hit.groupBy("name", "sightings", "first_seen", "last_seen").agg(F.countDistinct("entity").alias("entities"))
    return out.withColumn("resolved", F.col("entities") == 1)


def semi_anti_split(aux: DataFrame, main: DataFrame, keys: list[str]) -> DataFrame:
    """Auxiliary rows with a state: unmatched, duplicate (not the first of its key), matched."""
    present = main.select(*keys).distinct().withColumn("there", F.lit(True))
    order = Window.partitionBy(*keys).orderBy("aux_id")
    out = aux.withColumn("nth", F.row_number().over(order)).join(present, keys, "left")
    return out.select("aux_id", F.when(F.col("there").isNull(), "unmatched").when(F.col("nth") > 1, "duplicate").otherwise("matched").alias("state"))


def previous_asof(rows: DataFrame, key: str, order: list[str], take: list[str]) -> DataFrame:
    """Each row with the last row of its key strictly before it, where times are exact and unique enough: lag."""
    w = Window.partitionBy(key).orderBy(*order)
    return rows.withColumns({f"previous_{c}": F.lag(c).over(w) for c in take})


def latest_before(rows: DataFrame, key: str, instant: str, tie: str, take: dict[str, str], name: str) -> DataFrame:
    """Each row with a struct of the latest row of its key at an earlier instant (of several the last by ``tie``)."""
    w = Window.partitionBy(key).orderBy(F.unix_micros(instant)).rangeBetween(Window.unboundedPreceding, -1)
    own = F.struct(F.col(instant).alias("instant_"), F.col(tie).alias("tie_"), *(F.col(c).alias(n) for n, c in take.items()))
    return rows.withColumn(name, F.max(own).over(w))


def previous_asof_by_cutoff(rows: DataFrame) -> DataFrame:
    """visit_id and its previous visit of the team: strictly earlier and known by this row's cutoff."""
    placed = known.placed(rows.select("team", "visit_id", "kickoff", "cutoff"), "team", "kickoff", "visit_id")
    return known.with_latest_known(placed, "team", "cutoff", {"id": "visit_id"}, "before_").select("visit_id", F.col("before_.id").alias("previous_id"))


def interval_self_join(rows: DataFrame, days: int) -> DataFrame:
    """How many earlier rows of the team lie within the days before each row.

    Rows stand in their own stretch of that many days and, as context, in the next one; windows are by team
    and stretch, so a team with many rows is spread over time and no pairs are made.
    """
    span = days * 86_400_000_000
    at = F.unix_micros("kickoff")
    stretch = F.floor(at / span)
    both = F.array(F.struct(stretch.alias("part_"), F.lit(True).alias("own_")), F.struct((stretch + 1).alias("part_"), F.lit(False).alias("own_")))
    dealt = rows.select("visit_id", "team", at.alias("at_"), F.explode(both).alias("x_")).select("visit_id", "team", "at_", "x_.*")
    w = Window.partitionBy("team", "part_").orderBy("at_").rangeBetween(-span, -1)
    return dealt.withColumn("n", F.count("*").over(w)).filter("own_").select("visit_id", "n")


def home_away_pair(sides: DataFrame, key: str, features: list[str]) -> DataFrame:
    """Two side rows to one contest row: prefixed features and their differences; both sides are needed."""
    one = lambda s: sides.filter(F.col("side") == s).select(key, *(F.col(f).alias(f"{s}_{f}") for f in features))
    out = one("home").join(one("away"), key)
    return out.withColumns({f"diff_{f}": F.col(f"home_{f}") - F.col(f"away_{f}") for f in features})


def snapshot_diff(previous: DataFrame, current: DataFrame, key: str, fields: list[str]) -> DataFrame:
    """``new`` rows, and one row for each field that changed (null-safe)."""
    p = previous.select(F.col(key).alias("key_"), *(F.col(f).alias(f"p_{f}") for f in fields))
    met = current.join(p, current[key] == p["key_"], "left")
    changes = F.array_compact(F.array(*(F.when(F.col("key_").isNotNull() & ~F.col(f).eqNullSafe(F.col(f"p_{f}")), F.struct(F.lit(f).alias("field"), F.col(f"p_{f}").cast("string").alias("was"), F.col(f).cast("string").alias("now"))) for f in fields)))
    new = F.array(F.struct(F.lit("new").alias("field"), F.lit(None).cast("string").alias("was"), F.lit(None).cast("string").alias("now")))
    return met.select(key, F.explode(F.when(F.col("key_").isNull(), new).otherwise(changes)).alias("c")).select(key, "c.field", "c.was", "c.now")


def status_transitions(previous: DataFrame, current: DataFrame) -> DataFrame:
    """Rows that weren't known before and have another status now."""
    p = previous.filter("status != 'known'").select("id", F.col("status").alias("was"))
    return p.join(current.select("id", F.col("status").alias("now")), "id").filter("was != now")


def reconcile(primary: DataFrame, secondary: DataFrame, key: list[str], fields: list[str]) -> DataFrame:
    """A row for each primary row without counterpart, and for each field that differs."""
    s = secondary.select(*key, *(F.col(f).alias(f"s_{f}") for f in fields), F.lit(True).alias("there"))
    met = primary.join(s, key, "left")
    notes = F.array_compact(F.array(F.when(F.col("there").isNull(), F.lit("missing")), *(F.when(F.col("there") & ~F.col(f).eqNullSafe(F.col(f"s_{f}")), F.lit(f)) for f in fields)))
    return met.select(*key, F.explode(notes).alias("difference"))


def append_if_absent(history: DataFrame, live: DataFrame, keys: list[str], order: str) -> DataFrame:
    """History and the first live row of each key that history lacks."""
    w = Window.partitionBy(*keys).orderBy(order)
    first = live.withColumn("nth_", F.row_number().over(w)).filter("nth_ = 1").drop("nth_")
    return history.unionByName(first.join(history.select(*keys).distinct(), keys, "left_anti"), allowMissingColumns=True)


def latest_compatible(fixtures: DataFrame, stored: DataFrame) -> DataFrame:
    """For each fixture the stored forecast made by its as-of time, the latest one."""
    met = fixtures.join(stored, "fixture_id").filter(F.col("created_at") <= F.col("as_of"))
    return met.groupBy("fixture_id").agg(F.max(F.struct("created_at", "forecast_id")).alias("best")).select("fixture_id", F.col("best.forecast_id").alias("forecast_id"))


def paired_deltas(scored: DataFrame, key: str, model: str, loss: str, baseline: str) -> DataFrame:
    """Loss of each model less the baseline's on the same rows; row sets must be equal."""
    base = scored.filter(F.col(model) == baseline).select(key, F.col(loss).alias("base_"))
    return scored.filter(F.col(model) != baseline).join(base, key).select(key, model, (F.col(loss) - F.col("base_")).alias("delta"))


def param_grid(spark, **options: list) -> DataFrame:
    """All combinations of option values (as many as their counts' product), each with a row-hash id."""
    grid = spark.createDataFrame([tuple([float(v) for v in values] for values in options.values())], ", ".join(f"{name} array<double>" for name in options))
    for name in options:
        grid = grid.withColumn(name, F.explode(name))
    return grid.withColumn("param_id", derived_id(*(F.col(c) for c in options)))


def set_keyed_lookup(rows: DataFrame, members: str, table: DataFrame, key: str) -> DataFrame:
    """Join on an unordered set of members, written in sorted order."""
    return rows.withColumn("set_key_", F.concat_ws("", F.array_sort(members))).join(table.withColumnRenamed(key, "set_key_"), "set_key_", "left").drop("set_key_")


def fixture_alignment(official: DataFrame, challenger: DataFrame, key: str) -> DataFrame:
    """key, state: aligned where both tables have the key once; else missing, unexpected or repeated."""
    o, c = (df.groupBy(key).agg(F.count("*").alias(n)) for df, n in ((official, "o_"), (challenger, "c_")))
    state = F.when(F.col("c_").isNull(), "missing").when(F.col("o_").isNull(), "unexpected").when((F.col("o_") > 1) | (F.col("c_") > 1), "repeated").otherwise("aligned")
    return o.join(c, key, "full").select(key, state.alias("state"))


def catalog_enrich(pairs: DataFrame, catalog: DataFrame, key: str, fields: list[str]) -> DataFrame:
    """The catalogue's fields of both sides, null for a side it does not list; its keys are unique."""
    out = pairs
    for side in ("home", "away"):
        own = catalog.select(F.col(key).alias("key_"), *(F.col(f).alias(f"{side}_{f}") for f in fields))
        out = out.join(own, F.col(f"{side}_id") == F.col("key_"), "left").drop("key_")
    return out


def category_lookup(pairs: DataFrame, categories: DataFrame) -> DataFrame:
    """Category and weight by the exact competition name, null without an entry."""
    own = categories.select(F.col("name").alias("name_"), "category", "weight")
    return pairs.join(own, F.col("competition") == F.col("name_"), "left").drop("name_")


def venue_alias(names: DataFrame, venues: DataFrame) -> DataFrame:
    """row_id, site_id: the one site whose '|'-separated aliases hold the name; null for none or several."""
    alias = venues.select("site_id", F.explode(F.split("aliases", r"\|")).alias("alias")).select("site_id", F.trim("alias").alias("alias_"))
    one = alias.groupBy("alias_").agg(F.countDistinct("site_id").alias("n_"), F.min("site_id").alias("site_id")).filter("n_ = 1")
    return names.join(one, F.col("name") == F.col("alias_"), "left").select("row_id", "site_id")
