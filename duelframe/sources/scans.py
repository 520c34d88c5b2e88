"""Scans: CSV with quarantine, provider JSON, Parquet histories, catalogues, snapshots."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

#: Stands for a comma outside quotes while a line is split; where a line has it, ESCAPE and a letter stand for it.
MARK, ESCAPE = "\u0001", "\u0002"
MOST_HEADERS = 100
FIXTURE = ("fixture_id", "kickoff", "status", "stage", "home_name", "away_name", "home_score", "away_score", "home_extra", "away_extra")


def numbered_lines(spark: SparkSession, path: str) -> DataFrame:
    """(source_file, row_number from 1, line) of text files. Each split counts its own lines; what stands before a
    split in its file comes from one small row a split, so no task reads more than its splits."""
    lines = spark.read.text(path).select(F.col("_metadata.file_path").alias("source_file"), F.col("_metadata.file_block_start").alias("start_"), F.col("value").alias("line"), F.monotonically_increasing_id().alias("id_"))
    splits = lines.groupBy("source_file", "start_").agg(F.min("id_").alias("first_"), F.count("*").alias("n_"))
    before = F.coalesce(F.sum("n_").over(Window.partitionBy("source_file").orderBy("start_").rowsBetween(Window.unboundedPreceding, -1)), F.lit(0))
    splits = splits.select("source_file", "start_", (before - F.col("first_") + 1).alias("shift_"))
    return lines.join(F.broadcast(splits), ["source_file", "start_"]).select("source_file", (F.col("id_") + F.col("shift_")).alias("row_number"), "line")


def csv_scan_strict(spark: SparkSession, path: str, columns: list[str]) -> tuple[DataFrame, DataFrame]:
    """(good rows, quarantined rows): trimmed text columns; a file without one of ``columns`` is an error.

    Each file has a header line of its own (up to MOST_HEADERS kinds of them). Fields may be quoted, with commas and
    doubled quotes inside. Rows with too few or too many fields are quarantined with a reason and their text. Rows
    carry their file and their number in it; the first after the header is 2, and blank lines are skipped. A line is
    a row: one with a quote that it doesn't close is quarantined, so a quoted line feed makes two such rows.
    """
    lines = numbered_lines(spark, path).withColumn("fields_", F.transform(fields_of(F.col("line")), _unquoted))
    headers = lines.filter("row_number = 1").select("source_file", F.col("fields_").alias("header_"))
    kinds = [tuple(c.lstrip("\ufeff") for c in r[0]) for r in headers.select("header_").distinct().limit(MOST_HEADERS + 1).collect()]
    if len(kinds) > MOST_HEADERS:
        raise ValueError(f"more than {MOST_HEADERS} different headers")
    if not kinds or any(set(columns) - set(names) for names in kinds):
        raise ValueError(f"missing columns: {sorted({c for names in kinds or [()] for c in columns if c not in names})}")
    names = list(dict.fromkeys(c for kind in kinds for c in kind))
    rows = lines.filter("row_number > 1 and trim(line) != ''").join(F.broadcast(headers), "source_file")
    bare = F.transform("header_", lambda c: F.ltrim(c, F.lit("\ufeff")))
    placed = {c: F.col("fields_")[F.array_position(bare, c).cast("int") - 1] for c in names}
    value = lambda c: F.when(F.array_contains(bare, c) & (F.size("fields_") >= F.array_position(bare, c)), placed[c])
    closed = F.size(F.split("line", '"', -1)) % 2 == 1
    same = closed & (F.size("fields_") == F.size("header_"))
    reason = F.when(~closed, "unclosed quote").when(F.size("fields_") > F.size("header_"), "extra CSV fields").otherwise("missing CSV fields")
    bad = rows.filter(~same).select("source_file", "row_number", F.lit("parse").alias("stage"), reason.alias("reason"), F.create_map(F.lit("line"), F.col("line"), *(x for c in names for x in (F.lit(c), value(c)))).alias("payload"))
    return rows.filter(same).select(*(value(c).alias(c) for c in names), "source_file", "row_number"), bad


def fields_of(line: Column) -> Column:
    """Fields of a line, quotes and all: split at commas outside quotes, in time linear in the line.

    Between quotes, every other part is outside; commas there become MARK, and the parts put together again are split there.
    """
    safe = F.replace(F.replace(line, F.lit(ESCAPE), F.lit(ESCAPE + "e")), F.lit(MARK), F.lit(ESCAPE + "m"))
    parts = F.transform(F.split(safe, '"', -1), lambda x, i: F.when(i % 2 == 0, F.translate(x, ",", MARK)).otherwise(x))
    back = lambda x: F.replace(F.replace(x, F.lit(ESCAPE + "m"), F.lit(MARK)), F.lit(ESCAPE + "e"), F.lit(ESCAPE))
    quoted = F.transform(F.split(F.array_join(parts, '"'), MARK, -1), back)
    return F.when(F.contains(line, F.lit('"')), quoted).otherwise(F.split(line, ",", -1))


def _unquoted(field: Column) -> Column:
    bare = F.trim(field)
    return F.when(F.startswith(bare, F.lit('"')) & F.endswith(bare, F.lit('"')) & (F.length(bare) > 1), F.replace(bare.substr(F.lit(2), F.length(bare) - 2), F.lit('""'), F.lit('"'))).otherwise(bare)


SIDES = "struct<home:int,away:int>"
LAYOUT_A = f"matches array<struct<id:long,utcDate:string,status:string,stage:string,`group`:string,homeTeam:struct<id:long,name:string>,awayTeam:struct<id:long,name:string>,score:struct<duration:string,regularTime:{SIDES},fullTime:{SIDES},extraTime:{SIDES},penalties:{SIDES}>>>"
LAYOUT_B = f"response array<struct<fixture:struct<id:long,date:string,status:struct<short:string>>,league:struct<round:string>,teams:struct<home:struct<name:string>,away:struct<name:string>>,goals:{SIDES},score:struct<extratime:{SIDES},penalty:{SIDES}>>>"


def json_collection_scan_a(spark: SparkSession, path: str) -> DataFrame:
    """Nested provider objects to flat fixtures: regular time falls back to full time, stage to group."""
    m = spark.read.schema(LAYOUT_A).option("multiLine", True).json(path).select(F.posexplode("matches").alias("position", "m"))
    side = lambda s: F.coalesce(F.col(f"m.score.regularTime.{s}"), F.col(f"m.score.fullTime.{s}"))
    return m.select("position", F.col("m.id").alias("fixture_id"), F.try_to_timestamp("m.utcDate").alias("kickoff"), F.col("m.status").alias("status"), F.coalesce("m.stage", "m.group").alias("stage"), F.col("m.homeTeam.name").alias("home_name"), F.col("m.awayTeam.name").alias("away_name"), side("home").alias("home_score"), side("away").alias("away_score"), F.col("m.score.extraTime.home").alias("home_extra"), F.col("m.score.extraTime.away").alias("away_extra"))


def json_collection_scan_b(spark: SparkSession, path: str) -> DataFrame:
    """The other provider's layout to the same fixtures; extra time only where both scores are known."""
    m = spark.read.schema(LAYOUT_B).option("multiLine", True).json(path).select(F.posexplode("response").alias("position", "m"))
    both = F.col("m.score.extratime.home").isNotNull() & F.col("m.score.extratime.away").isNotNull()
    extra = lambda s: F.when(both, F.col(f"m.score.extratime.{s}"))
    return m.select("position", F.col("m.fixture.id").alias("fixture_id"), F.try_to_timestamp("m.fixture.date").alias("kickoff"), F.col("m.fixture.status.short").alias("status"), F.col("m.league.round").alias("stage"), F.col("m.teams.home.name").alias("home_name"), F.col("m.teams.away.name").alias("away_name"), F.col("m.goals.home").alias("home_score"), F.col("m.goals.away").alias("away_score"), extra("home").alias("home_extra"), extra("away").alias("away_extra"))


def fault_isolated(fixtures: DataFrame) -> tuple[DataFrame, DataFrame]:
    """(valid, invalid with reason): members are judged one by one; of a repeated id the first stays."""
    w = Window.partitionBy("fixture_id").orderBy("position")
    reason = F.when(F.col("fixture_id").isNull(), "missing id").when(F.col("kickoff").isNull(), "missing or bad kickoff").when(F.col("status").isNull(), "missing status").when(F.row_number().over(w) > 1, "duplicate id")
    marked = fixtures.withColumn("reason", reason)
    return marked.filter("reason is null").drop("reason"), marked.filter("reason is not null")


def parquet_scan(spark: SparkSession, path: str, schema: T.StructType) -> DataFrame:
    return spark.read.schema(schema).parquet(path)


def history_dir_scan(spark: SparkSession, path: str) -> DataFrame:
    """All snapshots of a directory; every row has its file's path and the SHA-256 of that file."""
    rows = spark.read.option("recursiveFileLookup", True).parquet(path).select("*", F.col("_metadata.file_path").alias("file_path"))
    files = spark.read.format("binaryFile").option("recursiveFileLookup", True).option("pathGlobFilter", "*.parquet").load(path).select(F.col("path").alias("p_"), F.sha2("content", 256).alias("file_sha256"))
    plain = lambda c: F.regexp_replace(c, "^file:/+", "/")
    return rows.join(files, plain(F.col("file_path")) == plain(F.col("p_"))).drop("p_")


def gzip_csv_history_scan(spark: SparkSession, path: str, doubles: list[str], config: str = "config") -> DataFrame:
    """Published snapshots: blanks are null, doubles are cast (NaN and infinity count as errors: null), and
    where the configuration column is missing one is made from the row's model."""
    rows = spark.read.option("header", True).option("recursiveFileLookup", True).csv(path)
    rows = rows.select(*(F.nullif(F.trim(c), F.lit("")).alias(c) for c in rows.columns))
    finite = lambda c: F.when(~F.isnan(F.col(c).try_cast("double")) & (F.abs(F.col(c).try_cast("double")) != float("inf")), F.col(c).try_cast("double"))
    rows = rows.withColumns({c: finite(c) for c in doubles if c in rows.columns})
    made = F.to_json(F.struct(F.lit("legacy").alias("config")))
    rows = rows.withColumn(config, F.coalesce(F.col(config), made) if config in rows.columns else made)
    return rows.withColumn("config_checksum", F.sha2(config, 256))


def catalog_scan(spark: SparkSession, path: str, key: str, lists: tuple[str, ...] = ()) -> DataFrame:
    """A catalogue CSV; ``|`` lists become arrays; repeated keys are an error."""
    rows = spark.read.option("header", True).option("inferSchema", False).csv(path)
    rows = rows.withColumns({c: F.filter(F.split(c, r"\|"), lambda x: x != "") for c in lists})
    if not rows.groupBy(key).count().filter("count > 1").isEmpty():
        raise ValueError(f"repeated {key}")
    return rows


def category_mapping(spark: SparkSession, mapping: dict[str, list[str]]) -> DataFrame:
    """name -> category; blank or repeated names are an error."""
    rows = spark.createDataFrame(list(mapping.items()), "category string, names array<string>").select("category", F.explode("names").alias("name"))
    if not rows.filter("trim(name) = ''").isEmpty() or not rows.groupBy("name").count().filter("count > 1").isEmpty():
        raise ValueError("blank or repeated name")
    return rows


def latest_snapshot_scan(spark: SparkSession, path: str) -> DataFrame:
    """The rows of the newest ``snapshot=`` partition; other partitions aren't read."""
    rows = spark.read.parquet(path)
    newest = rows.select("snapshot").agg(F.max("snapshot")).first()[0]
    return rows.filter(F.col("snapshot") == newest)
