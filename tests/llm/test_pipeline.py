"""The stages of the corpus pipeline on odd rows, and all of them in a row, against plain Python."""

import zlib
from collections import Counter

import pyarrow as pa
import pytest
from pyspark.sql import functions as F

import corpus_pipeline
from duelframe.llm import langid, quality
from test_training_data import LONG, ODD, brute_components, plain_actions, plain_sanitised, posteriors, reference_ids, u32

SF = "/root/testdata/sf0.001"
STAGES = dict(corpus_pipeline.STAGES)
SHAPE = "doc_id long, text string, lang string, source string, n_chars long, row_ string, sig binary, n int, component_id long, p_ double, `rank_` long"


@pytest.fixture(scope="module")
def home(spark, tmp_path_factory):
    """A folder with the given labels and documents, odd rows and copies among them, and columns with clashing names."""
    path = f"file://{tmp_path_factory.mktemp('sf')}"
    spark.read.parquet(f"{SF}/labels.parquet").write.parquet(f"{path}/labels.parquet")
    given = [(r["doc_id"], r["text"], r["lang"], r["source"], r["n_chars"]) for r in spark.read.parquet(f"{SF}/documents.parquet").collect()]
    rows = given + [(None if d is None else 100_000 + d, t, None, None, None) for d, t in ODD] + [(200_000, LONG * 12, None, "s", 1)] + [(250_000 + k, f"agent zorblax {k} wrote to qwyjibo@mail.example.org about qwyjibo", "en", "s", 1) for k in range(4)] + [(300_000 + k, t, lang, s, n) for k, (_, t, lang, s, n) in enumerate(given[:20])]
    spark.createDataFrame([(*r, "x", b"y", 7, 8, 0.5, 9) for r in rows], SHAPE).repartition(3).write.parquet(f"{path}/documents.parquet")
    return path


@pytest.fixture(scope="module")
def docs(spark, home):
    return spark.read.parquet(f"{home}/documents.parquet")


def rows_of(df):
    return Counter((r["doc_id"], r["text"]) for r in df.select("doc_id", "text").collect())


@pytest.mark.parametrize("name", list(STAGES))
def test_empty_table(spark, home, docs, name):
    out = STAGES[name](spark, docs.limit(0), home)
    assert out.count() == 0 and (name == "best-fit packing" or out.columns == docs.columns)


def of_quality(spark, docs, home):
    labels = spark.read.parquet(f"{home}/labels.parquet")
    model = quality.fit(docs, labels)
    score = quality.scorer(docs, model)
    scored = docs.select("doc_id", "text", F.col("source").alias("host_"), F.col("lang").alias("path_"), score("text").alias("p_"))
    rows = scored.collect()
    judged = posteriors([(r["host_"], r["path_"], r["p_"]) for r in rows])
    return Counter((r["doc_id"], r["text"]) for r, j in zip(rows, judged) if j[2] >= quality.REJECT_BELOW)


def of_language(spark, docs, home):
    model = langid.fit(docs.filter(langid.remainder() != 1))
    rows = docs.select("doc_id", "text").collect()
    found = langid.predict_texts(pa.array([r["text"] for r in rows], pa.string()), model).to_pylist()
    return Counter((r["doc_id"], r["text"]) for r, f in zip(rows, found) if f["lang_pred"] != "und" and f["score"] >= corpus_pipeline.LEAST_SCORE)


def of_jaccard(spark, docs, home):
    """One row of each component, that of the smallest doc_id; rows without words stay."""
    rows = [(r["doc_id"], r["text"]) for r in docs.select("doc_id", "text").collect()]
    keep, own = Counter(), {}
    for k, (d, t) in enumerate(rows):
        if not (t or "").split():
            keep[d, t] += 1
    least = {key: n for key, n in brute_components(rows).items()}
    for (d, _, c), _ in least.items():
        if d == c:
            own[d] = True
    for d, t in rows:
        # the one row without an id is like no other
        alone = d is None and any(key[0] is None and key[2] is None for key in least)
        if (t or "").split() and (d in own or alone) and not keep[d, t]:
            keep[d, t] += 1
    return keep


def of_pii(spark, docs, home):
    rows = [(r["doc_id"], r["text"]) for r in docs.select("doc_id", "text").collect()]
    want = plain_actions([t or "" for _, t in rows])
    assert {"zorblax", "qwyjibo"} <= set(want)
    return Counter((d, plain_sanitised(t, want)) for d, t in rows)


PLAIN = {"quality classifier": of_quality, "language ID": of_language, "n-gram Jaccard join": of_jaccard, "PII": of_pii}


@pytest.mark.parametrize("name", list(PLAIN))
def test_stage(spark, home, docs, name):
    out = STAGES[name](spark, docs, home)
    assert out.columns == docs.columns
    got = out.collect()
    assert Counter((r["doc_id"], r["text"]) for r in got) == PLAIN[name](spark, docs, home)
    assert all((r["row_"], bytes(r["sig"]), r["n"], r["component_id"], r["p_"], r["rank_"]) == ("x", b"y", 7, 8, 0.5, 9) for r in got)


def pieces(rows):
    out = Counter()
    for (d, t), n in rows.items():
        ids = [*reference_ids("byte_bpe_50k.json", t or ""), 2]
        first = len(ids) % 1024 or 1024
        bounds = [0, *range(first, len(ids) + 1, 1024)]
        for k, (a, b) in enumerate(zip(bounds, bounds[1:])):
            out[d, k, a, b - a, zlib.crc32(u32(ids[a:b]))] += n
    return out


def test_packing_stage(spark, home, docs):
    got = Counter(tuple(r)[:5] for r in STAGES["best-fit packing"](spark, docs, home).collect())
    assert got == pieces(rows_of(docs))


def test_run(spark, home, docs):
    """Each stage on what the one before it left, every decision in effect."""
    left, stages = docs, list(PLAIN.items())
    for k, (name, plain) in enumerate(stages):
        want = plain(spark, left, home)
        after = STAGES[name](spark, left, home)
        assert rows_of(after) == want, name
        left = corpus_pipeline.base.materialize(after, "test")
    got = corpus_pipeline.run(spark, home)
    assert Counter(tuple(r)[:5] for r in got.collect()) == pieces(rows_of(left))
    assert 0 < left.count() < docs.count()
