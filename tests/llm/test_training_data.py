"""Each operator against brute force, an exact round trip or held-out accuracy, on odd and given rows."""

import hashlib
import re
import struct
import zlib
from collections import Counter, defaultdict
from functools import lru_cache
from itertools import combinations

import numpy as np
import pytest
from pyspark.sql import functions as F
from tokenizers import Tokenizer

from duelframe.llm import base, bpe, components, hamming, jaccard, langid, media, packing, pii, quality, registry, sharding, token_store
from duelframe.llm.token_cache import CachedEncoder

WORDS = [f"w{k}x" for k in range(400)]
LONG = " ".join(WORDS[(k * 7 + k // 11) % 400] for k in range(6000))
BODY = " ".join(WORDS[:120])
NEAR = " ".join([*WORDS[:60], "other", *WORDS[61:120]])
ODD = [
    (0, ""), (1, None), (2, " \t\n"), (3, "one two"), (4, "one two"), (5, "A b C d E"), (6, "a B c D e"), (7, BODY), (8, BODY.upper()), (9, NEAR),
    (10, LONG), (11, LONG), (12, "x" * 5000), (13, " " * 3000), (14, "é x́ y 日本 語。　x \u0085 🙂\n\n\nΟΔΟΣ a\t\n b"),
    (15, "mail a.b+c@d-e.example.org or 1.2.3.4 and 300.1.1.1 call +1 (988) 555-2485 now"), (16, "card 4337166598464399 4337-1665-9846-4399 4337166598464398 1.2.3.4.5.6.7.8"),
    (17, "don't 's <|endoftext|> <|startoftext|> I'LL"), (None, "no id"), (18, "a b c d"), (19, "a b c d e"), (20, "z@z z@z.z@z.z +12345678901 +123456789 ٣٤٥"),
]
SHAPE = "doc_id long, text string, lang string, source string, n_chars long, shard int, component_id string, `rank_` long"


@pytest.fixture(scope="module")
def odd(spark):
    return spark.createDataFrame([(d, t, None, None, None, 9, "x", -1) for d, t in ODD], SHAPE).repartition(3)


@pytest.fixture(scope="module")
def docs(spark):
    return spark.read.parquet("/root/testdata/sf0.001/documents.parquet")


@pytest.fixture(scope="module")
def none(spark, odd):
    return spark.createDataFrame([], odd.schema)


def texts(df):
    return [(r["doc_id"], r["text"] or "") for r in df.select("doc_id", "text").collect()]


@lru_cache
def untouched(name):
    return Tokenizer.from_file(registry.tokenizer_path(name))


def reference_ids(name, text):
    return untouched(name).encode(text, add_special_tokens=False).ids


def u32(ids):
    return struct.pack(f"<{len(ids)}I", *ids)


@pytest.mark.parametrize("which", ["odd", "docs"])
def test_token_store(spark, request, which):
    df = request.getfixturevalue(which)
    path = f"{base.shared_dir(spark)}/store-{which}"
    token_store.write_store(df, path, registry.tokenizer_path("word_bpe_49k.json"), end_id=1)
    got = [tuple(r) for r in token_store.with_global_start(spark, path, token_store.read_store(spark, path)).select("doc_id", "start", "n_tokens", "ids_crc32").collect()]
    want, at = [], 0
    for d, t in sorted(texts(df), key=lambda x: (x[0] is not None, x[0])):
        ids = [*reference_ids("word_bpe_49k.json", t), 1]
        want.append((d, at, len(ids), zlib.crc32(u32(ids))))
        at += len(ids)
    assert sorted(got, key=str) == sorted(want, key=str)
    one = token_store.read_store(spark, path, [10, 3], with_ids=True).collect()
    assert {r["doc_id"]: r["ids"] for r in one} == {d: [*reference_ids("word_bpe_49k.json", t), 1] for d, t in texts(df) if d in (10, 3)}


def test_words_are_encoded_once_in_any_case():
    """Case and white space make no new chunks where the vocabulary ignores them; ids stay those of the whole text."""
    import pyarrow as pa

    name = "word_bpe_49k.json"
    encoder = CachedEncoder(registry.tokenizer_path(name))
    list(encoder.encode(pa.array(["x Word wORD\nWORD\nword word"])))
    assert len(encoder.slot) == 2
    own = [
        " J\u030ca H\u0331 T\u0308 W\u030a I\u0307 j\u030c \u0130I ıi ΟΔΟΣ ΣA ΑΣ a×b ÷ Éa\u0301 e\u0301 ﬁ ŉ ǅ Ǆ ß ẞ K Å",
        "A <|ENDOFTEXT|> B <|endoftext|> C <|StartOfText|>", " a</w> </w> b</W>\nIT'S IT's don'T 'S 's", "Aé Zé\u0301 ɐa ʼn Ÿ " + " ".join(chr(k) + "Q" for k in range(0xC0, 0x280)),
        "\u0301a", "J", "\u030cX", "A\u200bB C\u00a0D E\u3000F G\u0085H\r\nI\tJ", None, "",
    ]
    for texts_ in (own, own[::-1], [t for t in own if t and "<" not in t], *([t] for t in own)):
        got = [ids[i:j].tolist() for _, ids, at in CachedEncoder(registry.tokenizer_path(name)).encode(pa.array(texts_, pa.string())) for i, j in zip(at[:-1], at[1:])]
        assert got == [reference_ids(name, t or "") for t in texts_]


def test_byte_tokens_need_no_offsets():
    """Chunks that share a call are told apart by the bytes of their ids; the call is one without offsets."""
    import pyarrow as pa

    name = "byte_bpe_50k.json"
    for own in ([f"some words, é日本🙂 and{k} more\nlines  of them.  x\u0301 e\u0301 don't\u00a0{k}" for k in range(40)], [t for _, t in ODD], ["a \ufffd b \x00 c <|endoftext|> d\r\n e"]):
        encoder = CachedEncoder(registry.tokenizer_path(name))

        class Fast:
            encode_batch_fast = staticmethod(encoder.tokenizer.encode_batch_fast)

        encoder.tokenizer = Fast
        got = [ids[i:j].tolist() for _, ids, at in encoder.encode(pa.array(own, pa.string())) for i, j in zip(at[:-1], at[1:])]
        assert got == [reference_ids(name, t or "") for t in own]


@pytest.mark.parametrize("which", ["odd", "docs"])
def test_packing(request, which):
    df = request.getfixturevalue(which)
    rows = packing.pack(df, registry.tokenizer_path("byte_bpe_50k.json"), 2).collect()
    want = {}
    for d, t in texts(df):
        ids = [*reference_ids("byte_bpe_50k.json", t), 2]
        first = len(ids) % 1024 or 1024
        bounds = [0, *range(first, len(ids) + 1, 1024)]
        for k, (a, b) in enumerate(zip(bounds, bounds[1:])):
            want[d, k] = (a, b - a, zlib.crc32(u32(ids[a:b])))
    assert {(r["doc_id"], r["piece"]): (r["start"], r["length"], r["ids_crc32"]) for r in rows} == want and len(rows) == len(want)
    bins = defaultdict(list)
    for r in rows:
        bins[r["sequence_id"]].append((r["offset"], r["length"]))
    for own in bins.values():
        own.sort()
        assert own[0][0] == 0 and all(a + n == b for (a, n), (b, _) in zip(own, own[1:])) and sum(own[-1]) <= 1024
    assert len(bins) <= 1.03 * sum(r["length"] for r in rows) / 1024 + 2


def test_packing_keeps_large_and_null_ids(spark):
    """Ids that a double can't hold, and a null, in one batch; rows that repeat an id are packed each."""
    ids = [None, 9007199254740993, 9007199254740995, 9007199254740993, 7]
    rows = packing.pack(spark.createDataFrame([(d, f"text {k}", "x", 1) for k, d in enumerate(ids)], "doc_id long, text string, rank_ string, length int").coalesce(1), registry.tokenizer_path("byte_bpe_50k.json"), 2).collect()
    assert sorted((r["doc_id"] for r in rows), key=str) == sorted(ids, key=str) and len({r["sequence_id"] for r in rows}) == 1


def test_plan_keeps_the_histogram():
    rng = np.random.default_rng(5)
    for n in (1, 7, 5000):
        histogram = Counter(np.minimum(1024, rng.geometric(1 / 300, n)).tolist())
        made = packing.plan(dict(histogram), 1024)
        total = Counter()
        for p, of, repeats in made:
            assert sum(p) <= 1024 and 0 <= of <= len(p)
            for a in p:
                total[a] += repeats
        assert total == histogram
        assert sum(r for _, _, r in made) <= 1.02 * sum(a * c for a, c in histogram.items()) / 1024 + 2
    assert packing.plan({}, 1024) == []


@pytest.mark.parametrize("name", ["word_bpe_49k.json", "byte_bpe_50k.json"])
def test_added_tokens_keep_their_ids(name):
    import pyarrow as pa
    from tokenizers import Tokenizer

    plain = Tokenizer.from_file(registry.tokenizer_path(name))
    own = ["<|endoftext|>", "a <|endoftext|> b.<|endoftext|>, c<|startoftext|>d", "x\n\n<|endoftext|>  \n<|endoftext|><|endoftext|>é 's", "<|startoftext|> one. two<|endoftext|>", *(t or "" for _, t in ODD)]
    got = []
    for _, ids, at in CachedEncoder(registry.tokenizer_path(name)).encode(pa.array(own)):
        got += [ids[a:b].tolist() for a, b in zip(at[:-1], at[1:])]
    assert got == [plain.encode(t, add_special_tokens=False).ids for t in own]
    assert plain.token_to_id("<|endoftext|>") in got[0]


@pytest.mark.parametrize("name", ["word_bpe_49k.json", "byte_bpe_50k.json"])
def test_a_full_cache_keeps_ids(name, monkeypatch):
    """Many steps through a cache that is too small for them give the ids of an untouched tokenizer."""
    import pyarrow as pa

    from duelframe.llm import token_cache

    monkeypatch.setattr(token_cache, "CACHE_ENTRIES", 60)
    monkeypatch.setattr(token_cache, "SLICE_BYTES", 200)
    rng = np.random.default_rng(2)
    own = [" ".join(f"w{i}, x" for i in rng.integers(0, 90, rng.integers(0, 25))) for _ in range(120)] + [LONG[:3000]]
    encoder, got = CachedEncoder(registry.tokenizer_path(name)), []
    for _, ids, at in encoder.encode(pa.array(own)):
        got += [ids[a:b].tolist() for a, b in zip(at[:-1], at[1:])]
        assert len(encoder.slot) <= max(60, 800)
    assert got == [reference_ids(name, t) for t in own]


@pytest.mark.parametrize("histogram", [{100: 1000}, {10: 1000}, {1: 5000}, {341: 900}, {257: 400, 255: 400}, {600: 100, 100: 400}, {k: 50 for k in range(5, 90)}, {k: 7 for k in range(200, 330)}, {3: 1}])
def test_plan_of_short_pieces(histogram):
    made = packing.plan(histogram, 1024)
    total = Counter()
    for p, _, repeats in made:
        assert sum(p) <= 1024
        for a in p:
            total[a] += repeats
    assert total == histogram
    if len(histogram) == 1:
        [(a, n)] = histogram.items()
        least = -(-n // (1024 // a))
    else:
        least = -(-sum(a * n for a, n in histogram.items()) // 1024)
    assert least <= sum(n for _, _, n in made) <= 1.05 * least


def test_fit_finds_known_repeats():
    """A histogram made from patterns is fitted by counts that give it back; the solution is no worse than plain gradient steps."""
    found = packing.patterns(np.array([700, 500, 524, 324, 400, 224, 124, 100]), 1024, 0)
    assert (700, 324) in found and (524, 500) in found and (500, 400, 124) in found and all(sum(p) == 1024 and list(p) == sorted(p, reverse=True) for p in found)
    histogram = np.zeros(1025)
    for p, n in [((700, 324), 40), ((524, 500), 25), ((500, 400, 124), 10), ((700, 224, 100), 7)]:
        for a in p:
            histogram[a] += n
    x, residual = packing.fit_repeats(histogram, found)
    matrix = np.array([[p.count(a) for p in found] for a in range(1025)], float)
    y = np.zeros(len(found))
    for _ in range(20_000):
        y = np.maximum(0, y - matrix.T @ (matrix @ y - histogram) / np.linalg.norm(matrix, 2) ** 2)
    assert (x >= 0).all() and np.linalg.norm(matrix @ x - histogram) <= np.linalg.norm(matrix @ y - histogram) + 1e-3 * np.linalg.norm(histogram)
    assert residual == pytest.approx(np.linalg.norm(matrix @ x - histogram) / np.linalg.norm(histogram), abs=1e-6) and residual < 1e-3


@pytest.mark.parametrize("times", [1, 10_000])
def test_most_pieces_stand_in_fitted_patterns(times):
    rng = np.random.default_rng(1)
    histogram = {k: times * int(n) for k, n in Counter(rng.integers(1, 1024, 10_000).tolist()).items()} | {1024: 5000 * times}
    left = np.zeros(1025, np.int64)
    for k, n in histogram.items():
        left[k] = n
    assert packing.fit_repeats(left.astype(float), packing.patterns(np.flatnonzero(left), 1024, 0))[1] < 0.05
    made = packing.plan(histogram, 1024)
    assert sum(of * n for _, of, n in made) >= 0.9 * sum(histogram.values())
    assert sum(n for _, _, n in made) <= 1.007 * sum(a * n for a, n in histogram.items()) / 1024 + 1


def test_pieces_of_the_given_documents_stand_in_fitted_patterns(spark):
    docs = spark.read.parquet("/root/testdata/sf0.01/documents.parquet")
    got = packing.pack(docs, registry.tokenizer_path("byte_bpe_50k.json"), 2)
    pieces, inside, sequences, tokens = got.agg(F.count("*"), F.sum(F.col("fitted").cast("int")), F.countDistinct("sequence_id"), F.sum("length")).first()
    assert inside >= 0.8 * pieces and sequences <= 1.01 * tokens / 1024 + 1


@pytest.mark.parametrize("which", ["odd", "docs"])
def test_bpe(request, which):
    import public_tokenizers as P

    df, ranks = request.getfixturevalue(which), registry.tokenizer_path("byte_bpe_multi_50k.tiktoken")
    enc = bpe.encoding(ranks, P.PATTERN)
    got = bpe.decode(bpe.encode(df, ranks, P.PATTERN), ranks, P.PATTERN).collect()
    want = Counter()
    for d, t in texts(df):
        ids = [i for part in re_findall(P.PATTERN, t) for i in enc._encode_single_piece(part.encode())]
        want[d, len(ids), hashlib.sha256(u32(ids)).hexdigest(), hashlib.sha256(t.encode()).hexdigest(), t.encode()] += 1
    assert Counter((r["doc_id"], r["n_tokens"], r["ids_sha256"], r["decoded_sha256"], bytes(r["decoded"])) for r in got) == want


def re_findall(pattern, text):
    import regex

    return regex.findall(pattern, text)


def test_bpe_parts_of_long_text():
    import public_tokenizers as P

    enc = bpe.encoding(registry.tokenizer_path("byte_bpe_multi_50k.tiktoken"), P.PATTERN)
    for text in (LONG + "\n\n  " + LONG + ".  x 's 12 34\n", "日本 " * 3000, "a  \n " * 4000):
        cut = list(bpe.parts(text, 1000))
        assert "".join(cut) == text
        assert [i for c in cut for i in enc.encode_ordinary(c)] == enc.encode_ordinary(text)


LONG_RUNS = [s * n for s, n in ((" ", 2_000_000), ("\n", 2_000_000), (" \n\t\u3000", 500_000))]


def test_bpe_of_long_white_space(spark):
    """Runs that the library's pattern can't take: alone, before, between and after letters, equal to piece by piece."""
    import public_tokenizers as P

    ranks = registry.tokenizer_path("byte_bpe_multi_50k.tiktoken")
    enc = bpe.encoding(ranks, P.PATTERN)
    rows = [(10 * k + j, t) for k, run in enumerate(LONG_RUNS) for j, t in enumerate((run, run + "a", "b c" + run, f"x. {run} y z{run}1"))] + [(None, LONG_RUNS[0])]
    got = bpe.decode(bpe.encode(spark.createDataFrame(rows, "doc_id long, text string").repartition(4), ranks, P.PATTERN), ranks, P.PATTERN).drop("decoded").collect()
    want = Counter()
    for d, t in rows:
        ids = [i for part in re_findall(P.PATTERN, t) for i in enc._encode_single_piece(part.encode())]
        want[d, len(ids), hashlib.sha256(u32(ids)).hexdigest(), hashlib.sha256(t.encode()).hexdigest()] += 1
    assert Counter(tuple(r) for r in got) == want


@pytest.mark.parametrize("run", [" " * 12_000, "\n" * 12_000, "\x85\u2003 " * 5000, "\x1c" * 12_000, "\u200b" * 12_000])
def test_bpe_runs_are_those_of_the_library(run):
    """Below what overflows, the library itself gives the same ids, whatever counts as white space."""
    import public_tokenizers as P

    enc = bpe.encoding(registry.tokenizer_path("byte_bpe_multi_50k.tiktoken"), P.PATTERN)
    for text in (run, run + "a", run + ".", "a" + run, f"it's {run}é{run} \n", f"{run}\x1c{run}b", run + "\u200b"):
        assert bpe.encode_text(enc, text).tolist() == enc.encode_ordinary(text)


def brute_components(rows):
    sets = {}
    for k, (_, t) in enumerate(rows):
        low = (t or "").translate({c: c + 32 for c in range(65, 91)})
        w = re.findall(r"[^\x20\x09-\x0D]+", low)
        sets[k] = frozenset(tuple(w[i : i + 5]) for i in range(len(w) - 4)) if len(w) >= 5 else frozenset([tuple(w)] if w else [])
    parent = list(range(len(rows)))

    def root(k):
        while parent[k] != k:
            k = parent[k]
        return k

    for a, b in combinations(range(len(rows)), 2):
        both = len(sets[a] & sets[b])
        if both and 100 * both >= 80 * len(sets[a] | sets[b]):
            parent[root(a)] = root(b)
    least = {}
    for k, (d, _) in enumerate(rows):
        if d is not None:
            least[root(k)] = min(d, least.get(root(k), d))
    return Counter((d, len(sets[k]), least.get(root(k)) if sets[k] else d) for k, (d, _) in enumerate(rows))


@pytest.mark.parametrize("which", ["odd", "docs", "chains"])
def test_jaccard(spark, request, which):
    if which == "chains":
        rng = np.random.default_rng(3)
        rows, k = [], 0
        for base_words in (60, 200, 37):
            text = [WORDS[i] for i in rng.integers(0, 400, base_words)]
            for _ in range(40):
                at = rng.integers(0, base_words)
                text = [*text[:at], WORDS[rng.integers(0, 400)], *text[at + 1 :]]
                rows.append((1000 - k, " ".join(text)))
                k += 1
        shared = " ".join(WORDS[i] for i in rng.integers(0, 400, 80))
        rows += [(5000 + j, shared + " " + " ".join(WORDS[i] for i in rng.integers(0, 400, 30 + j % 9))) for j in range(60)]
        df = spark.createDataFrame(rows, "doc_id long, text string").repartition(5)
    else:
        df = request.getfixturevalue(which)
    rows = [(r["doc_id"], r["text"]) for r in df.select("doc_id", "text").collect()]
    assert Counter(map(tuple, jaccard.near_duplicates(df).collect())) == brute_components(rows)


@pytest.mark.parametrize("copies", [1, 60])
@pytest.mark.parametrize("how", ["appended", "inserted", "truncated"])
def test_jaccard_of_unequal_sizes(spark, how, copies):
    """Texts that contain one another, at similarities of about 0.78 to 0.92, alone and beside many copies."""
    rows = []
    for group, more in enumerate((9, 13, 17, 20, 22, 24, 25, 26, 28)):
        own = [f"g{group}n{k}" for k in range(104)]
        extra = [f"e{group}n{k}" for k in range(more)]
        other = own[: 104 - more] if how == "truncated" else [*own, *extra] if how == "appended" else [*own[:50], *extra[4:], *own[50:]]
        rows += [(1000 * group + k, " ".join(own)) for k in range(copies)] + [(1000 * group + 900, " ".join(other))]
        if how == "truncated":  # many copies of the short text, too
            rows += [(1000 * group + 901 + k, " ".join(other)) for k in range(copies - 1)]
    df = spark.createDataFrame(rows, "doc_id long, text string").repartition(3)
    assert Counter(map(tuple, jaccard.near_duplicates(df).collect())) == brute_components(rows)


def test_jaccard_keeps_one(odd):
    ids = [r["doc_id"] for r in jaccard.one_of_each(odd).select("doc_id").collect()]
    assert {7, 10, 3, 5, 0, 1, 2, None} <= set(ids) and not {8, 9, 11, 4, 6} & set(ids) and len(ids) == len(set(ids))


def test_jaccard_keeps_one_whatever_columns_are_called(spark, odd):
    """Columns that are called what the joins call theirs."""
    names = ["stay_", "stay_sig_", "unclear_", "rep", "sig", "row_", "id_", "chosen", "salt_", "a.b"]
    for df in (odd, odd.filter("doc_id is not null").dropDuplicates(["doc_id"])):
        wide = df.withColumns({c: F.lit(k) for k, c in enumerate(names)})
        got = jaccard.one_of_each(wide)
        assert got.columns == wide.columns
        assert sorted(map(str, got.select("doc_id", "text").collect())) == sorted(map(str, jaccard.one_of_each(df).select("doc_id", "text").collect()))


def test_jaccard_keeps_rows_that_share_an_id(spark):
    """Different texts under one id, or none, are documents of their own; copies among them go."""
    a, b, c, d = (" ".join(f"{x}{k}" for k in range(30)) for x in "abcd")
    rows = [(1, a), (1, b), (1, b), (2, a), (3, c), (None, c), (None, d), (None, d), (None, ""), (None, None), (4, " "), (4, " "), (5, b + " end")]
    kept = Counter((r["doc_id"], r["text"]) for r in jaccard.one_of_each(spark.createDataFrame([(*r, "x", 1) for r in rows], "doc_id long, text string, sig string, n int").repartition(3)).collect())
    assert kept == Counter([(1, a), (1, b), (3, c), (None, d), (None, ""), (None, None), (4, " "), (4, " ")])


@pytest.mark.parametrize("sizes", [(5, 9, 30, 200), (1500,)])
@pytest.mark.parametrize("rounds", [None, 0])
def test_jaccard_of_random_edits(spark, sizes, rounds, monkeypatch):
    """Families of 2 to 50 texts by edits of all kinds: words added in front, inside or behind, dropped, replaced.

    rounds: with leading documents in every block that holds more than two documents.
    """
    if rounds is not None:
        monkeypatch.setattr(jaccard, "PAIRS_PER_ENTRY", rounds)
    rng = np.random.default_rng(sum(sizes))
    rows = []
    for n in sizes:
        for family, copies in enumerate((2, 7, 50) if n < 1000 else (2, 12)):
            first = [f"f{n}x{family}w{k}" for k in range(n)]
            for c in range(copies):
                text = list(rng.choice(first, 0)) + first
                for _ in range(rng.integers(0, 3)):
                    k, at = int(rng.integers(1, max(2, n // 12 + 1))), int(rng.integers(0, n))
                    own = [f"o{n}x{family}c{c if rng.random() < 0.6 else 0}k{j}" for j in range(k)]
                    how = rng.integers(0, 5)
                    text = own + text if how == 0 else text + own if how == 1 else text[:at] + own + text[at:] if how == 2 else text[:at] + text[at + k :] if how == 3 else text[:at] + own + text[at + k :]
                rows.append((len(rows), " ".join(text)))
    df = spark.createDataFrame(rows, "doc_id long, text string").repartition(4)
    assert Counter(map(tuple, jaccard.near_duplicates(df).collect())) == brute_components(rows)


def test_jaccard_compares_few_pairs_of_a_group(spark, monkeypatch):
    """Of one large family whose texts nearly all pass the bounds with each other, few pairs are compared, and no link is lost."""
    monkeypatch.setattr(jaccard, "PAIRS_PER_ENTRY", 10**9)  # all pairs at once, without leading documents
    rng = np.random.default_rng(8)
    first = [f"base{k}" for k in range(146)]
    rows = []
    for k in range(240):
        text = list(first)
        for j, at in enumerate(rng.choice(146, 2 if k % 8 else 1, replace=False)):
            text[at] = f"own{k}x{j}"
        rows.append((k, " ".join(text)))
    compared, verified = [], jaccard.verified
    monkeypatch.setattr(jaccard, "verified", lambda pairs, sets: (compared.append(pairs.count()), verified(pairs, sets))[1])
    df = spark.createDataFrame(rows, "doc_id long, text string").repartition(4)
    assert Counter(map(tuple, jaccard.near_duplicates(df).collect())) == brute_components(rows)
    assert len(compared) > 1 and sum(compared) <= 20 * len(rows), compared


def test_jaccard_lists_few_pairs_that_do_not_link(spark, monkeypatch):
    """Of a family whose texts link with one text, and not with each other, hardly more pairs are listed than link."""
    monkeypatch.setattr(jaccard, "PAIRS_PER_ENTRY", 10**9)
    rng = np.random.default_rng(8)
    first = [f"base{k}" for k in range(146)]
    rows = [(0, " ".join(first))]
    for k in range(1, 240):
        text = list(first)
        for j, at in enumerate(rng.choice(12, 2, replace=False) * 12 + 4):
            text[at] = f"own{k}x{j}"
        rows.append((k, " ".join(text)))
    listed, overlaps = [], jaccard.overlaps
    monkeypatch.setattr(jaccard, "overlaps", lambda *a, **b: (listed.append((got := overlaps(*a, **b)).count()), got)[1])
    df = spark.createDataFrame(rows, "doc_id long, text string").repartition(4)
    assert Counter(map(tuple, jaccard.near_duplicates(df).collect())) == brute_components(rows)
    sets = [{tuple(t.split()[k : k + 5]) for k in range(142)} for _, t in rows]
    link = sum(9 * len(x & y) >= 4 * (len(x) + len(y)) for k, x in enumerate(sets) for y in sets[:k])
    assert link <= sum(listed) <= 1.2 * link < 0.5 * 240 * 239 / 2, (listed, link)


@pytest.mark.parametrize("part", [1 << 17, 5])
def test_components_take_few_rounds(spark, part, monkeypatch):
    """A path in any order needs few tables where a task may hold its edges; and small parts give the same."""
    monkeypatch.setattr(components, "STAR_EDGES", part)
    made, materialize = [], components.materialize
    monkeypatch.setattr(components, "materialize", lambda df, tag: (made.append(tag), materialize(df, tag))[1])
    order = np.random.default_rng(4).permutation(400).tolist()
    edges = [(order[k], order[k + 1]) for k in range(300)] + [(order[k], order[k + 1]) for k in range(301, 399)]
    got = {r["node"]: r["component"] for r in components.connected_components(spark.createDataFrame(edges, "a long, b long").repartition(3)).collect()}
    assert got == {x: min(own) for own in (order[:301], order[301:]) for x in own}
    assert part < 10 or len(made) <= 3 + 2 * 4, made


def test_components(spark):
    edges = [(k, k + 1) for k in range(0, 30)] + [(100, 105), (105, 103)] + [(200, k) for k in range(201, 240)] + [(7, 7)]
    got = {r["node"]: r["component"] for r in components.connected_components(spark.createDataFrame(edges, "a long, b long")).collect()}
    assert got == {**{k: 0 for k in range(31)}, 100: 100, 105: 100, 103: 100, **{k: 200 for k in range(200, 240)}}
    assert components.connected_components(spark.createDataFrame([], "a long, b long")).count() == 0


def plain_spans(text):
    out = []
    for m in re.finditer(r"[A-Za-z0-9._%+-]+@[A-Za-z0-9-]+(\.[A-Za-z0-9-]+)+", text):
        out.append((m.start(), m.end(), "email"))
    for m in re.finditer(r"[0-9]+(\.[0-9]+)(\.[0-9]+)(\.[0-9]+)", text):
        if all(int(x) <= 255 for x in m[0].split(".")):
            out.append((m.start(), m.end(), "ip"))
    for m in re.finditer(r"[0-9]([\x20-]?[0-9])+", text):
        d = [int(c) for c in m[0] if c.isdigit()]
        if 14 <= len(d) <= 19 and (sum(d[-1::-2]) + sum(sum(divmod(2 * x, 10)) for x in d[-2::-2])) % 10 == 0:
            out.append((m.start(), m.end(), "card"))
    for m in re.finditer(r"\+[0-9][\x20().0-9-]+[0-9]", text):
        if 10 <= sum(c.isdigit() for c in m[0]) <= 15:
            out.append((m.start(), m.end(), "phone"))
    return sorted(out, key=lambda s: (s[0], pii.KINDS.index(s[2])))


@pytest.mark.parametrize("which", ["odd", "docs"])
def test_pii_base(request, which):
    df = request.getfixturevalue(which)
    got = Counter(tuple(r)[:6] for r in pii.report(df).collect())
    want = Counter()
    for d, t in texts(df):
        spans = plain_spans(t)
        joined = ",".join(f"{k}:{a}:{b}" for a, b, k in spans)
        want[(d, *(sum(s[2] == k for s in spans) for k in pii.KINDS), hashlib.sha256(joined.encode()).hexdigest())] += 1
    assert got == want


def test_pii_linear_patterns():
    assert pii.base_spans("a" * 300_000 + "@") == [] and pii.base_spans("1" * 300_000 + "@x.") == []
    for t in ("@@a@b.c..d@e.f.g", "1.2.3.4.5.6.7.8.9", "+1+2 (345) 678-901234", "12 34-5678 9012 3456 78", "00255.1.1.1"):
        assert pii.base_spans(t) == plain_spans(t)


def test_pii_terms(spark):
    rows = [(k, f"the owner zorblax quux wrote from zed{k}@mail.example.org about it number{k}") for k in range(3)]
    rows += [(10 + k, f"agent qwyjibo sent it to secret@mail.example.org and the rest went home {k}") for k in range(4)]
    rows += [(100 + k, f"the rest went home and sent it to the number of {'abcdefghij'[k % 10]} it") for k in range(600)]
    df = spark.createDataFrame(rows, "doc_id long, text string")
    found = {r["doc_id"]: r for r in pii.report(df).collect()}
    assert "remove:6:13" in found[10]["spans"] and "email:25:" in found[10]["spans"] and "generalise:0:3" not in found[0]["spans"]
    clean = {r["doc_id"]: r["text"] for r in pii.sanitise(df).collect()}
    assert "qwyjibo" not in clean[10] and "@" not in clean[10] and "[EMAIL]" in clean[10] and clean[100] == rows[7][1] and len(clean) == len(rows)


def test_pii_terms_far_away(spark):
    """Terms of an entity's documents disclose it however far away they stand, and in any text."""
    far = " ".join(["filler words that go on"] * 8)
    rows = [(k, f"qwyjibo {far} secret@mail.example.org {far} Zorblax street, again qwyjibo {k}") for k in range(3)]
    rows += [(10, f"{far} and zorblax too")] + [(100 + k, f"{far} and words {k} of others too") for k in range(600)]
    df = spark.createDataFrame(rows, "doc_id long, text string").repartition(3)
    found = {r["doc_id"]: r["spans"].split(",") for r in pii.report(df).collect()}
    text = rows[0][1]
    for at in (0, text.rindex("qwyjibo")):
        assert f"remove:{at}:{at + 7}" in found[0]
    place = text.index("Zorblax")
    assert any(x in found[0] for x in (f"generalise:{place}:{place + 7}", f"remove:{place}:{place + 7}")) and "ip" not in found[0]
    assert found[10] != [""] and all(found[k] == [""] for k, _ in rows if k >= 100)
    clean = {r["doc_id"]: r["text"] for r in pii.sanitise(df).collect()}
    assert not any(w in clean[k].lower() for w in ("qwyjibo", "zorblax", "secret") for k in (0, 1, 2, 10)) and clean[100] == rows[4][1] and len(clean) == len(rows)


def test_pii_sanitise_odd(odd):
    clean = pii.sanitise(odd)
    assert clean.columns == odd.columns and clean.count() == odd.count()
    assert clean.filter("doc_id = 1 and text is null").count() == 1


def test_language(spark, odd, none):
    df = spark.read.parquet("/root/testdata/sf0.01/documents.parquet")
    got = langid.identify(df).join(df.select("doc_id", "lang"), "doc_id").filter("held_out").collect()
    assert all(zlib.crc32(str(r["doc_id"]).encode()) % 3 == 1 for r in got)
    assert np.mean([r["lang_pred"] == r["lang"] for r in got if r["lang_pred"] != "und"]) > 0.97
    assert all(0 <= r["score"] <= 1 for r in got)
    assert {(r["lang_pred"], r["score"]) for r in langid.identify(odd).collect()} == {("und", 0.0)}
    assert langid.identify(none).count() == 0


def plain_grams(text):
    low = text.lower()
    return {low[i : i + n] for n in (1, 2, 3) for i in range(len(low) - n + 1)}


def test_language_kernel(spark):
    """Presence, kernel and regression against sets of substrings and plain linear algebra."""
    df = spark.read.parquet("/root/testdata/sf0.001/documents.parquet").filter("lang is not null")
    model = langid.fit(df)
    rows = sorted((r["lang"], r["text"] or "") for r in langid.sample(df, langid.TEXTS).collect())
    texts = [t for _, t in rows if t][:40]
    known = {int(model.keys[c]): int(model.slots[c]) - 1 for c in np.flatnonzero(model.slots)}
    number = lambda g: sum((ord(c) + 1) << (21 * (len(g) - 1 - i)) for i, c in enumerate(g))
    want = np.zeros((len(texts), model.landmarks.shape[0]))
    for k, t in enumerate(texts):
        for g in plain_grams(t):
            if (at := known.get(number(g))) is not None:
                want[k, at] = 1
    got = langid.presence(texts, model)
    assert np.array_equal(got, want)
    kernel = np.array([[(x * (z > 0)).sum() / np.sqrt(max(x.sum(), 1) * (z > 0).sum()) for z in model.landmarks.T] for x in want])
    assert np.allclose(langid.kernel(got, model), kernel, atol=1e-4)
    scores = np.maximum(kernel @ model.weights, 0)
    import pyarrow as pa

    found = langid.predict_texts(pa.array(texts), model)
    assert [x.as_py() for x in found.field("lang_pred")] == [model.languages[k] for k in scores.argmax(1)]
    assert np.allclose(found.field("score").to_numpy(zero_copy_only=False), scores.max(1) / scores.sum(1), atol=1e-4)


def test_language_vocabulary_is_whole(spark, monkeypatch):
    """The most frequent n-grams by plain counting, all of them found again where cells collide."""
    df = spark.read.parquet("/root/testdata/sf0.001/documents.parquet").filter("lang is not null")
    texts = [r["text"] for r in langid.sample(df, 10).collect() if r["text"]]
    count = Counter(g for t in texts for g in plain_grams(t))
    number = lambda g: sum((ord(c) + 1) << (21 * (len(g) - 1 - i)) for i, c in enumerate(g))
    monkeypatch.setattr(langid, "VOCABULARY", 500)
    monkeypatch.setattr(langid, "TABLE_BITS", 10)
    got = langid.vocabulary_of(spark.createDataFrame([(t,) for t in texts], "text string")).tolist()
    assert got == [number(g) for g in sorted(count, key=lambda g: (-count[g], number(g)))[:500]]
    slots, keys = langid.hash_table(np.array(got, np.uint64))
    assert sorted(slots[slots > 0]) == list(range(1, 501))
    model = langid.Model(["x"], slots, keys, np.zeros((500, 1), np.float32), np.zeros((1, 1), np.float32))
    want = [[g in {number(x) for x in plain_grams(t)} for g in got] for t in texts[:15]]
    assert np.array_equal(langid.presence(texts[:15], model), np.array(want))


def test_many_languages_are_all_learned(spark, monkeypatch):
    """More languages than the bounds were made for: fewer texts and landmarks each, none left out."""
    monkeypatch.setattr(langid, "ALL_TEXTS", 200)
    monkeypatch.setattr(langid, "ALL_LANDMARKS", 100)
    rows = [(100 * k + j, f"{chr(0x4E00 + k)}{chr(0x5E00 + k)} word {chr(0x4E00 + k)}{j}", f"l{k:03d}") for k in range(60) for j in range(6)]
    df = spark.createDataFrame(rows, "doc_id long, text string, lang string")
    model = langid.fit(df)
    assert len(model.languages) == 60 and model.landmarks.shape[1] == 60
    got = {r["doc_id"]: r["lang_pred"] for r in langid.identify(df).collect()}
    assert np.mean([got[d] == lang for d, _, lang in rows]) > 0.95


def test_language_sample_of_repeated_rows(spark):
    """Copies and rows without an id take no other text's place; each language keeps its own bound."""
    rows = [(None, "x", f"text {k % 3}") for k in range(300)] + [(k, "y", f"other {k}") for k in range(20)] + [(7, "z", "same")] * 50 + [(8, None, "none")]
    got = Counter((r["lang"], r["text"]) for r in langid.sample(spark.createDataFrame(rows, "doc_id long, lang string, text string").repartition(4), 5).collect())
    assert Counter(lang for lang, _ in got.elements()) == {"x": 3, "y": 5, "z": 1} and max(got.values()) == 1


def test_quality(spark, odd, none):
    df, labels = (spark.read.parquet(f"/root/testdata/sf0.1/{t}.parquet") for t in ("documents", "labels"))
    train, test = labels.filter("doc_id % 2 = 0"), labels.filter("doc_id % 2 = 1")
    got = quality.assess(df, train, F.col("source"), F.col("lang")).join(test, "doc_id").collect()
    good, bad = ([r["keep"] for r in got if r["quality"] is not None and r[-2] == q] for q in (1, 0))
    assert np.mean(good) > 0.98 and np.mean(bad) < 0.25
    for rows in (odd, none):
        out = quality.assess(rows, labels.limit(0), F.col("source"), F.col("lang"))
        assert out.count() == rows.count() and out.filter("not keep").count() == 0
        assert quality.kept(rows, labels.limit(0), F.col("source"), F.col("lang")).columns == rows.columns


def posteriors(rows):
    """Host rate, path rate and quality of (host, path, score) rows: plain sums, each without the row's own score."""
    n = len(rows)
    mu = min(max(sum(r[2] for r in rows) / n, 1e-4), 1 - 1e-4)
    hosts, paths = defaultdict(list), defaultdict(list)
    for h, p, x in rows:
        hosts[h].append(x)
        paths[h, p].append(x)

    def strength(sites, prior):
        v = sum(len(x) * ((np.mean(x) - prior(k)) ** 2 - np.var(x) / len(x)) for k, x in sites.items())
        b = sum(len(x) * prior(k) * (1 - prior(k)) for k, x in sites.items())
        return min(max(b / max(v, 1e-9), quality.STRENGTH[0]), quality.STRENGTH[1])

    kh = strength(hosts, lambda k: mu)
    kp = strength(paths, lambda k: (sum(hosts[k[0]]) + kh * mu) / (len(hosts[k[0]]) + kh))
    logit = lambda p: np.log(p / (1 - p))
    out = []
    for h, p, x in rows:
        host = (sum(hosts[h]) - x + kh * mu) / (len(hosts[h]) - 1 + kh)
        path = (sum(paths[h, p]) - x + kp * host) / (len(paths[h, p]) - 1 + kp)
        out.append((host, path, 1 / (1 + np.exp(-(logit(x) + logit(path) - logit(mu))))))
    return out


def test_quality_posteriors(spark):
    """Sums by brute force: hot, sparse and null sites, equal scores."""
    rng = np.random.default_rng(4)
    rows = [("big", f"p{k % 3}", float(rng.uniform(0.05, 0.95))) for k in range(150)] + [(f"h{k % 17}", None if k % 5 == 0 else f"p{k % 2}", float(rng.uniform(0.3, 0.99))) for k in range(60)]
    rows += [(None, None, 0.5), (None, None, 0.5), ("one", "only", 0.9)]
    df = spark.createDataFrame([(k, *r) for k, r in enumerate(rows)], "k long, host_ string, path_ string, p_ double").repartition(4)
    got = [tuple(r)[1:] for r in quality.posterior(df).select("k", "host_rate", "path_rate", "quality_").orderBy("k").collect()]
    assert np.allclose(got, posteriors(rows), atol=1e-9)


def test_quality_sites(spark):
    df = spark.createDataFrame([("HTTP://A.org/x/y?z", "s", "l"), ("https://b.org", "s", "l"), (None, "s", "l"), ("no url", "s", "l")], "url string, source string, lang string")
    assert [tuple(r) for r in df.select(*quality.sites_of(df)).collect()] == [("a.org", "x"), ("b.org", ""), (None, None), ("", "")]
    assert [tuple(r) for r in df.drop("url").select(*quality.sites_of(df.drop("url"))).collect()] == [("s", "l")] * 4


@pytest.mark.parametrize("which", ["odd", "docs", "none"])
def test_sharding(request, which):
    df = request.getfixturevalue(which)
    got = sharding.shard(df).collect()
    assert Counter((r["doc_id"], r["size"], r["text_crc32"]) for r in got) == Counter((d, len(t.encode()) + 1, zlib.crc32(t.encode())) for d, t in texts(df))
    slots = defaultdict(list)
    for r in got:
        slots[r["shard"]].append(r["slot"])
    counts = [len(slots[s]) for s in range(8)]
    assert max(counts) - min(counts) <= 1 and all(sorted(v) == list(range(len(v))) for v in slots.values()) and set(slots) <= set(range(8))


def test_sharding_cuts_fewer_links(spark):
    rows = [(k, f"a line that names group number {k % 40} and is long enough\nown line {k} of this very document and more") for k in range(400)]
    _, nodes = sharding.nodes_of(spark.createDataFrame(rows, "doc_id long, text string"))
    links = sharding.incidence(nodes)
    before, after = (sharding.edge_cut(links, sharding.propagate(nodes, links, 4, n)).first()["cut"] for n in (0, 5))
    assert after < 0.7 * before


@pytest.mark.parametrize("given", [True, False])
def test_hamming(spark, given):
    rng = np.random.default_rng(1)
    if given:
        df = spark.read.parquet("/root/testdata/sf0.001/embeddings.parquet")
    else:
        rows = [(k, [float(x) for x in rng.normal(size=64)] if k % 3 else [1.0] * 64) for k in range(240)] + [(500, None), (550, []), (600, [1.0, -1.0])]
        df = spark.createDataFrame(rows, "vec_id long, embedding array<double>")
    rows = [(r["vec_id"], sum(1 << i for i, x in enumerate(r["embedding"][:64]) if x > 0)) for r in df.collect() if r["embedding"]]
    want = set()
    for q, c in rows:
        if q % 50 == 0:
            best = sorted(((c ^ d).bit_count(), i) for i, d in rows if i != q)[:10]
            want |= {(q, k + 1, i, dist) for k, (dist, i) in enumerate(best)}
    assert {tuple(r) for r in hamming.top_k(df).collect()} == want
    clashing = df.withColumn("code", F.lit("x")).withColumn("rows", F.lit(1)).withColumn("id", F.lit(2)).withColumn("radius", F.lit(3))
    for segments in (4, 7):  # wide and uneven segments for few codes: large radii
        assert {tuple(r) for r in hamming.top_k(clashing, segments=segments).collect()} == want


def test_hamming_of_far_away_queries(spark):
    """A query far from all codes, and a table with fewer codes than neighbours asked for, end by the last round."""
    rows = [(50, [1.0] * 64), *((k, [-1.0] * (60 + k) + [1.0] * (4 - k)) for k in range(1, 4))] + [(None, [1.0] * 64)]
    df = spark.createDataFrame(rows, "vec_id long, embedding array<double>")
    got = sorted(tuple(r) for r in hamming.top_k(df, segments=8).collect())
    assert got == [(50, 1, 1, 61), (50, 2, 2, 62), (50, 3, 3, 63)]


def test_hamming_widths():
    for codes in (0, 1, 500, 1 << 16, 1 << 20, 1 << 24, 1 << 33):
        bits = hamming.widths(codes)
        assert sum(bits) == 64 and max(bits) <= 22 and max(bits) - min(bits) <= 1
    assert hamming.widths(1 << 16) == [16] * 4 and hamming.widths(1 << 24) == [22, 21, 21]


def test_hamming_refuses_longer_vectors(spark):
    with pytest.raises(Exception, match="more components"):
        hamming.top_k(spark.createDataFrame([(50, [1.0] * 65), (51, [1.0] * 64)], "vec_id long, embedding array<double>")).collect()


@pytest.mark.parametrize("which", ["odd", "docs"])
def test_media(request, which):
    df = request.getfixturevalue(which)
    got = media.media_features(df).collect()
    want = Counter()
    for d, t in texts(df):
        raw = t.encode()
        payload = raw + b"\0" * (-len(raw) % 64 or (0 if raw else 64))
        file = media.pcm_wav(payload)
        want[d, len(raw), len(payload), hashlib.sha256(payload).hexdigest(), zlib.crc32(payload[-64:]), len(file), hashlib.sha256(file).hexdigest()] += 1
    assert Counter(tuple(r)[:7] for r in got) == want
    by = defaultdict(set)
    for r in got:
        by[r["payload_sha256"]].add(r["feature"])
    assert all(len(v) == 1 for v in by.values())


def test_media_blocks_and_tensors():
    import pyarrow as pa

    payload = bytes(np.random.default_rng(0).integers(0, 256, 300 * 128 * 2, dtype=np.uint8))
    whole = media.log_mel(payload)
    kept = media.BLOCK_FRAMES
    try:
        media.BLOCK_FRAMES = 64
        assert np.allclose(media.log_mel(payload), whole, atol=1e-3)
    finally:
        media.BLOCK_FRAMES = kept
    table = media.tensors(whole)
    assert len(table) == -(-len(whole) // media.PATCH) and isinstance(table["log_mel"].type, pa.FixedShapeTensorType)
    assert np.allclose(table["log_mel"].chunk(0).to_numpy_ndarray().reshape(-1, media.BANDS)[: len(whole)], whole)
    assert pa.ipc.open_stream(media.ipc(table)).read_all().num_rows == len(table)


def test_media_resampling_and_mel():
    """Polyphase resampling against inserting zeros, filtering and dropping; mel frames and segments one by one."""
    rng = np.random.default_rng(7)
    phases, window, bank = media.tables()
    low = np.zeros(media.TAPS * media.UP)
    for p in range(media.UP):
        low[p :: media.UP] = phases[p][::-1]
    for n in (1, 2, 5, 64, 999, 4000):
        x = rng.normal(size=n).astype(np.float32)
        full = np.zeros(n * media.UP)
        full[:: media.UP] = x
        filtered = np.convolve(full, low)
        shift = (media.TAPS - 1 - media.TAPS // 2) * media.UP
        want = [filtered[m * media.DOWN + shift] for m in range(n * media.UP // media.DOWN)]
        assert np.allclose(media.resample(x), want, atol=1e-4)
    payload = bytes(np.concatenate([rng.integers(120, 136, 6400), rng.integers(0, 256, 9600), rng.integers(120, 136, 6400)]).astype(np.uint8))
    y = media.resample(np.frombuffer(payload, np.uint8).astype(np.float32) / 128 - 1)
    mel = media.log_mel(payload)
    for k in range(0, len(mel), 3):
        part = np.zeros(media.FRAME)
        own = y[k * media.HOP : k * media.HOP + media.FRAME]
        part[: len(own)] = own
        angle = -2j * np.pi * np.outer(np.arange(media.FRAME // 2 + 1), np.arange(media.FRAME)) / media.FRAME
        assert np.allclose(mel[k], np.log(np.abs(np.exp(angle) @ (part * window)) ** 2 @ bank + 1e-6), atol=1e-2)
    energy = mel.mean(1) - np.median(mel.mean(1))
    want, begin, loud = [], None, False
    for k, e in enumerate([*energy, -np.inf]):
        if e >= media.CLOSE:
            begin, loud = (k, False) if begin is None else (begin, loud)
            loud |= e > media.OPEN
        elif begin is not None:
            want += [(begin, k)] if loud else []
            begin = None
    assert [tuple(x) for x in media.segments(mel).tolist()] == want and want


def test_media_tensors_are_stored(spark, odd, monkeypatch):
    import pyarrow as pa

    stored = {}

    def kept(df, tag):
        stored[tag] = base.materialize(df, tag)
        return stored[tag]

    monkeypatch.setattr(media, "materialize", kept)
    got = {r["payload_sha256"]: r["feature"] for r in media.media_features(odd).collect()}
    rows = stored["tensors"].collect()
    assert len(rows) == odd.count()
    for (_, t), r in zip(sorted(texts(odd), key=str), sorted(rows, key=lambda r: str((r["doc_id"], ""))), strict=True):
        raw = t.encode()
        payload = raw + b"\0" * (-len(raw) % 64 or (0 if raw else 64))
        assert r["payload_sha256"] == hashlib.sha256(payload).hexdigest()
        mel, table = media.log_mel(payload), pa.ipc.open_stream(r["tensors"]).read_all()
        assert np.array_equal(media.frames_of(table), mel) and isinstance(table["log_mel"].type, pa.FixedShapeTensorType)
        second = media.HOP * media.DOWN / (media.RATE * media.UP)
        spans = media.segments(mel)
        assert np.allclose([[x["start_s"], x["end_s"]] for x in r["segments"]], spans * second) if len(spans) else r["segments"] == []
        assert got[r["payload_sha256"]].startswith(f"frames={len(mel)};segments={len(spans)};voiced={int((spans[:, 1] - spans[:, 0]).sum())};mel=")


def test_empty_tables(spark, none):
    path = f"{base.shared_dir(spark)}/store-none"
    token_store.write_store(none, path, registry.tokenizer_path("word_bpe_49k.json"), end_id=1)
    assert token_store.with_global_start(spark, path, token_store.read_store(spark, path)).count() == 0
    assert packing.pack(none, registry.tokenizer_path("byte_bpe_50k.json"), 2).count() == 0
    assert jaccard.near_duplicates(none).count() == 0 and pii.report(none).count() == 0 and media.media_features(none).count() == 0
    import public_tokenizers as P

    ranks = registry.tokenizer_path("byte_bpe_multi_50k.tiktoken")
    assert bpe.decode(bpe.encode(none, ranks, P.PATTERN), ranks, P.PATTERN).count() == 0
    assert hamming.top_k(spark.createDataFrame([], "vec_id long, embedding array<float>")).count() == 0


def test_pii_words_outside_spans():
    """Blanking spans leaves the words that no span touches, however words and spans meet."""
    import random

    rnd = random.Random(3)
    for _ in range(4000):
        text = "".join(rnd.choice(["a", "Bc", "é", "²", "1", "_", " ", ".", "@", "+", "-", "1.2.3.4", "x@y.z", "é@ü", "+1234567890123", "İ"]) for _ in range(rnd.randrange(14)))
        spans = pii.base_spans(text)
        assert pii.words_of(pii.blanked(text, spans)) == {w for _, _, w in pii.outside(text, spans)}, text


def plain_actions(texts):
    """Terms and their actions by counting all pairs of entities and terms."""
    of_term, of_entity, both, different = Counter(), Counter(), Counter(), defaultdict(set)
    for t in texts:
        spans = plain_spans(t)
        entities = {f"{k}:{t[a:b].lower()}" for a, b, k in spans}
        terms = {m[0].lower() for m in re.finditer(r"[^\W\d_]+", t) if not any(a < m.end() and m.start() < b for a, b, _ in spans)}
        of_term.update({w.lower() for w in re.findall(r"[^\W\d_]+", t)})
        of_entity.update(entities)
        both.update((e, w) for e in entities for w in terms)
        for e in entities:
            for w in terms:
                different[e, w].add(t)
    want = {}
    for (e, w), c in both.items():
        sure = c / of_term[w] * len(different[e, w]) / (len(different[e, w]) + 1)
        if np.log(sure * len(texts) / of_entity[e]) / max(np.log(len(texts) / of_entity[e]), 1e-9) >= 0.85:
            want[w] = max(want.get(w, ""), "remove" if sure >= 0.6 else "generalise")
    return want


def plain_sanitised(text, want):
    """A text without its base spans and terms; of spans that overlap the first's replacement counts for all."""
    if text is None:
        return None
    base = plain_spans(text)
    spans = base + [(m.start(), m.end(), want[m[0].lower()]) for m in re.finditer(r"[^\W\d_]+", text) if m[0].lower() in want and not any(a < m.end() and m.start() < b for a, b, _ in base)]
    out, at = "", 0
    for a, b, kind in sorted(spans, key=lambda s: (s[0], -s[1])):
        if a >= at:
            out += text[at:a] + {"remove": "", "generalise": "[TERM]"}.get(kind, f"[{kind.upper()}]")
        at = max(at, b)
    return out + text[at:]


def test_pii_terms_of_the_given_documents(spark):
    """Rare entities have disclosing terms too, but not all words of their documents are disclosing."""
    rows = [(r["doc_id"], r["text"]) for r in spark.read.parquet("/root/testdata/sf0.01/documents.parquet").collect()]
    rows += [(10**6 + k, f"{rows[k][1]} greta zorblax wrote from g.zorblax@mail.example.org") for k in range(3)]
    df = spark.createDataFrame(rows, "doc_id long, text string").repartition(4)
    want = plain_actions([t or "" for _, t in rows])
    assert {r["term"]: r["action"] for r in pii.disclosing(df, pii.find(df)).collect()} == want
    assert want["zorblax"] == want["greta"] == "remove" and "generalise" in want.values()
    personal = [t for _, t in rows if t and plain_spans(t)]
    kept = [np.mean([w.lower() not in want for w in re.findall(r"[^\W\d_]+", t)] or [1]) for t in personal]
    assert min(kept) > 0.3 and np.mean(kept) > 0.7


def test_pii_copies_are_no_evidence(spark):
    """A third of all rows is one text with an entity: its words don't disclose it; and one text with many entities."""
    rows = [(k, "our office at info@mail.example.org answers letters on weekdays") for k in range(100)] + [(1000 + k, f"{w} plain words {k}") for k, w in enumerate(["abc", "xyz"] * 100)]
    rows += [(5000, " ".join(f"u{k}@mail.example.org" for k in range(300)) + " lonely")]
    df = spark.createDataFrame(rows, "doc_id long, text string").repartition(4)
    got = {r["term"]: r["action"] for r in pii.disclosing(df, pii.find(df)).collect()}
    assert got == plain_actions([t for _, t in rows]) == {"lonely": "generalise"}


@pytest.mark.parametrize("exact", [True, False])
def test_pii_terms_by_plain_counts(spark, exact, monkeypatch):
    """Disclosing terms of a table with hot, rare and shared entities by plain counting over all documents."""
    if not exact:
        monkeypatch.setattr(pii, "EXACT_TERMS", 0)
    rng = np.random.default_rng(8)
    vocabulary = [f"Word{'abcdefghij'[k % 10]}{'klmnopqrst'[k // 10]}" for k in range(100)]
    rows = []
    for k in range(400):
        words = list(rng.choice(vocabulary, 12))
        if k % 3 == 0:
            e = int(rng.integers(0, 8))
            words += [f"user{e}@mail.org", f"secret{'abcdefgh'[e]}", *([f"10.0.0.{e}"] if k % 2 else [])]
            if e < 4 and rng.random() < 0.5:
                words.append(f"half{'abcdefgh'[e]}")
        rows.append((k, " ".join(words)))
    rows += [(1000 + k, rows[3][1]) for k in range(5)] + [(2000, None), (2001, "")]
    texts = [t or "" for _, t in rows]
    want = plain_actions(texts)
    df = spark.createDataFrame(rows, "doc_id long, text string").repartition(4)
    got = {r["term"]: r["action"] for r in pii.disclosing(df, pii.find(df)).collect()}
    assert got == want and want
    for r in pii.report(df).collect():
        t = dict(rows)[r["doc_id"]] or ""
        spans = plain_spans(t)
        extra = [(a, b, want[w]) for a, b, w in pii.outside(t, spans) if w in want]
        order = [*pii.KINDS, "generalise", "remove"]
        assert r["spans"] == ",".join(f"{k}:{a}:{b}" for a, b, k in sorted([*spans, *extra], key=lambda s: (s[0], order.index(s[2]))))


def test_large_joins_are_not_broadcast(spark):
    """The copies of a spread join and tables of a dealt one don't go through the driver, however small their files are."""
    rows = spark.range(1000).selectExpr("id % 50 AS k", "id AS x")
    small = base.materialize(spark.range(50).selectExpr("id AS k", "id * 2 AS y"), "few")
    for out in (base.spread_join(rows, small, "k"), base.dealt_join(rows, small, "k"), base.spread_join(rows, small, "k", "left")):
        assert "Broadcast" not in out._jdf.queryExecution().executedPlan().toString()
        assert sorted((r["k"], r["x"], r["y"]) for r in out.select("k", "x", "y").collect()) == sorted((x % 50, x, x % 50 * 2) for x in range(1000))
