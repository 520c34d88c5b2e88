"""Bootstrap intervals of means with many resamples, without a row for each resample and row.

A group's rows stand in blocks. How many of a resample's n draws fall into a block comes from binomial splits down a
tree of blocks, each with a seed of its own group and node, so every task finds the same numbers by itself and the
draws of all blocks together are exactly n. Inside a block its draws are uniform. A block makes one vector, the sums of
its drawn values in every resample; a group of one block is finished there, and vectors of others are added up.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.ml.functions import array_to_vector, vector_to_array
from pyspark.ml.stat import Summarizer
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from duelframe.operators.windows import ranked

#: Rows of a block, and draws that one step makes.
BLOCK, STEP = 4096, 1 << 20
RESULT = "n long, mean double, low double, high double, share_below_zero double"


def _generator(seed: int, *node: int) -> np.random.Generator:
    return np.random.Generator(np.random.PCG64(np.random.SeedSequence([seed & 0xFFFFFFFF, (seed >> 32) & 0xFFFFFFFF, *node])))


def draws_of_block(seed: int, n: int, block: int, resamples: int, size: int = BLOCK) -> np.ndarray:
    """How many of each resample's ``n`` draws fall into this block of the group."""
    draws = np.full(resamples, n, np.int64)
    low, high = 0, -(-n // size)
    while high - low > 1:
        middle = (low + high) // 2
        rows, left = min(high * size, n) - low * size, (middle - low) * size
        to_left = _generator(seed, 1, low, high).binomial(draws, left / rows)
        if block < middle:
            draws, high = to_left, middle
        else:
            draws, low = draws - to_left, middle
    return draws


def drawn_sums(values: np.ndarray, draws: np.ndarray, seed: int, block: int) -> np.ndarray:
    """For each resample the sum of so many values drawn from the block."""
    random, out, first = _generator(seed, 2, block), np.zeros(len(draws)), 0
    ends = np.cumsum(draws)
    while first < len(draws):
        done = ends[first - 1] if first else 0
        last = max(first + 1, int(np.searchsorted(ends, done + STEP, "right")))
        own = draws[first:last]
        picked = values[random.integers(0, len(values), int(own.sum()))]
        out[first:last] = np.bincount(np.repeat(np.arange(len(own)), own), picked, len(own))
        first = last
    return out


def bootstrap_means(rows: DataFrame, key: str, by: str, value: str, resamples: int = 10_000, quantiles: tuple[float, float] = (0.025, 0.975), size: int = BLOCK) -> DataFrame:
    """by, n, mean, low, high (quantiles of resampled means) and share_below_zero (of them) for each group.

    Rows are placed by ``key``, so results don't depend on partitions; blocks have ``size`` rows. Rows without a value
    are left out.
    """
    known = rows.filter(F.col(value).isNotNull()).select(by, key, F.col(value).cast("double").alias("value_"))
    placed = ranked(known, [F.col(key), F.col("value_")], [by])
    block = F.floor((F.col("rank_") - 1) / size)
    blocks = placed.groupBy(by, block.alias("block_")).agg(F.transform(F.array_sort(F.collect_list(F.struct("rank_", "value_"))), lambda x: x.value_).alias("values_"))
    sizes = placed.groupBy(by).agg(F.count("*").alias("n"))
    met = blocks.join(sizes.withColumnRenamed(by, "of_"), F.col(by).eqNullSafe(F.col("of_")))
    dealt = met.select(F.col(by), F.xxhash64(F.col(by).cast("string")).alias("seed_"), "block_", "n", "values_")
    kind = rows.schema[by].dataType.simpleString()

    def whole(n: int, total: float, sums: np.ndarray) -> tuple:
        means = sums / n
        return (n, total / n, *np.quantile(means, quantiles).tolist(), float((means < 0).mean()))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for k, (seed, at, n) in enumerate(zip(*(batch.column(c).to_pylist() for c in (1, 2, 3)), strict=True)):
                values = batch.column(4)[k].values.to_numpy(zero_copy_only=False)
                sums = drawn_sums(values, draws_of_block(seed, n, at, resamples, size), seed, at)
                single = n <= size
                result = whole(n, float(values.sum()), sums) if single else (n, float(values.sum()), None, None, None)
                arrays = [pa.array([x], t) for x, t in zip(result, (pa.int64(), *[pa.float64()] * 4), strict=True)]
                yield pa.RecordBatch.from_arrays([batch.column(0).slice(k, 1), *arrays, pa.array([None if single else sums], pa.list_(pa.float64()))], [by, *(x.split()[0] for x in RESULT.split(", ")), "sums_"])

    made = dealt.mapInArrow(run, f"`{by}` {kind}, {RESULT}, sums_ array<double>").checkpoint()
    done = made.filter("sums_ is null").drop("sums_")
    added = made.filter("sums_ is not null").groupBy(by).agg(F.first("n").alias("n"), F.sum("mean").alias("total_"), vector_to_array(Summarizer.sum(array_to_vector("sums_"))).alias("sums_"))
    means = F.array_sort(F.transform("sums_", lambda x: x / F.col("n")))
    large = added.withColumn("means_", means).select(by, "n", (F.col("total_") / F.col("n")).alias("mean"), *(_at(F.col("means_"), q).alias(c) for q, c in zip(quantiles, ("low", "high"), strict=True)), (F.size(F.filter("means_", lambda x: x < 0)) / F.lit(resamples)).alias("share_below_zero"))
    return done.unionByName(large)


def _at(ordered: Column, share: float) -> Column:
    """A quantile of sorted values, with linear interpolation."""
    place = (F.size(ordered) - 1) * F.lit(share)
    low = F.floor(place).cast("int")
    a, b = F.get(ordered, low), F.get(ordered, F.least(low + 1, F.size(ordered) - 1))
    return a + (b - a) * (place - low)
