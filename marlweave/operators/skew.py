"""Counts per key that don't depend on how the rows spread over the keys.

Method: dense accumulator arrays. Every input split counts its own keys with numpy (a local dictionary and
bincount), so a hot key leaves a split as one row. The distinct keys get dense codes; the local counts are
scattered into blocks of a dense array, a set of splits at a time, and the sets of a block summed in two steps.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..session import materialize, ship, splits

BLOCK, PART, FAN = 1 << 14, 200_000, 64


def _local_counts(keys: list[str]):
    def count(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        held: dict[tuple, int] = {}
        for pdf in batches:
            codes, names = pd.factorize(pd.MultiIndex.from_frame(pdf[keys])) if len(keys) > 1 else pd.factorize(pdf[keys[0]], use_na_sentinel=False)
            for key, n in zip(names, np.bincount(codes, minlength=len(names)).tolist()):
                held[key] = held.get(key, 0) + n
            if len(held) > 200_000:  # bounds the worker's memory; a later row of the same key is only one more partial count
                yield _frame(held)
                held = {}
        yield _frame(held)

    def _frame(held: dict) -> pd.DataFrame:
        rows = [k if len(keys) > 1 else (k,) for k in held]
        out = pd.DataFrame(rows, columns=keys, dtype=object)
        out["n"] = np.fromiter(held.values(), np.int64, len(held))
        return out

    return count


def dense_counts(df: DataFrame, keys: list[str]) -> DataFrame:
    """Rows per key, as (keys..., n bigint). The keys must be strings.

    Rows with a null in a key are not counted; an empty table gives no rows; other columns are ignored, whatever
    their names. No task gets more rows of one key than there are input splits.
    """
    spark = df.sparkSession
    ship(spark)
    rows = df.select(*keys).where(F.expr(" AND ".join(f"`{k}` IS NOT NULL" for k in keys)))
    kinds = ", ".join(f"`{k}` string" for k in keys)
    local = materialize(rows.mapInPandas(_local_counts(keys), f"{kinds}, n bigint").withColumn("_task", F.spark_partition_id()), "local-counts")

    # Dictionary: the partition by hash gives the first part of a code, the place within the partition the rest.
    parts = max(splits(spark), local.count() // PART + 1)  # a part has about PART keys at most
    part = F.pmod(F.xxhash64(*keys), F.lit(parts)).cast("int")
    words = local.select(*keys).distinct().withColumn("_part", part)

    def number(pdf: pd.DataFrame) -> pd.DataFrame:
        pdf = pdf.sort_values(keys, kind="stable").reset_index(drop=True)
        pdf["_at"] = np.arange(len(pdf), dtype=np.int64)
        return pdf

    numbered = materialize(words.groupBy("_part").applyInPandas(number, f"{kinds}, _part int, _at bigint"), "dictionary")
    sizes = dict(numbered.groupBy("_part").agg((F.max("_at") + 1).alias("n")).collect())  # as many rows as partitions
    base, start = [], 0
    for p in range(parts):
        base.append(start)
        start += -(-sizes.get(p, 0) // BLOCK) * BLOCK  # every part begins a new block
    offsets = spark.createDataFrame(list(enumerate(base)), "_part int, _base bigint")  # as many rows as parts
    dictionary = numbered.join(F.broadcast(offsets), "_part").select(*keys, (F.col("_base") + F.col("_at")).alias("_code"))

    # Scatter-reduce: the counts of FAN splits to a dense block, then FAN of those, then the rest: no group grows with the table.
    coded = local.join(dictionary, keys).select(
        F.expr(f"_code div {BLOCK}").alias("_block"), F.expr(f"cast(_code % {BLOCK} as int)").alias("_in"), "n", F.expr(f"_task div {FAN}").cast("int").alias("_set")
    )

    def scatter(pdf: pd.DataFrame) -> pd.DataFrame:
        dense = np.zeros(int(pdf["_in"].max()) + 1, np.int64)
        np.add.at(dense, pdf["_in"].to_numpy(), pdf["n"].to_numpy())
        return pd.DataFrame({"_block": [int(pdf["_block"].iloc[0])], "_set": [int(pdf["_set"].iloc[0]) // FAN], "counts": [dense]})

    def total(pdf: pd.DataFrame) -> pd.DataFrame:
        dense = np.zeros(max(map(len, pdf["counts"])), np.int64)
        for c in pdf["counts"]:
            dense[: len(c)] += c
        return pd.DataFrame({"_block": [int(pdf["_block"].iloc[0])], "_set": [0], "counts": [dense]})

    kind = "_block bigint, _set int, counts array<bigint>"
    blocks = coded.groupBy("_block", "_set").applyInPandas(scatter, kind).groupBy("_block", "_set").applyInPandas(total, kind).groupBy("_block").applyInPandas(total, kind)
    counts = blocks.select("_block", F.posexplode("counts").alias("_in", "n")).select((F.col("_block") * BLOCK + F.col("_in")).alias("_code"), "n")
    return dictionary.join(counts, "_code").select(*keys, "n")


def leading(counts: DataFrame, group: str, item: str) -> DataFrame:
    """The item with the largest n of every group, of equals the smallest item; the partial minimum of each split keeps a hot group small."""
    best = F.min(F.struct((-F.col("n")).alias("m"), F.col(item).alias("item"))).alias("best")
    return counts.groupBy(group).agg(best).select(group, F.col("best.item").alias(item), (-F.col("best.m")).alias("n"))
