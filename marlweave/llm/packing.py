"""Texts into containers of fixed capacity: planning by the histogram of lengths.

Lengths are counted in tokens of a public tokenizer. A text above the capacity is cut into full pieces and a rest, all
others stay whole. The histogram has at most `capacity` entries, so the plan is made on the driver whatever the number
of texts: best-fit decreasing over counts of equal pieces and counts of equal gaps. Every piece then gets its rank
within its length, and with it a slot of the plan.
"""

from __future__ import annotations

import base64
from bisect import bisect_left, insort
from collections.abc import Iterator
from functools import cache
from pathlib import Path

import numpy as np
import pandas as pd
from pyspark import SparkFiles
from pyspark.sql import DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from ..session import materialize, ship, splits

TOKENIZER = "/opt/tokenizers/byte_bpe_50k.tiktoken"
#: Fixed value: how byte_bpe_50k cuts a text before merging.
PATTERN = r"""'s|'t|'re|'ve|'m|'ll|'d| ?\p{L}+| ?\p{N}+| ?[^\s\p{L}\p{N}]+|\s+(?!\S)|\s+"""


_sent: set[tuple[str, str]] = set()


@cache
def _encoding(path: str):
    import tiktoken

    with open(path, "rb") as f:
        ranks = {base64.b64decode(a): int(b) for a, b in map(bytes.split, f)}
    return tiktoken.Encoding("own", pat_str=PATTERN, mergeable_ranks=ranks, special_tokens={})


def token_counts(docs: DataFrame, path: str = TOKENIZER) -> DataFrame:
    """(doc_id bigint, n_tokens int) of every text; null ids and null texts give no row, an empty text has 0 tokens, a repeated doc_id counts once.

    The vocabulary is sent to the executors; path has to exist on the driver only."""
    sc = docs.sparkSession.sparkContext
    ship(docs.sparkSession)
    if (sc.applicationId, path) not in _sent:
        sc.addFile(path)
        _sent.add((sc.applicationId, path))
    name = Path(path).name
    rows = docs.select(F.col("doc_id").cast("bigint"), "text").where("doc_id IS NOT NULL AND text IS NOT NULL")

    def count(it: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        encode = _encoding(SparkFiles.get(name)).encode_ordinary
        for pdf in it:
            yield pd.DataFrame({"doc_id": pdf["doc_id"], "n_tokens": np.fromiter((len(encode(t)) for t in pdf["text"]), np.int32, len(pdf))})

    return rows.mapInPandas(count, "doc_id bigint, n_tokens int").dropDuplicates(["doc_id"])


def plan(histogram: dict[int, int], capacity: int) -> tuple[list[tuple[int, int, int, int, int]], int]:
    """Slots (length, first rank, slots, first container, offset in the container), and the number of containers.

    Best-fit decreasing: pieces of equal length are placed together, first into the gaps that they fill best. A group of
    containers with the same gap is a run of numbers; a run is cut where only a part of it is used.
    """
    gaps: dict[int, list[tuple[int, int]]] = {}  # gap: runs (first container, containers)
    order: list[int] = []  # the gaps that have runs, ascending
    slots, made = [], 0

    def give(gap: int, run: tuple[int, int]) -> None:
        if gap <= 0:
            return
        if gap not in gaps:
            insort(order, gap)
        gaps.setdefault(gap, []).append(run)

    for length in sorted((x for x in histogram if 0 < x <= capacity), reverse=True):
        left, rank = histogram[length], 0
        while left:
            at = bisect_left(order, length)
            fit = order[at] if at < len(order) else None
            if fit is None:
                each = capacity // length  # a new container takes as many of them as it holds
                n = -(-left // each)
                run, fit = (made, n), capacity
                made += n
            else:
                run = gaps[fit].pop()
                if not gaps[fit]:
                    del gaps[fit], order[at]
            first, n = run
            used = min(n, left)
            slots.append((length, rank, used, first, capacity - fit))
            rank += used
            left -= used
            give(fit - length, (first, used))
            if used < n:
                give(fit, (first + used, n - used))
    return slots, made


def pack(docs: DataFrame, capacity: int, path: str = TOKENIZER) -> DataFrame:
    """(doc_id bigint, piece int, first_token int, n_tokens int, container bigint, at int): where every piece of every text lies.

    Only texts of more than `capacity` tokens are cut. Texts without a token get no container and no row; null ids,
    null texts and repeated rows as in token_counts(). Of equal lengths the order is that of a hash of doc_id, so the
    same table always gives the same containers.
    """
    spark = docs.sparkSession
    counts = materialize(token_counts(docs, path), "token-counts")
    full = F.expr(f"n_tokens div {capacity}").cast("int")
    rest = F.expr(f"n_tokens % {capacity}").cast("int")
    cut = F.concat(F.expr(f"transform(sequence(0, greatest(0, cast(n_tokens div {capacity} as int) - 1)), i -> named_struct('piece', i, 'n', {capacity}))"), F.array(F.struct(full.alias("piece"), rest.alias("n"))))
    whole = F.array(F.struct(F.lit(0).alias("piece"), F.col("n_tokens").alias("n")))
    pieces = counts.select("doc_id", F.explode(F.when(F.col("n_tokens") > capacity, cut).otherwise(whole)).alias("p")).select("doc_id", "p.piece", "p.n").where("n > 0")
    # Partitions of a fixed number, in a fixed order: a lost one is made again with the same ranks.
    parts = max(spark.sparkContext.defaultParallelism * 4, counts.count() // 200_000 + 1)
    held = materialize(pieces.withColumn("part", F.expr(f"cast(pmod(xxhash64(doc_id), {parts}) as int)")), "pieces")
    seen = held.groupBy("part", "n").agg(F.count("*").alias("c"))
    # how many pieces of a length lie in earlier partitions; a window has as many rows as there are partitions
    before = seen.withColumn("before", F.coalesce(F.sum("c").over(W.partitionBy("n").orderBy("part").rowsBetween(W.unboundedPreceding, -1)), F.lit(0))).select(F.col("part").alias("of"), F.col("n").alias("length"), "before")
    totals = dict(seen.groupBy("n").agg(F.sum("c").alias("c")).collect())  # the histogram: at most `capacity` rows
    slots, _ = plan(totals, capacity)
    table = np.array(slots, np.int64).reshape(-1, 5)
    table = table[np.lexsort((table[:, 1], table[:, 0]))]
    lengths = np.unique(table[:, 0])
    bounds = np.searchsorted(table[:, 0], np.concatenate([lengths, [capacity + 1]]))
    shared = spark.sparkContext.broadcast((table, {int(x): (int(a), int(b)) for x, a, b in zip(lengths, bounds, bounds[1:])}))

    def place(pdf: pd.DataFrame, offsets: pd.DataFrame) -> pd.DataFrame:
        table, where = shared.value
        before = dict(zip(offsets["length"].tolist(), offsets["before"].tolist()))
        pdf = pdf.sort_values(["n", "doc_id", "piece"], kind="stable")
        out = []
        for n, group in pdf.groupby("n", sort=True):
            rank = before[int(n)] + np.arange(len(group))
            lo, hi = where[int(n)]
            slot = table[lo + np.searchsorted(table[lo:hi, 1], rank, "right") - 1]
            out.append(pd.DataFrame({"doc_id": group["doc_id"].to_numpy(), "piece": group["piece"].to_numpy(), "first_token": group["piece"].to_numpy() * capacity, "n_tokens": int(n), "container": slot[:, 3] + rank - slot[:, 1], "at": slot[:, 4]}))
        return pd.concat(out)

    # by number, so that the parts aren't put together again for being small: placing costs more than their bytes tell
    n = max(splits(spark), 1)
    return held.repartition(n, "part").groupBy("part").cogroup(before.repartition(n, "of").groupBy("of")).applyInPandas(place, "doc_id bigint, piece int, first_token int, n_tokens int, container bigint, at int")


def fill(packed: DataFrame, capacity: int) -> DataFrame:
    """(containers bigint, tokens bigint, share double): how full the containers of pack() are."""
    return packed.agg(F.countDistinct("container").alias("containers"), F.coalesce(F.sum("n_tokens"), F.lit(0)).alias("tokens")).withColumn("share", F.when(F.col("containers") > 0, F.col("tokens") / (F.col("containers") * capacity)))


def invariants(packed: DataFrame, capacity: int) -> DataFrame:
    """(texts, overfull, overlapping, cut_without_need bigint): texts with a place, and how often a rule of pack() is broken."""
    by = W.partitionBy("container").orderBy("at", "doc_id", "piece")
    placed = packed.withColumn("next", F.lead("at").over(by)).withColumn("pieces", F.count("*").over(W.partitionBy("doc_id"))).withColumn("tokens", F.sum("n_tokens").over(W.partitionBy("doc_id")))
    return placed.agg(F.countDistinct("doc_id").alias("texts"), F.count_if(F.col("at") + F.col("n_tokens") > capacity).alias("overfull"), F.count_if(F.col("at") + F.col("n_tokens") > F.col("next")).alias("overlapping"), F.count_if((F.col("pieces") > 1) & (F.col("tokens") <= capacity)).alias("cut_without_need"))
