"""Items that appear together more often than chance: heavy-light decomposition.

Within a group (tenant) an item is heavy if it is in at least max(HEAVY, baskets / SHARE) baskets, so that a group has
at most SHARE times as many heavy items as an average basket has items. Heavy pairs are counted by popcounts of dense bit
matrices, one for each block of baskets and pair of tiles of items, so that no task holds more than two tiles; light
pairs by hashing the pairs of each basket; a mixed pair by probing the baskets on the light item's list for heavy items.
Baskets of more than BIG items never emit pairs: an item in `support` of them or more goes to the matrices too, however
many such items there are, and a pair with a light item then has fewer big baskets than `support`, so it meets in a small
basket at least once and its big baskets are added by probing the lists.
"""

from __future__ import annotations

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from ..session import materialize, ship

HEAVY, SHARE, BIG, BLOCK, TILE = 64, 128, 256, 8192, 1024


def pair_counts(items: DataFrame, support: int = 5, lift: int = 4, heavy: int = HEAVY, share: int = SHARE, big: int = BIG, tile: int = TILE) -> DataFrame:
    """(grp, item_a, item_b strings, n_ab, n_a, n_b, n bigint, lift double): pairs with n_ab >= support and n_ab * n >= lift * n_a * n_b.

    items has grp, basket and item; n is the number of baskets of a group. Rows with a null or an empty item are
    ignored, repeated rows count once, a basket of one item has no pair, an empty table no rows; other columns are
    ignored. item_a < item_b by code point.
    """
    ship(items.sparkSession)
    pick = items.select(F.col("grp").cast("string"), F.col("basket").cast("string"), "item").where("grp IS NOT NULL AND basket IS NOT NULL AND item IS NOT NULL AND item <> ''")
    held = materialize(pick.distinct(), "incidences")
    sizes = held.groupBy("grp", "basket").agg(F.count("*").alias("size"))
    groups = sizes.groupBy("grp").agg(F.count("*").alias("n"), F.max("size").alias("most"))
    # Items below the support can be in no pair; they leave before anything is joined.
    freq = held.groupBy("grp", "item").agg(F.count("*").alias("n_i")).where(F.col("n_i") >= support)
    bigs = sizes.where(F.col("size") > big).select("grp", "basket", F.lit(True).alias("big"))
    wide = held.join(bigs, ["grp", "basket"]).groupBy("grp", "item").agg(F.count("*").alias("n_big")).where(F.col("n_big") >= support)
    freq = freq.join(groups.select("grp", "n"), "grp").join(wide, ["grp", "item"], "left")
    freq = materialize(freq.select("grp", "item", "n_i", "n", ((F.col("n_i") >= F.greatest(F.lit(heavy), F.col("n") / share)) | F.col("n_big").isNotNull()).alias("heavy")), "frequencies")
    kept = held.join(freq.select("grp", "item", "heavy"), ["grp", "item"]).join(bigs, ["grp", "basket"], "left")
    kept = materialize(kept.withColumn("big", F.coalesce("big", F.lit(False))), "kept")

    dense = _dense(kept.where("heavy"), support, tile)
    small = kept.where("NOT big").select("grp", "basket", "item", "heavy")
    light = small.where("NOT heavy").select("grp", "basket", F.col("item").alias("x"))
    other = small.select("grp", "basket", F.col("item").alias("y"), "heavy")
    # One join gives both kinds: light with light once (x < y), light with each heavy item of the basket.
    met = light.join(other, ["grp", "basket"]).where("(heavy AND x <> y) OR (NOT heavy AND x < y)")
    sparse = met.groupBy("grp", F.least("x", "y").alias("item_a"), F.greatest("x", "y").alias("item_b")).agg(F.count("*").alias("n_ab"))
    sparse = _with_big(sparse, kept.where("big").select("grp", "basket", "item"), bigs)
    counted = dense.unionByName(sparse.where(F.col("n_ab") >= support))
    of = freq.select("grp", "item", "n_i", "n")
    out = counted.join(of.select("grp", F.col("item").alias("item_a"), F.col("n_i").alias("n_a"), "n"), ["grp", "item_a"]).join(of.select("grp", F.col("item").alias("item_b"), F.col("n_i").alias("n_b")), ["grp", "item_b"])
    wanted = F.col("n_ab").cast("decimal(19,0)") * F.col("n") >= F.lit(lift).cast("decimal(5,0)") * F.col("n_a").cast("decimal(19,0)") * F.col("n_b").cast("decimal(13,0)")
    return out.where(wanted).select("grp", "item_a", "item_b", "n_ab", "n_a", "n_b", "n", (F.col("n_ab") * F.col("n") / F.col("n_a") / F.col("n_b")).alias("lift"))


def _with_big(sparse: DataFrame, lists: DataFrame, bigs: DataFrame) -> DataFrame:
    """Adds the big baskets of pairs that met in a small one, by probing the lists of both items."""
    if bigs.isEmpty():
        return sparse
    a = sparse.join(lists.select("grp", F.col("item").alias("item_a"), "basket"), ["grp", "item_a"])
    more = a.join(lists.select("grp", F.col("item").alias("item_b"), "basket"), ["grp", "item_b", "basket"]).groupBy("grp", "item_a", "item_b").agg(F.count("*").alias("more"))
    return sparse.join(more, ["grp", "item_a", "item_b"], "left").select("grp", "item_a", "item_b", (F.col("n_ab") + F.coalesce("more", F.lit(0))).alias("n_ab"))


def _dense(heavy: DataFrame, support: int, tile: int) -> DataFrame:
    """Counts of pairs of heavy items: bit rows of items for each block of baskets, AND and popcount of two tiles of items at a time."""
    hashed = lambda c, n: F.expr(f"cast(pmod(xxhash64({c}), {n}) as int)")
    baskets = heavy.select("grp", "basket").distinct()
    blocks = baskets.groupBy("grp").agg(F.expr(f"cast(ceil(count(*) / {BLOCK}) as int)").alias("blocks"))
    # the place of a basket in its block; a block has about BLOCK baskets
    placed = baskets.join(blocks, "grp").withColumn("block", hashed("basket", "blocks")).withColumn("col", F.row_number().over(W.partitionBy("grp", "block").orderBy("basket")) - 1).select("grp", "basket", "block", "col")
    tiles = heavy.select("grp", "item").distinct().groupBy("grp").agg(F.expr(f"cast(ceil(count(*) / {tile}) as int)").alias("tiles"))
    rows = heavy.select("grp", "basket", "item").join(placed, ["grp", "basket"]).join(tiles, "grp").withColumn("tile", hashed("item", "tiles"))

    def packed(pdf: pd.DataFrame) -> pd.DataFrame:
        items, row = np.unique(pdf["item"].to_numpy(dtype=object), return_inverse=True)
        bits = np.zeros((len(items), -(-(int(pdf["col"].max()) + 1) // 64) * 64), bool)
        bits[row, pdf["col"].to_numpy()] = True
        return pd.DataFrame({"grp": pdf["grp"].iloc[0], "block": pdf["block"].iloc[0], "tile": pdf["tile"].iloc[0], "tiles": pdf["tiles"].iloc[0], "item": items, "bits": [b.tobytes() for b in np.packbits(bits, axis=1)]})

    held = rows.groupBy("grp", "block", "tile").applyInPandas(packed, "grp string, block int, tile int, tiles int, item string, bits binary")
    met = held.withColumn("other", F.explode(F.expr("sequence(0, tiles - 1)"))).withColumn("i", F.least("tile", "other")).withColumn("j", F.greatest("tile", "other"))
    kind = "grp string, item_a string, item_b string, c bigint"

    def matrix(rows: pd.DataFrame) -> np.ndarray:
        out = np.zeros((len(rows), max((len(b) for b in rows["bits"]), default=8)), np.uint8)
        for k, b in enumerate(rows["bits"]):
            out[k, : len(b)] = np.frombuffer(b, np.uint8)
        return out.view(np.uint64)

    def popcounts(pdf: pd.DataFrame) -> pd.DataFrame:
        same = pdf["i"].iloc[0] == pdf["j"].iloc[0]
        left = pdf[pdf["tile"] == pdf["i"]]
        right = left if same else pdf[pdf["tile"] == pdf["j"]]
        x, y = matrix(left), matrix(right)
        width = min(x.shape[1], y.shape[1])
        a, b, c = [], [], []
        for k in range(len(x)):
            first = k + 1 if same else 0
            n = np.bitwise_count(y[first:, :width] & x[k, :width]).sum(axis=1, dtype=np.int64)
            at = np.flatnonzero(n)
            a.append(np.full(len(at), k))
            b.append(at + first)
            c.append(n[at])
        a, b, c = (np.concatenate(v).astype(np.int64) if v else np.empty(0, np.int64) for v in (a, b, c))
        p, q = left["item"].to_numpy(dtype=object)[a], right["item"].to_numpy(dtype=object)[b]
        swap = np.array([s > t for s, t in zip(p, q)], bool)
        return pd.DataFrame({"grp": pdf["grp"].iloc[0], "item_a": np.where(swap, q, p), "item_b": np.where(swap, p, q), "c": c})

    return met.groupBy("grp", "block", "i", "j").applyInPandas(popcounts, kind).groupBy("grp", "item_a", "item_b").agg(F.sum("c").alias("n_ab")).where(F.col("n_ab") >= support)
