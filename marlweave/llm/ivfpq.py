"""The most similar vectors of every vector: an inverted file of coarse centroids with product-quantised residuals.

Coarse centroids and the codebooks of the residuals are fitted on a bounded sample; every vector is coded and put into
the list of its nearest centroid. A query visits the lists of its nearest centroids, gets asymmetric distances there
from tables of its products with the codebooks, and keeps the best of all its lists; these are ranked anew by exact
cosines. Lists are cut into blocks of bounded size, the queries of a list into rounds of bounded size, so no task holds
a whole list however large. Exact vectors are sent once to each round of queries that wants them, not to each pair.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from ..session import materialize, ship

SUBSPACES, CODES, SAMPLE, MOST_LISTS = 16, 256, 40_000, 16_384
#: Members of a list that are searched at once, and queries of a list that are answered at once.
BLOCK, ROUND = 8192, 4096


def usable(vectors: pd.Series, dim: int) -> tuple[np.ndarray, np.ndarray]:
    """Which vectors have dim finite numbers, not all 0, and those as unit vectors (float32)."""
    ok = np.fromiter((v is not None and len(v) == dim for v in vectors), bool, len(vectors))
    x = np.array([np.asarray(v, np.float64) for v, k in zip(vectors, ok) if k], np.float64).reshape(-1, dim)
    with np.errstate(all="ignore"):
        top = np.abs(x).max(axis=1, initial=0)
        good = np.isfinite(top) & (top > 0)
        x = x[good] / top[good, None]  # neither overflow nor underflow in the norm
        x /= np.sqrt((x * x).sum(axis=1))[:, None]
    ok[np.flatnonzero(ok)] = good
    return ok, x.astype(np.float32)


def kmeans(x: np.ndarray, k: int, rounds: int = 6, seed: int = 7, spherical: bool = False) -> np.ndarray:
    """k centroids; an empty one takes the vector that lies farthest from its own."""
    r = np.random.default_rng(seed)
    c = x[r.choice(len(x), min(k, len(x)), replace=False)].copy()
    for _ in range(rounds):
        score = x @ c.T - (0 if spherical else 0.5 * (c * c).sum(axis=1))
        near = score.argmax(axis=1)
        far = np.argsort(score[np.arange(len(x)), near])
        n = np.bincount(near, minlength=len(c))
        order = np.argsort(near, kind="stable")
        some = np.flatnonzero(n)
        sums = np.add.reduceat(x[order], np.concatenate([[0], np.cumsum(n[some])[:-1]]), axis=0)
        c[some] = sums / n[some, None]
        for i, at in zip(np.flatnonzero(n == 0), far):
            c[i] = x[at]
        if spherical:
            c /= np.maximum(np.linalg.norm(c, axis=1, keepdims=True), 1e-12)
    return c


class Index:
    """Coarse centroids and codebooks."""

    def __init__(self, coarse: np.ndarray, books: np.ndarray) -> None:
        self.coarse, self.books = coarse, books
        self.margin = 0.0

    def measure(self, x: np.ndarray) -> None:
        """Sets margin: four times the root mean square of the errors that products of the vectors x with their codes have."""
        home = self.lists(x, 1)[:, 0]
        codes = self.encode(x - self.coarse[home])
        m, _, d = self.books.shape
        held = self.coarse[home] + np.concatenate([self.books[j][codes[:, j]] for j in range(m)], axis=1)
        rest = x - held
        self.margin = float(4 * np.sqrt(np.mean([((x[lo : lo + 500] @ rest.T) ** 2).mean() for lo in range(0, len(x), 500)])))

    def lists(self, x: np.ndarray, n: int) -> np.ndarray:
        """(vectors, n) nearest lists, nearest first."""
        n = min(n, len(self.coarse))
        score = x @ self.coarse.T
        if n == 1:
            return score.argmax(axis=1)[:, None]
        some = np.argpartition(-score, n - 1, axis=1)[:, :n]
        return np.take_along_axis(some, np.argsort(-np.take_along_axis(score, some, 1), axis=1, kind="stable"), 1)

    def encode(self, residual: np.ndarray) -> np.ndarray:
        m, _, d = self.books.shape
        out = np.empty((len(residual), m), np.uint8)
        for j in range(m):
            part, book = residual[:, j * d : (j + 1) * d], self.books[j]
            out[:, j] = (part @ book.T - 0.5 * (book * book).sum(axis=1)).argmax(axis=1)
        return out

    def scores(self, q: np.ndarray, at: int, codes: np.ndarray) -> np.ndarray:
        """(members, queries): products of the queries with the coded members of a list, by tables."""
        m, _, d = self.books.shape
        out = np.repeat((q @ self.coarse[at])[None, :], len(codes), axis=0)
        for j in range(m):
            tables = self.books[j] @ q[:, j * d : (j + 1) * d].T  # (codes, queries)
            out += tables[codes[:, j]]
        return out


def fit(x: np.ndarray, n: int) -> Index:
    """An index for n vectors from a sample of unit vectors."""
    lists = int(min(MOST_LISTS, max(1, 2 ** round(np.log2(max(n, 1) ** 0.5))), max(1, len(x) // 8)))
    coarse = kmeans(x, lists, spherical=True)
    rest = x - coarse[(x @ coarse.T).argmax(axis=1)]
    m = SUBSPACES if x.shape[1] % SUBSPACES == 0 else 1
    d = x.shape[1] // m
    books = np.stack([_padded(kmeans(np.ascontiguousarray(rest[:, j * d : (j + 1) * d]), CODES, 4, seed=j)) for j in range(m)])
    out = Index(coarse, books)
    out.measure(x[:3000])  # 9 million products
    return out


def _padded(book: np.ndarray) -> np.ndarray:
    return book if len(book) == CODES else np.concatenate([book, np.repeat(book[:1], CODES - len(book), axis=0)])


def neighbours(vectors: DataFrame, k: int = 5, dim: int = 64, probes: int = 4, depth: int = 32, floor: float = -1.0, queries: str = "true", sample: int = SAMPLE) -> DataFrame:
    """(id bigint, other bigint, cosine double, rank int): of every query its k most similar other vectors.

    vectors has id and embedding; other columns are ignored. Null ids and unusable vectors (null, another length, a
    number that isn't finite, all 0) are neither queries nor answers; an id that comes again counts once; equal vectors
    are neighbours of cosine 1, of equal cosines the smaller id comes first; an empty table gives no rows. queries is a
    condition on id, floor the least cosine of an answer. probes lists are visited by each query, and the depth best of
    all of them ranked exactly. A pair found from either side counts for both sides that are queries.
    """
    spark = vectors.sparkSession
    ship(spark)
    rows = vectors.select(F.col("id").cast("bigint"), "embedding").where(f"id IS NOT NULL AND size(embedding) = {dim}")
    n = rows.count()
    if n == 0:
        return spark.createDataFrame([], "id bigint, other bigint, cosine double, rank int")
    every, rows, copies = rows, *_distinct(rows, queries)
    slots = max(1, n // sample)
    picked = rows.where(F.pmod(F.xxhash64("id"), F.lit(slots)) == 0).select("embedding").limit(2 * sample).toPandas()  # only of the vectors to fit on
    _, x = usable(picked["embedding"], dim)
    if not len(x):
        return spark.createDataFrame([], "id bigint, other bigint, cosine double, rank int")
    shared = spark.sparkContext.broadcast(fit(x, n))

    def route(it: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        index = shared.value
        for pdf in it:
            ok, x = usable(pdf["embedding"], dim)
            ids, asks = pdf["id"].to_numpy()[ok], pdf["asks"].to_numpy()[ok]
            if not len(ids):
                continue
            near = index.lists(x, probes)
            home = near[:, 0].astype(np.int32)
            codes = index.encode(x - index.coarse[home])
            yield pd.DataFrame({"list": home, "home": -1, "id": ids, "data": [c.tobytes() for c in codes]})
            if asks.any():
                half = np.array([v.tobytes() for v in x[asks].astype(np.float16)], object)
                many = near.shape[1]
                yield pd.DataFrame({"list": near[asks].ravel().astype(np.int32), "home": np.repeat(home[asks], many), "id": np.repeat(ids[asks], many), "data": np.repeat(half, many)})

    routed = materialize(rows.mapInPandas(route, "list int, home int, id bigint, data binary"), "routed")
    sizes = routed.groupBy("list").agg(F.count(F.when(F.col("home") < 0, 1)).alias("n"), F.count(F.when(F.col("home") >= 0, 1)).alias("q"))
    cuts = sizes.where("n > 0 AND q > 0").select("list", F.expr(f"cast(ceil(n / {BLOCK}) as int)").alias("blocks"), F.expr(f"cast(ceil(q / {ROUND}) as int)").alias("rounds"))
    held = routed.join(cuts, "list")
    every_block, every_round = F.expr("sequence(0, blocks - 1)"), F.expr("sequence(0, rounds - 1)")
    of = lambda parts: F.expr(f"cast(pmod(xxhash64(id), {parts}) as int)")
    members = held.where("home < 0").withColumn("block", of("blocks")).withColumn("round", F.explode(every_round))
    asked = held.where("home >= 0").withColumn("round", of("rounds")).withColumn("block", F.explode(every_block))
    both = members.unionByName(asked).select("list", "block", "round", "home", "id", "data")

    def search(pdf: pd.DataFrame) -> pd.DataFrame:
        index = shared.value
        mine = pdf["home"].to_numpy() >= 0
        ids, first = np.unique(pdf["id"].to_numpy()[~mine], return_index=True)
        if not len(ids) or not mine.any():
            return pd.DataFrame({"home": np.empty(0, np.int32), "id": np.empty(0, np.int64), "other": np.empty(0, np.int64), "score": np.empty(0, np.float32)})
        codes = np.frombuffer(b"".join(pdf["data"].to_numpy()[~mine][first]), np.uint8).reshape(len(ids), -1)
        asking, start = np.unique(pdf["id"].to_numpy()[mine], return_index=True)
        homes = pdf["home"].to_numpy()[mine][start]
        q = np.frombuffer(b"".join(pdf["data"].to_numpy()[mine][start]), np.float16).reshape(len(asking), -1).astype(np.float32)
        at, out = int(pdf["list"].iloc[0]), []
        for lo in range(0, len(q), 256):
            s = index.scores(q[lo : lo + 256], at, codes).T
            s[ids[None, :] == asking[lo : lo + 256, None]] = -9
            if len(ids) > depth:
                top = np.argpartition(-s, depth, axis=1)[:, :depth]
                r, top = np.repeat(np.arange(len(s)), depth), top.ravel()
            else:
                r, top = np.divmod(np.arange(s.size), len(ids))
            keep = s[r, top] >= max(-8.0, floor - index.margin)  # the errors of near pairs exceed it in 0.3 % of cases at sf0.1
            out.append((homes[lo + r[keep]], asking[lo + r[keep]], ids[top[keep]], s[r[keep], top[keep]]))
        return pd.DataFrame(dict(zip(("home", "id", "other", "score"), map(np.concatenate, zip(*out)))))

    found = both.groupBy("list", "block", "round").applyInPandas(search, "home int, id bigint, other bigint, score float")
    best = found.withColumn("r", F.row_number().over(W.partitionBy("id").orderBy(F.col("score").desc(), "other"))).where(F.col("r") <= depth)
    found = materialize(best.select("home", "id", "other"), "candidates")
    exact = _cosines(rows, found, dim, floor)
    sides = exact.unionByName(exact.select(F.col("other").alias("id"), F.col("id").alias("other"), "cosine")).dropDuplicates(["id", "other"])
    if copies is not None:
        sides = _with_copies(sides, every, copies, k, floor, dim)
    return _ranked(sides.where(F.expr(queries)), k)


def _ranked(sides: DataFrame, k: int) -> DataFrame:
    ranked = sides.withColumn("rank", F.row_number().over(W.partitionBy("id").orderBy(F.col("cosine").desc(), "other")).cast("int"))
    return ranked.where(F.col("rank") <= k)


def _distinct(rows: DataFrame, queries: str) -> tuple[DataFrame, DataFrame | None]:
    """(id, embedding, asks), one row for each different vector, and of the vectors that several ids share (id, rep) of all of those.

    Only the smallest id of a vector is indexed, so that a vector shared by a third of all ids is searched once; it asks
    if any of its ids is a query."""
    keys = rows.select("id", F.xxhash64("embedding").alias("key")).distinct()
    shared = keys.groupBy("key").agg(F.count("*").alias("n"), F.min("id").alias("rep"), F.max(F.expr(queries)).alias("any_asks")).where("n > 1").select("key", "rep", "any_asks")
    shared = materialize(shared, "shared-vectors")
    if shared.isEmpty():
        return rows.withColumn("asks", F.expr(queries)), None
    copies = materialize(keys.join(shared, "key").select("id", "rep", "any_asks"), "copies")
    first = rows.join(copies, "id", "left").where("rep IS NULL OR rep = id").withColumn("asks", F.coalesce("any_asks", F.expr(queries)))
    return first.select("id", "embedding", "asks"), copies.select("id", "rep")


def _with_copies(sides: DataFrame, rows: DataFrame, copies: DataFrame, k: int, floor: float, dim: int) -> DataFrame:
    """Neighbours of all ids from those of the indexed ones: copies share their neighbours, and are neighbours of cosine 1."""
    first = copies.withColumn("r", F.row_number().over(W.partitionBy("rep").orderBy("id"))).where(F.col("r") <= k + 1).select("rep", F.col("id").alias("copy"))
    near = _ranked(sides, k).drop("rank")
    # the answers: an indexed vector stands for its first copies
    named = near.join(first.withColumnRenamed("rep", "other"), "other", "left").select("id", F.coalesce("copy", "other").alias("other"), "cosine")
    named = _ranked(named.distinct(), k + 1).drop("rank")
    # the askers: every copy asks what its vector asks
    asked = named.join(copies.select(F.col("id").alias("copy"), F.col("rep").alias("id")), "id", "left").select(F.coalesce("copy", "id").alias("id"), "other", "cosine")
    good = copies.select("rep").distinct().join(rows.select(F.col("id").alias("rep"), "embedding"), "rep").mapInPandas(lambda it: (pdf.loc[usable(pdf["embedding"], dim)[0], ["rep"]] for pdf in it), "rep bigint").distinct()
    own = copies.join(good, "rep").join(first, "rep").where("id <> copy").select("id", F.col("copy").alias("other"), F.lit(1.0).alias("cosine"))
    return asked.unionByName(own).where((F.col("id") != F.col("other")) & (F.col("cosine") >= floor))


def _cosines(rows: DataFrame, pairs: DataFrame, dim: int, floor: float) -> DataFrame:
    """(id, other, cosine): exact cosines of pairs (home, id, other), those of at least floor.

    The queries of a home are answered in rounds; each vector that a round needs is sent to it once."""
    load = pairs.groupBy("home").agg(F.count("*").alias("n")).select("home", F.expr(f"cast(ceil(n / {ROUND * 16}) as int)").alias("rounds"))
    cut = pairs.join(F.broadcast(load), "home").withColumn("round", F.expr("cast(pmod(xxhash64(id), rounds) as int)")).select("home", "round", "id", "other")  # as many rows as lists
    needed = cut.select("home", "round", F.explode(F.array("id", "other")).alias("id")).distinct()
    # the same id delivered again is dropped where it is used
    held = needed.join(rows.select("id", "embedding"), "id").select("home", "round", "id", F.lit(0).cast("bigint").alias("other"), F.lit(False).alias("ask"), F.col("embedding").alias("v"))
    both = cut.withColumns({"ask": F.lit(True), "v": F.lit(None).cast(rows.schema["embedding"].dataType)}).unionByName(held)

    def run(pdf: pd.DataFrame) -> pd.DataFrame:
        ask = pdf["ask"].to_numpy()
        ids, first = np.unique(pdf["id"].to_numpy()[~ask], return_index=True)
        x = np.stack(pdf["v"].to_numpy()[~ask][first]).astype(np.float64) if len(ids) else np.empty((0, dim))
        x /= np.abs(x).max(axis=1, keepdims=True)
        norm = (x * x).sum(axis=1)
        a, b = pdf["id"].to_numpy()[ask], pdf["other"].to_numpy()[ask]
        out = []
        for lo in range(0, len(a), 20_000):
            i, j = np.searchsorted(ids, a[lo : lo + 20_000]), np.searchsorted(ids, b[lo : lo + 20_000])
            cos = (x[i] * x[j]).sum(axis=1) / np.sqrt(norm[i] * norm[j])
            keep = cos >= floor
            out.append((a[lo : lo + 20_000][keep], b[lo : lo + 20_000][keep], cos[keep]))
        return pd.DataFrame(dict(zip(("id", "other", "cosine"), map(np.concatenate, zip(*out)))) if out else {"id": np.empty(0, np.int64), "other": np.empty(0, np.int64), "cosine": np.empty(0)})

    return both.groupBy("home", "round").applyInPandas(run, "id bigint, other bigint, cosine double")
