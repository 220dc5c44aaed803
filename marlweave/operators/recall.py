"""Recall: by entity names, by traversal, by vectors, and the merged and reranked list."""

from __future__ import annotations

from collections.abc import Iterator

from pyspark.sql import DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from ..functions.vectors import is_valid, score
from ..session import materialize, ship, splits

#: Vectors in a block of an exact comparison.
BLOCK = 10_000


def visible(rows: DataFrame, active: str | None) -> DataFrame:
    """Nodes or edges of the base graph and of the active concept generation; edges without a generation column are of the base graph."""
    if "concept_gen" not in rows.columns:
        return rows
    shown = F.col("concept_gen").isNull()
    return rows.where(shown | (F.col("concept_gen") == active) if active else shown)


def top(rows: DataFrame, k: int) -> DataFrame:
    """The k best by score, of equals the smaller ids."""
    return rows.orderBy(F.col("score").desc(), "id").limit(k)


def direct(docs: DataFrame, entities: DataFrame, mentions: DataFrame, names: list[str], k: int) -> DataFrame:
    """(id, score): documents that mention the named entities; the score is the share of all names in the query, matched or not."""
    hit = entities.where(F.col("norm").isin(names)).select(F.col("id").alias("entity_id"))
    rows = mentions.join(hit, "entity_id").join(docs.select(F.col("id").alias("doc_id")), "doc_id")
    return top(rows.groupBy(F.col("doc_id").alias("id")).agg((F.countDistinct("entity_id") / len(names)).alias("score")), k)


#: Names of a step that are held on the driver; a larger step is written out.
FRONTIER = 20_000


def hops(edges: DataFrame, names: list[str], depth: int) -> DataFrame:
    """(name, hop): names reached within depth steps, edges read in both directions; the named ones have hop 0.

    One join for each step; the frontier holds only names that are new, so a name is expanded once. Steps of at most
    FRONTIER names are broadcast, larger ones written out and joined."""
    spark = edges.sparkSession
    kind = "name string, hop int"
    ends = edges.select("src", "dst").distinct()
    both = materialize(ends, "edges") if depth > 1 else ends  # read again in every step
    both = both.select(F.col("src").alias("a"), F.col("dst").alias("b")).unionByName(both.select(F.col("dst").alias("a"), F.col("src").alias("b")))
    seen = frontier = spark.createDataFrame([(n, 0) for n in dict.fromkeys(names)], kind)
    for step in range(1, depth + 1):
        reached = both.join(frontier.select(F.col("name").alias("a")), "a", "left_semi").select(F.col("b").alias("name")).distinct()
        new = reached.join(seen.select("name"), "name", "left_anti").select("name", F.lit(step).alias("hop"))
        if step == depth:
            return seen.unionByName(new)
        few = new.limit(FRONTIER + 1).collect()  # at most FRONTIER + 1 names
        if not few:
            return seen
        frontier = spark.createDataFrame(few, kind) if len(few) <= FRONTIER else materialize(new, "frontier")
        seen = seen.unionByName(frontier)
    return seen


def related(docs: DataFrame, entities: DataFrame, mentions: DataFrame, edges: DataFrame, names: list[str], k: int, depth: int = 2, decay: float = 0.8, active: str | None = None) -> DataFrame:
    """(id, score): documents that mention entities related to the named ones; the score is decay to the power of the fewest steps. Every node and edge of a path has to be visible."""
    shown = visible(entities, active).where("norm <> ''")
    known = shown.select("norm").distinct()
    inside = visible(edges, active).select("src", "dst").distinct().join(known.withColumnRenamed("norm", "src"), "src", "left_semi").join(known.withColumnRenamed("norm", "dst"), "dst", "left_semi")
    far = hops(inside, names, depth).where("hop > 0").withColumnRenamed("name", "norm")
    rows = shown.select(F.col("id").alias("entity_id"), "norm").join(far, "norm").join(mentions, "entity_id").join(docs.select(F.col("id").alias("doc_id")), "doc_id")
    best = rows.groupBy(F.col("doc_id").alias("id")).agg(F.min("hop").alias("hop"))
    return top(best.select("id", F.pow(F.lit(decay), F.col("hop")).alias("score")), k)


def nearest(vectors: DataFrame, query: list[float], k: int, raw: bool = False) -> DataFrame:
    """(id, score): the k nearest of all valid vectors; one pass, k rows from each task."""
    q = F.array(*[F.lit(float(x)) for x in query])
    rows = vectors.where(is_valid(F.col("vector"))).select("id", score(F.col("vector"), q, raw).alias("score")).where("score IS NOT NULL")
    return top(rows, k)


def by_vector(docs: DataFrame, vectors: DataFrame, query: list[float], fetch: int, threshold: float) -> DataFrame:
    """(id, score): of the nearest `fetch` of the whole index those above the threshold and in docs; the limit comes first."""
    return nearest(vectors, query, fetch).where(F.col("score") >= threshold).join(docs.select("id"), "id", "left_semi")


def by_entity_vector(docs: DataFrame, entities: DataFrame, mentions: DataFrame, vectors: DataFrame, query: list[float], fetch: int, k: int, threshold: float = 0.0) -> DataFrame:
    """(id, score): documents that mention the entities nearest to the query, with their best score."""
    near = nearest(vectors, query, fetch).where(F.col("score") >= threshold).join(entities.select("id"), "id", "left_semi")
    rows = mentions.join(near.withColumnRenamed("id", "entity_id"), "entity_id").join(docs.select(F.col("id").alias("doc_id")), "doc_id")
    return top(rows.groupBy(F.col("doc_id").alias("id")).agg(F.max("score").alias("score")), k)


def indirect(related: DataFrame, by_entity: DataFrame) -> DataFrame:
    """(id, score): the better of two signals for each document."""
    return related.unionByName(by_entity).groupBy("id").agg(F.max("score").alias("score"))


def rerank(direct: DataFrame, indirect: DataFrame, vector: DataFrame, k: int, decay: float = 0.8, boost: float = 1.3) -> DataFrame:
    """(id, score, entity_score, vector_score, is_direct): the merged list.

    A document with both an entity and a vector signal gets the better score boosted, at most 1; indirect ones decay
    besides; single signals stay as they are. Direct beats indirect. Of equal scores direct ones come first, then
    indirect, then vector ones, each in the order of their own lists."""
    pools = direct.withColumn("pool", F.lit(0)).unionByName(indirect.withColumn("pool", F.lit(1))).unionByName(vector.withColumn("pool", F.lit(2)))
    of = lambda p: F.max(F.when(F.col("pool") == p, F.col("score")))
    m = pools.groupBy("id").agg(of(0).alias("d"), of(1).alias("i"), of(2).alias("v"))
    entity = F.coalesce("d", "i")
    both = F.greatest(entity, F.col("v")) * boost
    value = F.when(F.col("v").isNull(), entity).when(entity.isNull(), F.col("v")).when(F.col("d").isNotNull(), F.least(F.lit(1.0), both)).otherwise(F.least(F.lit(1.0), both * decay))
    out = m.select("id", value.alias("score"), entity.alias("entity_score"), F.col("v").alias("vector_score"), F.col("d").isNotNull().alias("is_direct"), F.when(F.col("d").isNotNull(), 0).when(F.col("i").isNotNull(), 1).otherwise(2).alias("pool"), F.coalesce("d", "i", "v").alias("own"))
    return out.orderBy(F.col("score").desc(), "pool", F.col("own").desc(), "id").limit(k).drop("pool", "own")


def recall(docs: DataFrame, entities: DataFrame, mentions: DataFrame, edges: DataFrame, doc_vectors: DataFrame, entity_vectors: DataFrame | None, names: list[str], query: list[float], k: int | None = 5, threshold: float | None = None, depth: int = 2, decay: float = 0.8, active: str | None = None) -> DataFrame:
    """The hybrid recall over four signals. A threshold of 0 or none means 0.7, k of 0 or none 5; twice k is fetched from the indexes."""
    spark = docs.sparkSession
    empty = spark.createDataFrame([], "id string, score double")
    if not query or not any(query):
        return rerank(empty, empty, empty, 0)
    k, threshold = k or 5, threshold or 0.7
    # read by every signal: the few columns of the nodes and the ids of the documents that count
    entities = materialize(entities.select("id", "norm", "concept_gen"), "nodes")
    docs = materialize(docs.select("id"), "document-ids")
    d = direct(docs, entities, mentions, names, k) if names else empty
    r = related(docs, entities, mentions, edges, names, k, depth, decay, active) if names else empty
    e = by_entity_vector(docs, entities, mentions, entity_vectors, query, 2 * k, k) if entity_vectors is not None else empty
    return rerank(d, indirect(r, e), by_vector(docs, doc_vectors, query, 2 * k, threshold), k, decay)


def similar(vectors: DataFrame, queries: DataFrame, collection: DataFrame, k: int = 20, threshold: float = 0.7, generation: str | None = None, whole: int = 4 * BLOCK) -> DataFrame:
    """(src, dst, score): similarity edges of the stated queries, in both directions; with a generation, a column gen that names it.

    Of each query the k nearest of the whole index, itself counted, in the order of the score to nine places and the id;
    then itself, other collections and scores below the threshold go. An index of more than `whole` vectors is cut into cells, and a
    query visits those that can hold one of its k nearest; where cells rule out too little, and below, all blocks meet. Both are exact.
    vectors and queries have id and vector, collection has one row (id, tenant_id, collection) for each id."""
    n = vectors.count()
    # pairs of unlike places go where they are found, by a hash; the others are compared by tenant and collection
    places = collection.select("id", F.xxhash64("tenant_id", "collection").alias("place"))
    held = vectors.where(is_valid(F.col("vector"))).select("id", "vector").join(places, "id", "left").fillna(0, "place")  # a null would make floats of the hashes
    ask = held if queries is vectors else queries.where(is_valid(F.col("vector"))).select("id", "vector").join(places, "id")
    near = _near_in_cells(held, ask, k, threshold, max(4, -(-n // BLOCK))) if n > whole else None
    near = _near_in_blocks(held, ask, k, threshold, max(4, -(-n // BLOCK))) if near is None else near
    a, b = (collection.select(F.col("id").alias(c), F.struct("tenant_id", "collection").alias(f"{c}_of")) for c in ("src", "dst"))
    pairs = near.select("src", "place", F.explode("near").alias("x")).where("x.place = place").select("src", "x.dst", F.col("x.s").alias("score"))
    kept = pairs.where((F.col("src") != F.col("dst")) & (F.col("score") >= threshold)).join(a, "src").join(b, "dst").where("src_of = dst_of").select("src", "dst", "score")
    out = kept.unionByName(kept.select(F.col("dst").alias("src"), F.col("src").alias("dst"), "score")).groupBy("src", "dst").agg(F.max("score").alias("score"))
    return out if generation is None else out.withColumn("gen", F.lit(generation))


def _nearest_of(x, y, ids: list, k: int, floor):
    """(query, index, score) of the k nearest of each row of x: rows of y, each with its ids, by the rank of the score and the id; none of a rank below its query's floor.

    The index counts through the ids of all rows."""
    import numpy as np

    if not len(x) or not len(y):
        return np.empty(0, int), np.empty(0, int), np.empty(0)
    many = np.array([len(i) for i in ids])
    flat = np.array([v for i in ids for v in i], object)
    starts, place = np.cumsum(many) - many, np.empty(len(flat), int)
    place[np.argsort(flat, kind="stable")] = np.arange(len(flat))
    out = []
    for lo in range(0, len(x), step := max(1, 2_000_000 // len(y))):
        s = (1 + x[lo : lo + step] @ y.T) / 2
        r = np.rint(s * PLACES)
        least = floor[lo : lo + step]
        if len(y) > k:
            least = np.maximum(least, -np.partition(-r, k - 1, axis=1)[:, k - 1])
        q, c = np.nonzero(r >= least[:, None])
        m = many[c]
        at = np.repeat(starts[c] - (np.cumsum(m) - m), m) + np.arange(m.sum())
        q, r, s = (np.repeat(z, m) for z in (q, r[q, c], s[q, c]))
        order = np.lexsort((place[at], -r, q))
        order = order[np.arange(len(q)) - np.searchsorted(q, q[order]) < k]
        out.append((q[order] + lo, at[order], s[order]))
    return tuple(np.concatenate(z) for z in zip(*out))


#: Scores rank by their nine places; SLACK is what can still change the last of them.
PLACES, SLACK = 1e9, 2e-9


def _first(rows: DataFrame, key: str, k: int) -> DataFrame:
    """(key, near): of rows (key, dst, place, s) the k first by the rank of s and dst, as an array of dst, place and s."""
    ranked = rows.withColumn("n", F.row_number().over(W.partitionBy(key).orderBy(F.rint(F.col("s") * PLACES).desc(), "dst"))).where(F.col("n") <= k)
    return ranked.groupBy(key).agg(F.collect_list(F.struct("dst", "place", "s")).alias("near"))


def _near_in_blocks(held: DataFrame, ask: DataFrame, k: int, threshold: float, blocks: int) -> DataFrame:
    """(src, place, near): the k nearest by comparing all queries with all vectors in blocks, each giving its own k best, so that no block holds more than its part."""
    import numpy as np
    import pandas as pd

    ship(held.sparkSession)
    part = F.pmod(F.xxhash64("id"), F.lit(blocks)).cast("int")
    index = held.withColumn("m", part).withColumn("q", F.explode(F.sequence(F.lit(0), F.lit(blocks - 1)))).withColumn("asks", F.lit(False))
    asked = ask.withColumn("q", part).withColumn("m", F.explode(F.sequence(F.lit(0), F.lit(blocks - 1)))).withColumn("asks", F.lit(True))

    def best(pdf: pd.DataFrame) -> pd.DataFrame:
        a, b = pdf[pdf["asks"]], pdf[~pdf["asks"]]
        if a.empty or b.empty:
            return pd.DataFrame({"src": [], "dst": [], "place": [], "s": []}, dtype=object)
        x, y = (np.array(z["vector"].tolist(), np.float64) for z in (a, b))
        x, y = (z / np.linalg.norm(z, axis=1, keepdims=True) for z in (x, y))
        q, at, s = _nearest_of(x, y, [[i] for i in b["id"]], k, np.full(len(x), (threshold - SLACK) * PLACES))
        return pd.DataFrame({"src": a["id"].to_numpy()[q], "dst": b["id"].to_numpy()[at], "place": b["place"].to_numpy()[at], "s": s})

    local = index.unionByName(asked).groupBy("q", "m").applyInPandas(best, "src string, dst string, place bigint, s double")
    return ask.select(F.col("id").alias("src"), "place").join(_first(local, "src", k), "src")


#: Directions in a cell, cells, numbers in the sample that cells are cut by, and queries that visit a cell at once.
CELL, CELLS, CELL_SAMPLE, CELL_VISITS = 2_000, 4_096, 4_000_000, 20_000
#: Directions are compared in units of this size.
GRID = 1e-12


def _near_in_cells(held: DataFrame, ask: DataFrame, k: int, threshold: float, blocks: int) -> DataFrame | None:
    """(src, place, near): the k nearest by cells, exactly; None if queries would visit more than `blocks` cells on the average.

    Vectors of one direction are one, with their k smallest ids. Cells are boxes cut at medians of a sample, which decides their
    size and nothing else. A query finds its k best in its own cell; another cell counts if its box is as near as the last of them."""
    import numpy as np
    import pandas as pd

    spark = held.sparkSession
    ship(spark)
    n = splits(spark)

    def directions(it: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for pdf in it:
            if len(pdf):
                v = np.array(pdf["vector"].tolist(), np.float64)
                yield pd.DataFrame({"id": pdf["id"], "place": pdf["place"], "unit": list(np.rint(v / np.linalg.norm(v, axis=1, keepdims=True) / GRID).astype(np.int64))})

    kind = "id string, place bigint, unit array<bigint>"
    index = materialize(held.mapInPandas(directions, kind), "directions")
    asked = index if ask is held else materialize(ask.mapInPandas(directions, kind), "asked-directions")
    few = index.withColumn("n", F.row_number().over(W.partitionBy("unit").orderBy("id"))).where(F.col("n") <= k).groupBy("unit").agg(F.sort_array(F.collect_list(F.struct("id", "place"))).alias("x")).select("unit", F.col("x.id").alias("ids"), F.col("x.place").alias("places"))
    few = few.withColumn("asks", F.lit(True)) if ask is held else few.join(asked.select("unit").distinct().withColumn("asks", F.lit(True)), "unit", "full_outer")
    few = materialize(few, "distinct-directions")
    size = few.agg(F.count("*").alias("n"), F.max(F.size("unit")).alias("d")).first()
    if not size["n"]:
        return None
    count = min(CELLS, -(-size["n"] // CELL))
    sample = few.select("unit").orderBy(F.xxhash64("unit")).limit(max(1, min(16 * count, CELL_SAMPLE // size["d"]))).toPandas()
    nodes, low, high = _cut(np.array(sample["unit"].tolist(), np.int64) * GRID, count)

    def place(it: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for pdf in it:
            if len(pdf):
                yield pdf.assign(cell=_cell_of(np.array(pdf["unit"].tolist(), np.int64) * GRID, nodes))

    cells = materialize(few.mapInPandas(place, "unit array<bigint>, ids array<string>, places array<bigint>, asks boolean, cell int"), "cells")

    def parts_of(pdf: pd.DataFrame):
        """The directions, which of them have ids, those ids, and all ids and places in a row."""
        has = pdf["ids"].map(lambda i: i is not None and len(i) > 0).to_numpy(bool)
        ids, places = list(pdf["ids"][has]), list(pdf["places"][has])
        flat = [np.array([v for i in z for v in i], object) for z in (ids, places)]
        return np.array(pdf["unit"].tolist(), np.int64) * GRID, has, ids, flat

    def own(pdf: pd.DataFrame) -> pd.DataFrame:
        v, has, ids, flat = parts_of(pdf)
        asks = (pdf["asks"] == True).to_numpy(bool)  # noqa: E712 - null counts as no
        x = v[asks]
        if not len(x):
            return pd.DataFrame({"unit": [], "bound": [], "dst": [], "place": [], "s": [], "visits": []}, dtype=object)
        bound = np.full(len(x), (threshold - SLACK) * PLACES)
        q, at, s = _nearest_of(x, v[has], ids, k, bound)
        ends = np.searchsorted(q, np.arange(len(x) + 1))
        full = np.diff(ends) == k
        bound[full] = np.rint(s[ends[1:][full] - 1] * PLACES)
        cut = lambda z: [z[i:j] for i, j in zip(ends, ends[1:])]
        return pd.DataFrame({"unit": list(pdf["unit"][asks]), "bound": bound, "dst": cut(flat[0][at]), "place": cut(flat[1][at]), "s": cut(s), "visits": _visited(x, bound / PLACES, pdf["cell"].iloc[0], low, high)})

    first = materialize(cells.repartition(n, "cell").groupBy("cell").applyInPandas(own, "unit array<bigint>, bound double, dst array<string>, place array<bigint>, s array<double>, visits array<int>"), "own-cells")
    visits = first.agg(F.coalesce(F.sum(F.size("visits")), F.lit(0)).alias("n")).first()["n"]
    if visits > blocks * size["n"]:
        return None
    asks = first.select("unit", "bound", F.explode("visits").alias("cell"))
    loads = materialize(asks.groupBy("cell").agg(F.ceil(F.count("*") / CELL_VISITS).cast("int").alias("parts")), "visits")
    left = asks.join(loads, "cell").select("cell", F.pmod(F.xxhash64("unit"), "parts").cast("int").alias("part"), "unit", "bound")
    right = cells.where("ids IS NOT NULL").join(loads, "cell").select("cell", F.explode(F.expr("sequence(0, parts - 1)")).alias("part"), "unit", "ids", "places")

    def others(a: pd.DataFrame, b: pd.DataFrame) -> pd.DataFrame:
        if a.empty or b.empty:
            return pd.DataFrame({"unit": [], "dst": [], "place": [], "s": []}, dtype=object)
        y, _, ids, flat = parts_of(b)
        q, at, s = _nearest_of(np.array(a["unit"].tolist(), np.int64) * GRID, y, ids, k, a["bound"].to_numpy())
        return pd.DataFrame({"unit": pd.Series(list(a["unit"].to_numpy()[q]), dtype=object), "dst": flat[0][at], "place": flat[1][at], "s": s})

    by = ["cell", "part"]
    second = left.repartition(n, *by).groupBy(*by).cogroup(right.repartition(n, *by).groupBy(*by)).applyInPandas(others, "unit array<bigint>, dst string, place bigint, s double")
    both = first.select("unit", F.explode(F.arrays_zip("dst", "place", "s")).alias("x")).select("unit", "x.*").unionByName(second)
    return asked.select(F.col("id").alias("src"), "place", "unit").join(_first(both, "unit", k), "unit").select("src", "place", "near")


def _cut(points, count: int):
    """At most count boxes that cut space at medians of the points: the cuts (dimension, value, lower, upper), where -c - 1 is box c, and the boxes' bounds."""
    import numpy as np

    nodes, low, high = [], [], []

    def grow(at, count: int, lo, hi) -> int:
        dim = int(np.argmax(points[at].var(axis=0)))
        v = points[at, dim]
        if count < 2 or len(at) < 2 or v.min() == v.max():
            low.append(lo)
            high.append(hi)
            return -len(low)
        value = float(m if (m := np.median(v)) > v.min() else v[v > m].min())
        me, up = len(nodes), v >= value
        nodes.append(())
        mid_lo, mid_hi = lo.copy(), hi.copy()
        mid_lo[dim] = mid_hi[dim] = value
        nodes[me] = (dim, value, grow(at[~up], count // 2, lo, mid_hi), grow(at[up], count - count // 2, mid_lo, hi))
        return me

    end = np.full(points.shape[1], np.inf)
    grow(np.arange(len(points)), count, -end, end)
    return nodes, np.array(low), np.array(high)


def _cell_of(points, nodes: list):
    """The box of each point."""
    import numpy as np

    out, todo = np.zeros(len(points), np.int32), [(0, np.arange(len(points)))] if nodes else []
    while todo:
        node, at = todo.pop()
        dim, value, *ends = nodes[node]
        up = points[at, dim] >= value
        for end, idx in zip(ends, (at[~up], at[up])):
            if end < 0:
                out[idx] = -end - 1
            elif len(idx):
                todo.append((end, idx))
    return out


def _visited(x, bound, own: int, low, high) -> list:
    """Of each point the boxes, but for its own, that can hold a point of a score not below its bound: half the square of a distance is 1 - cosine."""
    import numpy as np

    reach = 4 * (1 - (bound - SLACK))
    wide = np.maximum(np.maximum(low - x.max(axis=0), x.min(axis=0) - high), 0)
    near = np.flatnonzero((wide**2).sum(axis=1) <= reach.max())
    near = near[near != own].astype(np.int32)
    out = []
    for lo in range(0, len(x), step := max(1, 2_000_000 // max(1, near.size * x.shape[1]))):
        v = x[lo : lo + step, None]
        gap = np.maximum(np.maximum(low[near] - v, v - high[near]), 0)
        out += [near[z] for z in (gap**2).sum(axis=2) <= reach[lo : lo + step, None]]
    return out
