"""Near-duplicate texts by Golay-code fuzzy hashing.

The fingerprint of a text has SEGMENTS words of 23 bits. A bit is taken from the minimum of one of FUNCTIONS hash
functions over the text's word sequences, so two texts of similarity J differ in about (1 - J) / 2 of the bits. The
binary Golay code [23, 12, 7] is perfect: every word lies within distance 3 of one codeword. A word at distance 3 has
five more codewords at distance 4; the indices of all six are its keys, so that two words with up to two different bits
always share a key and words with a few more often do. By the pigeonhole principle a pair with fewer than
3 * SEGMENTS different bits has a segment with at most two.

An index has only 12 bits, so each segment is joined on the index and an anchor: the minimum of one more hash function
over the same word sequences. Rows that share both are compared by sizes and by a sketch of 256 bits, and the pairs that
remain verified exactly. Rows of an anchor that many texts have are spread over the tasks by anchor and index.

Such hashing can miss a pair; exact_links() is the way that can't.
"""

from __future__ import annotations

from collections.abc import Iterator
from functools import cache
from itertools import combinations

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from ..session import materialize, ship, splits
from . import vec

SEGMENTS, FUNCTIONS, NIBBLES = 20, 64, 4
#: An anchor of more than HOT texts, as estimated from about HOT_SAMPLE texts, is spread by index as well: what a task holds of one anchor is bounded.
HOT, HOT_SAMPLE = 200_000, 20_000
#: Fixed value: the generator polynomial x^11 + x^10 + x^6 + x^5 + x^4 + x^2 + 1 of the code.
GENERATOR = 0b110001110101


@cache
def _syndromes() -> tuple[np.ndarray, np.ndarray]:
    """Syndromes of the low 12 and the high 11 bits of a word."""

    def syndrome(x: int) -> int:
        for i in range(22, 10, -1):
            if x >> i & 1:
                x ^= GENERATOR << (i - 11)
        return x

    unit = [syndrome(1 << i) for i in range(23)]

    def table(bits: list[int]) -> np.ndarray:
        t = np.zeros(1 << len(bits), np.uint32)
        for i, u in enumerate(bits):
            t[1 << i : 2 << i] = t[: 1 << i] ^ np.uint32(u)
        return t

    return table(unit[:12]), table(unit[12:])


@cache
def _errors() -> np.ndarray:
    """For each syndrome six error patterns: the one of weight 3 or less, then those of weight 4, or the first again."""
    low, high = _syndromes()
    out = np.zeros((2048, 6), np.uint32)
    filled = np.zeros(2048, int)
    for weight in range(5):
        for at in combinations(range(23), weight):
            x = sum(1 << i for i in at)
            s = low[x & 4095] ^ high[x >> 12]
            if weight < 4:
                out[s], filled[s] = x, 1
            elif filled[s] < 6 and out[s, 0].bit_count() == 3:
                out[s, filled[s]] = x
                filled[s] += 1
    return out


def indices(words: np.ndarray) -> np.ndarray:
    """(n, 6) indices of the codewords near each 23-bit word; where there is one only, it is repeated."""
    low, high = _syndromes()
    s = low[words & np.uint32(4095)] ^ high[words >> np.uint32(12)]
    return (words[:, None] ^ _errors()[s]) >> np.uint32(11)


@cache
def _functions() -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    r = np.random.default_rng(2024)
    n = FUNCTIONS + SEGMENTS
    odd = r.integers(1, 1 << 32, n, dtype=np.uint64).astype(np.uint32) | np.uint32(1)
    add = r.integers(0, 1 << 32, n, dtype=np.uint64).astype(np.uint32)
    used = np.stack([r.permutation(FUNCTIONS)[:23] for _ in range(SEGMENTS)])
    return odd, add, used


def _minima(h: np.ndarray, first: np.ndarray) -> np.ndarray:
    """(functions, texts) minima over h[first[i]:first[i + 1]]; no text is empty."""
    a, b, _ = _functions()
    h32 = (h >> np.uint64(32)).astype(np.uint32)
    out = np.empty((len(a), len(first) - 1), np.uint32)
    for i in range(len(a)):
        x = h32 ^ b[i]
        x *= a[i]
        x ^= x >> np.uint32(15)
        out[i] = np.minimum.reduceat(x, first[:-1])
    return out


def fingerprints(texts: list[str], n: int, least: int) -> dict[str, np.ndarray]:
    """Of each text with at least `least` distinct sequences of n words: its number, slots, sketch, size, and a hash of the set.

    A slot is the anchor of a segment above its 23-bit word; the sketch has four bits of each minimum."""
    w = vec.words(texts)
    h, at = w.windows(n)
    doc = w.doc[at]
    # distinct sequences of a text
    order = np.lexsort((h, doc))
    h, doc = h[order], doc[order]
    new = np.ones(len(h), bool)
    new[1:] = (h[1:] != h[:-1]) | (doc[1:] != doc[:-1])
    h, doc = h[new], doc[new]
    size = np.bincount(doc, minlength=len(texts))
    keep = np.flatnonzero(size >= least)
    if not len(keep):
        return {}
    held = size[doc] >= least
    h, doc = h[held], doc[held]
    first = np.concatenate([[0], np.cumsum(size[keep])])
    m = _minima(h, first)
    _, _, used = _functions()
    seg = np.zeros((len(keep), SEGMENTS), np.uint64)
    for s in range(SEGMENTS):
        for i, f in enumerate(used[s]):
            x = m[f] * np.uint32(2 * s + 0x9E3779B1)
            seg[:, s] |= (x >> np.uint32(31)).astype(np.uint64) << np.uint64(i)
        seg[:, s] |= (m[FUNCTIONS + s].astype(np.uint64) << np.uint64(28)) | np.uint64(s << 23)
    sketch = np.zeros((NIBBLES, len(keep)), np.uint64)
    for f in range(FUNCTIONS):
        sketch[f % NIBBLES] |= (vec.mix(m[f].astype(np.uint64)) & np.uint64(15)) << np.uint64(f // NIBBLES * 4)
    total = np.add.reduceat(h, first[:-1])
    twist = np.bitwise_xor.reduceat(vec.mix(h ^ np.uint64(0x5555555555555555)), first[:-1])
    return {"at": keep, "slots": seg, "sketch": sketch.view(np.int64), "set_a": total.view(np.int64), "set_b": twist.view(np.int64), "size": size[keep].astype(np.int32)}


def near_duplicates(docs: DataFrame, n: int = 5, similarity: float = 0.8, least: int = 1, hot: int = HOT) -> tuple[DataFrame, DataFrame]:
    """(members, links). members: (document_id string, rep string); links: (rep_a, rep_b strings, similarity double), rep_a < rep_b.

    docs has document_id and content. Texts with the same set of word sequences are one class, named by its smallest
    document_id; links are pairs of classes whose similarity (shared / all distinct sequences of n words) reaches the
    threshold. Texts with fewer than `least` distinct sequences (also null, empty, very short ones) are in neither
    table; texts are read whole; a document delivered again counts once; other columns are ignored. hot decides how rows
    are spread over tasks and nothing else.
    """
    ship(docs.sparkSession)
    rows = docs.select(F.col("document_id").cast("string"), "content").where("document_id IS NOT NULL AND content IS NOT NULL")
    sketch = [f"sketch_{i}" for i in range(NIBBLES)]
    kind = "document_id string, set_a bigint, set_b bigint, size int, " + ", ".join(f"{c} bigint" for c in sketch) + ", slots binary"

    def run(it: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for pdf in it:
            texts = pdf["content"].tolist()
            for lo, hi in vec.batches(texts, 1_500_000):
                f = fingerprints(texts[lo:hi], n, least)
                if f:
                    yield pd.DataFrame({"document_id": pdf["document_id"].to_numpy()[lo:hi][f["at"]], "set_a": f["set_a"], "set_b": f["set_b"], "size": f["size"]} | dict(zip(sketch, f["sketch"])) | {"slots": [x.tobytes() for x in f["slots"]]})

    prints = materialize(rows.mapInPandas(run, kind), "fingerprints")
    # classes of equal texts; whatever else a fingerprint has is equal within a class
    reps = materialize(prints.groupBy("set_a", "set_b", "size").agg(F.min("document_id").alias("rep")), "classes")
    members = materialize(prints.select("document_id", "set_a", "set_b", "size").distinct().join(reps, ["set_a", "set_b", "size"]).select("document_id", "rep"), "members")
    # a class is known by the hash of its set until its texts are compared: less to shuffle than ids
    lead = prints.select(F.col("set_a").alias("id"), "size", *sketch, "slots").dropDuplicates(["id"])
    found = _candidates(lead, similarity, _hot(prints, hot))
    name = reps.select("set_a", "rep")
    named = found.join(name.select(F.col("set_a").alias("id_a"), F.col("rep").alias("rep_a")), "id_a").join(name.select(F.col("set_a").alias("id_b"), F.col("rep").alias("rep_b")), "id_b")
    named = materialize(named.select(F.least("rep_a", "rep_b").alias("id_a"), F.greatest("rep_a", "rep_b").alias("id_b")).distinct(), "named")
    return members, _verified(docs, named, n, similarity)


def _differing(x: np.ndarray, y: np.ndarray) -> np.ndarray:
    """How many of the minima behind two sketches differ in their four bits."""
    d = x ^ y
    d |= d >> np.uint64(2)
    d |= d >> np.uint64(1)
    return np.bitwise_count(d & np.uint64(0x1111111111111111)).sum(axis=0, dtype=np.int64)


def _pairs(key: np.ndarray, ids: np.ndarray, size: np.ndarray, sketch: np.ndarray, similarity: float) -> Iterator[pd.DataFrame]:
    """Pairs of rows with one key whose sizes and sketches allow the similarity. Rows are sorted by key."""
    mean = (1 - similarity) * 15 / 16  # different minima have the same four bits once in sixteen times
    most = FUNCTIONS * mean + 3.5 * (FUNCTIONS * mean * (1 - mean)) ** 0.5
    step, at = 1, np.arange(len(key))
    while len(at):  # rows `step` apart; ends with the longest run of one key
        at = at[at + step < len(key)]
        at = at[key[at] == key[at + step]]
        x, y = at, at + step
        ok = np.minimum(size[x], size[y]) >= similarity * np.maximum(size[x], size[y])
        x, y = x[ok], y[ok]
        ok = (_differing(sketch[:, x], sketch[:, y]) <= most) & (ids[x] != ids[y])
        if ok.any():
            a, b = ids[x[ok]], ids[y[ok]]
            yield pd.DataFrame({"id_a": np.minimum(a, b), "id_b": np.maximum(a, b)})
        step += 1


def _hot(prints: DataFrame, hot: int) -> np.ndarray:
    """Anchors that more than `hot` texts have by the count of a sample; fewer than a sample's anchors."""
    every = max(1, prints.count() // HOT_SAMPLE)
    some = prints.where(F.pmod(F.xxhash64("document_id"), F.lit(every)) == 0).select("slots")
    anchors = some.mapInPandas(lambda it: (pd.DataFrame({"anchor": np.frombuffer(b"".join(p["slots"]), np.int64) >> 23}) for p in it), "anchor bigint")
    return np.array(sorted(r[0] for r in anchors.groupBy("anchor").count().where(F.col("count") * every > hot).select("anchor").collect()), np.int64)


def _candidates(lead: DataFrame, similarity: float, hot: np.ndarray) -> DataFrame:
    """Pairs of classes that share an anchor and a codeword index in some segment and whose sizes and sketches allow the similarity."""
    spark = lead.sparkSession
    sketch = [f"sketch_{i}" for i in range(NIBBLES)]

    def explode(it: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for pdf in it:
            slot = np.frombuffer(b"".join(pdf["slots"]), np.int64)
            yield pd.DataFrame({"slot": slot} | {c: np.repeat(pdf[c].to_numpy(), SEGMENTS) for c in ("id", "size", *sketch)})

    shared = spark.sparkContext.broadcast(hot)

    def routed(it: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        """Rows of usual anchors go by anchor with all their indices to come, those of hot ones by anchor and index."""
        hot_ones = shared.value
        for pdf in explode(it):
            slot = pdf["slot"].to_numpy()
            many = np.isin(slot >> 23, hot_ones)
            index, row = np.full((~many).sum(), -1, np.int16), np.flatnonzero(~many)
            if many.any():
                near, r = _indices_of(slot[many])
                index, row = np.concatenate([index, near.astype(np.int16)]), np.concatenate([row, np.flatnonzero(many)[r]])
            yield pd.DataFrame({"idx": index} | {c: pdf[c].to_numpy()[row] for c in ("slot", "id", "size", *sketch)})

    kind = "idx smallint, slot bigint, id bigint, size int, " + ", ".join(f"{c} bigint" for c in sketch)
    # One shuffle; the keys are made, sorted and paired where their rows lie.
    anchor = F.shiftright("slot", 23)
    held = lead.mapInPandas(routed, kind).repartition(splits(spark), anchor, "idx").withColumn("anchor", anchor).sortWithinPartitions("anchor")

    def pair(it: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        tail = None  # the last anchor may go on in the next batch
        for pdf in it:
            if tail is not None:
                pdf = pd.concat([tail, pdf], ignore_index=True)
            anchor = pdf["anchor"].to_numpy()
            cut = int(np.searchsorted(anchor, anchor[-1]))
            yield from _group_pairs(pdf.iloc[:cut], similarity)
            tail = pdf.iloc[cut:]
        if tail is not None:
            yield from _group_pairs(tail, similarity)

    return materialize(held.mapInPandas(pair, "id_a bigint, id_b bigint").distinct(), "candidates")


def _indices_of(slot: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """The different indices near the words of slots, and the row of each."""
    near = indices((slot & 0x7FFFFF).astype(np.uint32)).astype(np.uint64)
    near.sort(axis=1)
    new = np.ones(near.shape, bool)
    new[:, 1:] = near[:, 1:] != near[:, :-1]
    return near[new], np.nonzero(new)[0]


def _group_pairs(rows: pd.DataFrame, similarity: float) -> Iterator[pd.DataFrame]:
    """Pairs of rows that share anchor and index; rows are sorted by anchor, their index is -1 where all indices count."""
    anchor = rows["anchor"].to_numpy()
    same = np.zeros(len(rows) + 1, bool)
    same[1:-1] = anchor[1:] == anchor[:-1]
    rows = rows[same[:-1] | same[1:]]
    if not len(rows):
        return
    slot, given = rows["slot"].to_numpy(), rows["idx"].to_numpy()
    free = np.flatnonzero(given < 0)
    near, r = _indices_of(slot[free])
    row, index = np.concatenate([free[r], np.flatnonzero(given >= 0)]), np.concatenate([near, given[given >= 0].astype(np.uint64)])
    key = ((slot[row] >> 23).view(np.uint64) << np.uint64(12)) | index
    order = np.argsort(key, kind="stable")
    key, row = key[order], row[order]
    ids, size = rows["id"].to_numpy(), rows["size"].to_numpy()
    sketch = np.stack([rows[f"sketch_{i}"].to_numpy() for i in range(NIBBLES)]).view(np.uint64)
    alone = np.zeros(len(key) + 1, bool)
    alone[1:-1] = key[1:] == key[:-1]
    keep = alone[:-1] | alone[1:]
    key, row = key[keep], row[keep]
    yield from _pairs(key, ids[row], size[row], sketch[:, row], similarity)


def _verified(docs: DataFrame, pairs: DataFrame, n: int, similarity: float) -> DataFrame:
    """Exact similarity of candidate pairs from their whole texts."""
    used = pairs.select(F.explode(F.array("id_a", "id_b")).alias("document_id")).distinct()
    texts = docs.select(F.col("document_id").cast("string"), "content").where("content IS NOT NULL").join(used, "document_id", "left_semi").dropDuplicates(["document_id"])
    a, b = (texts.select(F.col("document_id").alias(f"id_{x}"), F.col("content").alias(f"text_{x}")) for x in "ab")

    def run(it: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for pdf in it:
            for lo, hi in vec.batches([x + y for x, y in zip(pdf["text_a"], pdf["text_b"])], 1_500_000):
                part = pdf.iloc[lo:hi]
                sets = []
                for c in ("text_a", "text_b"):
                    w = vec.words(part[c].tolist())
                    h, at = w.windows(n)
                    first = np.searchsorted(w.doc[at], np.arange(hi - lo + 1))
                    sets.append([np.unique(h[first[i] : first[i + 1]]) for i in range(hi - lo)])
                value = []
                for x, y in zip(*sets):
                    both = len(np.intersect1d(x, y, assume_unique=True))
                    value.append((both, len(x) + len(y) - both))
                v = np.array(value, float).reshape(-1, 2)
                ok = (v[:, 0] >= similarity * v[:, 1] - 1e-9) & (v[:, 1] > 0)
                yield pd.DataFrame({"rep_a": part["id_a"].to_numpy()[ok], "rep_b": part["id_b"].to_numpy()[ok], "similarity": v[ok, 0] / v[ok, 1]})

    return pairs.join(a, "id_a").join(b, "id_b").mapInPandas(run, "rep_a string, rep_b string, similarity double")


def exact_links(docs: DataFrame, n: int = 5, similarity: float = 0.8, least: int = 1) -> DataFrame:
    """(document_id_a, document_id_b strings, similarity double): all pairs of different texts that reach the similarity, smaller id first.

    Prefix filter: the word sequences of a text are ordered from rare to frequent; two texts of the similarity share one
    of their first size - ceil(similarity * size) + 1. It loses nothing, but shuffles every sequence of every text.
    Documents, nulls and short texts as in near_duplicates(); of equal texts only the smallest id is in a pair.
    """
    ship(docs.sparkSession)
    rows = docs.select(F.col("document_id").cast("string"), "content").where("document_id IS NOT NULL AND content IS NOT NULL").dropDuplicates(["document_id"])

    def sequences(it: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for pdf in it:
            texts = pdf["content"].tolist()
            for lo, hi in vec.batches(texts, 1_500_000):
                w = vec.words(texts[lo:hi])
                h, at = w.windows(n)
                f = pd.DataFrame({"doc": w.doc[at], "gram": h.view(np.int64)}).drop_duplicates()
                yield pd.DataFrame({"document_id": pdf["document_id"].to_numpy()[lo:hi][f["doc"]], "gram": f["gram"].to_numpy()})

    grams = materialize(rows.mapInPandas(sequences, "document_id string, gram bigint"), "sequences")
    sets = grams.groupBy("document_id").agg(F.count("*").alias("size"), F.sum(F.col("gram").cast("decimal(38,0)")).alias("total"))
    reps = materialize(sets.where(F.col("size") >= least).groupBy("size", "total").agg(F.min("document_id").alias("document_id")), "distinct-texts")
    df = grams.groupBy("gram").agg(F.count("*").alias("df")).where("df > 1")
    held = grams.join(reps.select("document_id", "size"), "document_id").join(df, "gram", "left")
    order = W.partitionBy("document_id").orderBy(F.coalesce("df", F.lit(1)), "gram")
    first = held.withColumn("r", F.row_number().over(order)).where(F.expr(f"df IS NOT NULL AND r <= size - cast(ceil(size * {similarity} - 1e-9) as int) + 1")).select("gram", "document_id", "size")
    a, b = (first.select("gram", F.col("document_id").alias(f"id_{x}"), F.col("size").alias(f"n_{x}")) for x in "ab")
    met = a.join(b, "gram").where(f"id_a < id_b AND least(n_a, n_b) >= {similarity} * greatest(n_a, n_b) - 1e-9").select("id_a", "id_b").distinct()
    return _verified(docs, materialize(met, "prefix-candidates"), n, similarity).select(F.col("rep_a").alias("document_id_a"), F.col("rep_b").alias("document_id_b"), "similarity")


def document_pairs(members: DataFrame, links: DataFrame, block: int = 1000) -> DataFrame:
    """(document_id_a, document_id_b), smaller id first: links between documents, copies included. A class of more than `block` copies is joined in parts."""
    parts = members.groupBy("rep").agg(F.expr(f"cast(ceil(count(*) / {block}) as int)").alias("parts"), F.count("*").alias("n"))
    own = parts.where("n > 1").select(F.col("rep").alias("rep_a"), F.col("rep").alias("rep_b"))
    a, b = (members.join(parts, "rep").select(F.col("rep").alias(f"rep_{x}"), F.expr("cast(pmod(xxhash64(document_id), parts) as int)").alias(f"part_{x}"), F.col("document_id").alias(x)) for x in "ab")
    ends = own.unionByName(links.select("rep_a", "rep_b"))
    for x in "ab":
        ends = ends.join(parts.select(F.col("rep").alias(f"rep_{x}"), F.col("parts").alias(f"parts_{x}")), f"rep_{x}").withColumn(f"part_{x}", F.explode(F.expr(f"sequence(0, parts_{x} - 1)")))
    met = ends.join(a, ["rep_a", "part_a"]).join(b, ["rep_b", "part_b"]).where("rep_a <> rep_b OR a < b")
    return met.select(F.least("a", "b").alias("document_id_a"), F.greatest("a", "b").alias("document_id_b"))
