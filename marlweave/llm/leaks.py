"""Evaluation texts within training text: a broadcast set of n-grams of the test items, scanned over every word window.

The hashes of all sequences of n consecutive words of the items are the set; only hashes are broadcast, at most
max_grams of them. A larger set is broadcast as a table of bits of fixed size instead, which lets a few more windows
through. The windows that meet the set are joined with the n-grams on hash and words, so a hit counts only if its words
are the same, and neighbouring hits become one run.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from ..session import materialize, ship
from . import vec

N_WORDS = 12
MAX_GRAMS = 2_000_000  # 16 MB of hashes
SEEN_BITS, TABLE_BITS = 22, 27  # of the first look-up, and of the table in place of a larger set (16 MB)


def _grams(ids: list[int], texts: list[str], n: int) -> pd.DataFrame:
    w = vec.words(texts)
    h, at = w.windows(n)
    lowered = "\n".join((t or "").lower() for t in texts) + "\n"
    spans = [" ".join(_split(lowered[w.starts[a] : w.ends[a + n - 1]])) for a in at]
    return pd.DataFrame({"gram": h.view(np.int64), "item_id": np.asarray(ids, np.int64)[w.doc[at]], "words": spans}).drop_duplicates()


def _split(text: str) -> list[str]:
    """The words of a lower-cased text."""
    return "".join(c if c.isalnum() else " " for c in text).split()


def item_grams(items: DataFrame, n: int = N_WORDS) -> DataFrame:
    """(gram bigint, item_id bigint, words string): every sequence of n words of every item."""
    ship(items.sparkSession)

    def run(it: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for pdf in it:
            if len(f := _grams(pdf["item_id"].tolist(), pdf["text"].tolist(), n)):
                yield f

    return items.select(F.col("item_id").cast("bigint"), "text").where("item_id IS NOT NULL AND text IS NOT NULL").mapInPandas(run, "gram bigint, item_id bigint, words string")


def leaks(docs: DataFrame, items: DataFrame, n: int = N_WORDS, max_grams: int = MAX_GRAMS) -> DataFrame:
    """(doc_id bigint, item_id bigint, start_word bigint, n_words bigint): one row for each run of shared words.

    docs needs doc_id and text, items item_id and text; other columns are ignored. Null ids and null or empty texts
    give no rows, nor do items of less than n words. Texts are scanned whole, whatever their length. Repeated rows
    give repeated runs only once for each doc_id and place.
    """
    spark = docs.sparkSession
    ship(spark)
    grams = materialize(item_grams(items, n).distinct(), "item-grams")
    corpus = docs.select(F.col("doc_id").cast("bigint"), "text").where("doc_id IS NOT NULL AND text IS NOT NULL")
    few = grams.select("gram").distinct().count() <= max_grams
    shared = spark.sparkContext.broadcast(np.unique(grams.select("gram").distinct().toPandas()["gram"].to_numpy(np.int64).view(np.uint64)) if few else _table(grams))

    def scan(it: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        keys = shared.value
        seen = np.zeros(1 << SEEN_BITS, bool)
        if few:
            seen[keys >> np.uint64(64 - SEEN_BITS)] = True
        for pdf in it:
            ids, texts = pdf["doc_id"].to_numpy(), pdf["text"].tolist()
            for lo, hi in vec.batches(texts):
                w = vec.words(texts[lo:hi])
                h, at = w.windows(n)
                if few:
                    hit = np.flatnonzero(seen[h >> np.uint64(64 - SEEN_BITS)])
                    hit = hit[keys[np.minimum(np.searchsorted(keys, h[hit]), len(keys) - 1)] == h[hit]] if len(keys) else hit[:0]
                else:
                    slot = h >> np.uint64(64 - TABLE_BITS)
                    hit = np.flatnonzero(keys[slot >> np.uint64(3)] >> (slot & np.uint64(7)).astype(np.uint8) & 1)
                if len(hit):
                    d = w.doc[at[hit]]
                    yield pd.DataFrame({"gram": h[hit].view(np.int64), "doc_id": ids[lo:hi][d], "place": at[hit] - w.first[d], "words": _words_at(texts[lo:hi], w, at[hit], n)})

    hits = corpus.mapInPandas(scan, "gram bigint, doc_id bigint, place bigint, words string").join(grams, ["gram", "words"]).select("doc_id", "item_id", "place").distinct()
    runs = hits.withColumn("run", F.col("place") - F.row_number().over(W.partitionBy("doc_id", "item_id").orderBy("place")))
    return runs.groupBy("doc_id", "item_id", "run").agg(F.min("place").alias("start_word"), (F.count("*") + n - 1).alias("n_words")).drop("run")


def _words_at(texts: list[str], w: vec.Words, at: np.ndarray, n: int) -> list[str]:
    """The n words of each window. Windows come in the order of their texts."""
    base = np.concatenate([[0], np.cumsum([len((t or "").lower()) + 1 for t in texts])])
    out, last, low = [], -1, ""
    for a in at.tolist():
        d = int(w.doc[a])
        if d != last:
            last, low = d, texts[d].lower()
        out.append(" ".join(_split(low[w.starts[a] - base[d] : w.ends[a + n - 1] - base[d]])))
    return out


def _table(grams: DataFrame) -> np.ndarray:
    """A table of TABLE_BITS bits in which the first bits of every hash are set; made in blocks, so that the driver gets the table and not the hashes."""
    block = 16
    slot = F.shiftrightunsigned("gram", 64 - TABLE_BITS)

    def bits(pdf: pd.DataFrame) -> pd.DataFrame:
        b = np.zeros(1 << (TABLE_BITS - block), bool)
        b[pdf["slot"].to_numpy() & ((1 << (TABLE_BITS - block)) - 1)] = True
        return pd.DataFrame({"block": pdf["block"].iloc[:1], "bits": [np.packbits(b, bitorder="little").tobytes()]})

    rows = grams.select(slot.alias("slot")).distinct().withColumn("block", F.shiftright("slot", TABLE_BITS - block)).groupBy("block").applyInPandas(bits, "block bigint, bits binary").collect()
    out = np.zeros((1 << block, 1 << (TABLE_BITS - block - 3)), np.uint8)
    for r in rows:
        out[r["block"]] = np.frombuffer(r["bits"], np.uint8)
    return out.ravel()


def leaked_items(docs: DataFrame, items: DataFrame, n: int = N_WORDS) -> DataFrame:
    """(doc_id, item_id): each document with each item that it leaks."""
    return leaks(docs, items, n).select("doc_id", "item_id").distinct()


def without_leaks(docs: DataFrame, items: DataFrame, n: int = N_WORDS, whole: bool = True) -> DataFrame:
    """The corpus without leaking documents, or (whole=False) with the leaking spans cut out of the texts.

    Repeated rows and other columns stay as they are; texts without a leak, null and empty ones are unchanged."""
    found = leaks(docs, items, n)
    if whole:
        return docs.join(found.select(F.col("doc_id").alias("_leak")).distinct(), F.col("doc_id") == F.col("_leak"), "left_anti")
    spans = found.groupBy(F.col("doc_id").alias("_leak")).agg(F.collect_set(F.struct("start_word", "n_words")).alias("_spans"))

    @F.pandas_udf("string")
    def cut(text: pd.Series, spans: pd.Series) -> pd.Series:
        return pd.Series([_cut(t, s) for t, s in zip(text, spans)])

    joined = docs.join(spans, F.col("doc_id") == F.col("_leak"), "left")
    kept = [F.when(F.col("_spans").isNull(), F.col("text")).otherwise(cut("text", "_spans")).alias("text") if c == "text" else F.col(f"`{c}`") for c in docs.columns]
    return joined.select(*kept)


def _cut(text: str | None, spans) -> str | None:
    if text is None or spans is None:
        return text
    # Words of the text itself, by the same rule; lower-casing can change the number of code points, so places are kept for each code point.
    starts, inside = [], False
    ends = []
    for i, c in enumerate(text):
        alnum = any(x.isalnum() for x in c.lower())
        if alnum and not inside:
            starts.append(i)
        if inside and not alnum:
            ends.append(i)
        inside = alnum
    if inside:
        ends.append(len(text))
    out, at = [], 0
    for s in sorted(spans, key=lambda s: s["start_word"]):
        lo, hi = starts[s["start_word"]], ends[s["start_word"] + s["n_words"] - 1]
        if lo > at:
            out.append(text[at:lo])
        at = max(at, hi)
    return "".join(out) + text[at:]
