"""Scans, paging and probes of the document store, and its sinks."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..functions.text import has_pairs, is_binary, is_blank, is_card
from ..functions.vectors import is_valid


def collection_scan(docs: DataFrame, tenant: str, collection: str, vectors: DataFrame | None = None) -> DataFrame:
    """All documents of a tenant's collection; the vector, where asked for, may be null."""
    out = docs.where((F.col("tenant_id") == tenant) & (F.col("collection") == collection))
    return out.join(vectors, "id", "left") if vectors is not None else out


def points(docs: DataFrame, tenant: str, ids: DataFrame) -> DataFrame:
    """Documents of a tenant by id, whatever their collection. ids has id."""
    return docs.where(F.col("tenant_id") == tenant).join(ids.select("id").distinct(), "id", "left_semi")


def page(docs: DataFrame, tenant: str, collection: str, limit: int | None, offset: str | None = None, where: Column | None = None) -> DataFrame:
    """A page in the order of id. An offset that is no number counts as 0; no limit gives all rows."""
    out = collection_scan(docs, tenant, collection)
    out = out.where(where) if where is not None else out
    if limit is None:
        return out
    start = int(offset) if offset and offset.isdecimal() else 0
    return out.orderBy("id").offset(start).limit(limit)


def web_points(docs: DataFrame, tenant: str, collection: str, limit: int | None = None, offset: str | None = None) -> DataFrame:
    """A page of the documents whose metadata gives exactly `http` as their source; addresses don't count."""
    return page(docs, tenant, collection, limit, offset, has_pairs(F.col("metadata"), {"source": "http"}, exact=False))


def file_points(docs: DataFrame, tenant: str, collection: str, limit: int | None = None, offset: str | None = None) -> DataFrame:
    """The same for `file`."""
    return page(docs, tenant, collection, limit, offset, has_pairs(F.col("metadata"), {"source": "file"}, exact=False))


def page_after(docs: DataFrame, tenant: str, collection: str, limit: int, after: str | None = None, where: Column | None = None) -> DataFrame:
    """The page of the ids behind `after`: a filter and the smallest `limit`, so that a late page costs no more than the first."""
    out = collection_scan(docs, tenant, collection)
    out = out.where(where) if where is not None else out
    return (out.where(F.col("id") > after) if after is not None else out).orderBy("id").limit(limit)


def next_offset(rows: int, limit: int, offset: str | None = None) -> str | None:
    """The offset of the next page; none after a page that isn't full."""
    start = int(offset) if offset and offset.isdecimal() else 0
    return str(start + rows) if rows >= limit else None


def source_points(docs: DataFrame, tenant: str, source: str, chat: str | None = None) -> DataFrame:
    """The documents of one source; without a chat only those outside chats."""
    return docs.where((F.col("tenant_id") == tenant) & (F.col("source") == source) & F.col("chat_id").eqNullSafe(F.lit(chat)))


def counts(docs: DataFrame) -> DataFrame:
    return docs.groupBy("tenant_id", "collection").agg(F.count("*").alias("n"))


def has_chunks(docs: DataFrame, tenant: str, source: str) -> DataFrame:
    """One row with 0 or 1: whether a source has a document that is no catalogue card."""
    card = F.coalesce(F.get_json_object("metadata", "$.is_catalogue_card") == "true", F.lit(False)) | is_card(F.col("content"))
    return docs.where((F.col("tenant_id") == tenant) & (F.col("source") == source) & ~card).limit(1).agg(F.count("*").alias("n"))


def collections(docs: DataFrame, tenant: str) -> DataFrame:
    return docs.where(F.col("tenant_id") == tenant).select("collection").distinct()


def with_collection(old: DataFrame, name: str, tenant: str, embedder: str, size: int) -> DataFrame:
    """Collections after creating one: an existing one takes the embedder's name and size."""
    spark = old.sparkSession
    new = spark.createDataFrame([(name, tenant, embedder, size)], "name string, tenant_id string, embedder_name string, embedder_size int")
    return old.join(new, ["name", "tenant_id"], "left_anti").select("name", "tenant_id", "embedder_name", "embedder_size").unionByName(new)


def storable(new: DataFrame, existing: DataFrame) -> DataFrame:
    """New points that can be stored: content not blank, collection known; an invalid vector becomes null."""
    known = existing.select("tenant_id", "collection").distinct()
    out = new.where(~is_blank(F.col("content"))).join(known, ["tenant_id", "collection"], "left_semi")
    return out.withColumn("vector", F.when(is_valid(F.col("vector")), F.col("vector")))


def per_source(points: DataFrame) -> DataFrame:
    """What a bulk write fans out to: each source with its points."""
    return points.groupBy("tenant_id", F.coalesce("source", F.lit("unknown")).alias("source"), F.coalesce("chat_id", F.lit("")).alias("chat_id")).agg(F.count("*").alias("points"))


def routes(points: DataFrame, status: DataFrame) -> DataFrame:
    """The route of each source's write. points has tenant_id, collection, source and source_key, status has source_key, status and phase.

    none for procedures; similarity for points without a source; job for a source without a status row; phase while its
    ingestion is processing in the embedding phase; resume for any other source with a row."""
    s = points.select("tenant_id", "collection", "source_key", F.col("source").isNull().alias("loose")).distinct().join(status.withColumn("there", F.lit(True)), "source_key", "left")
    writing = F.coalesce((F.col("status") == "processing") & (F.col("phase") == "embedding"), F.lit(False))
    route = F.when(F.col("collection") == "procedural", "none").when(F.col("loose"), "similarity").when(F.col("there").isNull(), "job").when(writing, "phase").otherwise("resume")
    return s.select("tenant_id", "collection", "source_key", route.alias("route"))


def staged(points: DataFrame, status: DataFrame) -> DataFrame:
    """(id, staged): whether a point belongs to a staging pass: its vector is the empty one and its source is still being parsed. Such points get no graph."""
    parsing = status.where("phase = 'parsing'").select("source_key", F.lit(True).alias("parsing")).distinct()
    empty = F.col("vector").isNotNull() & (F.size("vector") == 0)
    return points.join(parsing, "source_key", "left").select("id", (empty & F.coalesce("parsing", F.lit(False))).alias("staged"))


def after_outside_writes(routes: DataFrame, status: DataFrame, transferring: bool = False) -> DataFrame:
    """(source_key, action): what a write outside an ingestion sets off: due (the graph phases of a source with a row are run again) or job (a source without one is rebuilt).

    During a transfer to another store sources with a row are left to what follows it."""
    out = routes.where("route IN ('resume', 'job')").select("source_key", F.when(F.col("route") == "resume", "due").otherwise("job").alias("action")).distinct()
    return out.where("action = 'job'") if transferring else out


def prose(docs: DataFrame) -> DataFrame:
    """Documents from which entities are extracted: not blank, binary, an image, a card or without a letter or digit. Flags of cards never veto.

    position orders them within a source: start_index, else chunk_index; without either they come last."""
    c = F.col("content")
    image = F.startswith(F.regexp_replace(c, r"^\s+", ""), F.lit("[Image]")) | F.coalesce(F.get_json_object("metadata", "$.image") == "true", F.lit(False))
    kept = docs.where(~is_blank(c) & ~is_binary(c) & ~image & ~is_card(c) & c.rlike(r"[\p{L}\p{N}]"))
    return kept.withColumn("position", F.coalesce(F.get_json_object("metadata", "$.start_index").cast("int"), F.col("chunk_index")))
