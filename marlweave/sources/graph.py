"""The tables of the domain as the graph's nodes and edges, each delivered row once."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from ..functions.text import field, normalize_name, provenance_key
from .tables import once, table


def _of(rows: DataFrame, tenant: str | None) -> DataFrame:
    """The rows of a tenant, or all; the tenant is the same in every delivery, so that this goes before the dedupe and reaches the scan."""
    return rows if tenant is None else rows.where(F.col("tenant_id") == tenant)


def documents(spark: SparkSession, sf_dir: str, tenant: str | None = None, collection: str | None = None) -> DataFrame:
    """(id, tenant_id, collection, content, metadata, created_at, source, chat_id, chunk_index, source_key) of a tenant or all; deliveries of a document differ in arrival only."""
    d = _of(table(spark, sf_dir, "document_with_entities"), tenant)
    d = once(d if collection is None else d.where(F.col("collection_name") == collection), "document_id")
    m = F.col("metadata")
    d = d.select(F.col("document_id").alias("id"), "tenant_id", F.col("collection_name").alias("collection"), "content", "metadata", "created_at", field(m, "source").alias("source"), field(m, "chat_id").alias("chat_id"), field(m, "chunk_index").cast("int").alias("chunk_index"))
    return d.withColumn("source_key", provenance_key(F.coalesce("source", F.lit("unknown")), F.col("chat_id")))


def document_vectors(spark: SparkSession, sf_dir: str) -> DataFrame:
    """(id, vector): the vectors of documents; document number n has vector n."""
    d = table(spark, sf_dir, "document_with_entities").select(F.col("document_id").alias("id")).where("document_id IS NOT NULL").distinct()
    e = table(spark, sf_dir, "embeddings").select("vec_id", F.col("embedding").alias("vector"))
    return d.withColumn("vec_id", F.substring("id", 5, 12).cast("bigint")).join(e, "vec_id").select("id", "vector")


def entities(spark: SparkSession, sf_dir: str, tenant: str | None = None) -> DataFrame:
    """One row for each node with its latest last_seen: (id, tenant_id, name, norm, type, types, confidence, documents, tracked, concept_gen, last_seen)."""
    e = _of(table(spark, sf_dir, "entity"), tenant).where("entity_id IS NOT NULL")
    fixed = ["tenant_id", "name", "entity_type", "types", "metadata", "tracked_by_provenance", "concept_gen"]
    e = e.groupBy("entity_id").agg(*[F.any_value(c).alias(c) for c in fixed], F.max("last_seen").alias("last_seen"))
    facts = F.from_json("metadata", "source_documents array<string>, source_document string, confidence double")
    return e.select(F.col("entity_id").alias("id"), "tenant_id", "name", normalize_name(F.col("name")).alias("norm"), F.col("entity_type").alias("type"), "types", facts["confidence"].alias("confidence"), source_documents(facts).alias("documents"), F.coalesce("tracked_by_provenance", F.lit(False)).alias("tracked"), "concept_gen", "last_seen")


def source_documents(facts: Column) -> Column:
    """The documents that a node's metadata names; a node of the older form names one, which counts if there is no list."""
    many, one, none = facts["source_documents"], facts["source_document"], F.array().cast("array<string>")
    return F.when(F.size(F.coalesce(many, none)) > 0, many).when(one != "", F.array(one)).otherwise(none)


def entity_vectors(spark: SparkSession, sf_dir: str) -> DataFrame:
    """(id, vector) of every node, usable or not."""
    return once(table(spark, sf_dir, "entity").select(F.col("entity_id").alias("id"), F.col("embedding").alias("vector")), "id")


def mentions(spark: SparkSession, sf_dir: str) -> DataFrame:
    """(doc_id, entity_id, confidence): the highest confidence of each pair."""
    return table(spark, sf_dir, "mention").groupBy(F.col("document_id").alias("doc_id"), "entity_id").agg(F.max("confidence").alias("confidence"))


def provenance(entities: DataFrame) -> DataFrame:
    """(doc_id, entity_id) from the source documents in the metadata of nodes."""
    return entities.select(F.explode("documents").alias("doc_id"), F.col("id").alias("entity_id")).distinct()


def relations(spark: SparkSession, sf_dir: str, tenant: str | None = None) -> DataFrame:
    """(relation_id, doc_id, tenant_id, src, dst, type, weight): extracted relations with normalized ends; rows that lack an end or join a name with itself are left out."""
    d = _of(table(spark, sf_dir, "document_with_entities").select("document_id", "tenant_id"), tenant).where("document_id IS NOT NULL").distinct()
    r = table(spark, sf_dir, "extracted_relation")
    # the document is the same in every delivery of a relation: of one tenant, the others' rows go before the dedupe
    r = once(r if tenant is None else r.join(d.select("document_id"), "document_id", "left_semi"), "relation_id")
    r = r.select("relation_id", "document_id", normalize_name(F.col("source_entity")).alias("src"), normalize_name(F.col("target_entity")).alias("dst"), F.col("relation_type").alias("type"), "weight")
    return r.where("src <> '' AND dst <> '' AND src <> dst").join(d, "document_id").select("relation_id", F.col("document_id").alias("doc_id"), "tenant_id", "src", "dst", "type", "weight")


def extracted(spark: SparkSession, sf_dir: str) -> DataFrame:
    """(extraction_id, doc_id, name, type, start, end, confidence), each extraction once."""
    x = once(table(spark, sf_dir, "extracted_entity"), "extraction_id")
    return x.select("extraction_id", F.col("document_id").alias("doc_id"), "name", F.col("entity_type").alias("type"), F.col("start_char").alias("start"), F.col("end_char").alias("end"), "confidence")


#: The same tables in SQL.
_SP = r"[\s\pZ]"
NORM = rf"regexp_replace(regexp_replace(lower(%s), '^{_SP}+|{_SP}+$', '', 'g'), '^(the|a|an)\s+', '')"
VIEWS = {
    "docs": """SELECT *, CASE WHEN chat_id IS NULL THEN coalesce(source, 'unknown') ELSE 'chat:' || chat_id || ':' || coalesce(source, 'unknown') END AS source_key FROM (
        SELECT DISTINCT document_id AS id, tenant_id, collection_name AS collection, content, metadata, created_at, metadata->>'$.source' AS source, metadata->>'$.chat_id' AS chat_id, (metadata->>'$.chunk_index')::INT AS chunk_index FROM document_with_entities)""",
    "dvec": "SELECT id, embedding::DOUBLE[] AS vector FROM (SELECT DISTINCT document_id AS id FROM document_with_entities) JOIN embeddings ON vec_id = substr(id, 5)::BIGINT",
    "ents": f"""SELECT entity_id AS id, any_value(tenant_id) AS tenant_id, any_value(name) AS name, {NORM % "any_value(name)"} AS norm, any_value(entity_type) AS type, any_value(types) AS types, (any_value(metadata)->>'$.confidence')::DOUBLE AS confidence,
        CASE WHEN len(CAST(any_value(metadata)->'$.source_documents' AS VARCHAR[])) > 0 THEN CAST(any_value(metadata)->'$.source_documents' AS VARCHAR[]) WHEN any_value(metadata)->>'$.source_document' <> '' THEN [any_value(metadata)->>'$.source_document'] ELSE [] END AS documents, coalesce(any_value(tracked_by_provenance), false) AS tracked, any_value(concept_gen) AS concept_gen, max(last_seen) AS last_seen FROM entity GROUP BY entity_id""",
    "evec": "SELECT entity_id AS id, any_value(embedding)::DOUBLE[] AS vector FROM entity GROUP BY entity_id",
    "men": "SELECT document_id AS doc_id, entity_id, max(confidence) AS confidence FROM mention GROUP BY ALL",
    "prov": "SELECT DISTINCT unnest(documents) AS doc_id, id AS entity_id FROM ents",
    "rels": f"""SELECT * FROM (SELECT relation_id, document_id AS doc_id, tenant_id, {NORM % "source_entity"} AS src, {NORM % "target_entity"} AS dst, relation_type AS type, weight
        FROM (SELECT DISTINCT * FROM extracted_relation) JOIN (SELECT DISTINCT document_id, tenant_id FROM document_with_entities) USING (document_id)) WHERE src <> '' AND dst <> '' AND src <> dst""",
    "ext": "SELECT DISTINCT extraction_id, document_id AS doc_id, name, entity_type AS type, start_char AS start, end_char AS \"end\", confidence FROM extracted_entity",
}
_NEEDS = {"prov": ["ents"]}


def sql(query: str, *names: str, recursive: bool = False) -> str:
    """A query over some of the views."""
    order: list[str] = []
    for n in names:
        order += [x for x in [*_NEEDS.get(n, []), n] if x not in order]
    if not order:
        return query
    head = ", ".join(f"{n} AS MATERIALIZED ({VIEWS[n]})" for n in order)
    rest = query.strip()
    if rest[:5].upper() == "WITH ":
        return f"WITH {'RECURSIVE ' if recursive else ''}{head}, {rest[5:]}"
    return f"WITH {head} {rest}"
