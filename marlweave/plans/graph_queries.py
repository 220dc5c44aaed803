"""Queries over the document, graph and vector operators, each with the SQL that gives the same rows."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ..functions import text as T
from ..functions.extract import LABELS, STATES, TECHNOLOGY_PATTERNS, VERBS, concept_type, typed, verb_type
from ..functions.vectors import is_valid, square_norm
from ..operators import assemble as A
from ..operators import checks as C
from ..operators import lifecycle as L
from ..operators import recall as R
from ..operators import scan as S
from ..sources import graph as G
from ..sources.graph import NORM, sql
from . import ingestion as I

TENANT, COLLECTION, ACTIVE = "agent_main", "declarative", "g2"
NAMES = ["assistant", "glossary", "ticket", "roadmap"]
DEPTH, DECAY, THRESHOLD, K = 2, 0.8, 0.6, 25
SOURCE = "handbook_main.md"
#: A pattern group added to the built-in ones; the contents of the test tables name no technology of those.
EXTRA = [r"\b(Assistant|Glossary|Runbook|Roadmap|Ticket|Inbox)\b"]
PATTERNS = [*TECHNOLOGY_PATTERNS, *EXTRA]

QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {}
SQL: dict[str, str] = {}


def query(name: str, text: str | None = None, *views: str, recursive: bool = False):
    def keep(f: Callable[[Graph], DataFrame]) -> Callable:
        QUERIES[name] = lambda spark, sf_dir: f(Graph(spark, sf_dir))
        if text:
            SQL[name] = sql(text, *views, recursive=recursive)
        return f

    return keep


class Graph:
    """The tables of one data folder, each made when it is first used."""

    def __init__(self, spark: SparkSession, sf_dir: str) -> None:
        self.spark, self.sf_dir = spark, sf_dir

    def __getattr__(self, name: str):
        make = {"docs": G.documents, "doc_vectors": G.document_vectors, "entities": G.entities, "entity_vectors": G.entity_vectors, "mentions": G.mentions, "relations": G.relations, "extracted": G.extracted}
        if name == "provenance":
            value = G.provenance(self.entities)
        elif name in make:
            value = make[name](self.spark, self.sf_dir)
        else:
            raise AttributeError(name)
        setattr(self, name, value)
        return value

    @property
    def mine(self) -> DataFrame:
        """Documents of the tenant's collection."""
        return S.collection_scan(G.documents(self.spark, self.sf_dir, TENANT, COLLECTION), TENANT, COLLECTION)

    @property
    def own_docs(self) -> DataFrame:
        return G.documents(self.spark, self.sf_dir, TENANT)

    @property
    def own_entities(self) -> DataFrame:
        return G.entities(self.spark, self.sf_dir, TENANT)

    @property
    def own_relations(self) -> DataFrame:
        return G.relations(self.spark, self.sf_dir, TENANT)

    def query_vector(self, n: int = 7) -> list[float]:
        row = self.spark.read.parquet(f"{self.sf_dir}/embeddings.parquet").where(F.col("vec_id") == n).select("embedding").first()
        return [float(x) for x in row[0]]

    def status(self) -> DataFrame:
        """A status of every source and phase, told by its key: what the host's phase engine would keep."""
        s = self.docs.select("source_key").distinct().withColumn("h", F.ascii(F.md5("source_key")))
        return s.select("source_key", F.explode(F.array(F.lit("embedding"), F.lit("ner"), F.lit("llm"))).alias("phase"), "h").select("source_key", "phase", F.when(F.col("h") % 5 == 0, F.when(F.col("phase") == "llm", "error").otherwise("done")).when(F.col("h") % 5 == 1, F.when(F.col("phase") == "ner", "running").otherwise("done")).otherwise("done").alias("state"), F.when(F.col("h") % 7 == 0, "old").otherwise("new").alias("tag")).where("NOT (substr(md5(source_key), 2, 1) = '0')")


_M = f"(SELECT * FROM docs WHERE tenant_id = '{TENANT}' AND collection = '{COLLECTION}')"
_STATUS = """SELECT source_key, phase, CASE WHEN h % 5 = 0 THEN CASE WHEN phase = 'llm' THEN 'error' ELSE 'done' END WHEN h % 5 = 1 THEN CASE WHEN phase = 'ner' THEN 'running' ELSE 'done' END ELSE 'done' END AS state,
    CASE WHEN h % 7 = 0 THEN 'old' ELSE 'new' END AS tag FROM (SELECT source_key, ascii(md5(source_key)) AS h, unnest(['embedding', 'ner', 'llm']) AS phase FROM (SELECT DISTINCT source_key FROM docs)) WHERE substr(md5(source_key), 2, 1) <> '0'"""
_CARD = "coalesce(metadata->>'$.is_catalogue_card' = 'true', false)"
_CARDTEXT = r"regexp_matches(content, '^\s*# CATALOGUE CARD')"
_BLANK = r"(content IS NULL OR regexp_full_match(content, '[\s\pZ]*'))"
_BINARY = r"(contains(content, chr(0)) OR regexp_matches(content, '^\s*%PDF') OR (length(content) > 0 AND length(substr(content, 1, 4096)) - length(replace(substr(content, 1, 4096), chr(65533), '')) >= 0.1 * length(substr(content, 1, 4096))))"


# Scans, sources and sinks

query("s01_collection_scan", f"SELECT id, content, vector IS NOT NULL AS has_vector FROM {_M} LEFT JOIN dvec USING (id)", "docs", "dvec")(
    lambda g: S.collection_scan(g.mine, TENANT, COLLECTION, g.doc_vectors).select("id", "content", F.col("vector").isNotNull().alias("has_vector"))
)
query("s02_points_by_id", f"SELECT id, collection FROM docs WHERE tenant_id = '{TENANT}' AND id IN (SELECT doc_id FROM rels WHERE type = 'IS_A')", "docs", "rels")(
    lambda g: S.points(g.own_docs, TENANT, g.relations.where("type = 'IS_A'").select(F.col("doc_id").alias("id"))).select("id", "collection")
)
query("s03_page", f"SELECT id FROM {_M} ORDER BY id LIMIT 20 OFFSET 20", "docs")(lambda g: S.page(g.mine, TENANT, COLLECTION, 20, "20").select("id"))
query("s03_page_after", f"SELECT id FROM {_M} WHERE id > 'd00-00000292' ORDER BY id LIMIT 20", "docs")(lambda g: S.page_after(g.mine, TENANT, COLLECTION, 20, "d00-00000292").select("id"))
query("s03_all_pages", f"SELECT id, metadata FROM {_M}", "docs")(lambda g: S.page(g.mine, TENANT, COLLECTION, None).select("id", "metadata"))
query("s04_file_scan", f"SELECT id FROM {_M} WHERE contains(metadata, '\"source\": \"{SOURCE}\"')", "docs")(
    lambda g: S.page(g.mine, TENANT, COLLECTION, None, where=T.has_pairs(F.col("metadata"), {"source": SOURCE}, exact=False)).select("id")
)
_TOLD = "'{\"source\": \"' || CASE length(content) % 3 WHEN 0 THEN 'http' WHEN 1 THEN 'file' ELSE 'https' END || '\"}'"  # the tables name files only
for _kind, _scan in (("http", S.web_points), ("file", S.file_points)):
    query(f"s04_{_kind}_scan", f"SELECT id FROM {_M} WHERE length(content) % 3 = {('http', 'file').index(_kind)}", "docs")(lambda g, scan=_scan: scan(g.mine.withColumn("metadata", F.expr(_TOLD)), TENANT, COLLECTION).select("id"))
query("s05_source_points", f"SELECT id, chunk_index FROM docs WHERE tenant_id = '{TENANT}' AND source = '{SOURCE}' AND chat_id IS NULL", "docs")(lambda g: S.source_points(g.own_docs, TENANT, SOURCE).select("id", "chunk_index"))
query("s06_counts", "SELECT tenant_id, collection, count(*) AS n FROM docs GROUP BY ALL", "docs")(lambda g: S.counts(g.docs))
query("s07_has_chunks", f"SELECT count(*) AS n FROM (SELECT 1 FROM docs WHERE tenant_id = '{TENANT}' AND source = '{SOURCE}' AND NOT {_CARD} AND NOT {_CARDTEXT} LIMIT 1)", "docs")(lambda g: S.has_chunks(g.own_docs, TENANT, SOURCE))
query("s08_collections", f"SELECT DISTINCT collection FROM docs WHERE tenant_id = '{TENANT}'", "docs")(lambda g: S.collections(g.own_docs, TENANT))
query("s08_create_collection", f"SELECT DISTINCT collection AS name, tenant_id, CASE WHEN tenant_id = '{TENANT}' AND collection = 'episodic' THEN 'new' ELSE 'old' END AS embedder_name, CASE WHEN tenant_id = '{TENANT}' AND collection = 'episodic' THEN 32 ELSE 64 END AS embedder_size FROM docs", "docs")(
    lambda g: S.with_collection(g.docs.select(F.col("collection").alias("name"), "tenant_id").distinct().select("name", "tenant_id", F.lit("old").alias("embedder_name"), F.lit(64).alias("embedder_size")), "episodic", TENANT, "new", 32)
)
query("s09_storable", f"SELECT id, vector IS NOT NULL AS has_vector FROM docs LEFT JOIN dvec USING (id) WHERE NOT {_BLANK} AND (tenant_id, collection) IN (SELECT (tenant_id, collection) FROM docs WHERE collection = '{COLLECTION}')", "docs", "dvec")(
    lambda g: S.storable(g.docs.join(g.doc_vectors, "id", "left"), g.docs.where(F.col("collection") == COLLECTION)).select("id", F.col("vector").isNotNull().alias("has_vector"))
)
query("s10_bulk_fan_out", "SELECT tenant_id, coalesce(source, 'unknown') AS source, coalesce(chat_id, '') AS chat_id, count(*) AS points FROM docs GROUP BY ALL", "docs")(lambda g: S.per_source(g.docs))


def _phases(g: Graph) -> DataFrame:
    """A status row of most sources, told by their key: (source_key, status, phase)."""
    h = F.ascii(F.md5("source_key"))
    of = lambda *x: F.element_at(F.array(*[F.lit(v) for v in x]), h % 6 + 1)
    return g.docs.select("source_key").distinct().where(h % 6 != 5).select("source_key", of("processing", "processing", "completed", "error", "processing").alias("status"), of("parsing", "embedding", "done", "error", "parsing").alias("phase"))


_ROWS = "st AS (SELECT source_key, ['processing', 'processing', 'completed', 'error', 'processing'][h % 6 + 1] AS status, ['parsing', 'embedding', 'done', 'error', 'parsing'][h % 6 + 1] AS phase FROM (SELECT DISTINCT source_key, ascii(md5(source_key)) AS h FROM docs) WHERE h % 6 <> 5)"
# a collection of procedures besides those of the tables, so that every route occurs
_PTS = "pts AS (SELECT tenant_id, collection, source, source_key FROM docs UNION SELECT tenant_id, 'procedural', source, source_key FROM docs WHERE collection = 'episodic')"
_ROUTES = "rt AS (SELECT DISTINCT tenant_id, collection, source_key, CASE WHEN collection = 'procedural' THEN 'none' WHEN source IS NULL THEN 'similarity' WHEN st.source_key IS NULL THEN 'job' WHEN status = 'processing' AND phase = 'embedding' THEN 'phase' ELSE 'resume' END AS route FROM pts LEFT JOIN st USING (source_key))"


def _points(g: Graph) -> DataFrame:
    p = g.docs.select("tenant_id", "collection", "source", "source_key")
    return p.unionByName(p.where("collection = 'episodic'").withColumn("collection", F.lit("procedural")))


query("s12_routes", f"WITH {_ROWS}, {_PTS}, {_ROUTES} SELECT * FROM rt", "docs")(lambda g: S.routes(_points(g), _phases(g)))
query("s11_staging_pass", f"WITH {_ROWS} SELECT id, contains(content, 'a') AND coalesce(phase = 'parsing', false) AS staged FROM docs LEFT JOIN st USING (source_key) WHERE content IS NOT NULL", "docs")(
    lambda g: S.staged(g.docs.where("content IS NOT NULL").withColumn("vector", F.when(F.contains("content", F.lit("a")), F.array().cast("array<double>"))), _phases(g))
)

# Predicates and projections

query("pred01_metadata_exact", "SELECT id FROM docs WHERE metadata->>'$.chunk_index' = '1'", "docs")(lambda g: g.docs.where(T.has_pairs(F.col("metadata"), {"chunk_index": 1})).select("id"))
query("pred01_metadata_fragment", "SELECT id FROM docs WHERE contains(metadata, '\"chunk_index\": 1')", "docs")(lambda g: g.docs.where(T.has_pairs(F.col("metadata"), {"chunk_index": 1}, exact=False)).select("id"))
query("pred03_stored_metadata", "SELECT id, coalesce(len(json_keys(metadata)), 0) AS n, metadata->>'$.source' AS source FROM docs", "docs")(lambda g: g.docs.select("id", F.size(T.stored_metadata(F.col("metadata"))).cast("bigint").alias("n"), T.stored_metadata(F.col("metadata"))["source"].alias("source")))
query("pred04_not_blank", f"SELECT id FROM docs WHERE NOT {_BLANK}", "docs")(lambda g: g.docs.where(~T.is_blank(F.col("content"))).select("id"))
query("pred05_binary", f"SELECT id FROM docs WHERE {_BINARY}", "docs")(lambda g: g.docs.where(T.is_binary(F.col("content"))).select("id"))
query("pred06_card", f"SELECT id FROM docs WHERE {_CARDTEXT}", "docs")(lambda g: g.docs.where(T.is_card(F.col("content"))).select("id"))
_PROSE = rf"SELECT * FROM docs WHERE NOT {_BLANK} AND NOT {_BINARY} AND NOT {_CARDTEXT} AND NOT regexp_matches(content, '^\s*\[Image\]') AND NOT coalesce(metadata->>'$.image' = 'true', false) AND regexp_matches(content, '[\pL\pN]')"
query("pred07_prose", f"SELECT id, chunk_index AS position FROM ({_PROSE})", "docs")(lambda g: S.prose(g.docs).select("id", "position"))
query("pred08_visible", f"SELECT id FROM ents WHERE concept_gen IS NULL OR concept_gen = '{ACTIVE}'", "ents")(lambda g: R.visible(g.entities, ACTIVE).select("id"))

query("pred08_visible_edges", f"SELECT relation_id FROM rels WHERE type <> 'USES'", "rels")(lambda g: R.visible(_tagged(g.relations), ACTIVE).select("relation_id"))


def _tagged(edges: DataFrame) -> DataFrame:
    """Edges with a concept generation by their type: IS_A of the active one, USES of another, the rest of the base graph."""
    return edges.withColumn("concept_gen", F.when(F.col("type") == "IS_A", ACTIVE).when(F.col("type") == "USES", "g1"))


# Joins, traversal and recall

_NAMES = ", ".join(f"'{n}'" for n in NAMES)
_DIRECT = f"SELECT doc_id AS id, count(DISTINCT entity_id) / {len(NAMES)}.0 AS score FROM men JOIN ents e ON e.id = entity_id JOIN {_M} d ON d.id = doc_id WHERE e.tenant_id = '{TENANT}' AND norm IN ({_NAMES}) GROUP BY doc_id ORDER BY score DESC, id LIMIT {K}"
query("j01_direct_recall", f"SELECT id, round(score, 6) AS score FROM ({_DIRECT})", "men", "ents", "docs")(lambda g: R.direct(g.mine, g.own_entities, g.mentions, NAMES, K).select("id", F.round("score", 6).alias("score")))
query("j03_orphan_entities", "SELECT id FROM ents WHERE id NOT IN (SELECT entity_id FROM men) AND id NOT IN (SELECT entity_id FROM prov)", "ents", "men", "prov")(lambda g: L.orphans(g.entities, g.mentions, g.provenance).select("id"))
query("j03_isolated_entities", "SELECT e.id FROM ents e WHERE id NOT IN (SELECT entity_id FROM men) AND NOT EXISTS (SELECT 1 FROM (SELECT tenant_id, src AS norm FROM rels UNION SELECT tenant_id, dst FROM rels) r WHERE r.tenant_id = e.tenant_id AND r.norm = e.norm)", "ents", "men", "rels")(lambda g: L.isolated(g.entities, g.mentions, g.relations).select("id"))
query("j04_endpoint_join", "SELECT DISTINCT relation_id FROM rels r JOIN ents a ON a.tenant_id = r.tenant_id AND a.norm = src JOIN ents b ON b.tenant_id = r.tenant_id AND b.norm = dst", "rels", "ents")(
    lambda g: g.relations.join(g.entities.select("tenant_id", F.col("norm").alias("src")).distinct(), ["tenant_id", "src"], "left_semi").join(g.entities.select("tenant_id", F.col("norm").alias("dst")).distinct(), ["tenant_id", "dst"], "left_semi").select("relation_id")
)
_BFS = f"""vis AS (SELECT DISTINCT norm FROM ents WHERE tenant_id = '{TENANT}' AND norm <> '' AND (concept_gen IS NULL OR concept_gen = '{ACTIVE}')),
    ed AS (SELECT DISTINCT src, dst FROM rels WHERE tenant_id = '{TENANT}' AND src IN (FROM vis) AND dst IN (FROM vis)), und AS (SELECT src AS a, dst AS b FROM ed UNION SELECT dst, src FROM ed),
    bfs(name, hop) AS (SELECT unnest([{_NAMES}]), 0 UNION SELECT b, hop + 1 FROM bfs JOIN und ON a = name WHERE hop < {DEPTH}),
    far AS (SELECT name, min(hop) AS hop FROM bfs GROUP BY name HAVING min(hop) > 0)"""
_RELATED = f"SELECT doc_id AS id, {DECAY} ** min(hop) AS score FROM far JOIN ents e ON e.norm = far.name AND e.tenant_id = '{TENANT}' AND (concept_gen IS NULL OR concept_gen = '{ACTIVE}') JOIN men ON entity_id = e.id JOIN {_M} d ON d.id = doc_id GROUP BY doc_id ORDER BY score DESC, id LIMIT {K}"
query("j05_hops", f"WITH {_BFS} SELECT name, hop FROM far", "ents", "rels", recursive=True)(lambda g: _hops(g))
query("j05_related_recall", f"WITH {_BFS} SELECT id, round(score, 6) AS score FROM ({_RELATED})", "ents", "rels", "men", "docs", recursive=True)(lambda g: R.related(g.mine, g.own_entities, g.mentions, g.own_relations, NAMES, K, DEPTH, DECAY, ACTIVE).select("id", F.round("score", 6).alias("score")))


def _hops(g: Graph) -> DataFrame:
    known = R.visible(g.own_entities, ACTIVE).where("norm <> ''").select("norm").distinct()
    edges = g.own_relations.select("src", "dst").distinct().join(known.withColumnRenamed("norm", "src"), "src", "left_semi").join(known.withColumnRenamed("norm", "dst"), "dst", "left_semi")
    return R.hops(edges, NAMES, DEPTH).where("hop > 0")


_Q = "(SELECT embedding::DOUBLE[] FROM embeddings WHERE vec_id = 7)"
_COS = f"(1 + list_cosine_similarity(vector, {_Q})) / 2"
_NEAR = f"SELECT id, {_COS} AS score FROM dvec ORDER BY score DESC, id LIMIT {2 * K}"
_ENEAR = f"SELECT id, {_COS} AS score FROM evec WHERE len(vector) = 64 AND list_dot_product(vector, vector) > 0 AND isfinite(list_dot_product(vector, vector)) ORDER BY score DESC, id LIMIT {2 * K}"
_BYENT = f"SELECT doc_id AS id, max(n.score) AS score FROM ({_ENEAR}) n JOIN ents e ON e.id = n.id AND e.tenant_id = '{TENANT}' JOIN men ON entity_id = e.id JOIN {_M} d ON d.id = doc_id GROUP BY doc_id ORDER BY score DESC, id LIMIT {K}"
_VEC = f"SELECT id, score FROM ({_NEAR}) WHERE score >= {THRESHOLD} AND id IN (SELECT id FROM {_M})"
query("n01_vector_recall", f"SELECT id, round(score, 6) AS score FROM ({_VEC})", "docs", "dvec")(lambda g: R.by_vector(g.mine, g.doc_vectors, g.query_vector(), 2 * K, THRESHOLD).select("id", F.round("score", 6).alias("score")))
query("n02_search", f"SELECT id, round(score, 6) AS score FROM (SELECT id, {_COS} AS score FROM dvec ORDER BY score DESC, id LIMIT {K}) WHERE id IN (SELECT id FROM {_M})", "docs", "dvec")(lambda g: R.by_vector(g.mine, g.doc_vectors, g.query_vector(), K, 0.0).select("id", F.round("score", 6).alias("score")))
_SIM = f"""near AS (SELECT a.id AS src, b.id AS dst, (1 + list_cosine_similarity(a.vector, b.vector)) / 2 AS score, row_number() OVER (PARTITION BY a.id ORDER BY round((1 + list_cosine_similarity(a.vector, b.vector)) / 2, 9) DESC, b.id) AS r FROM dvec a, dvec b),
    kept AS (SELECT src, dst, score FROM near JOIN docs x ON x.id = src JOIN docs y ON y.id = dst WHERE r <= 20 AND src <> dst AND score >= {THRESHOLD} AND x.tenant_id = y.tenant_id AND x.collection = y.collection)"""
query("n03_similarity_edges", f"WITH {_SIM} SELECT src, dst, round(max(score), 6) AS score FROM (SELECT * FROM kept UNION ALL SELECT dst, src, score FROM kept) GROUP BY src, dst", "docs", "dvec")(lambda g: R.similar(g.doc_vectors, g.doc_vectors, g.docs.select("id", "tenant_id", "collection"), 20, THRESHOLD).select("src", "dst", F.round("score", 6).alias("score")))
query("n04_similarity_generation", f"WITH {_SIM} SELECT src, dst, 'v2' AS gen, round(max(score), 6) AS score FROM (SELECT * FROM kept UNION ALL SELECT dst, src, score FROM kept) GROUP BY src, dst", "docs", "dvec")(lambda g: R.similar(g.doc_vectors, g.doc_vectors, g.docs.select("id", "tenant_id", "collection"), 20, THRESHOLD, generation="v2").select("src", "dst", "gen", F.round("score", 6).alias("score")))
query("n05_valid_vectors", "SELECT id, vector IS NOT NULL AND len(vector) > 0 AND list_dot_product(vector, vector) > 0 AND isfinite(list_dot_product(vector, vector)) AS valid FROM evec", "evec")(lambda g: g.entity_vectors.select("id", is_valid(F.col("vector")).alias("valid")))
query("j06_entity_vector_recall", f"SELECT id, round(score, 6) AS score FROM ({_BYENT})", "ents", "evec", "men", "docs")(lambda g: R.by_entity_vector(g.mine, g.own_entities, g.mentions, g.entity_vectors, g.query_vector(), 2 * K, K).select("id", F.round("score", 6).alias("score")))
query("a10_indirect_pool", f"WITH {_BFS}, rel AS ({_RELATED}), byent AS ({_BYENT}) SELECT id, round(max(score), 6) AS score FROM (SELECT * FROM rel UNION ALL SELECT * FROM byent) GROUP BY id", "ents", "rels", "men", "docs", "evec", recursive=True)(
    lambda g: R.indirect(R.related(g.mine, g.own_entities, g.mentions, g.own_relations, NAMES, K, DEPTH, DECAY, ACTIVE), R.by_entity_vector(g.mine, g.own_entities, g.mentions, g.entity_vectors, g.query_vector(), 2 * K, K)).select("id", F.round("score", 6).alias("score"))
)
_RERANK = f"""WITH {_BFS}, dir AS ({_DIRECT}), rel AS ({_RELATED}), byent AS ({_BYENT}), vecs AS ({_VEC}), ind AS (SELECT id, max(score) AS score FROM (SELECT * FROM rel UNION ALL SELECT * FROM byent) GROUP BY id),
    m AS (SELECT id, max(CASE WHEN p = 0 THEN score END) AS d, max(CASE WHEN p = 1 THEN score END) AS i, max(CASE WHEN p = 2 THEN score END) AS v FROM (SELECT id, score, 0 AS p FROM dir UNION ALL SELECT id, score, 1 FROM ind UNION ALL SELECT id, score, 2 FROM vecs) GROUP BY id)
    SELECT id, round(s, 6) AS score, round(coalesce(d, i), 6) AS entity_score, round(v, 6) AS vector_score, d IS NOT NULL AS is_direct FROM (SELECT *, CASE WHEN v IS NULL THEN coalesce(d, i) WHEN coalesce(d, i) IS NULL THEN v WHEN d IS NOT NULL THEN least(1.0, greatest(d, v) * 1.3) ELSE least(1.0, greatest(i, v) * 1.3 * {DECAY}) END AS s FROM m)
    ORDER BY s DESC, CASE WHEN d IS NOT NULL THEN 0 WHEN i IS NOT NULL THEN 1 ELSE 2 END, coalesce(d, i, v) DESC, id LIMIT {K}"""
query("r03_hybrid_recall", _RERANK, "ents", "rels", "men", "docs", "evec", "dvec", recursive=True)(lambda g: hybrid(g))


def hybrid(g: Graph) -> DataFrame:
    rows = R.recall(g.mine, g.own_entities, g.mentions, g.own_relations, g.doc_vectors, g.entity_vectors, NAMES, g.query_vector(), K, THRESHOLD, DEPTH, DECAY, ACTIVE)
    return rows.select("id", *[F.round(c, 6).alias(c) for c in ("score", "entity_score", "vector_score")], "is_direct")


# Extraction and assembly

_BEST = r"SELECT doc_id, key, name, type, start, \"end\", confidence FROM (SELECT *, row_number() OVER (PARTITION BY doc_id, key ORDER BY coalesce(-confidence, 0), extraction_id) AS r FROM (SELECT *, regexp_replace(lower(name), '^[\s\pZ]+|[\s\pZ]+$', '', 'g') AS key FROM ext) WHERE key <> '') WHERE r = 1".replace('\\"', '"')
query("a05_best_per_name", _BEST, "ext")(lambda g: A.best_per_name(g.extracted))
_PAT = [p.replace("'", "''") for p in PATTERNS]
#: Every match with its place: the lengths of what lies between the matches and of the matches before it.
_HITS = " UNION ALL ".join(
    f"SELECT doc_id, ms[k] AS name, (list_sum(list_transform(ps[1:k], lambda x: length(x))) + coalesce(list_sum(list_transform(ms[1:k - 1], lambda x: length(x))), 0))::INT AS start FROM (SELECT doc_id, ms, ps, unnest(range(1, len(ms) + 1)) AS k FROM (SELECT id AS doc_id, regexp_extract_all(content, '(?i){p}', 1) AS ms, string_split_regex(content, '(?i){p}') AS ps FROM docs))"
    for p in _PAT
)
query("f08_technologies", f'SELECT doc_id, name, start, (start + length(name))::INT AS "end", 0.85::DOUBLE AS confidence FROM ({_HITS})', "docs")(lambda g: A.technologies(g.docs, PATTERNS))
_SPANS = f"b AS ({_BEST})"
query(
    "j07_proximity",
    f"""WITH {_SPANS} SELECT doc_id, source, target, CASE WHEN contains(t, 'is a') OR contains(t, 'are a') THEN 'IS_A' WHEN contains(t, 'based on') THEN 'BASED_ON' ELSE 'RELATED_TO' END AS type, 0.6::DOUBLE AS weight FROM (
    SELECT x.doc_id, x.name AS source, y.name AS target, lower(CASE WHEN y.start > x."end" THEN substr(content, x."end" + 1, y.start - x."end") ELSE '' END) AS t FROM b x JOIN b y ON x.doc_id = y.doc_id AND (x.start, x.name) < (y.start, y.name) AND y.start - x."end" < 100 JOIN docs d ON d.id = x.doc_id
    WHERE NOT EXISTS (SELECT 1 FROM rels r WHERE r.doc_id = x.doc_id AND r.type = 'IS_A' AND r.src = lower(x.name) AND r.dst = lower(y.name)))""",
    "ext", "docs", "rels",
)(lambda g: _proximity(g))


def _proximity(g: Graph) -> DataFrame:
    best = A.best_per_name(g.extracted)
    lower = g.relations.where("type = 'IS_A'").select("doc_id", "src", "dst").distinct()
    names = best.select("doc_id", "name", F.lower("name").alias("low")).distinct()
    known = lower.join(names.select("doc_id", F.col("name").alias("source"), F.col("low").alias("src")), ["doc_id", "src"]).join(names.select("doc_id", F.col("name").alias("target"), F.col("low").alias("dst")), ["doc_id", "dst"])
    return A.proximity(best, g.docs, known)


query("j08_co_occurrence", f"WITH {_SPANS}, few AS (SELECT doc_id FROM b GROUP BY doc_id HAVING count(*) <= 10) SELECT x.doc_id, x.name AS source, y.name AS target, round((coalesce(x.confidence, 0.5) + coalesce(y.confidence, 0.5)) / 4, 6) AS weight FROM b x JOIN b y ON x.doc_id = y.doc_id AND x.name < y.name WHERE x.doc_id IN (FROM few)", "ext")(
    lambda g: A.co_occurrence(A.best_per_name(g.extracted)).select("doc_id", "source", "target", F.round("weight", 6).alias("weight"))
)
query(
    "j09_span_overlap",
    f"""WITH {_SPANS}, t AS (SELECT id AS doc_id, unnest(range(0, length(content), 40)) AS s FROM docs WHERE content <> ''), own AS (SELECT t.doc_id, s, name, row_number() OVER (PARTITION BY t.doc_id, s ORDER BY start, name) AS r FROM t JOIN b ON b.doc_id = t.doc_id AND s < "end" AND start < s + 10),
        sub AS (SELECT t.doc_id, s, name, row_number() OVER (PARTITION BY t.doc_id, s ORDER BY start, name) AS r FROM t JOIN b ON b.doc_id = t.doc_id AND s - 20 < "end" AND start < s + 30 WHERE s % 80 = 0)
        SELECT doc_id, s::INT AS s, coalesce(own.name, sub.name) AS name FROM t LEFT JOIN (FROM own WHERE r = 1) own USING (doc_id, s) LEFT JOIN (FROM sub WHERE r = 1) sub USING (doc_id, s) WHERE coalesce(own.name, sub.name) IS NOT NULL""",
    "ext", "docs",
)(lambda g: A.overlapping(_lattice(g), A.best_per_name(g.extracted)).select("doc_id", "s", "name"))


def _lattice(g: Graph) -> DataFrame:
    """Tokens of ten characters every forty, each second one with a subtree of three tokens, the others with one of six."""
    t = g.docs.where("content <> ''").select(F.col("id").alias("doc_id"), F.explode(F.expr("sequence(0, length(content) - 1, 40)")).alias("s"))
    return t.select("doc_id", F.col("s").alias("token"), "s", (F.col("s") + 10).alias("e"), (F.col("s") - 20).alias("sub_s"), (F.col("s") + 30).alias("sub_e"), F.when(F.col("s") % 80 == 0, 3).otherwise(6).alias("sub_n"))


query("a04_conditional_counts", "SELECT count(*) AS n, count(*) FILTER (tracked) AS tracked, count(*) FILTER (concept_gen IS NOT NULL) AS tagged FROM ents", "ents")(lambda g: g.entities.agg(F.count("*").alias("n"), F.count_if("tracked").alias("tracked"), F.count_if(F.col("concept_gen").isNotNull()).alias("tagged")))
query(
    "a06_merge_entities",
    rf"""WITH r AS (SELECT md5(tenant_id || ':' || norm) AS key, norm, e.name, e.type, doc_id, e.confidence, extraction_id AS ord FROM (SELECT *, {NORM % "name"} AS norm FROM ext) e JOIN docs d ON d.id = doc_id WHERE norm <> '')
    SELECT key, arg_min(name, ord) AS name, arg_min(type, ord) AS type, count(DISTINCT doc_id) AS documents, max(confidence) AS confidence FROM r GROUP BY key""",
    "ext", "docs",
)(lambda g: A.merge_entities(_keyed(g)).withColumn("documents", F.size("documents").cast("bigint")))


def _keyed(g: Graph) -> DataFrame:
    x = g.extracted.join(g.docs.select(F.col("id").alias("doc_id"), "tenant_id"), "doc_id").where(T.normalize_name(F.col("name")) != "")
    return x.select(T.entity_key(F.col("tenant_id"), F.col("name")).alias("key"), "name", "type", "doc_id", "confidence", F.col("extraction_id").alias("ord"))


query("a07_merge_mentions", "SELECT doc_id, entity_id, confidence FROM men", "men")(lambda g: A.merge_mentions(g.mentions))
query("a08_fold_relations", "SELECT tenant_id, src, dst, type, round(list_reduce(list(weight ORDER BY relation_id), lambda a, x: (a + x) / 2), 6) AS weight, count(*) AS n FROM rels WHERE weight IS NOT NULL GROUP BY ALL", "rels")(
    lambda g: A.fold_weights(g.relations, ["tenant_id", "src", "dst", "type"], "relation_id").select("tenant_id", "src", "dst", "type", F.round("weight", 6).alias("weight"), "n")
)
query("a09_fold_per_document", "SELECT doc_id, src, dst, type, round(list_reduce(list(weight ORDER BY relation_id), lambda a, x: (a + x) / 2), 6) AS weight FROM rels WHERE weight IS NOT NULL GROUP BY ALL", "rels")(
    lambda g: A.fold_weights(g.relations, ["doc_id", "src", "dst", "type"], "relation_id").select("doc_id", "src", "dst", "type", F.round("weight", 6).alias("weight"))
)
query("a11_accumulated_text", f"SELECT tenant_id, source_key, count(*) AS chunks, least(12000, sum(length(content)) + 2 * (count(*) - 1))::BIGINT AS chars FROM (SELECT *, coalesce(sum(length(content)) OVER (PARTITION BY tenant_id, source_key ORDER BY chunk_index IS NULL, chunk_index, id ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING), 0) AS before FROM ({_PROSE})) WHERE before <= 12000 GROUP BY ALL", "docs")(lambda g: A.accumulated(S.prose(g.docs)))
query("a12_sources", "SELECT tenant_id, source_key, count(*) AS n FROM docs GROUP BY ALL", "docs")(lambda g: g.docs.groupBy("tenant_id", "source_key").agg(F.count("*").alias("n")))
query("f01_normalized_names", "SELECT id, norm FROM ents", "ents")(lambda g: g.entities.select("id", "norm"))
query("f02_entity_keys", "SELECT id, md5(tenant_id || ':' || norm) AS key FROM ents WHERE norm IS NOT NULL", "ents")(lambda g: g.entities.where("norm IS NOT NULL").select("id", T.entity_key(F.col("tenant_id"), F.col("name")).alias("key")))
query("f04_provenance_keys", "SELECT id, source_key FROM docs", "docs")(lambda g: g.docs.select("id", "source_key"))
query("f05_generations", "SELECT DISTINCT coalesce(concept_gen, 'v7') AS gen, CASE WHEN concept_gen IS NULL THEN 'v8' ELSE 'v2' END AS next FROM ents", "ents")(lambda g: g.entities.select(F.coalesce("concept_gen", F.lit("v7")).alias("gen")).distinct().withColumn("next", T.next_generation(F.col("gen"))))
query("f06_versioned_names", "SELECT DISTINCT 'similar_' || coalesce(concept_gen, 'v1') AS name FROM ents", "ents")(lambda g: g.entities.select(T.versioned("similar", F.coalesce("concept_gen", F.lit("v1"))).alias("name")).distinct())
query("f07_vector_norms", "SELECT id, round(sqrt(list_dot_product(vector, vector)), 6) AS norm FROM dvec", "dvec")(lambda g: g.doc_vectors.select("id", F.round(F.sqrt(square_norm(F.col("vector"))), 6).alias("norm")))
_LABEL = "CASE type WHEN 'ORGANIZATION' THEN 'ORG' WHEN 'LOCATION' THEN 'GPE' WHEN 'CONCEPT' THEN 'WORK_OF_ART' ELSE type END"  # a label that a recogniser could have given
query("f09_labels", "WITH l(label, t) AS (VALUES " + ", ".join(f"('{k}', '{v}')" for k, v in LABELS.items()) + f") SELECT extraction_id, coalesce(t, 'UNKNOWN') AS type, CASE WHEN t IS NULL THEN 0.5 ELSE 0.9 END::DOUBLE AS confidence FROM (SELECT extraction_id, {_LABEL} AS label FROM ext) LEFT JOIN l USING (label)", "ext")(
    lambda g: g.extracted.select("extraction_id", F.expr(_LABEL).alias("label")).select("extraction_id", typed(F.col("label"))[0].alias("type"), typed(F.col("label"))[1].alias("confidence"))
)
_LEMMA = "lower(regexp_replace(type, '(S|_ON|_A|_TO)$', ''))"  # 'USES' of 'use', 'DEPENDS_ON' of 'depends', which is none
query("f10_verb_types", "WITH v(lemma, t) AS (VALUES " + ", ".join(f"('{k}', '{v}')" for k, v in VERBS.items()) + f") SELECT relation_id, coalesce(t, 'RELATED_TO') AS type FROM (SELECT relation_id, {_LEMMA} AS lemma FROM rels) LEFT JOIN v USING (lemma)", "rels")(
    lambda g: g.relations.select("relation_id", verb_type(F.expr(_LEMMA)).alias("type"))
)
query("f16_concept_types", "SELECT id, CASE WHEN upper(trim(type)) IN ('PERSON', 'EVENT', 'CONCEPT') THEN upper(trim(type)) ELSE 'CONCEPT' END AS type FROM ents", "ents")(lambda g: g.entities.select("id", concept_type(F.col("type"), {"PERSON", "EVENT", "CONCEPT"}).alias("type")))
query("f21_default_chunk_index", "SELECT id, coalesce(chunk_index, row_number() OVER (PARTITION BY tenant_id, source_key ORDER BY created_at, id) - 1)::BIGINT AS chunk_index FROM docs", "docs")(lambda g: _default_index(g))


def _default_index(g: Graph) -> DataFrame:
    n = A.numbered(g.docs.select("id", "tenant_id", "source_key", "created_at", "chunk_index"), ["tenant_id", "source_key"])
    return n.select("id", F.coalesce(F.col("chunk_index").cast("bigint"), F.col("n")).alias("chunk_index"))


query("w01_next_edges", f"SELECT src, dst FROM (SELECT id AS src, lead(id) OVER (PARTITION BY tenant_id, source_key ORDER BY chunk_index NULLS FIRST, created_at, id) AS dst FROM (SELECT *, max(chunk_index) OVER (PARTITION BY tenant_id, source_key) AS most FROM docs WHERE NOT {_CARD}) WHERE most IS NULL OR chunk_index IS NOT NULL) WHERE dst IS NOT NULL", "docs")(lambda g: A.next_edges(g.docs))
query("j13_structure", f"SELECT 'PART_OF' AS kind, id AS src, tenant_id || '/' || source_key AS dst FROM docs UNION ALL SELECT 'HAS_SUMMARY', tenant_id || '/' || source_key, id FROM docs WHERE {_CARD}", "docs")(lambda g: A.structure(g.docs))
query("j13_child_of", "SELECT 'CHILD_OF' AS kind, a.id AS src, b.id AS dst FROM docs a JOIN docs b ON b.tenant_id = a.tenant_id AND b.id = left(a.id, 4) || lpad((substr(a.id, 5)::BIGINT - 1)::VARCHAR, 8, '0')", "docs")(lambda g: A.structure(_with_parents(g)).where("kind = 'CHILD_OF'"))


def _with_parents(g: Graph) -> DataFrame:
    """Documents whose metadata names the document before them as their parent, of whatever tenant that is."""
    before = F.concat(F.substring("id", 1, 4), F.lpad((F.substring("id", 5, 8).cast("bigint") - 1).cast("string"), 8, "0"))
    return g.docs.withColumn("metadata", F.to_json(F.struct(before.alias("parent_id"))))


query("j10_co_mentioned", "WITH m AS (SELECT DISTINCT d.tenant_id, doc_id, source_key, norm FROM men JOIN ents e ON e.id = entity_id JOIN docs d ON d.id = doc_id WHERE norm IS NOT NULL) SELECT r.tenant_id, src, dst, array_to_string(list_sort(list(DISTINCT a.source_key)), ',') AS keys FROM (SELECT DISTINCT tenant_id, src, dst FROM rels) r JOIN m a ON a.tenant_id = r.tenant_id AND a.norm = src JOIN m b ON b.doc_id = a.doc_id AND b.norm = dst GROUP BY r.tenant_id, src, dst", "men", "ents", "docs", "rels")(lambda g: A.co_mentioned(g.relations, g.entities, g.mentions, g.docs))
_CONTAIN = "c AS (SELECT id, tenant_id, lower(name) AS low FROM ents WHERE type = 'CONCEPT' AND length(lower(name)) >= 3), tx AS (SELECT id AS doc_id, tenant_id, lower(content) AS t FROM docs)"
query("j11_name_in_text", f"WITH {_CONTAIN} SELECT doc_id, id AS entity_id FROM c JOIN tx USING (tenant_id) WHERE contains(t, low)", "ents", "docs")(lambda g: A.containing(g.entities.where("type = 'CONCEPT'"), g.docs))
query("w05_stale_probe", f"SELECT (SELECT count(*) FROM ents WHERE concept_gen <> '{ACTIVE}') + (SELECT count(*) FROM rels WHERE type = 'USES') > 0 AS stale", "ents", "rels")(lambda g: L.stale_visible(g.entities, ACTIVE, edges=_tagged(g.relations)))

# Upserts, deletions and generations

_NEW = f"""nw AS (SELECT md5(d.tenant_id || ':' || n) AS key, min(e.name) AS name, min(e.type) AS type, max(e.confidence) AS confidence, count(DISTINCT doc_id) AS documents FROM (SELECT *, {NORM % "name"} AS n FROM ext WHERE name IS NOT NULL) e JOIN docs d ON d.id = doc_id WHERE n <> '' AND d.collection = 'episodic' GROUP BY 1),
    od AS (SELECT md5(tenant_id || ':' || norm) AS key, min(name) AS name, min(type) AS type, min(type) AS t, max(confidence) AS confidence, max(concept_gen) AS concept_gen FROM ents WHERE norm <> '' GROUP BY 1)"""
query("m01_upsert_entities", f"WITH {_NEW} SELECT key, coalesce(nw.name, od.name) AS name, coalesce(od.type, nw.type) AS type, CASE WHEN od.type IS NULL OR nw.type IS NULL OR od.type = nw.type THEN 1 ELSE 2 END::BIGINT AS n_types, round(greatest(od.confidence, nw.confidence), 6) AS confidence, CASE WHEN nw.key IS NULL THEN od.concept_gen END AS concept_gen FROM od FULL JOIN nw USING (key)", "ext", "docs", "ents")(lambda g: _upserted(g))


def _old_nodes(g: Graph) -> DataFrame:
    o = g.entities.where("norm <> ''").groupBy(T.entity_key(F.col("tenant_id"), F.col("name")).alias("key"))
    o = o.agg(F.min("name").alias("name"), F.min("type").alias("type"), F.max("confidence").alias("confidence"), F.max("concept_gen").alias("concept_gen"))
    return o.withColumn("types", F.array("type")).withColumn("documents", F.array().cast("array<string>"))


def _new_nodes(g: Graph) -> DataFrame:
    x = _keyed(g).join(g.docs.where("collection = 'episodic'").select(F.col("id").alias("doc_id")), "doc_id", "left_semi")
    return x.groupBy("key").agg(F.min("name").alias("name"), F.min("type").alias("type"), F.max("confidence").alias("confidence"), F.collect_set("doc_id").alias("documents"))


def _upserted(g: Graph) -> DataFrame:
    return A.upsert_entities(_old_nodes(g), _new_nodes(g)).select("key", "name", "type", F.size("types").cast("bigint").alias("n_types"), F.round("confidence", 6).alias("confidence"), "concept_gen")


query("m02_upsert_mentions", "WITH n AS (SELECT doc_id, entity_id, 0.95::DOUBLE AS confidence FROM men JOIN docs d ON d.id = doc_id WHERE collection = 'episodic') SELECT * FROM n UNION ALL SELECT doc_id, entity_id, confidence FROM men ANTI JOIN n USING (doc_id, entity_id)", "men", "docs")(
    lambda g: A.upsert_mentions(g.mentions, g.mentions.join(g.docs.where("collection = 'episodic'").select(F.col("id").alias("doc_id")), "doc_id", "left_semi").withColumn("confidence", F.lit(0.95)))
)
_HALVES = "o AS (SELECT tenant_id, src, dst, type, avg(weight) AS w, list_sort(list(DISTINCT doc_id)) AS f FROM rels WHERE weight IS NOT NULL AND relation_id % 2 = 0 GROUP BY ALL), n AS (SELECT tenant_id, src, dst, type, avg(weight) AS w, list_sort(list(DISTINCT doc_id)) AS f FROM rels WHERE weight IS NOT NULL AND relation_id % 2 = 1 GROUP BY ALL)"
query("m03_upsert_relations", f"WITH {_HALVES} SELECT tenant_id, src, dst, type, round(CASE WHEN o.w IS NULL THEN n.w WHEN n.w IS NULL THEN o.w ELSE (o.w + n.w) / 2 END, 6) AS weight, array_to_string(list_concat(list_filter(coalesce(o.f, []), lambda x: NOT list_contains(coalesce(n.f, []), x)), coalesce(n.f, [])), ',') AS files FROM o FULL JOIN n USING (tenant_id, src, dst, type)", "rels")(lambda g: _merged_relations(g))


def _merged_relations(g: Graph) -> DataFrame:
    half = lambda p: g.relations.where(f"weight IS NOT NULL AND relation_id % 2 = {p}").groupBy("tenant_id", "src", "dst", "type").agg(F.avg("weight").alias("weight"), F.sort_array(F.collect_set("doc_id")).alias("files"))
    return A.upsert_relations(half(0), half(1), ["tenant_id", "src", "dst", "type"]).select("tenant_id", "src", "dst", "type", F.round("weight", 6).alias("weight"), F.concat_ws(",", "files").alias("files"))


query(
    "m04_write_batches",
    "SELECT tenant_id, size, CASE WHEN e + r <= size THEN 1 ELSE ceil(e / size) + ceil(r / size) END::BIGINT AS plans FROM (SELECT tenant_id, (SELECT count(*) FROM ents x WHERE x.tenant_id = t.tenant_id) AS e, (SELECT count(*) FROM rels y WHERE y.tenant_id = t.tenant_id) AS r, unnest([100, 5000]) AS size FROM (SELECT tenant_id FROM ents UNION SELECT tenant_id FROM rels) t)",
    "ents", "rels",
)(lambda g: A.write_plans(g.entities, g.relations, "tenant_id", 100).withColumn("size", F.lit(100)).unionByName(A.write_plans(g.entities, g.relations, "tenant_id").withColumn("size", F.lit(A.WRITE_BATCH))).select("tenant_id", "size", "plans"))
query("m05_upsert_concepts", f"WITH {_NEW} SELECT key, coalesce(od.type, nw.type) AS type, CASE WHEN od.key IS NULL OR (nw.key IS NOT NULL AND od.concept_gen IS NOT NULL) THEN 'g3' ELSE od.concept_gen END AS concept_gen FROM od FULL JOIN nw USING (key)", "ext", "docs", "ents")(lambda g: A.upsert_concepts(_old_nodes(g), _new_nodes(g), "g3").select("key", "type", "concept_gen"))
# a node of a tenant and name for every hit: the TECHNOLOGY nodes of the name, else its first node, else a new one
_FOUND = f"""hit AS (SELECT DISTINCT h.doc_id, d.tenant_id, lower(h.name) AS norm FROM ({_HITS}) h JOIN docs d ON d.id = h.doc_id),
    tec AS (SELECT *, coalesce(type = 'TECHNOLOGY' OR list_contains(types, 'TECHNOLOGY'), false) AS tech FROM ents), named AS (SELECT tenant_id, norm, min(id) AS first, bool_or(tech) AS some FROM tec GROUP BY ALL),
    node AS (SELECT t.tenant_id, t.norm, t.id FROM tec t JOIN named n ON n.tenant_id = t.tenant_id AND n.norm = t.norm WHERE (t.tech OR (NOT n.some AND t.id = n.first)) AND (t.tenant_id, t.norm) IN (SELECT (tenant_id, norm) FROM hit)
        UNION ALL SELECT tenant_id, norm, ('0x' || substr(md5(tenant_id || ':' || norm), 1, 15))::BIGINT FROM (SELECT DISTINCT tenant_id, norm FROM hit) WHERE (tenant_id, norm) NOT IN (SELECT (tenant_id, norm) FROM ents WHERE norm IS NOT NULL)),
    fd AS (SELECT DISTINCT doc_id, id AS entity_id FROM hit JOIN node USING (tenant_id, norm)), tid AS (SELECT id FROM tec WHERE tech UNION SELECT entity_id FROM fd)"""
_M6 = f"{_FOUND}, m AS (SELECT doc_id, entity_id FROM men WHERE entity_id NOT IN (SELECT id FROM tid) UNION SELECT doc_id, entity_id FROM fd)"
query("m06_refresh_mentions", f"WITH {_M6} SELECT doc_id, entity_id FROM m", "docs", "ents", "men")(lambda g: _refreshed(g)["mentions"])
query("m06_refresh_entities", f"WITH {_M6} SELECT id FROM (SELECT id FROM ents UNION SELECT id FROM node) WHERE NOT (id IN (SELECT id FROM tid) AND id NOT IN (SELECT entity_id FROM m) AND id NOT IN (SELECT entity_id FROM prov))", "docs", "ents", "men", "prov")(lambda g: _refreshed(g)["entities"].select("id"))


def _refreshed(g: Graph) -> dict[str, DataFrame]:
    hits = A.technologies(g.docs, PATTERNS).select("doc_id", "name").distinct().join(g.docs.select(F.col("id").alias("doc_id"), "tenant_id"), "doc_id")
    written = L.upsert_technologies(g.entities, hits, g.provenance)
    return L.refresh_technologies(written["entities"], g.mentions, written["found"], written["provenance"])


query("m07_backfill", f"WITH {_CONTAIN}, base AS (SELECT doc_id, entity_id FROM men UNION SELECT doc_id, entity_id FROM prov) SELECT * FROM base UNION SELECT doc_id, id FROM c JOIN tx USING (tenant_id) WHERE contains(t, low) AND id NOT IN (SELECT entity_id FROM base)", "ents", "docs", "men", "prov")(lambda g: L.backfill(g.entities, g.mentions, lambda bare: A.containing(bare, g.docs), g.provenance))
_CO = "co AS (WITH m AS (SELECT DISTINCT d.tenant_id, doc_id, source_key, norm FROM men JOIN ents e ON e.id = entity_id JOIN docs d ON d.id = doc_id WHERE norm IS NOT NULL) SELECT r.tenant_id, src, dst, array_to_string(list_sort(list(DISTINCT a.source_key)), ',') AS keys FROM (SELECT DISTINCT tenant_id, src, dst FROM rels) r JOIN m a ON a.tenant_id = r.tenant_id AND a.norm = src JOIN m b ON b.doc_id = a.doc_id AND b.norm = dst GROUP BY r.tenant_id, src, dst)"
query("m07_backfill_edges", f"WITH {_CO} SELECT tenant_id, src, dst, type, CASE WHEN type <> 'USES' THEN '' ELSE keys END AS files FROM (SELECT DISTINCT tenant_id, src, dst, type FROM rels) LEFT JOIN co USING (tenant_id, src, dst)", "men", "ents", "docs", "rels")(lambda g: _edges_filled(g))


def _edges_filled(g: Graph) -> DataFrame:
    """Edges of type USES without a source, all others with one that is empty text."""
    edges = g.relations.select("tenant_id", "src", "dst", "type").distinct().withColumn("files", F.when(F.col("type") != "USES", F.array(F.lit(""))))
    out = L.backfill_edges(edges, A.co_mentioned(g.relations, g.entities, g.mentions, g.docs))
    return out.select("tenant_id", "src", "dst", "type", F.when(F.col("files").isNotNull(), F.concat_ws(",", "files")).alias("files"))


query("m08_swap", "SELECT 'document' AS kind, id, 3::BIGINT AS dims FROM docs WHERE content <> '' UNION ALL SELECT 'entity', id::VARCHAR, len(vector)::BIGINT FROM evec WHERE vector IS NOT NULL", "docs", "evec")(lambda g: _swapped(g))


def _measured(texts: list[str]) -> list[list[float]]:
    """An embedder for tests: the length and the number of two letters; an empty text has no valid vector."""
    return [[len(t), t.count("a"), t.count("e")] for t in texts]


def _swapped(g: Graph) -> DataFrame:
    """The vectors of the next generation after a swap in a store of its own."""
    import uuid

    from ..session import shared_dir

    store = L.Store(g.spark, f"{shared_dir(g.spark)}/store-{uuid.uuid4().hex}")
    store.publish({"docs": g.docs.select("id", "content", "tenant_id", "collection"), "entity_vectors_v1": g.entity_vectors})
    gen = L.swap_embedder(store, _measured, lambda v: R.similar(v, v, g.docs.select("id", "tenant_id", "collection"), 20, 0.999, generation="v2"))
    dims = F.size("vector").cast("bigint").alias("dims")
    return store.read(f"vectors_{gen}").select(F.lit("document").alias("kind"), "id", dims).unionByName(store.read(f"entity_vectors_{gen}").select(F.lit("entity").alias("kind"), F.col("id").cast("string").alias("id"), dims))


query("m08_carried_vectors", "SELECT id FROM evec WHERE len(vector) = 64 AND list_dot_product(vector, vector) > 0 AND isfinite(list_dot_product(vector, vector))", "evec")(lambda g: L.carried_vectors(g.entity_vectors, 64).select("id"))
query("m09_legacy_vectors", "SELECT id, CASE WHEN id % 2 = 0 OR len(vector) = 64 THEN len(vector) END::BIGINT AS dims FROM evec", "evec")(lambda g: _filled(g))


def _filled(g: Graph) -> DataFrame:
    """Vectors of which only nodes with an even id are of the current generation."""
    current = g.entity_vectors.withColumn("vector", F.when(F.col("id") % 2 == 0, F.col("vector")))
    out = L.backfilled_vectors(current, g.entity_vectors, 64)
    return out.select("id", F.when(F.col("vector").isNotNull(), F.size("vector")).cast("bigint").alias("dims"))


query("m10_concept_flip", f"SELECT 'node' AS kind, id, CASE WHEN concept_gen IS NOT NULL THEN concept_gen = '{ACTIVE}' END AS active FROM ents UNION ALL SELECT 'edge', relation_id, CASE type WHEN 'IS_A' THEN true WHEN 'USES' THEN false END FROM rels", "ents", "rels")(lambda g: _flipped(g))


def _flipped(g: Graph) -> DataFrame:
    """Nodes and edges after a flip that finds the marker it expects, and one that doesn't and so changes nothing."""
    _, nodes, edges, marker = L.flip_concepts(g.entities, _tagged(g.relations), "g1", "g1", ACTIVE)
    done, nodes, edges, _ = L.flip_concepts(nodes, edges, marker, "g1", "g9")
    assert not done
    return nodes.select(F.lit("node").alias("kind"), "id", F.col("concept_gen_active").alias("active")).unionByName(edges.select(F.lit("edge").alias("kind"), F.col("relation_id").alias("id"), F.col("concept_gen_active").alias("active")))


query("m11_stale_concepts", f"SELECT id FROM ents WHERE concept_gen <> '{ACTIVE}' AND id NOT IN (SELECT entity_id FROM men)", "ents", "men")(lambda g: L.stale_concepts(L.flip(g.entities, ACTIVE), g.mentions).select("id"))
query("m12_stale_after_flip", f"SELECT count(*) > 0 AS stale FROM (SELECT concept_gen, CASE WHEN concept_gen IS NOT NULL THEN concept_gen = '{ACTIVE}' END AS active FROM ents) WHERE concept_gen <> '{ACTIVE}' AND active IS DISTINCT FROM false", "ents")(lambda g: L.stale_visible(L.flip(g.entities, ACTIVE), ACTIVE, marked_inactive=True))
_GONE = f"(SELECT id FROM docs WHERE source = '{SOURCE}')"
_D1 = f"m AS (SELECT * FROM men WHERE doc_id NOT IN {_GONE}), p AS (SELECT * FROM prov WHERE doc_id NOT IN {_GONE})"
query("d01_delete_by_metadata", f"WITH {_D1} SELECT id FROM ents WHERE id IN (SELECT entity_id FROM m) OR id IN (SELECT entity_id FROM p)", "docs", "men", "ents", "prov")(lambda g: _deleted(g, False)["entities"].select("id"))
query("d01_delete_source_scoped", f"WITH {_D1} SELECT id FROM ents WHERE NOT tracked OR id IN (SELECT entity_id FROM p)", "docs", "men", "ents", "prov")(lambda g: _deleted(g, True)["entities"].select("id"))
query("d01_mentions_left", f"WITH {_D1} SELECT doc_id, entity_id FROM m", "docs", "men", "ents", "prov")(lambda g: _deleted(g, False)["mentions"].select("doc_id", "entity_id"))


def _deleted(g: Graph, scoped: bool) -> dict[str, DataFrame]:
    return L.delete_points(g.docs, g.entities, g.mentions, g.provenance, F.coalesce(F.col("source") == SOURCE, F.lit(False)), scoped)


query("d02_delete_by_ids", "WITH gone AS (SELECT DISTINCT doc_id FROM rels WHERE type = 'IS_A'), m AS (SELECT * FROM men ANTI JOIN gone USING (doc_id)) SELECT id FROM ents WHERE id IN (SELECT entity_id FROM m)", "rels", "men", "ents")(lambda g: L.delete_ids(g.docs, g.entities, g.mentions, g.relations.where("type = 'IS_A'").select(F.col("doc_id").alias("id")).distinct())["entities"].select("id"))
query("d03_delete_collection", "WITH m AS (SELECT men.* FROM men JOIN docs d ON d.id = doc_id WHERE collection <> 'episodic') SELECT id FROM ents WHERE id IN (SELECT entity_id FROM m)", "docs", "men", "ents")(lambda g: L.delete_ids(g.docs, g.entities, g.mentions, g.docs.where("collection = 'episodic'").select("id"))["entities"].select("id"))
_FILES = f"SELECT r.tenant_id, src, dst, type, CASE type WHEN 'IS_A' THEN '{ACTIVE}' WHEN 'USES' THEN 'g1' END AS concept_gen, list_sort(list(DISTINCT source_key)) AS files FROM rels r JOIN docs d ON d.id = doc_id GROUP BY ALL"
_SCOPES = {"source": (f"x = '{SOURCE}'", {"key": SOURCE}), "chat": ("starts_with(x, 'chat:chat-1')", {"prefix": "chat:chat-1"}), "knowledge_base": ("NOT starts_with(x, 'chat:')", {"knowledge_base": True})}
_OWNED = {"ner": "concept_gen IS NULL", "llm": "concept_gen IS NOT NULL", "both": "true"}
_STRIPPED = "SELECT tenant_id, src, dst, type, len(CASE WHEN t THEN f ELSE files END)::BIGINT AS n FROM (SELECT *, %s AND len(f) < len(files) AS t FROM (SELECT *, list_filter(files, lambda x: NOT (%s)) AS f FROM ed)) WHERE NOT t OR len(f) > 0"
for _scope, (_cond, _args) in _SCOPES.items():
    query(f"d04_strip_{_scope}", f"WITH ed AS ({_FILES}) " + _STRIPPED % ("true", _cond), "rels", "docs")(lambda g, a=_args: _files_left(L.strip_provenance(_edge_files(g), L.in_scope(**a))))


def _files_left(edges: DataFrame) -> DataFrame:
    return edges.select("tenant_id", "src", "dst", "type", F.size("files").cast("bigint").alias("n"))


def _edge_files(g: Graph) -> DataFrame:
    return _tagged(g.relations.join(g.docs.select(F.col("id").alias("doc_id"), "source_key"), "doc_id").groupBy("tenant_id", "src", "dst", "type").agg(F.collect_set("source_key").alias("files")))


_PURGE = f"mine AS (SELECT id FROM docs WHERE source_key = '{SOURCE}'), ties AS (SELECT doc_id, entity_id FROM men UNION SELECT doc_id, entity_id FROM prov), cut AS (SELECT t.doc_id, t.entity_id FROM ties t JOIN ents e ON e.id = entity_id WHERE doc_id IN (FROM mine) AND %s), lft AS (SELECT doc_id, entity_id FROM ties ANTI JOIN cut USING (doc_id, entity_id))"
for _phase, _cond in _OWNED.items():
    query(f"d05_purge_{_phase}", "WITH " + _PURGE % _cond + " SELECT id FROM ents WHERE NOT (id IN (SELECT entity_id FROM cut) AND id NOT IN (SELECT entity_id FROM lft))", "docs", "men", "ents", "prov")(lambda g, p=_phase: _purged(g, p)["entities"].select("id"))
    query(f"d05_purge_{_phase}_ties", "WITH " + _PURGE % _cond + " SELECT 'mention' AS kind, doc_id, entity_id FROM men ANTI JOIN cut USING (doc_id, entity_id) UNION ALL SELECT 'provenance', doc_id, entity_id FROM prov ANTI JOIN cut USING (doc_id, entity_id)", "docs", "men", "ents", "prov")(lambda g, p=_phase: _ties(_purged(g, p)))
    query(f"d05_purge_{_phase}_edges", f"WITH ed AS ({_FILES}) " + _STRIPPED % (_cond, f"x = '{SOURCE}'"), "rels", "docs")(lambda g, p=_phase: _files_left(_purged(g, p)["edges"]))


def _ties(tables: dict[str, DataFrame]) -> DataFrame:
    m, p = (tables[k].select(F.lit(n).alias("kind"), "doc_id", "entity_id") for k, n in (("mentions", "mention"), ("provenance", "provenance")))
    return m.unionByName(p)


def _purged(g: Graph, phase: str) -> dict[str, DataFrame]:
    none = g.spark.createDataFrame([], "src string, dst string, score double")
    return L.purge_source(g.docs, g.entities, g.mentions, _edge_files(g), none, SOURCE, phase, g.provenance)


_NEXT = f"SELECT src, dst FROM (SELECT id AS src, lead(id) OVER (PARTITION BY tenant_id, source_key ORDER BY chunk_index NULLS FIRST, created_at, id) AS dst FROM (SELECT *, max(chunk_index) OVER (PARTITION BY tenant_id, source_key) AS most FROM docs WHERE NOT {_CARD}) WHERE most IS NULL OR chunk_index IS NOT NULL) WHERE dst IS NOT NULL"
_OTHERS = f"SELECT id FROM docs WHERE tenant_id <> '{TENANT}'"


def _everything(g: Graph) -> dict[str, DataFrame]:
    """All tables; the links of consecutive chunks stand for similarity edges."""
    sources = g.docs.select("tenant_id", "source_key").distinct()
    return {"docs": g.docs, "entities": g.entities, "mentions": g.mentions, "provenance": g.provenance, "edges": g.relations, "similar": A.next_edges(g.docs), "collections": g.docs.select("tenant_id", "collection").distinct(), "source_files": sources}


def _listed(tables: dict[str, DataFrame], *names: str) -> DataFrame:
    """(tbl, key): the keys of all rows of some tables."""
    keys = {"docs": ["id"], "entities": ["id"], "mentions": ["doc_id", "entity_id"], "provenance": ["doc_id", "entity_id"], "edges": ["relation_id"], "similar": ["src", "dst"], "collections": ["tenant_id", "collection"], "source_files": ["tenant_id", "source_key"]}
    parts = [tables[n].select(F.lit(n).alias("tbl"), F.concat_ws("|", *[F.col(c).cast("string") for c in keys[n]]).alias("key")) for n in names]
    out = parts[0]
    for p in parts[1:]:
        out = out.unionByName(p)
    return out


query(
    "d06_wipe_tenant_graph",
    f"""WITH o AS ({_OTHERS}), m AS (SELECT * FROM men WHERE doc_id IN (FROM o)), p AS (SELECT * FROM prov WHERE doc_id IN (FROM o)), n AS ({_NEXT})
    SELECT 'docs' AS tbl, id AS key FROM docs UNION ALL SELECT 'entities', id::VARCHAR FROM ents WHERE tenant_id <> '{TENANT}' OR id IN (SELECT entity_id FROM m) OR id IN (SELECT entity_id FROM p) UNION ALL SELECT 'mentions', doc_id || '|' || entity_id FROM m UNION ALL SELECT 'provenance', doc_id || '|' || entity_id FROM p
    UNION ALL SELECT 'edges', relation_id::VARCHAR FROM rels WHERE tenant_id <> '{TENANT}' UNION ALL SELECT 'similar', src || '|' || dst FROM n WHERE src IN (FROM o) AND dst IN (FROM o)""",
    "docs", "ents", "men", "prov", "rels",
)(lambda g: _listed(L.wipe_tenant(_everything(g), TENANT), "docs", "entities", "mentions", "provenance", "edges", "similar"))
query(
    "d07_drop_tenant",
    f"""WITH o AS ({_OTHERS}), m AS (SELECT * FROM men WHERE doc_id IN (FROM o)), dead AS (SELECT id FROM ents WHERE tenant_id = '{TENANT}' AND id NOT IN (SELECT entity_id FROM m)), p AS (SELECT * FROM prov WHERE doc_id IN (FROM o) AND entity_id NOT IN (FROM dead))
    SELECT 'docs' AS tbl, id AS key FROM o UNION ALL SELECT DISTINCT 'collections', tenant_id || '|' || collection FROM docs WHERE tenant_id <> '{TENANT}' UNION ALL SELECT 'entities', id::VARCHAR FROM ents WHERE id NOT IN (FROM dead) UNION ALL SELECT 'mentions', doc_id || '|' || entity_id FROM m
    UNION ALL SELECT 'provenance', doc_id || '|' || entity_id FROM p UNION ALL SELECT DISTINCT 'source_files', tenant_id || '|' || source_key FROM docs WHERE tenant_id <> '{TENANT}'""",
    "docs", "ents", "men", "prov",
)(lambda g: _listed(L.drop_tenant(_everything(g), TENANT), "docs", "collections", "entities", "mentions", "provenance", "source_files"))
query("d08_orphan_sources", "SELECT DISTINCT tenant_id, source_key FROM docs WHERE collection = 'episodic' AND (tenant_id, source_key) NOT IN (SELECT (tenant_id, source_key) FROM docs WHERE collection <> 'episodic')", "docs")(lambda g: L.orphan_sources(g.docs.select("tenant_id", "source_key").distinct(), g.docs.where("collection <> 'episodic'")))
query("d09_delete_batches", "SELECT 'ids' AS kind, ceil(count(*) / 100)::BIGINT AS batches FROM docs", "docs")(lambda g: A.batches(g.docs.select(F.lit("ids").alias("kind")), A.DELETE_BATCH))
query("d10_empty_vectors", "SELECT id, vector IS NULL AS absent FROM evec WHERE vector IS NULL OR len(vector) > 0", "evec")(lambda g: L.without_empty_vectors(g.entity_vectors).select("id", F.col("vector").isNull().alias("absent")))

# Checks

query("v01_integrity", "SELECT 'documents_without_vector' AS check_name, count(*) AS n FROM docs WHERE id NOT IN (SELECT id FROM dvec) UNION ALL SELECT 'entities_without_edge', count(*) FROM ents e WHERE id NOT IN (SELECT entity_id FROM men) AND NOT EXISTS (SELECT 1 FROM rels r WHERE r.tenant_id = e.tenant_id AND (r.src = e.norm OR r.dst = e.norm))".replace("NOT EXISTS (SELECT 1 FROM rels r WHERE r.tenant_id = e.tenant_id AND (r.src = e.norm OR r.dst = e.norm))", "NOT EXISTS (SELECT 1 FROM (SELECT tenant_id, src AS x FROM rels UNION SELECT tenant_id, dst FROM rels) r WHERE r.tenant_id = e.tenant_id AND r.x = e.norm)"), "docs", "dvec", "ents", "men", "rels")(lambda g: C.integrity(g.docs, g.doc_vectors, g.entities, g.mentions, g.relations))
query("v02_complete", f"WITH st AS ({_STATUS}) SELECT source_key, bool_and(state = 'done' AND tag = 'new') AND count(*) FILTER (state = 'done' AND tag = 'new') = 3 AS complete FROM st GROUP BY source_key", "docs")(lambda g: C.complete(g.status(), {p: "new" for p in ("embedding", "ner", "llm")}))
query("v03_plan", f"WITH st AS ({_STATUS}) SELECT source_key, CASE WHEN bool_or(state = 'error') THEN 'resume' WHEN NOT bool_or(phase = 'embedding' AND state = 'done') THEN 'reingest' WHEN bool_and(phase = 'embedding' OR (state = 'done' AND tag = 'new')) THEN 'none' ELSE 'graph' END AS action FROM st GROUP BY source_key", "docs")(lambda g: C.plan(g.status(), {"ner": "new", "llm": "new"}))
query("v04_missing_status", f"WITH st AS ({_STATUS}) SELECT DISTINCT source_key FROM docs WHERE source_key NOT IN (SELECT source_key FROM st)", "docs")(lambda g: C.missing_status(g.docs, g.status()))
query("v05_failed_phases", f"WITH st AS ({_STATUS}) SELECT source_key, string_agg(phase, ',' ORDER BY phase) AS phases FROM st WHERE state = 'error' GROUP BY source_key", "docs")(lambda g: C.failed_phases(g.status()))
query("v08_due_after_transfer", "SELECT DISTINCT source_key FROM docs GROUP BY source_key HAVING max(created_at) < TIMESTAMPTZ '2025-06-01 00:00:00+00'", "docs")(lambda g: C.due_after_transfer(g.docs.groupBy("source_key").agg(F.max("created_at").alias("updated_at")), "2025-06-01 00:00:00"))
query("v09_phases_reset", f"WITH {_ROWS}, {_PTS}, {_ROUTES} SELECT DISTINCT source_key, CASE route WHEN 'resume' THEN 'due' ELSE 'job' END AS action FROM rt WHERE route IN ('resume', 'job')", "docs")(lambda g: S.after_outside_writes(S.routes(_points(g), _phases(g)), _phases(g)))
query("v09_during_transfer", f"WITH {_ROWS}, {_PTS}, {_ROUTES} SELECT DISTINCT source_key, 'job' AS action FROM rt WHERE route = 'job'", "docs")(lambda g: S.after_outside_writes(S.routes(_points(g), _phases(g)), _phases(g), True))
query("v10_embedder_drift", f"SELECT bool_or(embedder_name <> 'old' OR embedder_size <> 64) AS drifted FROM (SELECT DISTINCT CASE WHEN tenant_id = '{TENANT}' AND collection = 'episodic' THEN 'new' ELSE 'old' END AS embedder_name, CASE WHEN tenant_id = '{TENANT}' AND collection = 'episodic' THEN 32 ELSE 64 END AS embedder_size FROM docs)", "docs")(lambda g: C.drifted(S.with_collection(g.docs.select(F.col("collection").alias("name"), "tenant_id").distinct().select("name", "tenant_id", F.lit("old").alias("embedder_name"), F.lit(64).alias("embedder_size")), "episodic", TENANT, "new", 32), "old", 64))

# Extraction pipeline

# every match with its place, as for technologies; of each name of a document the first, and relations of those that are near each other, or of few
_CAPS = """cap AS (SELECT doc_id, name, lower(name) AS key, start, start + length(name) AS "end", d FROM (SELECT doc_id, ms[k] AS name, (list_sum(list_transform(ps[1:k], lambda x: length(x))) + coalesce(list_sum(list_transform(ms[1:k - 1], lambda x: length(x))), 0))::INT AS start, k AS d
        FROM (SELECT doc_id, ms, ps, unnest(range(1, len(ms) + 1)) AS k FROM (SELECT id AS doc_id, regexp_extract_all(content, '[A-Z][a-z]+') AS ms, string_split_regex(content, '[A-Z][a-z]+') AS ps FROM docs)))),
    one AS (SELECT doc_id, key, arg_min(name, d) AS name, min(start) AS start, arg_min("end", d) AS "end" FROM cap GROUP BY ALL)"""
query("x01_extract", f'WITH {_CAPS} SELECT doc_id, name, start, "end", 0.5::DOUBLE AS confidence FROM one', "docs")(lambda g: I.extract(g.docs).select("doc_id", F.explode("entities").alias("e")).select("doc_id", "e.name", F.col("e.start_char").alias("start"), F.col("e.end_char").alias("end"), "e.confidence"))
query(
    "x01_relations",
    f"""WITH {_CAPS}, few AS (SELECT doc_id FROM one GROUP BY doc_id HAVING count(*) <= 10), near AS (SELECT x.doc_id, x.name AS source, y.name AS target, lower(substr(content, x."end" + 1, greatest(0, y.start - x."end"))) AS t FROM one x JOIN one y ON x.doc_id = y.doc_id AND (x.start, x.name) < (y.start, y.name) AND y.start - x."end" < 100 JOIN docs ON id = x.doc_id)
    SELECT doc_id, source, target, CASE WHEN contains(t, 'is a') OR contains(t, 'are a') THEN 'IS_A' WHEN contains(t, 'based on') THEN 'BASED_ON' ELSE 'RELATED_TO' END AS type, 0.6::DOUBLE AS weight FROM near
    UNION ALL SELECT x.doc_id, x.name, y.name, 'CO_OCCURS_WITH', 0.25 FROM one x JOIN one y ON x.doc_id = y.doc_id AND x.start < y.start WHERE x.doc_id IN (FROM few)""",
    "docs",
)(lambda g: I.extract(g.docs).select("doc_id", F.explode("relations").alias("r")).select("doc_id", F.col("r.source_entity").alias("source"), F.col("r.target_entity").alias("target"), F.col("r.relation_type").alias("type"), "r.weight"))


query("x02_graph_rows", f"SELECT md5(tenant_id || ':' || n) AS key, count(DISTINCT id) AS documents FROM (SELECT id, tenant_id, {NORM % 'k'} AS n FROM (SELECT id, tenant_id, unnest(regexp_extract_all(content, '[A-Z][a-z]+')) AS k FROM docs)) WHERE n <> '' GROUP BY 1", "docs")(lambda g: I.graph_rows(I.extract(g.docs))[1].groupBy("key").agg(F.count_distinct("doc_id").alias("documents")))
query(
    "x04_llm_phase",
    f"""WITH t AS (SELECT id, content, {_BLANK} AS blank, length(content) % 7 AS h, nullif(regexp_extract(content, '[A-Z][a-z]+'), '') AS w FROM docs), a AS (SELECT unnest([1, 2]) AS attempt)
    SELECT id AS source_key, attempt, CASE WHEN content IS NULL THEN 'error' WHEN blank THEN 'done' WHEN h = 1 THEN 'not_ready' WHEN h = 2 THEN CASE attempt WHEN 1 THEN 'not_ready' ELSE 'error' END WHEN h = 3 THEN 'not_ready' WHEN h = 4 THEN CASE attempt WHEN 1 THEN 'not_ready' ELSE 'error' END WHEN h = 5 AND w IS NOT NULL THEN 'error' ELSE 'done' END AS state,
        CASE WHEN NOT blank AND h IN (0, 6) THEN w END AS concept FROM t, a""",
    "docs",
)(lambda g: _attempts(g))


def _attempts(g: Graph) -> DataFrame:
    texts = g.docs.select(F.col("id").alias("source_key"), F.col("content").alias("text"))
    said = lambda n: I.concepts(texts, _moody, {"TERM"}, {"USES"}, attempt=n).select("source_key", F.lit(n).alias("attempt"), "state", F.when(F.size("concepts") > 0, F.element_at("concepts", 1)["text"]).alias("concept"))
    return said(1).unionByName(said(2))


query("pred02_conjunction", f"SELECT id FROM docs WHERE metadata->>'$.source' = '{SOURCE}' AND metadata->>'$.chunk_index' = '3'", "docs")(lambda g: g.docs.where(I.conjunction([{"key": "source", "match": SOURCE}, {"key": "chunk_index", "match": 3}])).select("id"))
query("f12_segments", "SELECT id, md5(content) AS text, true AS fit FROM docs WHERE content <> ''", "docs")(lambda g: _segmented(g))


def _moody(text: str) -> str:
    """A model for tests that fails in every way, by the length of the text: breaks down (1), takes too long (2), says nothing (3), says what can't be read (4), or names a relation of an unknown type besides (5)."""
    import json

    h = len(text) % 7
    if h == 1:
        raise ConnectionError
    if h == 2:
        raise TimeoutError
    said = json.loads(_stub(text) or '{"concepts": [], "relations": []}')
    if h == 5 and said["concepts"]:
        said["relations"] = [{"type": "LIKES", "origin": "a", "destination": "b", "text": "c"}]
    return {3: " ", 4: "Sorry, no."}.get(h, json.dumps(said))


def _stub(text: str) -> str:
    """A model for tests: the first capitalised word as its only concept, an empty answer without one."""
    import json
    import re

    m = re.search(r"[A-Z][a-z]+", text)
    return json.dumps({"concepts": [{"type": "TERM", "text": m[0]}], "relations": []}) if m else ""


def _segmented(g: Graph) -> DataFrame:
    import pandas as pd

    from ..functions.extract import segments
    from ..session import ship

    ship(g.spark)

    def run(it):
        for pdf in it:
            rows = [(i, at, len(s), s) for i, t in zip(pdf["id"], pdf["content"]) for at, s in segments(t, 400)]
            if rows:
                yield pd.DataFrame(rows, columns=["id", "at", "n", "part"])

    parts = g.docs.where("content <> ''").select("id", "content").mapInPandas(run, "id string, at bigint, n bigint, part string")
    whole = F.concat_ws("", F.transform(F.sort_array(F.collect_list(F.struct("at", "part"))), lambda x: x["part"]))
    return parts.groupBy("id").agg(F.md5(whole).alias("text"), (F.max("n") <= 400).alias("fit"))


# The rest of the pipeline

query("j02_collection_mentions", f"SELECT doc_id, count(*) AS n FROM men WHERE doc_id IN (SELECT id FROM {_M}) GROUP BY doc_id", "men", "docs")(lambda g: g.mentions.join(g.mine.select(F.col("id").alias("doc_id")), "doc_id", "left_semi").groupBy("doc_id").agg(F.count("*").alias("n")))
query("j12_delete_outer", "SELECT tenant_id, collection FROM (SELECT DISTINCT tenant_id, collection FROM docs) WHERE collection <> 'episodic'", "docs")(lambda g: g.docs.select("tenant_id", "collection").distinct().join(g.docs.where("collection = 'episodic'").select("tenant_id", "collection").distinct(), ["tenant_id", "collection"], "left_anti"))
query("f14_proximity_types", "SELECT type, count(*) AS n FROM (SELECT CASE WHEN contains(t, 'is a') OR contains(t, 'are a') THEN 'IS_A' WHEN contains(t, 'based on') THEN 'BASED_ON' ELSE 'RELATED_TO' END AS type FROM (SELECT lower(content) AS t FROM docs WHERE content IS NOT NULL)) GROUP BY type", "docs")(lambda g: g.docs.where("content IS NOT NULL").groupBy(T.proximity_type(F.col("content")).alias("type")).agg(F.count("*").alias("n")))
query("f17_merged_metadata", "WITH m AS (SELECT entity_id, list(DISTINCT doc_id) AS d, max(confidence) AS c FROM men GROUP BY entity_id) SELECT id, len(list_distinct(list_concat(documents, coalesce(d, []))))::BIGINT AS documents, greatest(confidence, c) AS confidence FROM ents LEFT JOIN m ON entity_id = id", "men", "ents")(lambda g: _merged(g))
query("f22_phase_states", f"WITH st AS ({_STATUS}) SELECT source_key, phase, CASE WHEN state IN ('done', 'skipped', 'not_ready', 'running', 'pending', 'error') THEN state ELSE 'error' END AS state FROM st", "docs")(lambda g: g.status().select("source_key", "phase", F.when(F.col("state").isin(*STATES), F.col("state")).otherwise("error").alias("state")))
query("r01_recall_defaults", f"SELECT id, round(score, 6) AS score FROM (SELECT id, {_COS} AS score FROM dvec ORDER BY score DESC, id LIMIT 10) WHERE score >= 0.7 AND id IN (SELECT id FROM {_M}) ORDER BY score DESC, id LIMIT 5", "docs", "dvec")(lambda g: R.recall(g.mine, g.own_entities, g.mentions, g.own_relations, g.doc_vectors, None, [], g.query_vector(), None, 0.0).select("id", F.round("score", 6).alias("score")))
_ASKED = "Does the Glossary name Redis, redis, a Vector Database or GraphRAG on Azure? Nobody knows of a Rediscovery."
query("r02_query_entities", "SELECT DISTINCT lower(n) AS name FROM (" + " UNION ALL ".join(f"SELECT unnest(regexp_extract_all('{_ASKED}', '(?i){p}', 1)) AS n" for p in _PAT) + ")")(lambda g: I.query_entities(g.spark, _ASKED, EXTRA))
query("x03_source_phase", rf"SELECT md5(tenant_id || ':' || n) AS key, count(DISTINCT id) AS documents FROM (SELECT id, tenant_id, {NORM % 'k'} AS n FROM (SELECT id, tenant_id, unnest(regexp_extract_all(content, '[A-Z][a-z]+')) AS k FROM ({_PROSE}) WHERE source_key = '{SOURCE}')) WHERE n <> '' GROUP BY 1", "docs")(lambda g: I.source_phase(g.docs, SOURCE)[0].select("key", F.size("documents").cast("bigint").alias("documents")))
_GIVEN = f"SELECT tenant_id, source_key, CASE WHEN length(t) > 12000 THEN substr(t, 1, 12000) || ' [truncated]' ELSE t END AS text FROM (SELECT tenant_id, source_key, string_agg(content, chr(10) || chr(10) ORDER BY chunk_index NULLS LAST, id) AS t FROM (SELECT *, coalesce(sum(length(content)) OVER (PARTITION BY tenant_id, source_key ORDER BY chunk_index IS NULL, chunk_index, id ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING), 0) AS before FROM ({_PROSE})) WHERE before <= 12000 GROUP BY ALL)"
query("m13_concept_texts", f"SELECT tenant_id, source_key, md5(text) AS text FROM ({_GIVEN})", "docs")(lambda g: A.accumulated_text(S.prose(g.docs)).select("tenant_id", "source_key", F.md5("text").alias("text")))
query(
    "m13_concept_recompute",
    f"""WITH said AS (SELECT tenant_id, {NORM % "w"} AS n FROM (SELECT tenant_id, nullif(regexp_extract(text, '[A-Z][a-z]+'), '') AS w FROM ({_GIVEN})) WHERE w IS NOT NULL), nw AS (SELECT DISTINCT md5(tenant_id || ':' || n) AS key FROM said),
        od AS (SELECT md5(tenant_id || ':' || norm) AS key, min(type) AS type, max(concept_gen) AS concept_gen FROM ents WHERE norm <> '' GROUP BY 1)
        SELECT key, coalesce(type, 'TERM') AS type, 'g3' AS concept_gen FROM nw LEFT JOIN od USING (key) WHERE od.key IS NULL OR concept_gen IS NOT NULL""",
    "docs", "ents",
)(lambda g: _recomputed(g))
NEEDS = {"embedding": ["parsing"], "ner": ["embedding"], "llm": ["ner"], "similarity": ["embedding"]}
query(
    "v06_dependent_phases",
    "WITH RECURSIVE n(phase, before) AS (VALUES " + ", ".join(f"('{p}', '{b}')" for p, bs in NEEDS.items() for b in bs) + "), r(phase) AS (SELECT unnest(['ner', 'similarity']) UNION SELECT n.phase FROM n JOIN r ON n.before = r.phase) SELECT phase FROM r",
)(lambda g: g.spark.createDataFrame([(p,) for p in C.with_dependents(NEEDS, ["ner", "similarity"])], "phase string"))


def _merged(g: Graph) -> DataFrame:
    m = g.mentions.groupBy(F.col("entity_id").alias("id")).agg(F.collect_set("doc_id").alias("d"), F.max("confidence").alias("c"))
    e = g.entities.join(m, "id", "left")
    documents, confidence = I.merged_metadata(F.col("documents"), F.col("d"), F.col("confidence"), F.col("c"))
    return e.select("id", F.size(documents).cast("bigint").alias("documents"), confidence.alias("confidence"))


def _recomputed(g: Graph) -> DataFrame:
    """Concepts of every source by the stub model, written as a new generation."""
    texts = A.accumulated_text(S.prose(g.docs)).withColumn("k", F.concat_ws("|", "tenant_id", "source_key"))
    said = I.concepts(texts.select(F.col("k").alias("source_key"), "text"), _stub, {"TERM"}, set()).where("state = 'done'")
    found = said.select(F.split("source_key", r"\|")[0].alias("tenant_id"), F.explode("concepts").alias("c")).select(T.entity_key(F.col("tenant_id"), F.col("c.text")).alias("key"), F.col("c.text").alias("name"), F.col("c.type").alias("type"))
    new = found.groupBy("key").agg(F.min("name").alias("name"), F.min("type").alias("type"))
    return A.upsert_concepts(_old_nodes(g), new, "g3").where("concept_gen = 'g3'").select("key", "type", "concept_gen")
