"""Queries over the operators of this subpackage, and the SQL that gives the same rows where there is one."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ..sources.tables import table
from .golay import document_pairs, near_duplicates
from .ivfpq import neighbours
from .language import mislabelled, segments
from .leaks import leaked_items
from .lookalike import lookalike_classes, lookalike_nodes
from .packing import fill, invariants, pack
from .residue import residue
from .together import pair_counts
from .variants import groups, variant_pairs

ARTICLE = r"^(the|a|an)\s+"
BLANKS = r"^[\s\p{Z}\u0085\u001c-\u001f]+|[\s\p{Z}\u0085\u001c-\u001f]+$"


def endpoints(spark: SparkSession, sf_dir: str) -> DataFrame:
    """(grp, basket, item): the names at both ends of each relation of weight 0.3 or more, by tenant and document."""
    rows = table(spark, sf_dir, "extracted_relation").where("weight >= 0.3").select("document_id", F.explode(F.array("source_entity", "target_entity")).alias("name"))
    rows = rows.where("name IS NOT NULL").select("document_id", F.regexp_replace(F.regexp_replace(F.lower("name"), BLANKS, ""), ARTICLE, "").alias("item")).where("item <> ''").distinct()
    docs = table(spark, sf_dir, "document_with_entities").select("document_id", "tenant_id").where("document_id IS NOT NULL AND tenant_id IS NOT NULL").distinct()
    return rows.join(docs, "document_id").select(F.col("tenant_id").alias("grp"), F.col("document_id").alias("basket"), "item")


def _vectors(spark: SparkSession, sf_dir: str) -> DataFrame:
    return table(spark, sf_dir, "entity").select(F.col("entity_id").alias("id"), "embedding")


def p1_found(spark: SparkSession, sf_dir: str) -> DataFrame:
    near = neighbours(_vectors(spark, sf_dir), k=5, probes=4, floor=0.9)
    return near.select(F.least("id", "other").alias("entity_id_a"), F.greatest("id", "other").alias("entity_id_b")).distinct()


def p1_nearest(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The five nearest of every node whose id is divisible by 100, against all nodes."""
    return neighbours(_vectors(spark, sf_dir), k=5, probes=48, depth=64, queries="id % 100 = 0").select("id", "other", F.round("cosine", 6).alias("cosine"), "rank")


def p1_every(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The five nearest of every node, however far they are."""
    return neighbours(_vectors(spark, sf_dir), k=5, probes=16, depth=24).select("id", "other", F.round("cosine", 6).alias("cosine"), "rank")


def p2_counts(spark: SparkSession, sf_dir: str) -> DataFrame:
    out = pair_counts(endpoints(spark, sf_dir))
    return out.select(F.col("grp").alias("tenant_id"), F.col("item_a").alias("name_a"), F.col("item_b").alias("name_b"), "n_ab", "n_a", "n_b", "n", F.round("lift", 6).alias("lift"))


def p2_found(spark: SparkSession, sf_dir: str) -> DataFrame:
    return p2_counts(spark, sf_dir).select("tenant_id", "name_a", "name_b")


def p3_found(spark: SparkSession, sf_dir: str) -> DataFrame:
    return mislabelled(table(spark, sf_dir, "document_with_entities")).select("document_id", "lang")


def p3_segments(spark: SparkSession, sf_dir: str) -> DataFrame:
    return segments(table(spark, sf_dir, "document_with_entities"))


def p4_found(spark: SparkSession, sf_dir: str) -> DataFrame:
    return lookalike_nodes(table(spark, sf_dir, "entity"))


def p4_classes(spark: SparkSession, sf_dir: str) -> DataFrame:
    return lookalike_classes(table(spark, sf_dir, "entity"))


def names_of_people(spark: SparkSession, sf_dir: str) -> DataFrame:
    """(tenant_id, kind, name): the stored names of persons and organisations, of nodes and of extractions."""
    kinds = F.col("entity_type").isin("PERSON", "ORGANIZATION")
    nodes = table(spark, sf_dir, "entity").where(kinds).select("tenant_id", F.col("entity_type").alias("kind"), "name")
    docs = table(spark, sf_dir, "document_with_entities").select("document_id", "tenant_id").distinct()
    found = table(spark, sf_dir, "extracted_entity").where(kinds).select("document_id", F.col("entity_type").alias("kind"), "name").distinct().join(docs, "document_id")
    return nodes.unionByName(found.select("tenant_id", "kind", "name"))


def p5_groups(spark: SparkSession, sf_dir: str) -> DataFrame:
    return groups(names_of_people(spark, sf_dir))


def p5_found(spark: SparkSession, sf_dir: str) -> DataFrame:
    return variant_pairs(p5_groups(spark, sf_dir))


def p7_found(spark: SparkSession, sf_dir: str) -> DataFrame:
    return document_pairs(*near_duplicates(table(spark, sf_dir, "document_with_entities"), n=3, similarity=0.5, least=10))


def p7_classes(spark: SparkSession, sf_dir: str) -> DataFrame:
    """One row for each document: its class of equal texts and the number of classes linked to it, at five words and 0.8."""
    members, links = near_duplicates(table(spark, sf_dir, "document_with_entities"))
    ends = links.select(F.explode(F.array("rep_a", "rep_b")).alias("rep")).groupBy("rep").agg(F.count("*").alias("links"))
    return members.join(ends, "rep", "left").select("document_id", "rep", F.coalesce("links", F.lit(0)).alias("links"))


def _capacity(spark: SparkSession, sf_dir: str, window: str) -> int:
    return table(spark, sf_dir, "context_window").where(F.col("window_name") == window).first()["capacity_tokens"]


def p8_pack(spark: SparkSession, sf_dir: str) -> DataFrame:
    return pack(table(spark, sf_dir, "documents"), _capacity(spark, sf_dir, "medium"))


def p8_fill(spark: SparkSession, sf_dir: str) -> DataFrame:
    return fill(p8_pack(spark, sf_dir), _capacity(spark, sf_dir, "medium"))


def p8_invariants(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Texts that have a place, and breaches of the rules, of which there must be none."""
    return invariants(p8_pack(spark, sf_dir), _capacity(spark, sf_dir, "medium"))


def p9_found(spark: SparkSession, sf_dir: str) -> DataFrame:
    return leaked_items(table(spark, sf_dir, "documents"), table(spark, sf_dir, "eval_item"))


def p10_found(spark: SparkSession, sf_dir: str) -> DataFrame:
    return residue(table(spark, sf_dir, "documents")).select("doc_id")


def p10_kinds(spark: SparkSession, sf_dir: str) -> DataFrame:
    return residue(table(spark, sf_dir, "documents")).select("doc_id", "kind", F.round("coverage", 6).alias("coverage"), F.size("spans").alias("n_spans"))


def p10_spans(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Where the residue of each such text lies."""
    return residue(table(spark, sf_dir, "documents")).select("doc_id", F.explode("spans").alias("s")).select("doc_id", "s.start", "s.end", "s.kind")


QUERIES = {"p8_pack": p8_pack, "p8_fill": p8_fill, "p8_invariants": p8_invariants, "p1_found": p1_found, "p1_nearest": p1_nearest, "p1_every": p1_every, "p5_found": p5_found, "p5_groups": p5_groups, "p3_found": p3_found, "p3_segments": p3_segments, "p10_found": p10_found, "p10_kinds": p10_kinds, "p10_spans": p10_spans, "p2_found": p2_found, "p2_counts": p2_counts, "p4_found": p4_found, "p4_classes": p4_classes, "p7_found": p7_found, "p7_classes": p7_classes, "p9_found": p9_found}
_PAIRS = r"""WITH r AS (SELECT DISTINCT document_id, unnest([source_entity, target_entity]) AS name FROM extracted_relation WHERE weight >= 0.3),
        b AS (SELECT DISTINCT tenant_id, document_id, regexp_replace(regexp_replace(lower(name), '^[\s\pZ]+|[\s\pZ]+$', '', 'g'), '^(the|a|an)\s+', '') AS item
            FROM r JOIN (SELECT DISTINCT document_id, tenant_id FROM document_with_entities) USING (document_id) WHERE name IS NOT NULL),
        k AS (SELECT * FROM b WHERE item <> ''), t AS (SELECT tenant_id, count(DISTINCT document_id) AS n FROM k GROUP BY tenant_id),
        f AS (SELECT tenant_id, item, count(*) AS c FROM k GROUP BY ALL),
        p AS (SELECT x.tenant_id, x.item AS name_a, y.item AS name_b, count(*) AS n_ab FROM k x JOIN k y ON x.document_id = y.document_id AND x.item < y.item GROUP BY ALL HAVING count(*) >= 5)
        SELECT p.tenant_id, name_a, name_b, n_ab, fa.c AS n_a, fb.c AS n_b, n, round(n_ab * n / fa.c / fb.c, 6) AS lift
        FROM p JOIN t USING (tenant_id) JOIN f fa ON fa.tenant_id = p.tenant_id AND fa.item = name_a JOIN f fb ON fb.tenant_id = p.tenant_id AND fb.item = name_b
        WHERE n_ab * n >= 4 * fa.c * fb.c"""

SQL: dict[str, str] = {
    "p2_counts": _PAIRS,
    "p2_found": f"SELECT tenant_id, name_a, name_b FROM ({_PAIRS})",
    "p8_invariants": "SELECT count(DISTINCT doc_id) AS texts, 0::BIGINT AS overfull, 0::BIGINT AS overlapping, 0::BIGINT AS cut_without_need FROM documents WHERE doc_id IS NOT NULL AND text <> ''",
    "p1_found": """WITH e AS (SELECT entity_id AS id, any_value(embedding)::DOUBLE[] AS v FROM entity WHERE len(embedding) = 64 GROUP BY entity_id), u AS (SELECT * FROM e WHERE isfinite(list_dot_product(v, v)) AND list_dot_product(v, v) > 0),
        s AS (SELECT a.id AS a, b.id AS b, list_cosine_similarity(a.v, b.v) AS c FROM u a JOIN u b ON a.id <> b.id), r AS (SELECT *, row_number() OVER (PARTITION BY a ORDER BY c DESC, b) AS k FROM s WHERE c >= 0.9)
        SELECT DISTINCT least(a, b) AS entity_id_a, greatest(a, b) AS entity_id_b FROM r WHERE k <= 5""",
    "p1_nearest": """WITH e AS (SELECT entity_id AS id, any_value(embedding)::DOUBLE[] AS v FROM entity WHERE len(embedding) = 64 GROUP BY entity_id), u AS (SELECT * FROM e WHERE isfinite(list_dot_product(v, v)) AND list_dot_product(v, v) > 0),
        s AS (SELECT a.id, b.id AS other, list_cosine_similarity(a.v, b.v) AS c FROM u a JOIN u b ON a.id <> b.id WHERE a.id % 100 = 0), r AS (SELECT *, CAST(row_number() OVER (PARTITION BY id ORDER BY c DESC, other) AS INT) AS rank FROM s)
        SELECT id, other, round(c, 6) AS cosine, rank FROM r WHERE rank <= 5""",
    "p7_found": r"""WITH d AS (SELECT DISTINCT document_id AS id, regexp_extract_all(lower(content), '[\pL\pN]+') AS w FROM document_with_entities WHERE content IS NOT NULL),
        g AS (SELECT DISTINCT id, unnest(list_transform(range(1, len(w) - 1), lambda k: array_to_string(w[k:k+2], ' '))) AS s FROM d), n AS (SELECT id, count(*) AS c FROM g GROUP BY id HAVING count(*) >= 10),
        p AS (SELECT a.id AS a, b.id AS b, count(*) AS k FROM g a JOIN g b ON a.s = b.s AND a.id < b.id GROUP BY ALL)
        SELECT a AS document_id_a, b AS document_id_b FROM p JOIN n x ON x.id = a JOIN n y ON y.id = b WHERE 2 * k >= x.c + y.c - k""",
    "p7_classes": r"""WITH d AS (SELECT DISTINCT document_id AS id, regexp_extract_all(lower(content), '[\pL\pN]+') AS w FROM document_with_entities WHERE content IS NOT NULL),
        g AS (SELECT DISTINCT id, unnest(list_transform(range(1, len(w) - 3), lambda k: array_to_string(w[k:k+4], ' '))) AS s FROM d), n AS (SELECT id, count(*) AS c, md5(string_agg(s, '|' ORDER BY s)) AS k FROM g GROUP BY id),
        r AS (SELECT id, c, min(id) OVER (PARTITION BY c, k) AS rep FROM n), h AS (SELECT g.id, s, c FROM g JOIN r ON r.id = g.id AND r.rep = r.id),
        p AS (SELECT a.id AS a, a.c AS ca, b.c AS cb, count(*) AS k FROM h a JOIN h b ON a.s = b.s AND a.id <> b.id GROUP BY a.id, b.id, a.c, b.c), l AS (SELECT a AS rep, count(*) AS links FROM p WHERE 5 * k >= 4 * (ca + cb - k) GROUP BY a)
        SELECT id AS document_id, rep, coalesce(links, 0) AS links FROM r LEFT JOIN l USING (rep)""",
    "p9_found": r"""WITH d AS (SELECT doc_id, regexp_extract_all(lower(text), '[\pL\pN]+') AS w FROM documents WHERE text IS NOT NULL),
        i AS (SELECT item_id, regexp_extract_all(lower(text), '[\pL\pN]+') AS w FROM eval_item WHERE text IS NOT NULL),
        dg AS (SELECT doc_id, unnest(list_transform(range(1, len(w) - 10), lambda k: array_to_string(w[k:k+11], ' '))) AS g FROM d),
        ig AS (SELECT item_id, unnest(list_transform(range(1, len(w) - 10), lambda k: array_to_string(w[k:k+11], ' '))) AS g FROM i)
        SELECT DISTINCT doc_id, item_id FROM dg JOIN ig USING (g)""",
}
