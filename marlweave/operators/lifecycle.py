"""Deletion, pruning, refresh and generations: pure functions from old tables to new ones, and the versioned store that publishes them."""

from __future__ import annotations

import json
import uuid
from collections.abc import Callable

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from ..functions.text import entity_key, normalize_name
from ..functions.vectors import is_valid
from ..session import materialize, ship


def without(rows: DataFrame, gone: DataFrame, key: str, gone_key: str = "id") -> DataFrame:
    """The rows whose key isn't gone."""
    return rows.join(gone.select(F.col(gone_key).alias(key)).distinct(), key, "left_anti")


def orphans(entities: DataFrame, mentions: DataFrame, provenance: DataFrame | None = None, tracked_only: bool = False) -> DataFrame:
    """Nodes without a mention and, where given, without provenance; tracked_only: tracked nodes without provenance, mentions don't count."""
    if tracked_only:
        return entities.where("tracked").join(provenance.select(F.col("entity_id").alias("id")).distinct(), "id", "left_anti")
    out = entities.join(mentions.select(F.col("entity_id").alias("id")).distinct(), "id", "left_anti")
    return out.join(provenance.select(F.col("entity_id").alias("id")).distinct(), "id", "left_anti") if provenance is not None else out


def isolated(entities: DataFrame, mentions: DataFrame, edges: DataFrame) -> DataFrame:
    """Nodes without any edge: no mention, and no relation of their name in their tenant."""
    ends = edges.select("tenant_id", F.explode(F.array("src", "dst")).alias("norm")).distinct()
    return orphans(entities, mentions).join(ends, ["tenant_id", "norm"], "left_anti")


def delete_points(docs: DataFrame, entities: DataFrame, mentions: DataFrame, provenance: DataFrame, gone: Column, source_scoped: bool) -> dict[str, DataFrame]:
    """The tables after deleting the documents for which gone holds, with their mentions and provenance, and the nodes that this orphans.

    Scoped to a source only tracked nodes without provenance go, else any without mention and provenance."""
    ids = docs.where(gone).select("id")
    m, p = without(mentions, ids, "doc_id"), without(provenance, ids, "doc_id")
    dead = orphans(entities, m, p, tracked_only=source_scoped)
    return {"docs": without(docs, ids, "id"), "mentions": without(m, dead, "entity_id"), "provenance": without(p, dead, "entity_id"), "entities": without(entities, dead, "id")}


def delete_ids(docs: DataFrame, entities: DataFrame, mentions: DataFrame, ids: DataFrame) -> dict[str, DataFrame]:
    """The tables after deleting documents by id and sweeping nodes without a mention."""
    m = without(mentions, ids, "doc_id")
    return {"docs": without(docs, ids, "id"), "mentions": m, "entities": without(entities, orphans(entities, m), "id")}


#: Fixed value: what the provenance keys of chats begin with.
CHAT_PREFIX = "chat:"


def in_scope(key: str | None = None, prefix: str | None = None, knowledge_base: bool = False) -> Callable[[Column], Column]:
    """A condition on a provenance key: one source's key, every key with a prefix (a chat), or every key outside chats."""

    def removed(file: Column) -> Column:
        out = F.lit(False)
        out = out | (file == key) if key is not None else out
        out = out | F.startswith(file, F.lit(prefix)) if prefix is not None else out
        return out | ~F.startswith(file, F.lit(CHAT_PREFIX)) if knowledge_base else out

    return removed


def _of_phase(rows: DataFrame, phase: str) -> Column:
    """The rows that a phase made: ner the untagged ones, llm those with a generation, both all."""
    tagged = F.col("concept_gen").isNotNull() if "concept_gen" in rows.columns else F.lit(False)
    return {"ner": ~tagged, "llm": tagged, "both": F.lit(True)}[phase]


def strip_provenance(edges: DataFrame, removed: Callable[[Column], Column], phase: str = "both") -> DataFrame:
    """Edges (…, files, concept_gen) without the removed keys; an edge of the phase that this leaves without keys goes, all others stay."""
    touched = F.coalesce(F.exists("files", removed), F.lit(False)) & _of_phase(edges, phase)
    kept = F.filter("files", lambda f: ~removed(f))
    return edges.where(~touched | (F.size(kept) > 0)).withColumn("files", F.when(touched, kept).otherwise(F.col("files")))


def purge_source(docs: DataFrame, entities: DataFrame, mentions: DataFrame, edges: DataFrame, similar: DataFrame, source_key: str, phase: str = "both", provenance: DataFrame | None = None) -> dict[str, DataFrame]:
    """The graph without what one source's phase made: ner (base nodes and edges), llm (tagged ones) or both. Documents stay.

    Mentions and provenance of the source's documents to nodes of the phase go, then those of their nodes that have
    neither left, and the keys of the source on edges of the phase; similarity edges go unless only the LLM phase is purged."""
    mine = docs.where(F.col("source_key") == source_key).select("id")
    owned = entities.where(_of_phase(entities, phase)).select(F.col("id").alias("entity_id"))
    ties = mentions.select("doc_id", "entity_id") if provenance is None else mentions.select("doc_id", "entity_id").unionByName(provenance.select("doc_id", "entity_id"))
    gone = ties.join(mine.withColumnRenamed("id", "doc_id"), "doc_id", "left_semi").join(owned, "entity_id", "left_semi").select("doc_id", "entity_id").distinct()
    left = ties.join(gone, ["doc_id", "entity_id"], "left_anti")
    dead = gone.select(F.col("entity_id").alias("id")).distinct().join(left.select(F.col("entity_id").alias("id")), "id", "left_anti")
    s = similar if phase == "llm" else similar.join(mine.withColumnRenamed("id", "src"), "src", "left_anti").join(mine.withColumnRenamed("id", "dst"), "dst", "left_anti")
    out = {"entities": without(entities, dead, "id"), "mentions": mentions.join(gone, ["doc_id", "entity_id"], "left_anti"), "edges": strip_provenance(edges, in_scope(key=source_key), phase), "similar": s}
    return out if provenance is None else out | {"provenance": provenance.join(gone, ["doc_id", "entity_id"], "left_anti")}


def wipe_tenant(tables: dict[str, DataFrame], tenant: str) -> dict[str, DataFrame]:
    """docs, entities, mentions, provenance, edges and similar without what was derived for a tenant: relations, mentions, provenance, similarity edges, then its nodes without any edge. Documents stay."""
    other = lambda df: df.where(F.col("tenant_id") != tenant)
    ids = tables["docs"].where(F.col("tenant_id") == tenant).select("id")
    out = tables | {k: without(tables[k], ids, "doc_id") for k in ("mentions", "provenance")} | {"edges": other(tables["edges"]), "similar": without(without(tables["similar"], ids, "src"), ids, "dst")}
    ties = out["mentions"].select(F.col("entity_id").alias("id")).unionByName(out["provenance"].select(F.col("entity_id").alias("id"))).distinct()
    mine = tables["entities"].where(F.col("tenant_id") == tenant)
    ends = out["edges"].select("tenant_id", F.explode(F.array("src", "dst")).alias("norm")).distinct()
    return out | {"entities": other(tables["entities"]).unionByName(mine.join(ties, "id", "left_semi").unionByName(mine.join(ties, "id", "left_anti").join(ends, ["tenant_id", "norm"], "left_semi").select(*mine.columns)))}


def drop_tenant(tables: dict[str, DataFrame], tenant: str) -> dict[str, DataFrame]:
    """docs, collections, entities, mentions, provenance and source_files without the data of a tenant: its documents and collections, its nodes that no mention is left of, and its source files without a document."""
    ids = tables["docs"].where(F.col("tenant_id") == tenant).select("id")
    out = tables | {"docs": without(tables["docs"], ids, "id"), "collections": tables["collections"].where(F.col("tenant_id") != tenant)} | {k: without(tables[k], ids, "doc_id") for k in ("mentions", "provenance")}
    dead = orphans(tables["entities"].where(F.col("tenant_id") == tenant), out["mentions"])
    files = tables["source_files"]
    lone = orphan_sources(files.where(F.col("tenant_id") == tenant), out["docs"])
    return out | {"entities": without(tables["entities"], dead, "id"), "source_files": files.join(lone, ["tenant_id", "source_key"], "left_anti"), "provenance": without(out["provenance"], dead, "entity_id")}


def orphan_sources(source_files: DataFrame, docs: DataFrame) -> DataFrame:
    """Source files (tenant_id, source_key) without a document."""
    return source_files.join(docs.select("tenant_id", "source_key").distinct(), ["tenant_id", "source_key"], "left_anti")


def _technology(entities: DataFrame) -> Column:
    """Whether a node is a TECHNOLOGY by its type or, where it has them, one of its types."""
    own = F.col("type") == "TECHNOLOGY"
    return F.coalesce(own | F.array_contains("types", "TECHNOLOGY") if "types" in entities.columns else own, F.lit(False))


def upsert_technologies(entities: DataFrame, hits: DataFrame, provenance: DataFrame, confidence: float = 0.85) -> dict[str, DataFrame]:
    """Nodes and provenance after writing the technologies that were found, and found (doc_id, entity_id): the node of each hit.

    hits has doc_id, tenant_id and name. A node is known by tenant and normalized name: a hit goes to the TECHNOLOGY nodes
    of its name, else to the first node of it, which keeps its type and gains TECHNOLOGY among its types, else to a new
    one. As source document a node gains the first of its hits; provenance has them all."""
    place = ["tenant_id", "norm"]
    hits = materialize(hits.select("doc_id", "tenant_id", normalize_name(F.col("name")).alias("norm")).where("norm <> ''").distinct(), "technologies")
    terms = hits.groupBy(*place).agg(F.min("doc_id").alias("_doc"))
    held = entities.select("id", *place, _technology(entities).alias("tech")).join(terms, place)
    first = held.groupBy(*place).agg(F.min("id").alias("first"), F.max("tech").alias("some"))
    old = held.join(first, place).where("tech OR (NOT some AND id = first)").select("id", *place, "_doc")
    key = entity_key(F.col("tenant_id"), F.col("norm"))
    numbers = dict(entities.dtypes)["id"] != "string"
    new = terms.join(first, place, "left_anti").select((F.conv(F.substring(key, 1, 15), 16, 10).cast("bigint") if numbers else key).alias("id"), *place, "_doc")
    there = F.col("_name").isNotNull()
    kept = entities.join(old.select("id", F.col("norm").alias("_name"), "_doc"), "id", "left")
    kept = kept.withColumns({
        "name": F.coalesce("_name", "name"), "type": F.when(there, F.coalesce("type", F.lit("TECHNOLOGY"))).otherwise(F.col("type")), "types": F.when(there, F.array_union(F.coalesce("types", F.array().cast("array<string>")), F.array(F.lit("TECHNOLOGY")))).otherwise(F.col("types")),
        "confidence": F.when(there, F.greatest("confidence", F.lit(confidence))).otherwise(F.col("confidence")), "documents": F.when(there, F.array_union("documents", F.array("_doc"))).otherwise(F.col("documents")), "tracked": there | F.col("tracked"),
    }).drop("_name", "_doc")
    made = new.select("id", *place, F.col("norm").alias("name"), F.lit("TECHNOLOGY").alias("type"), F.array(F.lit("TECHNOLOGY")).alias("types"), F.lit(confidence).alias("confidence"), F.array("_doc").alias("documents"), F.lit(True).alias("tracked"))
    found = materialize(hits.join(old.select("id", *place).unionByName(new.select("id", *place)), place).select("doc_id", F.col("id").alias("entity_id")).distinct(), "technology-mentions")
    return {"entities": kept.unionByName(made, allowMissingColumns=True), "provenance": provenance.select("doc_id", "entity_id").unionByName(found).distinct(), "found": found}


def refresh_technologies(entities: DataFrame, mentions: DataFrame, found: DataFrame, provenance: DataFrame) -> dict[str, DataFrame]:
    """Mentions and nodes after extracting technologies anew. found has doc_id and entity_id of all current hits, whose nodes are there (upsert_technologies).

    Mentions of TECHNOLOGY nodes (by type or types) that weren't found again go; TECHNOLOGY nodes with neither mention nor
    provenance are pruned; nothing else changes, and a second run changes nothing."""
    tech = entities.where(_technology(entities))
    stale = mentions.join(tech.select(F.col("id").alias("entity_id")), "entity_id", "left_semi").join(found, ["doc_id", "entity_id"], "left_anti").select("doc_id", "entity_id")
    m = mentions.join(stale, ["doc_id", "entity_id"], "left_anti").select("doc_id", "entity_id").unionByName(found.select("doc_id", "entity_id")).distinct()
    dead = orphans(tech, m, provenance)
    return {"mentions": m, "entities": without(entities, dead, "id")}


def backfill(entities: DataFrame, mentions: DataFrame, contained: Callable[[DataFrame], DataFrame], provenance: DataFrame) -> DataFrame:
    """(doc_id, entity_id): provenance from mentions, and for concepts without any from texts that contain them.

    contained gives (doc_id, entity_id), each pair once, of the nodes it is called with; it is asked for the concepts without provenance only,
    so that pairs of the others are never made."""
    base = materialize(mentions.select("doc_id", "entity_id").unionByName(provenance.select("doc_id", "entity_id")).distinct(), "provenance")
    bare = entities.where("type = 'CONCEPT'").join(base.select(F.col("entity_id").alias("id")).distinct(), "id", "left_anti")
    return base.unionByName(contained(bare).select("doc_id", "entity_id"))  # no node is in both


def backfill_edges(edges: DataFrame, co_mentioned: DataFrame) -> DataFrame:
    """Edges (tenant_id, src, dst, …, files) where those without a source get the sources of the documents that mention both ends.

    co_mentioned has tenant_id, src, dst and keys (comma-separated, as co_mentioned() gives them)."""
    keys = co_mentioned.select("tenant_id", "src", "dst", F.split("keys", ",").alias("_keys"))
    bare = F.col("files").isNull() | (F.size("files") == 0)
    out = edges.join(keys, ["tenant_id", "src", "dst"], "left")
    return out.withColumn("files", F.when(bare, F.coalesce("_keys", "files")).otherwise(F.col("files"))).drop("_keys")


def carried_vectors(old: DataFrame, dims: int) -> DataFrame:
    """Vectors that a new generation can carry on: valid and of the new size."""
    return old.where(is_valid(F.col("vector")) & (F.size("vector") == dims))


def reembedded(docs: DataFrame, embed: Callable[[list[str]], list[list[float]]]) -> DataFrame:
    """(id, vector): the contents embedded anew, in batches; a null content counts as empty, and invalid vectors are left out."""
    from collections.abc import Iterator

    import pandas as pd

    ship(docs.sparkSession)

    def run(it: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for pdf in it:
            if len(pdf):
                yield pd.DataFrame({"id": pdf["id"], "vector": [list(map(float, v)) for v in embed([t or "" for t in pdf["content"]])]})

    out = docs.select("id", "content").mapInPandas(run, "id string, vector array<double>")
    return out.where(is_valid(F.col("vector")))


def swap_embedder(store: Store, embed: Callable[[list[str]], list[list[float]]], link: Callable[[DataFrame], DataFrame]) -> str:
    """Makes the next generation of vectors beside the current one, flips to it and drops the old one; returns its name.

    Of the store's tables it reads docs and entity_vectors_<gen>, and writes vectors_<gen> from the contents,
    entity_vectors_<gen> carried over as they are, and similar_<gen>, the links that `link` makes of the new vectors. A
    reader sees the old generation or the new one, never a mixture; of two swaps at once the second fails."""
    before = store.manifest()
    old = before.get("generation", "v1")
    new = f"v{int(old[1:]) + 1}"
    vectors = materialize(reembedded(store.read("docs", before), embed), "new-vectors")
    tables = {f"vectors_{new}": vectors, f"similar_{new}": link(vectors)}
    if f"entity_vectors_{old}" in before["tables"]:
        tables[f"entity_vectors_{new}"] = store.read(f"entity_vectors_{old}", before).where("vector IS NOT NULL")
    version = store.publish(tables, expected=before["version"], facts={"generation": new})
    store.publish({}, expected=version, drop=[t for t in before["tables"] if t.endswith(f"_{old}")])
    return new


def backfilled_vectors(current: DataFrame, legacy: DataFrame, dims: int) -> DataFrame:
    """(id, vector): the vectors of the current generation, and where there is none the legacy one if it has the current size."""
    old = legacy.where(F.size("vector") == dims).select("id", F.col("vector").alias("_old"))
    return current.join(old, "id", "left").select("id", F.coalesce("vector", "_old").alias("vector"))


def without_empty_vectors(vectors: DataFrame) -> DataFrame:
    """Vectors without the empty ones; null ones stay."""
    return vectors.where(F.col("vector").isNull() | (F.size("vector") > 0))


def flip(rows: DataFrame, generation: str) -> DataFrame:
    """Nodes or edges with concept_gen_active after the flip: false on other generations, null on base ones."""
    return rows.withColumn("concept_gen_active", F.when(F.col("concept_gen").isNotNull(), F.col("concept_gen") == generation))


def flip_concepts(entities: DataFrame, edges: DataFrame, marker: str | None, expected: str | None, new: str) -> tuple[bool, DataFrame, DataFrame, str | None]:
    """(flipped, nodes, edges, marker): the flip to a new generation, if the marker still is what was expected (None: no marker); else nothing changes."""
    if marker != expected:
        return False, entities, edges, marker
    return True, flip(entities, new), flip(edges, new), new


def stale_concepts(flipped: DataFrame, mentions: DataFrame) -> DataFrame:
    """Inactive concepts without a mention."""
    return orphans(flipped.where("NOT concept_gen_active"), mentions)


def stale_visible(entities: DataFrame, active: str, marked_inactive: bool = False, edges: DataFrame | None = None) -> DataFrame:
    """One row (stale boolean): whether a node, or an edge, of another generation isn't marked inactive; each is looked for until the first."""
    other = F.col("concept_gen").isNotNull() & (F.col("concept_gen") != active)
    hit = other & (~F.coalesce(F.col("concept_gen_active") == F.lit(False), F.lit(False)) if marked_inactive else F.lit(True))
    live = entities.where(hit).select("concept_gen").limit(1)
    live = live if edges is None else live.unionByName(edges.where(hit).select("concept_gen").limit(1))
    return live.agg((F.count("*") > 0).alias("stale"))


class Store:
    """Tables in versioned folders. Each publication writes manifest-<n>.json, which names the version of every table; the highest n that is complete is current.

    A manifest is created only if there is none of its number, so of two writers one fails, and none is ever replaced or
    removed before the next one stands: a reader always finds one, resolves it once and keeps its snapshot."""

    KEPT = 5  # manifests that stay for readers who are behind

    def __init__(self, spark: SparkSession, root: str) -> None:
        self.spark, self.root = spark, root.rstrip("/")
        jvm = spark._jvm
        self._path = jvm.org.apache.hadoop.fs.Path
        self._fs = self._path(self.root).getFileSystem(spark._jsc.hadoopConfiguration())

    def _numbers(self) -> list[int]:
        if not self._fs.exists(self._path(self.root)):
            return []
        names = [f.getPath().getName() for f in self._fs.listStatus(self._path(self.root))]
        return sorted((int(n[9:-5]) for n in names if n.startswith("manifest-") and n.endswith(".json") and n[9:-5].isdecimal()), reverse=True)

    def manifest(self) -> dict:
        """The current manifest: version, tables and facts; version 0 without tables before the first publication."""
        for n in self._numbers():
            stream = self._fs.open(self._path(f"{self.root}/manifest-{n}.json"))
            try:
                return json.loads(self.spark._jvm.org.apache.commons.io.IOUtils.toString(stream, "UTF-8"))
            except ValueError:  # still being written
                continue
            finally:
                stream.close()
        return {"version": 0, "tables": {}}

    def read(self, name: str, manifest: dict | None = None) -> DataFrame:
        return self.spark.read.parquet((manifest or self.manifest())["tables"][name])

    def publish(self, tables: dict[str, DataFrame], expected: int | None = None, facts: dict | None = None, drop: list[str] | None = None) -> int:
        """Writes new versions and the next manifest; fails if another version than the expected one is current, or becomes so meanwhile.

        facts are kept in the manifest; drop names tables that it no longer lists."""
        written = {}
        for name, df in tables.items():
            written[name] = f"{self.root}/{name}/v-{uuid.uuid4().hex}"
            df.write.parquet(written[name])
        now = self.manifest()
        if expected is not None and now["version"] != expected:
            raise RuntimeError(f"version {now['version']} is current, not {expected}")
        new = now | (facts or {}) | {"version": now["version"] + 1, "tables": {k: v for k, v in (now["tables"] | written).items() if k not in (drop or [])}}
        at = self._path(f"{self.root}/manifest-{new['version']}.json")
        try:
            out = self._fs.create(at, False)
        except Exception as e:
            raise RuntimeError(f"version {new['version']} was published by another writer") from e
        out.write(bytearray(json.dumps(new).encode()))
        out.close()
        for n in self._numbers()[self.KEPT :]:
            self._fs.delete(self._path(f"{self.root}/manifest-{n}.json"), False)
        return new["version"]
