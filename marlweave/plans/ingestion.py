"""The ingestion pipeline: extraction from texts, the phase of a language model, and the graph rows of both.

Recogniser and model are arguments; the defaults are rule-based and the same in every run, as no parser is installed.
"""

from __future__ import annotations

import re
from collections.abc import Callable, Iterator

import pandas as pd
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from ..functions.extract import LABELS, NAMED_CONFIDENCE, TECHNOLOGY_CONFIDENCE, TECHNOLOGY_PATTERNS, UNKNOWN_CONFIDENCE, VERBS, answer, segments
from ..functions.text import entity_key, has_pairs, normalize_name
from ..operators.assemble import CO_OCCURRING, NEAR, fold_weights, merge_entities, merge_mentions
from ..operators.scan import prose
from ..session import ship

#: text to (name, label, start, end)
Recogniser = Callable[[str], list[tuple[str, str, int, int]]]
#: text to tokens with i, start, end, lemma, pos, dep and head
Parser = Callable[[str], list[dict]]
#: Fixed value: the weight of a relation that a parse shows.
GROUNDED = 0.85
_ENTITY = "array<struct<name:string,type:string,start_char:int,end_char:int,confidence:double>>"
_RELATION = "array<struct<source_entity:string,target_entity:string,relation_type:string,weight:double>>"


def capitals(text: str) -> list[tuple[str, str, int, int]]:
    """The default recogniser: words that begin with a capital, of unknown type."""
    return [(m[0], "", m.start(), m.end()) for m in re.finditer(r"[A-Z][a-z]+", text)]


def entity_type(label: str) -> tuple[str, float]:
    """Type and confidence of a recogniser's label."""
    return (LABELS[label], NAMED_CONFIDENCE) if label in LABELS else ("UNKNOWN", UNKNOWN_CONFIDENCE)


def dependencies(tokens: list[dict], entities: list[tuple]) -> list[tuple[str, str, str, float]]:
    """(source, target, type, weight) from a parsed text: tokens with i, start, end, lemma, pos, dep and head; entities as extract_text() has them.

    Every subject of a verb (also a passive one, and its agent) with every object (also a predicate, and the object of a
    preposition), where both are entities and not the same; the type follows from the verb's lemma."""
    children: dict[int, list[dict]] = {}
    for t in tokens:
        if t["head"] != t["i"]:
            children.setdefault(t["head"], []).append(t)
    placed = sorted(entities, key=lambda e: e[2])

    def at(start: int, end: int) -> str | None:
        return next((e[0] for e in placed if start < e[3] and e[2] < end), None)

    def entity(t: dict) -> str | None:
        """The first entity that the token overlaps, else the first that its subtree does, if that has two to five tokens."""
        tree, todo = [t], [t]
        while todo:
            below = children.get(todo.pop()["i"], [])
            tree += below
            todo += below
        own = at(t["start"], t["end"])
        return own or (at(min(x["start"] for x in tree), max(x["end"] for x in tree)) if 2 <= len(tree) <= 5 else None)

    out: dict[tuple[str, str, str], None] = {}
    for verb in (t for t in tokens if t["pos"] in ("VERB", "AUX")):
        arcs = children.get(verb["i"], [])
        of = lambda *deps: [t for t in arcs if t["dep"] in deps]  # noqa: B023, E731
        under = lambda dep, *deps: [x for t in of(dep) for x in children.get(t["i"], []) if x["dep"] in deps]
        subjects = of("nsubj", "nsubjpass") + under("agent", "pobj")
        objects = of("dobj", "attr", "acomp", "oprd") + under("prep", "pobj", "pcomp")
        for x in map(entity, subjects):
            for y in map(entity, objects):
                if x and y and x != y:
                    out[x, y, VERBS.get(verb["lemma"], "RELATED_TO")] = None
    return [(*k, GROUNDED) for k in out]


def extract_text(text: str, recognise: Recogniser, patterns: list[re.Pattern], parse: Parser | None = None) -> tuple[list[tuple], list[tuple]]:
    """Entities and relations of one text: segments, recogniser, patterns, the best of each name, dependencies, proximity of pairs that those don't have, and co-occurrence."""
    found: dict[str, tuple] = {}

    def take(name: str, kind: str, start: int, end: int, sure: float) -> None:
        key = name.strip().lower()
        if key and (key not in found or sure > found[key][4]):
            found[key] = (name, kind, start, end, sure)

    for at, part in segments(text):
        for name, label, start, end in recognise(part):
            kind, sure = entity_type(label)
            take(name, kind, at + start, at + end, sure)
    for p in patterns:
        for m in p.finditer(text):
            take(m[0], "TECHNOLOGY", m.start(), m.end(), TECHNOLOGY_CONFIDENCE)
    entities = list(found.values())
    placed = sorted(entities, key=lambda e: (e[2], e[0]))
    tokens = [t | {"i": (at, t["i"]), "head": (at, t["head"]), "start": at + t["start"], "end": at + t["end"]} for at, part in segments(text) for t in parse(part)] if parse else []
    relations = dependencies(tokens, entities)
    known = {r[:2] for r in relations}
    for i, a in enumerate(placed):
        for b in placed[i + 1 :]:
            if b[2] - a[3] >= NEAR:
                break
            if (a[0], b[0]) in known:
                continue
            between = text[a[3] : b[2]].lower()
            kind = "IS_A" if "is a" in between or "are a" in between else "BASED_ON" if "based on" in between else "RELATED_TO"
            relations.append((a[0], b[0], kind, 0.6))
    if len(entities) <= CO_OCCURRING:
        relations += [(a[0], b[0], "CO_OCCURS_WITH", (a[4] + b[4]) / 4) for i, a in enumerate(entities) for b in entities[i + 1 :]]
    return entities, relations


def extract(docs: DataFrame, recognise: Recogniser = capitals, extra_patterns: list[str] | None = None, parse: Parser | None = None) -> DataFrame:
    """(doc_id, tenant_id, entities, relations) of every document; a null text has none. A recogniser or parser that needs a model gets it by models.per_process()."""
    ship(docs.sparkSession)
    sources = [*TECHNOLOGY_PATTERNS, *(extra_patterns or [])]

    def run(it: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        patterns = [re.compile(p, re.I) for p in sources]
        for pdf in it:
            rows = [extract_text(t or "", recognise, patterns, parse) for t in pdf["content"]]
            out = pdf[["doc_id", "tenant_id"]].copy()
            out["entities"] = [[dict(zip(("name", "type", "start_char", "end_char", "confidence"), e)) for e in es] for es, _ in rows]
            out["relations"] = [[dict(zip(("source_entity", "target_entity", "relation_type", "weight"), r)) for r in rs] for _, rs in rows]
            if len(out):
                yield out

    return docs.select(F.col("id").alias("doc_id"), "tenant_id", "content").mapInPandas(run, f"doc_id string, tenant_id string, entities {_ENTITY}, relations {_RELATION}")


def graph_rows(extracted: DataFrame) -> tuple[DataFrame, DataFrame, DataFrame]:
    """Entities (key, tenant_id, name, type, doc_id, confidence), mentions (doc_id, key, confidence) and relations (doc_id, src, dst, type, weight) of extracted documents."""
    e = extracted.select("doc_id", "tenant_id", F.explode("entities").alias("e")).select("doc_id", "tenant_id", "e.*").where(normalize_name(F.col("name")) != "")
    e = e.withColumn("key", entity_key(F.col("tenant_id"), F.col("name")))
    m = e.groupBy("doc_id", "key").agg(F.max("confidence").alias("confidence"))
    r = extracted.select("doc_id", "tenant_id", F.explode("relations").alias("r")).select("doc_id", entity_key(F.col("tenant_id"), F.col("r.source_entity")).alias("src"), entity_key(F.col("tenant_id"), F.col("r.target_entity")).alias("dst"), F.col("r.relation_type").alias("type"), F.col("r.weight").alias("weight"))
    return e.select("key", "tenant_id", "name", "type", "doc_id", "confidence"), m, r.where("src <> dst")


def source_phase(docs: DataFrame, source_key: str, recognise: Recogniser = capitals) -> tuple[DataFrame, DataFrame, DataFrame]:
    """Entities (key, name, type, documents, confidence), mentions and folded relations of one source's prose: what its phase writes after the purge."""
    entities, mentions, relations = graph_rows(extract(prose(docs.where(F.col("source_key") == source_key)), recognise))
    merged = merge_entities(entities.withColumn("ord", F.struct("doc_id", "name")))
    folded = fold_weights(relations.withColumn("ord", F.concat_ws("|", "doc_id", "src", "dst", "type")), ["src", "dst", "type"], "ord")
    return merged, merge_mentions(mentions.withColumnRenamed("key", "entity_id")), folded


def query_entities(spark: SparkSession, text: str, extra_patterns: list[str] | None = None) -> DataFrame:
    """(name): the technologies of a query, lower-cased and stripped; articles stay."""
    patterns = [re.compile(p, re.I) for p in [*TECHNOLOGY_PATTERNS, *(extra_patterns or [])]]
    entities, _ = extract_text(text, lambda t: [], patterns)
    return spark.createDataFrame([(n,) for n in dict.fromkeys(e[0].strip().lower() for e in entities)], "name string")


def outcome(text: str | None, model: Callable[[str], str] | None, concept_types: set[str], relation_types: set[str], enabled: bool = True, attempt: int = 1) -> dict:
    """What the phase of the language model makes of one source's text: state, reason, concepts, relations and dropped items.

    skipped while disabled; error for a source without points (no text) or without a model; done with a warning for
    blank text and for an answer that is valid but empty; not_ready for a failure of the model and for no answer at all;
    a time-out and an answer that can't be read are not_ready at the first attempt and then an error; a part of the
    items dropped is an error; else done."""
    none = {"reason": "", "concepts": [], "relations": [], "dropped": 0}
    if text is None:
        return none | {"state": "error", "reason": "no stored points"}
    if not enabled:
        return none | {"state": "skipped", "reason": "disabled"}
    if model is None:
        return none | {"state": "error", "reason": "no model"}
    if not text.strip():
        return none | {"state": "done", "reason": "empty-extraction"}
    again = "not_ready" if attempt <= 1 else "error"
    try:
        said = model(text)
    except TimeoutError:
        return none | {"state": again, "reason": "time-out"}
    except Exception as e:
        return none | {"state": "not_ready", "reason": f"failure: {type(e).__name__}"}
    if not (said or "").strip():
        return none | {"state": "not_ready", "reason": "no answer"}
    a = answer(said, concept_types, relation_types)
    if not a["concepts"] and not a["relations"]:
        return none | ({"state": "done", "reason": "empty-extraction"} if a["read"] else {"state": again, "reason": "unreadable"})
    if a["dropped"]:
        return none | {"state": "error", "reason": "partial", "dropped": a["dropped"]}
    return none | {"state": "done", "concepts": a["concepts"], "relations": a["relations"]}


def concepts(texts: DataFrame, model: Callable[[str], str] | None, concept_types: set[str], relation_types: set[str], enabled: bool = True, attempt: int = 1) -> DataFrame:
    """(source_key, state, reason, concepts, relations, dropped) of each source's accumulated text (source_key, text), by outcome()."""
    ship(texts.sparkSession)
    kind = "source_key string, state string, reason string, concepts array<struct<type:string,text:string>>, relations array<struct<type:string,origin:string,destination:string,text:string>>, dropped int"

    def run(it: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for pdf in it:
            rows = [{"source_key": k} | outcome(None if t is None else str(t), model, concept_types, relation_types, enabled, attempt) for k, t in zip(pdf["source_key"], pdf["text"])]
            if rows:
                yield pd.DataFrame(rows)[["source_key", "state", "reason", "concepts", "relations", "dropped"]]

    return texts.select("source_key", "text").mapInPandas(run, kind)


def conjunction(conditions: list[dict]) -> Column:
    """A filter from conditions {key, match}: all must hold."""
    return has_pairs(F.col("metadata"), {c["key"]: c["match"] for c in conditions})


def merged_metadata(old: Column, new: Column, old_confidence: Column, new_confidence: Column) -> tuple[Column, Column]:
    """The united documents and the higher confidence of two records of an entity."""
    none = F.array().cast("array<string>")
    return F.array_union(F.coalesce(old, none), F.coalesce(new, none)), F.greatest(old_confidence, new_confidence)
