"""Extraction from texts: technologies, labels, relation types, segments and answers of a language model."""

from __future__ import annotations

import hashlib
import json
import re

from pyspark.sql import Column
from pyspark.sql import functions as F

from .text import unfenced

#: Pattern groups of technologies and their confidence.
TECHNOLOGY_PATTERNS = [
    r"\b(Neo4j|MongoDB|PostgreSQL|MySQL|Redis|Elasticsearch)\b",
    r"\b(Kubernetes|Docker|Terraform|Ansible)\b",
    r"\b(Python|Java|Go|Rust|TypeScript|JavaScript)\b",
    r"\b(TensorFlow|PyTorch|LangChain|spaCy)\b",
    r"\b(RAG|GraphRAG|Vector Database|LLM|GPT)\b",
    r"\b(AWS|Azure|GCP|Cloud)\b",
]
TECHNOLOGY_CONFIDENCE, NAMED_CONFIDENCE, UNKNOWN_CONFIDENCE = 0.85, 0.9, 0.5
#: Labels of a named-entity recogniser and the types they stand for.
LABELS = {
    "PERSON": "PERSON", "ORG": "ORGANIZATION", "GPE": "LOCATION", "LOC": "LOCATION", "PRODUCT": "PRODUCT", "EVENT": "EVENT", "DATE": "DATE", "MONEY": "FINANCIAL", "PERCENT": "FINANCIAL",
    "LAW": "CONCEPT", "FAC": "LOCATION", "WORK_OF_ART": "CONCEPT",
}
#: Lemmas of verbs and the relation types they stand for.
VERBS = {
    "use": "USES", "utilize": "USES", "employ": "USES", "leverage": "USES", "create": "CREATES", "build": "CREATES", "make": "CREATES", "generate": "CREATES", "develop": "DEVELOPS", "write": "DEVELOPS", "code": "DEVELOPS",
    "implement": "IMPLEMENTS", "support": "SUPPORTS", "provide": "SUPPORTS", "extend": "EXTENDS", "inherit": "INHERITS", "derive": "INHERITS", "include": "INCLUDES", "contain": "CONTAINS", "embed": "INCLUDES",
    "integrate": "INTEGRATES", "connect": "INTEGRATES", "depend": "DEPENDS_ON", "require": "DEPENDS_ON", "need": "DEPENDS_ON", "define": "DEFINES", "represent": "REPRESENTS", "describe": "DEFINES", "replace": "REPLACES",
    "supersede": "REPLACES", "call": "CALLS", "invoke": "CALLS", "be": "IS_A", "design": "DESIGNS", "name": "NAMED", "become": "BECOMES", "produce": "PRODUCES", "cause": "CAUSES", "lead": "LEADS_TO", "affect": "AFFECTS",
    "prevent": "PREVENTS", "help": "HELPS", "improve": "IMPROVES", "reduce": "REDUCES", "increase": "INCREASES",
}
#: Largest segment, and the window of a hard cut as a share of it.
SEGMENT_CHARS, CUT_FROM = 100_000, 0.75
#: The states of a phase.
STATES = ("done", "skipped", "not_ready", "running", "pending", "error")


def typed(label) -> tuple[Column, Column]:
    """Type and confidence of a column of a recogniser's labels."""
    kind = F.create_map(*[F.lit(x) for p in LABELS.items() for x in p])[label]
    return F.coalesce(kind, F.lit("UNKNOWN")), F.when(kind.isNotNull(), NAMED_CONFIDENCE).otherwise(UNKNOWN_CONFIDENCE)


def verb_type(lemma) -> Column:
    """The relation type of a column of verb lemmas."""
    return F.coalesce(F.create_map(*[F.lit(x) for p in VERBS.items() for x in p])[lemma], F.lit("RELATED_TO"))


def concept_type(kind, known: set[str]) -> Column:
    """A column of types where those that aren't known become CONCEPT."""
    upper = F.upper(F.trim(kind))
    return F.when(upper.isin(*sorted(known)), upper).otherwise("CONCEPT")


def segments(text: str, cap: int = SEGMENT_CHARS) -> list[tuple[int, str]]:
    """Offset and text of segments of at most cap characters, whose concatenation is the text.

    Paragraphs keep the blank lines behind them and are packed together while they fit; a longer paragraph is cut at
    the last space of the last quarter, or hard."""
    out: list[tuple[int, str]] = []
    pieces = re.findall(r".*?(?:\n[^\S\n]*\n\s*|\Z)", text, re.S)
    for piece in (p for p in pieces if p):
        while len(piece) > cap:
            space = piece.rfind(" ", int(cap * CUT_FROM), cap)
            cut = space + 1 if space >= 0 else cap
            out.append((0, piece[:cut]))
            piece = piece[cut:]
        if piece and out and len(out[-1][1]) + len(piece) <= cap:
            out[-1] = (0, out[-1][1] + piece)
        elif piece:
            out.append((0, piece))
    at, placed = 0, []
    for _, s in out:
        placed.append((at, s))
        at += len(s)
    return placed


def fingerprint(concepts: dict, relations: dict, prompt: str, model: str, enabled: bool) -> str:
    """The same for the same settings, whatever the order of their keys."""
    settings = {"concepts": concepts, "relations": relations, "prompt": prompt.strip(), "model": model, "enabled": enabled}
    return hashlib.sha256(json.dumps(settings, sort_keys=True, ensure_ascii=False).encode()).hexdigest()


def state(status) -> str:
    """A known state of a phase; anything else is an error."""
    return status if isinstance(status, str) and status in STATES else "error"


def answer(text: str | None, concept_types: set[str], relation_types: set[str]) -> dict:
    """Concepts and relations of a model's answer, how many items were dropped, and whether it could be read. Never raises.

    Reads an object {concepts, relations} or a list of {subject, relation_type, object}, fenced or with words around a
    list. Types are upper-cased; concepts of another type become CONCEPT, relations of another type are dropped, and so
    are items without text or without an end. A part that is no list counts as one dropped item. The concepts of a list
    are its different subjects and objects, whatever their letter case."""
    data = _json(unfenced(text or ""))
    told = lambda x, k: str(x.get(k) if x.get(k) is not None else "").strip()
    kind = lambda x, k, known, other: told(x, k).upper() if told(x, k).upper() in known else other
    concepts: list[dict] = []
    relations: list[dict] = []
    raw = 0
    if isinstance(data, dict):
        for key in ("concepts", "relations"):
            part = data.get(key, [])
            if not isinstance(part, list):
                raw += 1
                continue
            raw += len(part)
            for x in (x for x in part if isinstance(x, dict) and told(x, "text")):
                if key == "concepts":
                    concepts.append({"type": kind(x, "type", concept_types, "CONCEPT"), "text": told(x, "text")})
                elif (t := kind(x, "type", relation_types, "")) and told(x, "origin") and told(x, "destination"):
                    relations.append({"type": t, "origin": told(x, "origin"), "destination": told(x, "destination"), "text": told(x, "text")})
        dropped = raw - len(concepts) - len(relations)
    elif isinstance(data, list):
        seen: dict[str, dict] = {}
        for x in (x for x in data if isinstance(x, dict)):
            ends, t = (told(x, "subject"), told(x, "object")), kind(x, "relation_type", relation_types, "")
            if all(ends) and t:
                relations.append({"type": t, "origin": ends[0], "destination": ends[1], "text": ""})
                for name, of in zip(ends, ("subject_type", "object_type")):
                    seen.setdefault(name.casefold(), {"type": kind(x, of, concept_types, "CONCEPT"), "text": name})
        concepts, dropped = list(seen.values()), len(data) - len(relations)
    else:
        dropped = 0
    return {"concepts": concepts, "relations": relations, "dropped": max(0, dropped), "read": isinstance(data, dict | list)}


def _json(text: str):
    for part in (text, text[text.find("[") : text.rfind("]") + 1] if "[" in text else ""):
        try:
            return json.loads(part)
        except ValueError:
            continue
    return None
