"""Outside models: one instance for each process, structured answers, language gates and the tags of phases."""

from __future__ import annotations

import hashlib
import json
import threading
from collections.abc import Callable
from typing import Any

_held: dict[str, Any] = {}
_lock = threading.Lock()

#: Shortest text whose language is told, and the least probability.
SHORTEST, SURE = 5, 0.8


def per_process(name: str, load: Callable[[], Any]) -> Any:
    """The model of a name, loaded at its first use in this process and shared by all tasks that run in it."""
    if name not in _held:
        with _lock:
            if name not in _held:
                _held[name] = load()
    return _held[name]


def language(text: str | None, guess: Callable[[str], list[tuple[str, float]]]) -> str | None:
    """The first language whose probability exceeds SURE; none for a text of less than SHORTEST characters or if the guess fails."""
    text = (text or "").strip()
    if len(text) < SHORTEST:
        return None
    try:
        return next((lang for lang, p in guess(text) if p > SURE), None)
    except Exception:
        return None


def answer_schema(concept_types: list[str], relation_types: list[str]) -> dict:
    """The JSON schema of a model's answer: concepts and relations whose types are among those given."""
    text = {"type": "string"}
    item = lambda kinds, *keys: {"type": "object", "properties": {"type": {"type": "string", "enum": sorted(kinds)} if kinds else text} | {k: text for k in keys}, "required": ["type", *keys]}
    lists = {"concepts": item(concept_types, "text"), "relations": item(relation_types, "origin", "destination", "text")}
    return {"type": "object", "properties": {k: {"type": "array", "items": v} for k, v in lists.items()}, "required": sorted(lists)}


class Unstructured(ValueError):
    """An answer that doesn't keep its schema; text is what the model said, empty if it said nothing."""

    def __init__(self, why: str, text: str = "") -> None:
        super().__init__(why)
        self.text = text


def structured(model: Any, prompt: str, schema: dict) -> dict:
    """A model's answer by a schema: of a model that has a method `structured` by that, of any other callable by a prompt that states the schema, and checked."""
    if hasattr(model, "structured"):
        data = model.structured(prompt, schema)
        return _checked(data, schema, json.dumps(data) if data is not None else "")
    said = model(f"{prompt}\n\nAnswer with JSON only, by this schema:\n{json.dumps(schema, sort_keys=True)}") or ""
    try:
        return _checked(json.loads(said), schema, said)
    except json.JSONDecodeError as e:
        raise Unstructured(str(e), said) from e


def _checked(data: Any, schema: dict, said: str) -> dict:
    problem = _breach(data, schema)
    if problem:
        raise Unstructured(problem, said)
    return data


def _breach(data: Any, schema: dict, at: str = "answer") -> str:
    """Where data breaks a schema of objects, arrays and strings; empty if nowhere."""
    kind = {"object": dict, "array": list, "string": str}[schema["type"]]
    if not isinstance(data, kind):
        return f"{at} is no {schema['type']}"
    if kind is str:
        return "" if data in schema.get("enum", [data]) else f"{at} is none of the values allowed"
    if kind is list:
        return next((b for i, x in enumerate(data) if (b := _breach(x, schema["items"], f"{at}[{i}]"))), "")
    missing = [k for k in schema.get("required", []) if k not in data]
    return f"{at} lacks {missing[0]}" if missing else next((b for k, s in schema["properties"].items() if k in data and (b := _breach(data[k], s, f"{at}.{k}"))), "")


def phase_tags(models: dict[str, str], entities: bool, concepts: bool) -> dict[str, str]:
    """The tag of each graph phase: a hash of its material settings. Definitions, prompts and patterns are none: a change of those refreshes the graph by itself."""
    settings = {"ner": {"models": dict(sorted(models.items())), "entities": entities, "concepts": concepts}, "llm": {"concepts": concepts}}
    return {phase: hashlib.sha256(json.dumps(s, sort_keys=True).encode()).hexdigest()[:16] for phase, s in settings.items()}
