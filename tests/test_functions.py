import random
import re

import pytest
from hypothesis import given, settings
from hypothesis import strategies as st
from pyspark.sql import functions as F

from marlweave.functions import extract as X
from marlweave.functions import text as T
from marlweave.functions.vectors import is_valid, score
from marlweave.operators.checks import with_dependents
from marlweave.operators.scan import next_offset
from marlweave.functions import models as M
from marlweave.plans.ingestion import dependencies, entity_type, extract_text


@given(st.text(alphabet="ab \n\r\t", max_size=120), st.integers(4, 50))
@settings(max_examples=300, deadline=None)
def test_segments_are_lossless_and_bounded(text, cap):
    parts = X.segments(text, cap)
    assert "".join(s for _, s in parts) == text
    assert all(0 < len(s) <= cap for _, s in parts)
    assert [at for at, _ in parts] == [sum(len(s) for _, s in parts[:i]) for i in range(len(parts))]


@pytest.mark.parametrize("text, cap, want", [("", 50, []), ("one two", 50, ["one two"]), ("one\n\ntwo", 50, ["one\n\ntwo"]), ("a" * 60, 25, ["a" * 25, "a" * 25, "a" * 10]), ("aaa bbb ccc ddd eee fff ggg", 25, ["aaa bbb ccc ddd eee fff ", "ggg"])])
def test_segment_cases(text, cap, want):
    assert [s for _, s in X.segments(text, cap)] == want


def test_columns_of_names_and_keys(spark):
    rows = [(" The  Beatles ", "t"), ("A", "t"), ("an Apple", "t"), ("", "t"), (None, "t"), ("theatre", "t"), (" X ", "t")]
    got = [r[0] for r in spark.createDataFrame(rows, "n string, t string").select(T.normalize_name(F.col("n"))).collect()]
    assert got == ["beatles", "a", "apple", "", None, "theatre", "x"]
    d = spark.range(1).select(T.entity_key(F.lit("t"), F.lit("The X")).alias("a"), T.provenance_key(F.lit("f"), F.lit(None).cast("string")).alias("b"), T.provenance_key(F.lit("f"), F.lit("c")).alias("c"), T.next_generation(F.lit("v9")).alias("d"), T.next_generation(F.lit("x")).alias("e")).first()
    import hashlib

    assert tuple(d) == (hashlib.md5(b"t:x").hexdigest(), "f", "chat:c:f", "v10", "v2")


def test_content_predicates(spark):
    rows = ["ordinary", "# CATALOGUE CARD\nx", " ", "%PDF-1 \0", "�" * 10 + "a" * 80, "�" * 10 + "a" * 90, "", None, "　"]
    d = spark.createDataFrame([(x,) for x in rows], "c string").select(T.is_blank(F.col("c")), T.is_binary(F.col("c")), T.is_card(F.col("c"))).collect()
    assert [bool(r[0]) for r in d] == [False, False, True, False, False, False, True, True, True]
    assert [bool(r[1]) for r in d] == [False, False, False, True, True, True, False, False, False]
    assert [bool(r[2]) for r in d] == [False, True] + [False] * 7


def test_metadata_exact_and_fragment(spark):
    d = spark.createDataFrame([('{"chunk_index": 1}',), ('{"chunk_index": 10, "tenant_id": "t"}',), ("broken",), (None,)], "m string")
    m = F.col("m")
    got = d.select(T.has_pairs(m, {"chunk_index": 1}), T.has_pairs(m, {"chunk_index": 1}, exact=False), T.stored_metadata(m)).collect()
    assert [tuple(r)[:2] for r in got] == [(True, True), (False, True), (False, False), (False, False)]
    assert [r[2] for r in got] == [{"chunk_index": "1"}, {"chunk_index": "10"}, {}, {}]


def test_vectors(spark):
    nan, inf = float("nan"), float("inf")
    d = spark.createDataFrame([([1.0, 0.0],), ([0.0, 0.0],), ([nan, 1.0],), ([inf, 1.0],), ([],), (None,)], "v array<float>")
    assert [r[0] for r in d.select(is_valid(F.col("v"))).collect()] == [True] + [False] * 5
    q = F.array(F.lit(-2.0), F.lit(0.0))
    assert [r[0] for r in d.limit(1).select(score(F.col("v"), q)).collect()] == [0.0]
    assert [r[0] for r in d.limit(1).select(score(F.col("v"), q, raw=True)).collect()] == [-1.0]


def test_proximity_types(spark):
    texts = {"this a": "IS_A", "they ARE A": "IS_A", "is based on": "BASED_ON", "near": "RELATED_TO"}
    d = spark.createDataFrame([(k,) for k in texts], "t string").select("t", T.proximity_type(F.col("t")).alias("k"))
    assert {r.t: r.k for r in d.collect()} == texts


def test_driver_side_functions():
    assert T.definitions("# c\n\nterm: a thing\nno colon\nRule : x: y") == {"TERM": "a thing", "RULE": "x: y"}
    assert T.unfenced("```json\n[1]\n```") == "[1]" and T.unfenced("[1]") == "[1]"
    waits = [T.backoff(i, jitter=random.Random(1)) for i in range(10)]
    assert waits[0] < waits[3] and max(waits) <= 10
    a, b = X.fingerprint({"x": 1, "y": 2}, {}, " p ", "m", True), X.fingerprint({"y": 2, "x": 1}, {}, "p", "m", True)
    assert a == b != X.fingerprint({}, {}, "p", "m", True)
    assert [X.state(s) for s in ("done", "odd", None, True)] == ["done", "error", "error", "error"]
    needs = {"ner": ["embed"], "llm": ["ner"], "x": []}
    assert [with_dependents(needs, p) for p in (["embed"], ["x"], ["llm", "x"], [])] == [["embed", "llm", "ner"], ["x"], ["llm", "x"], []]
    assert [next_offset(100, 100), next_offset(99, 100), next_offset(100, 100, "100"), next_offset(100, 100, "junk")] == ["100", None, "200", "100"]


@pytest.mark.parametrize(
    "said, concepts, relations, dropped",
    [
        ('```json\n{"concepts": [{"type": "TERM", "text": "Alpha"}, {"type": "ODD", "text": "Beta"}, {"type": "TERM", "text": " "}], "relations": [{"type": "USES", "origin": "Alpha", "destination": "Beta", "text": "t"}, {"origin": "x"}]}\n```', [("TERM", "Alpha"), ("CONCEPT", "Beta")], [("USES", "Alpha", "Beta")], 2),
        ('{"concepts": [{"type": "term", "text": "Alpha"}], "relations": [{"type": "uses", "origin": "Alpha", "destination": "Beta", "text": "t"}, {"type": "LIKES", "origin": "Alpha", "destination": "Beta", "text": "t"}]}', [("TERM", "Alpha")], [("USES", "Alpha", "Beta")], 1),
        ('words [{"subject": "Kiln", "relation_type": "uses", "object": "Clay", "subject_type": "term"}, {"subject": "KILN", "relation_type": "USES", "object": "Fire"}, {"subject": "Kiln", "relation_type": "ODD", "object": "Air"}] words', [("TERM", "Kiln"), ("CONCEPT", "Clay"), ("CONCEPT", "Fire")], [("USES", "Kiln", "Clay"), ("USES", "KILN", "Fire")], 1),
        ('{"concepts": "no list", "relations": null}', [], [], 2),
        ("not json", [], [], 0),
        (None, [], [], 0),
        ("[1, 2]", [], [], 2),
    ],
)
def test_answers(said, concepts, relations, dropped):
    a = X.answer(said, {"TERM"}, {"USES"})
    assert [(c["type"], c["text"]) for c in a["concepts"]] == concepts
    assert [(r["type"], r["origin"], r["destination"]) for r in a["relations"]] == relations
    assert a["dropped"] == dropped


def test_extraction_prefers_the_surer_and_keeps_offsets():
    text = "Odile keeps the kiln warm.\n\nIts log lives in Redis, which Tamsin reads."
    entities, relations = extract_text(text, lambda t: [(m[0], "PERSON", m.start(), m.end()) for m in re.finditer("Odile|Tamsin", t)], [re.compile(p, re.I) for p in X.TECHNOLOGY_PATTERNS])
    assert {(e[0], e[1], text[e[2] : e[3]]) for e in entities} == {("Odile", "PERSON", "Odile"), ("Redis", "TECHNOLOGY", "Redis"), ("Tamsin", "PERSON", "Tamsin")}
    assert ("Redis", "Tamsin", "RELATED_TO", 0.6) in relations and ("Odile", "Tamsin", "CO_OCCURS_WITH", 0.45) in relations
    assert entity_type("ORG") == ("ORGANIZATION", 0.9) and entity_type("?") == ("UNKNOWN", 0.5)


def _tokens(text, *rows):
    out, at = [], 0
    for i, (word, lemma, pos, dep, head) in enumerate(rows):
        at = text.index(word, at)
        out.append({"i": i, "start": at, "end": at + len(word), "lemma": lemma, "pos": pos, "dep": dep, "head": head})
        at += len(word)
    return out


def test_relations_of_a_parse():
    names = lambda text, *ns: [(n, "X", text.index(n), text.index(n) + len(n), 0.9) for n in ns]
    text = "Odile uses Red Clay"
    active = _tokens(text, ("Odile", "Odile", "PROPN", "nsubj", 1), ("uses", "use", "VERB", "ROOT", 1), ("Red", "red", "ADJ", "amod", 3), ("Clay", "clay", "NOUN", "dobj", 1))
    assert dependencies(active, names(text, "Odile", "Red Clay")) == [("Odile", "Red Clay", "USES", 0.85)]
    assert dependencies(active, names(text, "Odile", "Red")) == [("Odile", "Red", "USES", 0.85)]  # by the subtree of the object
    assert dependencies(active, names(text, "Odile")) == []
    text = "Kiln was built by Tamsin with Brick"
    passive = _tokens(text, ("Kiln", "Kiln", "PROPN", "nsubjpass", 2), ("was", "be", "AUX", "auxpass", 2), ("built", "build", "VERB", "ROOT", 2), ("by", "by", "ADP", "agent", 2), ("Tamsin", "Tamsin", "PROPN", "pobj", 3), ("with", "with", "ADP", "prep", 2), ("Brick", "Brick", "PROPN", "pobj", 5))
    got = dependencies(passive, names(text, "Kiln", "Tamsin", "Brick"))
    assert got == [("Kiln", "Brick", "CREATES", 0.85), ("Tamsin", "Brick", "CREATES", 0.85)]
    entities, relations = extract_text(text, lambda t: [(n, "X", t.index(n), t.index(n) + len(n)) for n in ("Kiln", "Tamsin", "Brick")], [], lambda t: passive)
    assert relations[:2] == got and ("Kiln", "Tamsin", "RELATED_TO", 0.6) in relations and ("Kiln", "Brick", "RELATED_TO", 0.6) not in relations


def test_outside_models():
    made = []
    load = lambda: made.append(1) or object()
    assert M.per_process("m", load) is M.per_process("m", load) and made == [1]
    guess = lambda t: [("xx", 0.5), ("en", 0.9), ("de", 0.95)]
    assert [M.language(t, guess) for t in ("a text", " abc ", None)] == ["en", None, None]
    assert M.language("a text", lambda t: [("en", 0.8)]) is None and M.language("a text", lambda t: 1 / 0) is None
    schema = M.answer_schema(["TERM"], ["USES"])
    good = {"concepts": [{"type": "TERM", "text": "Kiln"}], "relations": []}
    assert M.structured(lambda p: __import__("json").dumps(good), "q", schema) == good
    native = type("N", (), {"structured": lambda self, p, s: good})()
    assert M.structured(native, "q", schema) == good
    for said in ("no json", '{"concepts": []}', '{"concepts": [{"type": "ODD", "text": "x"}], "relations": []}', "[]", ""):
        with pytest.raises(M.Unstructured) as e:
            M.structured(lambda p, s=said: s, "q", schema)
        assert e.value.text == said
    a, b = M.phase_tags({"en": "m", "de": "n"}, True, True), M.phase_tags({"de": "n", "en": "m"}, True, True)
    assert a == b and set(a) == {"ner", "llm"}
    assert M.phase_tags({}, True, False)["llm"] != a["llm"] and M.phase_tags({"en": "k"}, True, True)["llm"] == a["llm"]
