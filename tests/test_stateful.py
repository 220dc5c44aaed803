"""Uploads, uploads anew and deletions in any order leave the graph of what is there now."""

from hypothesis import HealthCheck, given, settings
from hypothesis import strategies as st
from pyspark.sql import functions as F

from marlweave.operators import lifecycle as L

PEOPLE = ("Odile", "Tamsin", "Ruben", "Yusra", "Per")
FILES = (("kiln.md", None), ("glaze.md", None), ("kiln.md", "room-7"))
DOCS, ENTITIES, MENTIONS = "id string, source string, chat_id string", "id bigint, name string, tracked boolean", "doc_id string, entity_id bigint, confidence double"
upload = st.tuples(st.just("upload"), st.sampled_from(range(len(FILES))), st.lists(st.sets(st.sampled_from(range(len(PEOPLE))), max_size=2), min_size=1, max_size=2))
delete = st.tuples(st.just("delete"), st.sampled_from(range(len(FILES))), st.just([]))


class Graph:
    """The tables in Spark and, beside them, what is stored: the people of each chunk of each file."""

    def __init__(self, spark):
        self.spark, self.stored, self.made = spark, {}, 0
        self.rows = {"docs": [], "entities": [], "mentions": []}

    def frames(self):
        make = lambda k, kind: self.spark.createDataFrame(self.rows[k], kind)
        return make("docs", DOCS), make("entities", ENTITIES), make("mentions", MENTIONS)

    def delete(self, file, scoped):
        docs, entities, mentions = self.frames()
        name, chat = FILES[file]
        out = L.delete_points(docs, entities, mentions, mentions.select("doc_id", "entity_id"), (F.col("source") == name) & F.col("chat_id").eqNullSafe(F.lit(chat)), scoped)
        self.rows = {k: [tuple(r) for r in out[k].select(*[c.split()[0] for c in kind.split(", ")]).collect()] for k, kind in (("docs", DOCS), ("entities", ENTITIES), ("mentions", MENTIONS))}
        self.stored.pop(file, None)

    def upload(self, file, chunks, scoped):
        self.delete(file, scoped)  # an upload replaces what the file had
        held = {r[0] for r in self.rows["entities"]}
        for people in chunks:
            self.made += 1
            self.rows["docs"].append((f"c{self.made}", *FILES[file]))
            self.rows["mentions"] += [(f"c{self.made}", p, 0.5) for p in people]
            self.rows["entities"] += [(p, PEOPLE[p], True) for p in people - held]
            held |= people
        self.stored[file] = chunks


@given(st.lists(st.one_of(upload, delete), min_size=2, max_size=4), st.booleans())
@settings(max_examples=4, deadline=None, suppress_health_check=list(HealthCheck))
def test_any_order_of_steps_leaves_the_graph_of_what_is_stored(spark, steps, scoped):
    g = Graph(spark)
    for kind, file, chunks in steps:
        g.upload(file, chunks, scoped) if kind == "upload" else g.delete(file, scoped)
    chunks = [c for cs in g.stored.values() for c in cs]
    assert len(g.rows["docs"]) == len(chunks)
    assert sorted(p for _, p, _ in g.rows["mentions"]) == sorted(p for c in chunks for p in c)
    assert {r[0] for r in g.rows["entities"]} == {p for c in chunks for p in c}


def test_a_purge_of_one_phase_leaves_the_other(spark):
    docs = spark.createDataFrame([("c1", "kiln"), ("c2", "glaze")], "id string, source_key string")
    entities = spark.createDataFrame([(1, None), (2, "g1"), (3, None)], "id bigint, concept_gen string")
    mentions = spark.createDataFrame([("c1", 1), ("c1", 2), ("c1", 3), ("c2", 3)], "doc_id string, entity_id bigint")
    edges = spark.createDataFrame([("a", "b", None, ["kiln"]), ("a", "c", "g1", ["kiln"]), ("b", "c", None, ["kiln", "glaze"]), ("c", "d", None, None)], "src string, dst string, concept_gen string, files array<string>")
    similar = spark.createDataFrame([("c1", "c2", 0.9)], "src string, dst string, score double")
    left = {p: L.purge_source(docs, entities, mentions, edges, similar, "kiln", p) for p in ("ner", "llm", "both")}
    assert {p: {r.id for r in t["entities"].collect()} for p, t in left.items()} == {"ner": {2, 3}, "llm": {1, 3}, "both": {3}}
    assert {p: {(r.src, r.dst) for r in t["edges"].collect()} for p, t in left.items()} == {"ner": {("a", "c"), ("b", "c"), ("c", "d")}, "llm": {("a", "b"), ("b", "c"), ("c", "d")}, "both": {("b", "c"), ("c", "d")}}
    assert {p: t["similar"].count() for p, t in left.items()} == {"ner": 0, "llm": 1, "both": 0}


def test_a_broken_prune_is_noticed(spark):
    """A mutation: pruning without looking at mentions must change the result."""
    g = Graph(spark)
    g.rows = {"docs": [("c1", *FILES[0]), ("c2", *FILES[1])], "entities": [(0, PEOPLE[0], True), (1, PEOPLE[1], True)], "mentions": [("c1", 0, 0.5), ("c1", 1, 0.5), ("c2", 1, 0.5)]}
    d, e, m = g.frames()
    right = L.delete_points(d, e, m, m.select("doc_id", "entity_id"), F.col("source") == FILES[0][0], False)["entities"]
    wrong = L.delete_points(d, e, m.limit(0), m.limit(0).select("doc_id", "entity_id"), F.col("source") == FILES[0][0], False)["entities"]
    assert {r.id for r in right.collect()} == {1} and wrong.count() == 0
