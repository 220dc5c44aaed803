import pytest
from pyspark.sql import functions as F

from marlweave.operators import assemble as A
from marlweave.operators import lifecycle as L
from marlweave.operators import recall as R
from marlweave.operators import scan as S
from marlweave.plans import ingestion as I


def frame(spark, rows, kind):
    return spark.createDataFrame(rows, kind)


def test_fold_is_the_mean_so_far(spark):
    rows = [("k", i, float(i)) for i in (1, 2, 3)] + [("n", 1, None), ("n", 2, 4.0)] + [("hot", i, float(i % 7)) for i in range(500)]
    got = {r.k: (r.weight, r.n) for r in A.fold_weights(frame(spark, rows, "k string, o bigint, weight double"), ["k"], "o").collect()}
    acc = 0.0
    for i in range(1, 500):
        acc = (acc + i % 7) / 2
    assert got["k"] == (2.25, 3) and got["n"] == (4.0, 1) and got["hot"] == (pytest.approx(acc, abs=1e-12), 500)


def test_rerank_branches(spark):
    kind = "id string, score double"
    d, i, v = frame(spark, [("d", 0.5), ("dv", 0.5), ("di", 0.25), ("cap", 0.9)], kind), frame(spark, [("i", 0.64), ("iv", 0.8), ("di", 0.9)], kind), frame(spark, [("v", 0.7), ("dv", 0.6), ("iv", 0.5), ("cap", 0.95)], kind)
    got = {r.id: (round(r.score, 6), r.is_direct) for r in R.rerank(d, i, v, 10).collect()}
    assert got == {"d": (0.5, True), "dv": (0.78, True), "di": (0.25, True), "cap": (1.0, True), "i": (0.64, False), "iv": (0.832, False), "v": (0.7, False)}
    tied = R.rerank(frame(spark, [("z", 0.5)], kind), frame(spark, [("y", 0.5)], kind), frame(spark, [("x", 0.5)], kind), 3)
    assert [r.id for r in tied.collect()] == ["z", "y", "x"]


def test_vector_limit_comes_before_the_filter(spark):
    vectors = frame(spark, [("a", [1.0, 0.0]), ("b", [1.0, 0.1]), ("c", [0.0, 1.0]), ("n", None), ("z", [0.0, 0.0])], "id string, vector array<float>")
    docs = frame(spark, [("b",), ("c",)], "id string")
    assert [r.id for r in R.by_vector(docs, vectors, [1.0, 0.0], 1, 0.0).collect()] == []
    assert {r.id for r in R.by_vector(docs, vectors, [1.0, 0.0], 3, 0.0).collect()} == {"b", "c"}


def test_traversal(spark):
    edges = frame(spark, [("a", "b"), ("c", "b"), ("c", "d"), ("d", "e"), ("b", "a")], "src string, dst string")
    assert {(r.name, r.hop) for r in R.hops(edges, ["a"], 3).collect()} == {("a", 0), ("b", 1), ("c", 2), ("d", 3)}
    entities = frame(spark, [(1, "b", None), (2, "c", "g1"), (3, "d", "g2"), (4, "a", None)], "id bigint, norm string, concept_gen string")
    mentions = frame(spark, [("x", 1), ("y", 3), ("y", 1), ("z", 3)], "doc_id string, entity_id bigint")
    docs = frame(spark, [("x",), ("y",), ("z",)], "id string")
    for gen, want in (("g1", {"x": 0.8, "y": 0.8}), ("g2", {"x": 0.8, "y": 0.8}), (None, {"x": 0.8, "y": 0.8})):
        assert {r.id: round(r.score, 6) for r in R.related(docs, entities, mentions, edges, ["a"], 5, active=gen).collect()} == want


def test_recall_defaults(spark):
    empty = frame(spark, [], "id string, score double")
    assert R.recall(empty, empty, empty, empty, empty, None, [], [0.0]).count() == 0


def test_similar_edges(spark):
    v = frame(spark, [("a", [1.0, 0.0]), ("b", [1.0, 0.05]), ("c", [0.0, 1.0]), ("d", [1.0, 0.01])], "id string, vector array<float>")
    of = frame(spark, [("a", "t", "k"), ("b", "t", "k"), ("c", "t", "k"), ("d", "u", "k")], "id string, tenant_id string, collection string")
    assert {(r.src, r.dst) for r in R.similar(v, v, of, k=3, threshold=0.9).collect()} == {("a", "b"), ("b", "a")}
    assert R.similar(v, v, of, k=2, threshold=0.9).count() == 0  # the place is taken by another tenant's document


def test_similar_by_cells_is_exact(spark, monkeypatch):
    import random

    import numpy as np

    rng = random.Random(5)
    rows = [(f"d{i:04d}", [float(n := rng.randrange(40, 900)), float(rng.randrange(n // 20, n // 9)), float(rng.randrange(n // 15, n // 6))]) for i in range(1400)]
    rows += [(f"e{i:03d}", [3.0 + i, 0.0, 0.0]) for i in range(60)] + [(f"f{i:03d}", rows[7][1]) for i in range(60)]  # one direction, one vector
    v = frame(spark, rows, "id string, vector array<double>")
    of = v.select("id", F.lit("t").alias("tenant_id"), F.when(F.col("id") < "d0900", "k").otherwise("l").alias("collection")).where("id <> 'd0005'")  # takes a place, but is in no collection
    names, x = np.array([r[0] for r in rows]), np.array([r[1] for r in rows])
    x /= np.linalg.norm(x, axis=1, keepdims=True)
    s = (1 + x @ x.T) / 2
    monkeypatch.setattr(R, "CELL", 60)

    def want(asked, k, threshold):
        rank = {i: np.lexsort((names, -np.round(s[i], 9)))[:k] for i in asked}
        pairs = {(names[i], names[j]) for i in asked for j in rank[i] if i != j and "d0005" not in (names[i], names[j]) and s[i, j] >= threshold and (names[i] < "d0900") == (names[j] < "d0900")}
        return pairs | {(b, a) for a, b in pairs}

    def blocks(*_):
        raise AssertionError("all blocks meet")

    monkeypatch.setattr(R, "_near_in_blocks", blocks)
    got = R.similar(v, v, of, 20, 0.999, whole=100)
    assert {(r.src, r.dst) for r in got.collect()} == want(range(len(rows)), 20, 0.999)
    got = R.similar(v, v.where("id LIKE '%3'"), of, 3, 0.5, whole=100)
    assert {(r.src, r.dst) for r in got.collect()} == want([i for i, n in enumerate(names) if n.endswith("3")], 3, 0.5)
    monkeypatch.undo()
    assert {(r.src, r.dst) for r in R.similar(v, v, of, 20, 0.999).collect()} == want(range(len(rows)), 20, 0.999)


def test_similar_compares_blocks_where_cells_rule_out_little(spark, monkeypatch):
    monkeypatch.setattr(R, "CELL", 10)
    v = spark.range(400).select(F.col("id").cast("string"), F.expr("transform(sequence(1, 24), i -> cast(pmod(xxhash64(id, i), 2001) - 1000 as double))").alias("vector"))
    of = v.select("id", F.lit("t").alias("tenant_id"), F.lit("k").alias("collection"))
    one, two = ({tuple(r)[:2] for r in R.similar(v, v, of, 5, 0.5, whole=w).collect()} for w in (100, 1000))
    assert one == two and len(one) > 1000
    assert R.similar(v.where("false"), v, of, whole=-1).count() == 0


def test_upserts(spark):
    kind = "key string, name string, type string, types array<string>, documents array<string>, confidence double, concept_gen string"
    old = frame(spark, [("k", "Old", "TECH", ["TECH"], ["a"], 0.7, "g1"), ("o", "Only", "X", ["X"], [], None, "g1")], kind)
    new = frame(spark, [("k", "New", "TERM", ["b", "a"], 0.6), ("n", "Made", "TERM", ["c"], 0.5)], "key string, name string, type string, documents array<string>, confidence double")
    got = {r.key: tuple(r)[1:] for r in A.upsert_entities(old, new).collect()}
    assert got == {"k": ("New", "TECH", ["TECH", "TERM"], ["a", "b"], 0.7, None), "o": ("Only", "X", ["X"], [], None, "g1"), "n": ("Made", "TERM", ["TERM"], ["c"], 0.5, None)}
    k = "src string, dst string, type string, weight double, files array<string>"
    got = {r.src: (r.weight, r.files) for r in A.upsert_relations(frame(spark, [("a", "b", "T", 1.0, ["x", "y"]), ("o", "b", "T", 1.0, ["x"])], k), frame(spark, [("a", "b", "T", 2.0, ["y", "z"]), ("n", "b", "T", 3.0, None)], k)).collect()}
    assert got == {"a": (1.5, ["x", "y", "z"]), "o": (1.0, ["x"]), "n": (3.0, [])}
    k = "key string, name string, type string, concept_gen string"
    got = {r.key: (r.type, r.concept_gen) for r in A.upsert_concepts(frame(spark, [("base", "B", "T", None), ("old", "O", "T", "g1"), ("left", "L", "T", "g1")], k), frame(spark, [("base", "B", "C"), ("old", "O", "C"), ("new", "N", "C")], "key string, name string, type string"), "g2").collect()}
    assert got == {"base": ("T", None), "old": ("T", "g2"), "left": ("T", "g1"), "new": ("C", "g2")}


def test_next_edges(spark):
    kind = "id string, tenant_id string, source_key string, created_at timestamp, chunk_index int, metadata string"
    rows = [("A", "t", "s", None, 2, '{"start_index": 10}'), ("B", "t", "s", None, 0, '{"start_index": 30}'), ("C", "t", "s", None, 1, '{"start_index": 20}')]
    assert {(r.src, r.dst) for r in A.next_edges(frame(spark, rows, kind)).collect()} == {("A", "C"), ("C", "B")}
    rows = [r[:5] + ("{}",) for r in rows] + [("X", "t", "s", None, None, "{}"), ("K", "t", "s", None, 1, '{"is_catalogue_card": true}')]
    assert {(r.src, r.dst) for r in A.next_edges(frame(spark, rows, kind)).collect()} == {("B", "C"), ("C", "A")}


def test_strip_provenance(spark):
    edges = frame(spark, [("a", ["x", "y"]), ("b", ["x"]), ("c", None)], "src string, files array<string>")
    assert {r.src: r.files for r in L.strip_provenance(edges, lambda f: f == "x").collect()} == {"a": ["y"], "c": None}


def test_refresh_is_idempotent(spark):
    entities = frame(spark, [(1, "TECHNOLOGY"), (2, "TECHNOLOGY"), (3, "PERSON")], "id bigint, type string")
    mentions = frame(spark, [("d", 2), ("d", 3)], "doc_id string, entity_id bigint")
    found = frame(spark, [("d", 1)], "doc_id string, entity_id bigint")
    none = frame(spark, [], "doc_id string, entity_id bigint")
    for _ in range(2):
        out = L.refresh_technologies(entities, mentions, found, none)
        entities, mentions = out["entities"], out["mentions"]
        assert {r.id for r in entities.collect()} == {1, 3} and {tuple(r) for r in mentions.collect()} == {("d", 1), ("d", 3)}


def test_stale_probe(spark):
    kind = "id bigint, concept_gen string"
    for rows, want in (([], False), ([(1, None)], False), ([(1, "g1")], True), ([(1, "g2")], False)):
        assert L.stale_visible(frame(spark, rows, kind), "g2").first().stale is want
    assert L.stale_visible(L.flip(frame(spark, [(1, "g1")], kind), "g2"), "g2", marked_inactive=True).first().stale is False


def test_prose_selection(spark):
    rows = [("prose", "An ordinary sentence.", "{}"), ("card", "# CATALOGUE CARD\nx", "{}"), ("image", "[Image] x", '{"image": true}'), ("leaked", "Ordinary.", '{"is_catalogue_card": true}'), ("blank", "  ", "{}"), ("binary", "%PDF\0\0", "{}"), ("signs", "--- ***", "{}")]
    got = S.prose(frame(spark, rows, "id string, content string, metadata string").withColumn("chunk_index", F.lit(1)))
    assert {r.id for r in got.collect()} == {"prose", "leaked"}


def test_llm_phase(spark):
    def model(text):
        if text in ("fail", "late"):
            raise RuntimeError if text == "fail" else TimeoutError
        item = '{"type": "TERM", "text": "x"}'
        return {"mute": " ", "odd": "no json", "empty": '{"concepts": [], "relations": []}', "part": f'{{"concepts": [{item}, {{"text": ""}}]}}'}.get(text, f'{{"concepts": [{item}]}}')

    texts = ["text", "fail", "late", "mute", "odd", "empty", "part", " "]
    rows = frame(spark, [(t, t) for t in texts] + [("null", None)], "source_key string, text string")
    always = {"text": "done", "fail": "not_ready", "mute": "not_ready", "empty": "done", "part": "error", " ": "done", "null": "error"}
    for attempt, state in ((1, "not_ready"), (2, "error")):
        got = I.concepts(rows, model, {"TERM"}, set(), attempt=attempt).collect()
        assert {r.source_key: r.state for r in got} == always | {"late": state, "odd": state}
        assert [len(r.concepts) for r in got if r.source_key in ("text", "part")] == [1, 0]
    assert {r.state for r in I.concepts(rows, model, {"TERM"}, set(), enabled=False).where("source_key <> 'null'").collect()} == {"skipped"}
    assert {r.state for r in I.concepts(rows, None, {"TERM"}, set()).collect()} == {"error"}


def test_store_publishes_snapshots(spark, tmp_path):
    store = L.Store(spark, f"file://{tmp_path}/store")
    assert store.publish({"docs": spark.range(3).toDF("id")}, expected=0) == 1
    before = store.manifest()
    assert store.publish({"docs": store.read("docs").where("id > 0")}) == 2
    assert store.read("docs").count() == 2 and store.read("docs", before).count() == 3
    with pytest.raises(RuntimeError):
        store.publish({"docs": spark.range(1).toDF("id")}, expected=1)
    real = store.manifest
    store.manifest = lambda: before  # a writer who read before the other published
    with pytest.raises(RuntimeError):
        store.publish({"docs": spark.range(1).toDF("id")})
    store.manifest = real
    (tmp_path / "store" / "manifest-9.json").write_text('{"version": 9, "tab')  # a manifest that is still being written
    assert store.manifest()["version"] == 2


def test_swap_of_the_embedder(spark, tmp_path):
    store = L.Store(spark, f"file://{tmp_path}/swap")
    docs = frame(spark, [("a", "xx"), ("b", ""), ("c", None)], "id string, content string")
    store.publish({"docs": docs, "entity_vectors_v1": frame(spark, [(1, [1.0]), (2, None)], "id bigint, vector array<double>"), "vectors_v1": docs.select("id")})
    assert L.swap_embedder(store, lambda ts: [[float(len(t)), 0.0] for t in ts], lambda v: v.select(F.col("id").alias("src"), F.col("id").alias("dst"))) == "v2"
    now = store.manifest()
    assert set(now["tables"]) == {"docs", "vectors_v2", "similar_v2", "entity_vectors_v2"} and now["generation"] == "v2"
    assert [tuple(r) for r in store.read("vectors_v2").collect()] == [("a", [2.0, 0.0])] and [r.id for r in store.read("entity_vectors_v2").collect()] == [1]


def test_scopes_of_provenance(spark):
    edges = frame(spark, [("kb", ["f"], None), ("both", ["f", "chat:1:f"], None), ("chat", ["chat:1:f", "chat:1:g"], "g1"), ("none", None, None), ("empty", [], None)], "src string, files array<string>, concept_gen string")
    left = lambda phase="both", **scope: {r.src: r.files for r in L.strip_provenance(edges, L.in_scope(**scope), phase).collect()}
    rest = {"none": None, "empty": []}
    assert left(key="f") == rest | {"both": ["chat:1:f"], "chat": ["chat:1:f", "chat:1:g"]}
    assert left(prefix="chat:1:") == rest | {"kb": ["f"], "both": ["f"]}
    assert left(knowledge_base=True) == rest | {"both": ["chat:1:f"], "chat": ["chat:1:f", "chat:1:g"]}
    assert left("llm", prefix="chat:1:") == rest | {"kb": ["f"], "both": ["f", "chat:1:f"]}


def test_temporary_tables_are_removed(spark):
    from pathlib import Path

    from marlweave import session

    with session.temporary_tables():
        df = session.materialize(spark.range(3), "t")
        at = Path(session._written[-1][1].removeprefix("file://").removeprefix("file:"))
        assert df.count() == 3 and at.exists()
    assert not at.exists()


def test_streaming(spark, tmp_path):
    from marlweave.streaming import ingest

    at = str(tmp_path / "in")
    rows = [("a", "2025-01-01 00:00:00", "t"), ("a", "2025-01-01 00:00:00", "t"), ("b", "2025-01-01 00:30:00", "t")]
    spark.createDataFrame(rows, "id string, at string, tenant string").selectExpr("id", "cast(at as timestamp) at", "tenant").write.parquet(at)
    stream = spark.readStream.schema("id string, at timestamp, tenant string").parquet(at)
    seen = []
    q = ingest.upserting(ingest.deduplicated(stream, "id", "at"), lambda df, n: seen.extend(r.id for r in df.collect()), str(tmp_path / "cp"))
    q.awaitTermination(60)
    assert sorted(seen) == ["a", "b"]
    assert {(r.tenant, r.n) for r in ingest.windowed(spark.read.parquet(at), "at", "tenant", "1 hour").collect()} == {("t", 3)}


def test_entry_points(spark):
    import __spark_entry__ as e

    assert set(e.oracle_sql()) <= set(e.queries())
    assert len(e.queries()) > 90


def test_neighbours_and_ranks_of_a_hot_source(spark, monkeypatch):
    import random
    from datetime import datetime, timedelta

    r = random.Random(1)
    start = datetime(2025, 1, 1)
    rows = [(f"d{i:03}", "t", r.choice(["s", "s", "s", "u"]), start + timedelta(minutes=r.randrange(5000)), r.choice([0, 1, 2]), "{}") for i in range(200)]
    docs = frame(spark, rows, "id string, tenant_id string, source_key string, created_at timestamp, chunk_index int, metadata string")
    want = set()
    for s in "su":
        order = [x[0] for x in sorted((x for x in rows if x[2] == s), key=lambda x: (x[4], x[3], x[0]))]
        want |= set(zip(order, order[1:]))
    assert {(x.src, x.dst) for x in A.next_edges(docs).collect()} == want
    monkeypatch.setattr(A, "CUT_ROWS", 10)  # as if the source had very many rows of a few places
    placed = docs.select("id", "tenant_id", "source_key", "created_at", F.col("chunk_index").alias("place"))
    for places in (1, 2, 256):
        assert {(x.src, x.dst) for x in A._following(placed, ["tenant_id", "source_key"], places, 10).collect()} == want
    for s in "su":
        order = [x[0] for x in sorted((x for x in rows if x[2] == s), key=lambda x: (x[3], x[0]))]
        got = {x.id: x.n for x in A.numbered(docs, ["tenant_id", "source_key"]).where(F.col("source_key") == s).collect()}
        assert got == {d: i for i, d in enumerate(order)}


def test_co_mentions_of_usual_and_wide_documents(spark, monkeypatch):
    entities = frame(spark, [(i, f"n{i}") for i in range(12)], "id bigint, norm string")
    mentions = frame(spark, [("wide", i) for i in range(12)] + [("a", 0), ("a", 1), ("b", 1), ("b", 2)], "doc_id string, entity_id bigint")
    docs = frame(spark, [("wide", "t", "w"), ("a", "t", "x"), ("b", "t", "y")], "id string, tenant_id string, source_key string")
    edges = frame(spark, [("t", "n0", "n1"), ("t", "n1", "n2"), ("t", "n5", "n4"), ("t", "n0", "gone"), ("u", "n0", "n1")], "tenant_id string, src string, dst string")
    want = {("n0", "n1"): "w,x", ("n1", "n2"): "w,y", ("n5", "n4"): "w"}
    for most in (256, 5, 0):
        monkeypatch.setattr(A, "MANY_NAMES", most)
        assert {(x.src, x.dst): x["keys"] for x in A.co_mentioned(edges, entities, mentions, docs).collect()} == want


def test_technologies_come_from_one_scan(spark):
    docs = frame(spark, [("a", "Redis and redis, then Go."), ("b", "nothing"), ("c", None)], "id string, content string")
    got = {tuple(x) for x in A.technologies(docs, [r"\b(Redis|MySQL)\b", r"\b(Go)\b"]).collect()}
    assert got == {("a", "Redis", 0, 5, 0.85), ("a", "redis", 10, 15, 0.85), ("a", "Go", 22, 24, 0.85)}
    docs = frame(spark, [("a", "google, go")], "id string, content string")
    assert {tuple(x)[1:4] for x in A.technologies(docs, [r"\b(Go)\b"]).collect()} == {("go", 8, 10)}


def test_containing_finds_names_of_any_length(spark):
    long = " ".join(f"w{i}" for i in range(12))
    entities = frame(spark, [(1, "t", long), (2, "t", "go"), (3, "t", "Red Fox"), (4, "u", "red fox"), (5, "t", "c++"), (6, "t", None), (7, None, "red"), (8, "t", "red fox")], "id bigint, tenant_id string, name string")
    docs = frame(spark, [("a", "t", f"x {long.upper()}, the red foxes"), ("b", "t", "red-fox go C++11"), ("c", "t", None), ("d", "u", "bored foxes: red fox"), ("e", "t", "")], "id string, tenant_id string, content string")
    for most in (100, 1):
        assert {tuple(x) for x in A.containing(entities, docs, most_names=most).collect()} == {("a", 1), ("a", 3), ("a", 8), ("b", 5), ("d", 4)}
    assert A.containing(entities.limit(0), docs).count() == A.containing(entities, docs.limit(0)).count() == 0


def test_containing_joins_the_nodes_of_a_name_outside_the_workers(spark):
    entities = spark.range(700).select("id", F.lit("t").alias("tenant_id"), F.when(F.col("id") < 600, "Red Fox").otherwise(F.concat(F.lit("fox "), F.col("id"))).alias("name"))
    docs = frame(spark, [("a", "t", "the red fox, a RED FOX and fox 650"), ("b", "t", "red foxes"), ("b", "t", "red foxes"), ("c", "u", "red fox")], "id string, tenant_id string, content string")
    for most in (1000, 1):
        got = A.containing(entities, docs, most_names=most)
        assert sorted(tuple(x) for x in got.collect()) == sorted([(d, e) for d in ("a", "b") for e in range(600)] + [("a", 650)])
        plan = got._jdf.queryExecution().analyzed().toString().splitlines()
        out = next(x for x in plan if "InPandas" in x)
        assert "low#" in out.rpartition("[")[2] and "entity_id" not in out  # a worker gives names, not pairs


def test_backfill_asks_texts_for_concepts_without_provenance_only(spark):
    entities = frame(spark, [(1, "t", "red", "CONCEPT"), (2, "t", "fox", "CONCEPT"), (3, "t", "dog", "CONCEPT"), (4, "t", "fox", "PERSON"), (5, "t", "fox", "CONCEPT")], "id bigint, tenant_id string, name string, type string")
    docs = frame(spark, [("a", "t", "red fox"), ("b", "t", "red dog")], "id string, tenant_id string, content string")
    mentions = frame(spark, [("a", 1, 0.5), ("a", 1, 0.7), ("b", 4, 0.5)], "doc_id string, entity_id bigint, confidence double")
    provenance = frame(spark, [("a", 1), ("x", 3)], "doc_id string, entity_id bigint")
    asked = []

    def contained(bare):
        asked.extend(r.id for r in bare.collect())
        return A.containing(bare, docs)

    assert sorted(tuple(x) for x in L.backfill(entities, mentions, contained, provenance).collect()) == [("a", 1), ("a", 2), ("a", 5), ("b", 4), ("x", 3)]
    assert sorted(asked) == [2, 5]


def test_routes_of_writes(spark):
    points = frame(spark, [("t", "declarative", "f", "f"), ("t", "declarative", "g", "g"), ("t", "declarative", "h", "h"), ("t", "declarative", "i", "i"), ("t", "declarative", None, "unknown"), ("t", "procedural", "f", "f")], "tenant_id string, collection string, source string, source_key string")
    status = frame(spark, [("f", "processing", "embedding"), ("g", "processing", "parsing"), ("h", "completed", None)], "source_key string, status string, phase string")
    routes = S.routes(points, status)
    assert {(r.collection[:4], r.source_key): r.route for r in routes.collect()} == {("decl", "f"): "phase", ("decl", "g"): "resume", ("decl", "h"): "resume", ("decl", "i"): "job", ("decl", "unknown"): "similarity", ("proc", "f"): "none"}
    assert {tuple(r) for r in S.after_outside_writes(routes, status).collect()} == {("g", "due"), ("h", "due"), ("i", "job")}
    assert {tuple(r) for r in S.after_outside_writes(routes, status, transferring=True).collect()} == {("i", "job")}
    held = frame(spark, [("a", "g", []), ("b", "g", [1.0]), ("c", "f", []), ("d", "g", None)], "id string, source_key string, vector array<double>")
    assert {r.id for r in S.staged(held, status).where("staged").collect()} == {"a"}


def test_write_plans(spark):
    entities = frame(spark, [("a",)] * 3 + [("b",)] * 5, "k string")
    relations = frame(spark, [("a",)] * 2 + [("b",)] * 1 + [("c",)] * 6, "k string")
    assert {tuple(r) for r in A.write_plans(entities, relations, "k", 5).collect()} == {("a", 1), ("b", 2), ("c", 2)}


def test_accumulated_text_counts_contents_only(spark):
    rows = [("t", "s", "c1", 1, "aaaa"), ("t", "s", "c2", 2, "bbbb"), ("t", "s", "c3", 3, "cc"), ("t", "s", "c4", 4, "dd"), ("t", "u", "c5", None, "xx"), ("t", "u", "c6", 1, "yy")]
    prose = frame(spark, rows, "tenant_id string, source_key string, id string, position int, content string")
    got = {r.source_key: r.text for r in A.accumulated_text(prose, 8).collect()}
    assert got == {"s": "aaaa\n\nbb [truncated]", "u": "yy\n\nxx"}
    assert {tuple(r)[1:] for r in A.accumulated(prose, 8).collect()} == {("s", 3, 8), ("u", 2, 6)}


def test_pages_by_key(spark):
    docs = frame(spark, [(f"d{i}", "t", "c") for i in range(7)], "id string, tenant_id string, collection string")
    seen, after = [], None
    while rows := [r.id for r in S.page_after(docs, "t", "c", 3, after).collect()]:
        seen, after = seen + rows, rows[-1]
    assert seen == [f"d{i}" for i in range(7)]


def test_refresh_writes_a_node_and_mention_for_every_hit(spark):
    kind = "id bigint, tenant_id string, name string, norm string, type string, types array<string>, confidence double, documents array<string>, tracked boolean, concept_gen string"
    node = lambda i, tenant, name, type: (i, tenant, name, name.lower(), type, [type], 0.5, [], False, None)
    entities = frame(spark, [node(1, "t", "Redis", "TECHNOLOGY"), node(2, "t", "Glossary", "CONCEPT"), node(3, "t", "Glossary", "EVENT"), node(4, "t", "Old", "TECHNOLOGY"), node(5, "u", "Redis", "PERSON")], kind)
    mentions = frame(spark, [("d0", 2), ("d0", 3), ("d0", 4)], "doc_id string, entity_id bigint")
    hits = frame(spark, [("d1", "t", "redis"), ("d1", "t", "glossary"), ("d2", "t", "roadmap"), ("d3", "t", "Roadmap "), ("d4", "v", "redis")], "doc_id string, tenant_id string, name string")
    provenance = frame(spark, [], "doc_id string, entity_id bigint")
    for _ in range(2):
        written = L.upsert_technologies(entities, hits, provenance)
        out = L.refresh_technologies(written["entities"], mentions, written["found"], written["provenance"])
        entities, mentions, provenance = (frame(spark, df.collect(), df.schema) for df in (out["entities"], out["mentions"], written["provenance"]))
        nodes = {r.id: r for r in entities.collect()}
        named = {(r.tenant_id, r.norm): r.id for r in nodes.values() if r.id > 5}
        assert set(nodes) == {1, 2, 3, 5, *named.values()} and set(named) == {("t", "roadmap"), ("v", "redis")}
        found = {("d1", 1), ("d1", 2), ("d2", named["t", "roadmap"]), ("d3", named["t", "roadmap"]), ("d4", named["v", "redis"])}
        assert {tuple(r) for r in mentions.collect()} == found | {("d0", 3)} and {tuple(r) for r in provenance.collect()} == found
        assert (nodes[2].type, nodes[2].types, nodes[2].confidence, nodes[2].documents, nodes[2].tracked) == ("CONCEPT", ["CONCEPT", "TECHNOLOGY"], 0.85, ["d1"], True)
        assert nodes[3].types == ["EVENT"] and nodes[5].types == ["PERSON"] and nodes[named["t", "roadmap"]].documents == ["d2"]


def test_vectors_of_merged_and_upserted_nodes(spark):
    rows = frame(spark, [("k", "A", "T", "d2", 0.5, 2, [2.0]), ("k", "a", "T", "d1", 0.7, 1, None), ("j", "B", None, "d1", None, 3, None)], "key string, name string, type string, doc_id string, confidence double, ord int, vector array<double>")
    merged = {r.key: r for r in A.merge_entities(rows).collect()}
    assert (merged["k"].name, merged["k"].vector, merged["k"].documents, merged["k"].confidence) == ("a", [2.0], ["d1", "d2"], 0.7) and merged["j"].vector is None
    kind = "key string, name string, type string, types array<string>, documents array<string>, confidence double, concept_gen string, vector array<double>"
    old = frame(spark, [("k", "O", "T", ["T"], [], 0.9, "g1", [1.0]), ("l", "L", "T", ["T"], [], 0.9, None, [1.0])], kind)
    new = frame(spark, [("k", "N", "U", None, ["d"], 0.1, None, None), ("l", "N", "U", None, ["d"], 0.1, None, [3.0]), ("m", "M", "U", None, ["d"], 0.1, None, [4.0])], kind)
    got = {r.key: (r.type, r.types, r.confidence, r.concept_gen, r.vector) for r in A.upsert_entities(old, new).collect()}
    assert got == {"k": ("T", ["T", "U"], 0.9, None, [1.0]), "l": ("T", ["T", "U"], 0.9, None, [3.0]), "m": ("U", ["U"], 0.1, None, [4.0])}


def test_maintenance(spark):
    from marlweave.operators import checks as C

    rows = [("new", "embedding", "running", None), ("ok", "embedding", "done", None), ("ok", "ner", "done", "t"), ("old", "embedding", "done", None), ("old", "ner", "done", "s"), ("bad", "embedding", "done", None), ("bad", "ner", "error", "t")]
    status = frame(spark, rows, "source_key string, phase string, state string, tag string")
    act = lambda drift: {r.source_key: r.action for r in C.plan(status, {"ner": "t"}, drift).collect()}
    assert act(False) == {"new": "reingest", "ok": "none", "old": "graph", "bad": "resume"} and act(True) == {"new": "reingest", "ok": "reembed", "old": "reembed", "bad": "resume"}
    assert [C.exit_code([True], True), C.exit_code([True, False], True), C.exit_code([], False), C.exit_code([], True, dry_run=True)] == [0, 1, 1, 2]
    assert C.generation_current("a", "a") and not C.generation_current(None, "a")


def test_wiping_and_dropping_a_tenant(spark):
    tables = {
        "docs": frame(spark, [("a", "t", "s", "c"), ("b", "u", "s", "c")], "id string, tenant_id string, source_key string, collection string"),
        "entities": frame(spark, [(1, "t", "x"), (2, "t", "y"), (3, "u", "x")], "id bigint, tenant_id string, norm string"),
        "mentions": frame(spark, [("a", 1), ("b", 2), ("b", 3)], "doc_id string, entity_id bigint"),
        "provenance": frame(spark, [("a", 1)], "doc_id string, entity_id bigint"),
        "edges": frame(spark, [("t", "x", "y"), ("u", "x", "y")], "tenant_id string, src string, dst string"),
        "similar": frame(spark, [("a", "a"), ("b", "b")], "src string, dst string"),
        "collections": frame(spark, [("t", "c"), ("u", "c")], "tenant_id string, collection string"),
        "source_files": frame(spark, [("t", "s"), ("u", "s")], "tenant_id string, source_key string"),
    }
    wiped, dropped = L.wipe_tenant(tables, "t"), L.drop_tenant(tables, "t")
    assert {k: wiped[k].count() for k in ("docs", "entities", "mentions", "provenance", "edges", "similar")} == {"docs": 2, "entities": 2, "mentions": 2, "provenance": 0, "edges": 1, "similar": 1}
    assert {r.id for r in wiped["entities"].collect()} == {2, 3}  # 2 is still mentioned by another tenant's document
    assert {k: dropped[k].count() for k in ("docs", "collections", "entities", "mentions", "provenance", "source_files")} == {"docs": 1, "collections": 1, "entities": 2, "mentions": 2, "provenance": 0, "source_files": 1}
