"""Graph assembly: extraction results to nodes and edges, folds of duplicates, upserts and structure edges."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from ..functions.text import proximity_type, strip
from ..session import materialize, ship, splits

#: Window of proximity in characters, entities up to which all pairs co-occur, rows of a write batch and ids of a delete batch.
NEAR, CO_OCCURRING, WRITE_BATCH, DELETE_BATCH = 100, 10, 5000, 100
LAST, MANY_NAMES = 64, 256


def best_per_name(extracted: DataFrame) -> DataFrame:
    """(doc_id, key, name, type, start, end, confidence): of each name of a document the surest extraction, of equals the first."""
    key = F.lower(strip(F.col("name")))
    order = F.struct(F.coalesce(-F.col("confidence"), F.lit(0.0)).alias("c"), F.col("extraction_id").alias("x"), "name", "type", "start", "end", "confidence")
    best = extracted.withColumn("key", key).where("key <> ''").groupBy("doc_id", "key").agg(F.min(order).alias("b"))
    return best.select("doc_id", "key", "b.name", "b.type", "b.start", "b.end", "b.confidence")


def technologies(docs: DataFrame, patterns: list[str], confidence: float = 0.85) -> DataFrame:
    """(doc_id, name, start, end, confidence): every match of every pattern as the text spells it, with its place in code points.

    Patterns are read without regard to case. Only texts that can hold a match leave the JVM."""
    import re
    from collections.abc import Iterator

    import pandas as pd

    ship(docs.sparkSession)
    any_of = "(?iu)" + "|".join(f"(?:{p})" for p in patterns).replace(r"\b", "")

    def run(it: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        compiled = [re.compile(p, re.I) for p in patterns]
        for pdf in it:
            out = [(d, m[0], m.start(), m.end()) for d, t in zip(pdf["doc_id"], pdf["content"]) for p in compiled for m in p.finditer(t)]
            yield pd.DataFrame(out, columns=["doc_id", "name", "start", "end"])

    found = docs.where(F.col("content").rlike(any_of)).select(F.col("id").alias("doc_id"), "content").mapInPandas(run, "doc_id string, name string, start int, end int")
    return found.withColumn("confidence", F.lit(confidence))


def proximity(entities: DataFrame, docs: DataFrame, known: DataFrame | None = None) -> DataFrame:
    """(doc_id, source, target, type, weight): entities of a document whose second begins less than 100 characters after the first ends.

    The range condition is met by buckets of the window's size, each start looked up in the buckets that it can reach.
    known (doc_id, source, target) holds pairs that have a relation already. The type follows from the text between."""
    a = entities.select("doc_id", F.col("name").alias("source"), F.col("start").alias("s1"), F.col("end").alias("e1"), F.explode(F.sequence(F.expr(f"start div {NEAR}"), F.expr(f"greatest(start, end + {NEAR}) div {NEAR}"))).alias("bucket"))
    b = entities.select("doc_id", F.col("name").alias("target"), F.col("start").alias("s2"), F.expr(f"start div {NEAR}").alias("bucket"))
    pairs = a.join(b, ["doc_id", "bucket"]).where(f"(s1, source) < (s2, target) AND s2 - e1 < {NEAR}").drop("bucket")
    if known is not None:
        pairs = pairs.join(known.select("doc_id", "source", "target").distinct(), ["doc_id", "source", "target"], "left_anti")
    between = F.expr("CASE WHEN s2 > e1 THEN substring(content, e1 + 1, s2 - e1) ELSE '' END")
    rows = pairs.join(docs.select(F.col("id").alias("doc_id"), "content"), "doc_id")
    return rows.select("doc_id", "source", "target", proximity_type(between).alias("type"), F.lit(0.6).alias("weight"))


def co_occurrence(entities: DataFrame, most: int = CO_OCCURRING) -> DataFrame:
    """(doc_id, source, target, weight): all pairs of a document of at most `most` entities; the weight is (c1 + c2) / 4."""
    few = entities.groupBy("doc_id").agg(F.count("*").alias("n")).where(F.col("n") <= most).select("doc_id")
    held = entities.join(few, "doc_id", "left_semi").select("doc_id", "name", F.coalesce("confidence", F.lit(0.5)).alias("c"))
    a, b = (held.select("doc_id", F.col("name").alias(n), F.col("c").alias(c)) for n, c in (("source", "c1"), ("target", "c2")))
    return a.join(b, "doc_id").where("source < target").select("doc_id", "source", "target", ((F.col("c1") + F.col("c2")) / 4).alias("weight"))


def overlapping(tokens: DataFrame, entities: DataFrame) -> DataFrame:
    """(doc_id, token, s, name): each token with the first entity, by start, that its span overlaps, else the first that the span of its subtree does, if that has two to five tokens.

    tokens has doc_id, token, s, e and, of the subtree, sub_s, sub_e and sub_n."""
    held = entities.select("doc_id", "name", "start", "end")
    wide = F.col("sub_n").between(2, 5)
    met = tokens.withColumns({"lo": F.when(wide, F.least("s", "sub_s")).otherwise(F.col("s")), "hi": F.when(wide, F.greatest("e", "sub_e")).otherwise(F.col("e"))}).join(held, "doc_id").where("lo < end AND start < hi")
    own = F.when(F.expr("s < end AND start < e"), F.struct("start", "name"))
    sub = F.when(wide & F.expr("sub_s < end AND start < sub_e"), F.struct("start", "name"))
    first = F.coalesce(F.min(own), F.min(sub))
    return met.groupBy("doc_id", "token", "s").agg(first["name"].alias("name")).where("name IS NOT NULL")


def merge_mentions(mentions: DataFrame) -> DataFrame:
    """The highest confidence of each document and entity."""
    return mentions.groupBy("doc_id", "entity_id").agg(F.max("confidence").alias("confidence"))


def merge_entities(rows: DataFrame) -> DataFrame:
    """(key, name, type, documents, confidence): entities of many documents as one; the first name, type and, where rows have one, vector in the order of ord, all documents, the highest confidence.

    rows has key, name, type, doc_id, confidence and ord."""
    first = lambda c: F.min_by(c, F.when(F.col(c).isNotNull() & (F.col(c) != ""), F.col("ord")))
    return rows.groupBy("key").agg(first("name").alias("name"), first("type").alias("type"), F.sort_array(F.collect_set("doc_id")).alias("documents"), F.max("confidence").alias("confidence"), *([F.min_by("vector", F.when(F.col("vector").isNotNull(), F.col("ord"))).alias("vector")] if "vector" in rows.columns else []))


def fold_weights(rows: DataFrame, key: list[str], order: str, weight: str = "weight") -> DataFrame:
    """(key..., weight, n): duplicates folded in order, each with the mean so far: 1, 2, 3 gives 2.25. Null weights are skipped.

    A weight counts half as much with each one that follows, so the last 64 give the result to the last bit; they are
    picked in two steps, so that a key with very many rows isn't sorted in one task."""
    rows = rows.where(F.col(weight).isNotNull())
    n = rows.groupBy(*key).agg(F.count("*").alias("n"))
    salted = rows.withColumn("_salt", F.pmod(F.xxhash64(order), F.lit(16)))
    for by in ([*key, "_salt"], key):
        salted = salted.withColumn("_r", F.row_number().over(W.partitionBy(*by).orderBy(F.col(order).desc()))).where(F.col("_r") <= LAST)
    lists = salted.groupBy(*key).agg(F.sort_array(F.collect_list(F.struct(F.col(order).alias("o"), F.col(weight).alias("w")))).alias("l"))
    folded = F.aggregate(F.slice("l", 2, LAST), F.element_at("l", 1)["w"], lambda a, x: (a + x["w"]) / 2)
    return lists.select(*key, folded.alias("weight")).join(n, key)


def upsert_entities(old: DataFrame, new: DataFrame) -> DataFrame:
    """Nodes after writing new ones. Both have key, name, type, types, documents, confidence, concept_gen.

    An existing node keeps its type, takes the new name, adds a new type, unites documents, keeps the higher confidence
    and loses its concept tag; a new one starts with its type alone. Where both have a vector, a new one replaces the old
    one and none leaves it as it is."""
    o = old.select("key", *[F.col(c).alias(f"o_{c}") for c in old.columns if c != "key"])
    vectors = ["vector"] if "vector" in old.columns and "vector" in new.columns else []
    n = new.select("key", *[F.col(c).alias(f"n_{c}") for c in ("name", "type", "documents", "confidence", *vectors)])
    both = o.join(n, "key", "full_outer")
    there, written = F.col("o_type").isNotNull() | F.col("o_name").isNotNull(), F.col("n_name").isNotNull()
    types = F.when(~written, F.col("o_types")).when(~there, F.array("n_type")).otherwise(F.array_union("o_types", F.array("n_type")))
    none = F.array().cast("array<string>")
    return both.select("key", F.coalesce("n_name", "o_name").alias("name"), F.coalesce("o_type", "n_type").alias("type"), types.alias("types"), F.array_union(F.coalesce("o_documents", none), F.coalesce("n_documents", none)).alias("documents"), F.greatest("o_confidence", "n_confidence").alias("confidence"), F.when(~written, F.col("o_concept_gen")).alias("concept_gen"), *[F.coalesce("n_vector", "o_vector").alias("vector") for _ in vectors])


def upsert_mentions(old: DataFrame, new: DataFrame) -> DataFrame:
    """Mentions after writing new ones: the last confidence wins."""
    return new.select("doc_id", "entity_id", "confidence").unionByName(old.select("doc_id", "entity_id", "confidence").join(new, ["doc_id", "entity_id"], "left_anti"))


def upsert_relations(old: DataFrame, new: DataFrame, key: list[str] | None = None) -> DataFrame:
    """Relations after writing new ones: the mean of old and new weight; files that are old only come first, then the new ones."""
    k = key or ["src", "dst", "type"]
    both = old.select(*k, F.col("weight").alias("ow"), F.col("files").alias("of")).join(new.select(*k, F.col("weight").alias("nw"), F.col("files").alias("nf")), k, "full_outer")
    none = F.array().cast("array<string>")
    weight = F.when(F.col("ow").isNull(), F.col("nw")).when(F.col("nw").isNull(), F.col("ow")).otherwise((F.col("ow") + F.col("nw")) / 2)
    return both.select(*k, weight.alias("weight"), F.concat(F.array_except(F.coalesce("of", none), F.coalesce("nf", none)), F.coalesce("nf", none)).alias("files"))


def upsert_concepts(old: DataFrame, new: DataFrame, generation: str) -> DataFrame:
    """Nodes (key, name, type, concept_gen) after writing concepts (key, name, type): only created nodes get the tag; tagged ones that are found again move to the new generation, base nodes stay as they are."""
    o = old.select("key", F.col("name").alias("on"), F.col("type").alias("ot"), "concept_gen", F.lit(True).alias("there"))
    n = new.select("key", F.col("name").alias("nn"), F.col("type").alias("nt"), F.lit(True).alias("found"))
    tag = F.when(F.col("there").isNull() | (F.col("found") & F.col("concept_gen").isNotNull()), F.lit(generation)).otherwise(F.col("concept_gen"))
    return o.join(n, "key", "full_outer").select("key", F.coalesce("on", "nn").alias("name"), F.coalesce("ot", "nt").alias("type"), tag.alias("concept_gen"))


def batches(kind: DataFrame, size: int = WRITE_BATCH) -> DataFrame:
    """(kind, batches): how many batches of a size the rows of each kind need."""
    return kind.groupBy("kind").agg(F.ceil(F.count("*") / size).cast("bigint").alias("batches"))


def write_plans(entities: DataFrame, relations: DataFrame, key: str, size: int = WRITE_BATCH) -> DataFrame:
    """(key, plans): in how many transactions each key's graph is written: one if its entities and relations together are no more than size, else batches of entities and then of relations."""
    rows = entities.select(key, F.lit(1).alias("e")).unionByName(relations.select(key, F.lit(0).alias("e")))
    n = rows.groupBy(key).agg(F.sum("e").alias("es"), F.count("*").alias("all"))
    many = F.ceil(F.col("es") / size) + F.ceil((F.col("all") - F.col("es")) / size)
    return n.select(key, F.when(F.col("all") <= size, 1).otherwise(many).cast("bigint").alias("plans"))


def next_edges(docs: DataFrame) -> DataFrame:
    """(src, dst): consecutive chunks of a source, cards left out, in the order of start_index, else chunk_index; chunks without a place only if none has one, by arrival and id."""
    card = F.coalesce(F.get_json_object("metadata", "$.is_catalogue_card") == "true", F.lit(False))
    place = F.coalesce(F.get_json_object("metadata", "$.start_index").cast("int"), F.col("chunk_index"))
    rows = docs.where(~card).select("id", "tenant_id", "source_key", "created_at", place.alias("place"))
    placed = rows.groupBy("tenant_id", "source_key").agg(F.max("place").alias("some"))
    rows = rows.join(placed, ["tenant_id", "source_key"]).where("some IS NULL OR place IS NOT NULL")
    return _following(rows, ["tenant_id", "source_key"])


#: Places in a cut of a source, and rows above which a cut is made finer.
CUT_PLACES, CUT_ROWS = 256, 100_000


def _following(rows: DataFrame, key: list[str], places: int = CUT_PLACES, most: int = CUT_ROWS) -> DataFrame:
    """(src, dst): neighbours within a key in the order of place, created_at and id.

    A key is cut into ranges of places, and a range with very many rows into the rows of one place and hour; neighbours
    are found inside the cuts, and the last of one leads to the first of the next. No task sorts a whole key: rows are
    sorted by cut, and the ends of the cuts are a small part of them."""
    rows = rows.withColumn("at", F.coalesce("place", F.lit(-1))).withColumn("range", F.floor(F.col("at") / places))
    full = rows.groupBy(*key, "range").agg(F.count("*").alias("n")).where(F.col("n") > most).select(*key, "range", F.lit(True).alias("fine"))
    rows = rows.join(full, [*key, "range"], "left").select(*key, "id", "created_at", "at", F.when(F.col("fine"), F.col("at")).otherwise(F.col("range") * places).alias("cut"), F.when(F.col("fine"), F.date_trunc("hour", "created_at")).alias("hour"))
    cut, order = [*key, "cut", "hour"], ["at", "created_at", "id"]
    inner = rows.select(F.col("id").alias("src"), F.lead("id").over(W.partitionBy(*cut).orderBy(*order)).alias("dst"))
    ends = rows.groupBy(*cut).agg(F.min_by("id", F.struct(*order)).alias("first"), F.max_by("id", F.struct(*order)).alias("last"))
    outer = ends.select(F.col("last").alias("src"), F.lead("first").over(W.partitionBy(*key).orderBy("cut", "hour")).alias("dst"))
    return inner.unionByName(outer).where("dst IS NOT NULL")


def numbered(rows: DataFrame, key: list[str]) -> DataFrame:
    """rows with n, the place of each within its key from 0 in the order of created_at and id, counted by days so that no task sorts a whole key."""
    cut = [*key, "day"]
    rows = rows.withColumn("day", F.date_trunc("day", "created_at"))
    days = rows.groupBy(*cut).agg(F.count("*").alias("c"))
    before = days.select(*cut, F.coalesce(F.sum("c").over(W.partitionBy(*key).orderBy("day").rowsBetween(W.unboundedPreceding, -1)), F.lit(0)).alias("before"))
    inner = rows.withColumn("r", F.row_number().over(W.partitionBy(*cut).orderBy("created_at", "id")) - 1)
    same = [F.col(f"x.{c}").eqNullSafe(F.col(f"y.{c}")) for c in cut]
    joined = inner.alias("x").join(before.alias("y"), same)
    return joined.select("x.*", (F.col("x.r") + F.col("y.before")).alias("n")).drop("r", "day")


#: Fixed value: what marks a text that was cut.
CUT = " [truncated]"


def _taken(prose: DataFrame, limit: int) -> DataFrame:
    """The chunks of each source that a language model gets, with position r: in order until the contents before exceed the limit; separators don't count."""
    w = W.partitionBy("tenant_id", "source_key").orderBy(F.col("position").isNull(), "position", "id")
    # a chunk has a character at least: what comes after limit + 2 chunks can't count, and goes before the sums
    near = prose.withColumn("r", F.row_number().over(w)).where(F.col("r") <= limit + 2)
    before = F.coalesce(F.sum(F.length("content")).over(w.rowsBetween(W.unboundedPreceding, -1)), F.lit(0))
    return near.withColumn("before", before).where(F.col("before") <= limit)


def accumulated(prose: DataFrame, limit: int = 12_000) -> DataFrame:
    """(tenant_id, source_key, chunks, chars): how much of each source's text a language model gets: the chunks taken, joined by blank lines and cut to the limit."""
    total = F.sum(F.length("content")) + 2 * (F.count("*") - 1)
    return _taken(prose, limit).groupBy("tenant_id", "source_key").agg(F.count("*").alias("chunks"), F.least(F.lit(limit), total).cast("bigint").alias("chars"))


def accumulated_text(prose: DataFrame, limit: int = 12_000) -> DataFrame:
    """(tenant_id, source_key, text): what accumulated() counts, joined by blank lines; a text that was cut ends with a mark."""
    chunks = F.sort_array(F.collect_list(F.struct("r", F.col("content").alias("c"))))
    whole = F.concat_ws("\n\n", F.transform(chunks, lambda x: x["c"]))
    joined = _taken(prose, limit).groupBy("tenant_id", "source_key").agg(whole.alias("whole"))
    return joined.select("tenant_id", "source_key", F.when(F.length("whole") > limit, F.concat(F.substring("whole", 1, limit), F.lit(CUT))).otherwise(F.col("whole")).alias("text"))


def structure(docs: DataFrame) -> DataFrame:
    """(kind, src, dst): PART_OF from documents to their source, HAS_SUMMARY from sources to their cards, CHILD_OF from documents to the parent that their metadata names, if it is a document of the tenant."""
    card = F.coalesce(F.get_json_object("metadata", "$.is_catalogue_card") == "true", F.lit(False))
    part = docs.select(F.lit("PART_OF").alias("kind"), F.col("id").alias("src"), F.concat_ws("/", "tenant_id", "source_key").alias("dst"))
    named = docs.where(~card).select("tenant_id", F.col("id").alias("src"), F.get_json_object("metadata", "$.parent_id").alias("dst")).where("dst IS NOT NULL AND dst <> ''")
    child = named.join(docs.select("tenant_id", F.col("id").alias("dst")), ["tenant_id", "dst"], "left_semi").select(F.lit("CHILD_OF").alias("kind"), "src", "dst")
    return part.unionByName(child).unionByName(docs.where(card).select(F.lit("HAS_SUMMARY").alias("kind"), F.concat_ws("/", "tenant_id", "source_key").alias("src"), F.col("id").alias("dst")))


def co_mentioned(edges: DataFrame, entities: DataFrame, mentions: DataFrame, docs: DataFrame) -> DataFrame:
    """(tenant_id, src, dst, keys): for each edge the sources of documents that mention both ends."""
    m = mentions.join(entities.select(F.col("id").alias("entity_id"), "norm"), "entity_id").join(docs.select(F.col("id").alias("doc_id"), "tenant_id", "source_key"), "doc_id").select("tenant_id", "doc_id", "source_key", "norm").distinct()
    wanted = edges.select("tenant_id", "src", "dst").distinct()
    ends = wanted.select("tenant_id", F.explode(F.array("src", "dst")).alias("norm")).distinct()
    m = materialize(m.join(ends, ["tenant_id", "norm"], "left_semi"), "named-mentions")
    # A usual document gives its own pairs, so a name in very many documents costs no more than its mentions; a document
    # with very many names is met from the edges instead, so it never gives all its pairs.
    many = m.groupBy("doc_id").agg(F.count("*").alias("names")).where(F.col("names") > MANY_NAMES).select("doc_id")
    few, wide = m.join(many, "doc_id", "left_anti"), m.join(many, "doc_id", "left_semi")
    side = lambda df, c: df.select("tenant_id", "doc_id", "source_key", F.col("norm").alias(c))
    place = ["tenant_id", "doc_id", "source_key"]
    met = side(few, "src").join(side(few, "dst"), place).where("src <> dst").join(wanted, ["tenant_id", "src", "dst"], "left_semi")
    rest = wanted.join(side(wide, "src"), ["tenant_id", "src"]).join(side(wide, "dst"), [*place, "dst"], "left_semi")
    met = met.select("tenant_id", "src", "dst", "source_key").unionByName(rest.select("tenant_id", "src", "dst", "source_key"))
    return met.groupBy("tenant_id", "src", "dst").agg(F.concat_ws(",", F.sort_array(F.collect_set("source_key"))).alias("keys"))


#: Names in one automaton: their number and characters, and the texts that meet it; nodes of a name that its texts meet at once.
BLOCK_NAMES, BLOCK_CHARS, BLOCK_TEXTS, BLOCK_NODES = 100_000, 8_000_000, 20_000, 256


def containing(entities: DataFrame, docs: DataFrame, least: int = 3, most_names: int = BLOCK_NAMES) -> DataFrame:
    """(doc_id, entity_id): entities and the documents of their tenant whose lowered text contains their lowered name, anywhere in it.

    Names of at least `least` characters count. An automaton finds all names of a text in one pass over it. Names within
    the bounds of one block are broadcast; more are cut into blocks, and the texts of a tenant meet each of its blocks in
    parts of bounded size. The workers give each name of a text once; its nodes, which may be very many, are joined to
    it afterwards in parts of bounded size, so that no task holds or sorts the pairs. An entity has one
    name, so that each pair comes once."""
    from collections.abc import Iterator

    import pandas as pd

    spark = docs.sparkSession
    ship(spark)
    low = F.lower("name")
    nodes = materialize(entities.where(F.length(low) >= least).select(F.col("id").alias("entity_id"), "tenant_id", low.alias("low")).where("tenant_id IS NOT NULL").distinct(), "named-nodes")
    names = materialize(nodes.groupBy("tenant_id", "low").agg(F.count("*").alias("nodes")), "names")
    size = names.agg(F.count("*").alias("n"), F.coalesce(F.sum(F.length("low")), F.lit(0)).alias("chars")).first()
    texts = docs.where("content IS NOT NULL").select(F.col("id").alias("doc_id"), "tenant_id", "content")
    columns = ["tenant_id", "doc_id", "low", "nodes"]
    kind = "tenant_id string, doc_id string, low string, nodes bigint"

    if size["n"] <= most_names and size["chars"] <= BLOCK_CHARS:
        held: dict[str, list] = {}
        for r in names.collect():  # within the bounds of a block
            held.setdefault(r["tenant_id"], []).append((r["low"], r["nodes"]))
        shared = spark.sparkContext.broadcast(held)

        def scan(it: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
            automata: dict = {}
            for pdf in it:
                out = []
                for doc, tenant, text in zip(pdf["doc_id"], pdf["tenant_id"], pdf["content"]):
                    if tenant in shared.value:
                        if tenant not in automata:
                            automata[tenant] = _automaton(shared.value[tenant])
                        out += [(tenant, doc, *x) for x in _found(automata[tenant], text)]
                yield pd.DataFrame(out, columns=columns)

        return _nodes_of(texts.mapInPandas(scan, kind), nodes.join(names, ["tenant_id", "low"]))

    block = F.expr("cast(pmod(xxhash64(low), blocks) as int)")
    loads = names.groupBy("tenant_id").agg(F.count("*").alias("n"), F.sum(F.length("low")).alias("chars")).join(texts.groupBy("tenant_id").agg(F.count("*").alias("t")), "tenant_id")
    loads = loads.select("tenant_id", F.expr(f"cast(ceil(greatest(n / {most_names}, chars / {BLOCK_CHARS})) as int)").alias("blocks"), F.expr(f"cast(ceil(t / {BLOCK_TEXTS}) as int)").alias("parts"))
    loads = materialize(loads, "name-blocks")
    left = names.join(loads, "tenant_id").withColumn("block", block).withColumn("part", F.explode(F.expr("sequence(0, parts - 1)"))).select("tenant_id", "block", "part", "low", "nodes")
    right = texts.join(loads, "tenant_id").withColumn("part", F.expr("cast(pmod(xxhash64(doc_id), parts) as int)")).withColumn("block", F.explode(F.expr("sequence(0, blocks - 1)"))).select("tenant_id", "block", "part", "doc_id", "content")
    place = ["tenant_id", "block", "part"]

    def meet(names: pd.DataFrame, texts: pd.DataFrame) -> pd.DataFrame:
        automaton = _automaton(zip(names["low"], names["nodes"]))
        out = [(t, d, *x) for t, d, text in zip(texts["tenant_id"], texts["doc_id"], texts["content"]) for x in _found(automaton, text)]
        return pd.DataFrame(out, columns=columns)

    return _nodes_of(left.groupBy(*place).cogroup(right.groupBy(*place)).applyInPandas(meet, kind), nodes.join(names, ["tenant_id", "low"]))


def _nodes_of(hits: DataFrame, nodes: DataFrame) -> DataFrame:
    """(doc_id, entity_id) of hits (tenant_id, doc_id, low, nodes) and nodes (tenant_id, low, entity_id, nodes); the last column is how many nodes have the name.

    The nodes of a name are cut into parts, each met by the name's texts, and the shuffle isn't coalesced, as the result can be far larger than what is shuffled."""
    key = ["tenant_id", "low", "part"]
    parts = F.expr(f"cast(ceil(nodes / {BLOCK_NODES}) as int)")
    met = hits.distinct().withColumn("part", F.explode(F.sequence(F.lit(0), parts - 1))).select(*key, "doc_id")
    cut = nodes.withColumn("part", F.pmod(F.xxhash64("entity_id"), parts).cast("int")).select(*key, "entity_id")
    n = splits(hits.sparkSession)
    return met.repartition(n, *key).join(cut.repartition(n, *key), key).select("doc_id", "entity_id")


def _automaton(names):
    import ahocorasick

    out = ahocorasick.Automaton()
    for n, nodes in names:
        out.add_word(n, (n, nodes))
    out.make_automaton()
    return out


def _found(automaton, text: str) -> set:
    return {x for _, x in automaton.iter(text.lower())} if len(automaton) else set()
