import random
from collections import Counter
from itertools import combinations

import numpy as np
import pytest

from marlweave.llm import golay, ivfpq, language, leaks, lookalike, packing, residue, together, variants, vec

WORDS = "amber basil cedar delta ember fable grove hazel ivory jolly karma lemon mango noble ocean pearl quilt raven sable tulip umber vivid wheat yacht zebra".split()


def prose(r, n):
    return " ".join(r.choice(WORDS) + str(r.randrange(30)) for _ in range(n))


# words


def test_words_are_runs_of_letters_and_digits():
    w = vec.words(["Der ＩＤ a_b", None, "", "x  der " * 3])
    assert np.bincount(w.doc, minlength=4).tolist() == [4, 0, 0, 6]
    assert w.hashes[0] == w.hashes[5] and len(set(w.hashes[:4])) == 4


def test_hashes_don_t_depend_on_the_batch():
    long = "word " * 700_000 + "end"
    assert vec.words(["end"]).hashes[0] == vec.words([long]).hashes[-1] == vec.words(["a b", long, "end"]).hashes[-1]


# 9: leaks


def doc_items(spark):
    item = " ".join(f"w{i}" for i in range(20))
    rows = [(1, "before " + item + " after", "a"), (2, " ".join(f"w{i}" for i in range(11)), "a"), (3, "x W3, w4 " + " ".join(f"w{i}" for i in range(5, 15)), None), (4, None, "a"), (5, "", "a"), (1, "before " + item + " after", "a"), (None, item, "a"), (6, "pad " * 60_000 + item, "a")]
    docs = spark.createDataFrame(rows, "doc_id bigint, text string, item_id string")
    items = spark.createDataFrame([(7, item, 0), (8, "too short", 0), (9, None, 0), (None, item, 0)], "item_id bigint, text string, doc_id int")
    return docs, items


def test_leaks_report_runs_and_both_paths_agree(spark):
    docs, items = doc_items(spark)
    want = {(1, 7, 1, 20), (3, 7, 1, 12), (6, 7, 60_000, 20)}
    assert {tuple(r) for r in leaks.leaks(docs, items).collect()} == want
    assert {tuple(r) for r in leaks.leaks(docs, items, max_grams=0).collect()} == want
    assert leaks.leaks(docs.limit(0), items).count() == leaks.leaks(docs, items.limit(0)).count() == 0


def test_leaks_can_be_removed(spark):
    docs, items = doc_items(spark)
    assert {r.doc_id for r in leaks.without_leaks(docs, items).collect()} == {2, 4, 5, None}
    cut = {r.doc_id: r.text for r in leaks.without_leaks(docs, items, whole=False).collect()}
    assert cut[1] == "before  after" and cut[3] == "x " and cut[4] is None and cut[5] == ""


# 4: look-alikes


@pytest.mark.parametrize("name, form", [("Ｆｉｔｅ　Ｘ", "Fite X"), ("Gо​bо", "Gobo"), ("Ρazό-Ιndex", "Pazó-Index"), ("a­b‑c", "ab-c"), ("сор", "cop"), ("Привeт", "Привет"), ("Gobo", "Gobo"), ("gobo", "gobo"), ("Göbo", "Göbo"), ("", ""), (None, None), ("\U0001d400b", "Ab")])
def test_consistent_forms(name, form):
    assert lookalike.consistent(name) == form
    assert lookalike.consistent(form) == form


def test_lookalike_nodes(spark):
    rows = [(1, "t", "Gobo", 0), (2, "t", "Gоbo", 0), (2, "t", "Gоbo", 1), (3, "t", "Gobo", 0), (4, "u", "Gоbo", 0), (5, "t", "gobo", 0), (6, "t", None, 0), (7, "t", " ", 0), (8, "t", " ", 0), (None, "t", "Gоbо", 0)]
    df = spark.createDataFrame(rows, "entity_id bigint, tenant_id string, name string, form int")
    assert {tuple(r) for r in lookalike.lookalike_nodes(df).collect()} == {(1, 2), (2, 3)}
    assert lookalike.lookalike_nodes(df.limit(0)).count() == 0


# 2: pairs


@pytest.mark.parametrize("settings", [{}, {"heavy": 1, "share": 10**6, "tile": 7}, {"heavy": 6, "share": 1000, "big": 8}, {"heavy": 1, "share": 10**6}, {"heavy": 10**6, "share": 1, "big": 4}])
def test_pairs_against_brute_force(spark, settings):
    r = random.Random(1)
    rows, baskets = [], {}
    for b in range(120):
        names = {f"i{min(int(r.expovariate(0.25)), 40)}" for _ in range(r.choice([2, 3, 5, 30]))}
        baskets["g" if b % 3 else "h", b] = names
        rows += [("g" if b % 3 else "h", b, n, 1) for n in names for _ in range(r.choice([1, 2]))]
    rows += [(None, 1, "x", 1), ("g", None, "x", 1), ("g", 1, None, 1), ("g", 1, "", 1)]
    want = {}
    for grp in "gh":
        mine = [v for (g, _), v in baskets.items() if g == grp]
        single, both = Counter(x for v in mine for x in v), Counter(p for v in mine for p in combinations(sorted(v), 2))
        want |= {(grp, a, b): (c, single[a], single[b], len(mine)) for (a, b), c in both.items() if c >= 5 and c * len(mine) >= 2 * single[a] * single[b]}
    df = spark.createDataFrame(rows, "grp string, basket int, item string, n int")
    got = {(x.grp, x.item_a, x.item_b): (x.n_ab, x.n_a, x.n_b, x.n) for x in together.pair_counts(df, lift=2, **settings).collect()}
    assert got == want and want
    assert together.pair_counts(df.limit(0)).count() == 0


# 7: near-duplicates


def test_golay_code_decodes():
    e = golay._errors()
    assert len(e) == 2048 and (np.bitwise_count(e[:, 0]) <= 3).all()
    x = np.random.default_rng(1).integers(0, 1 << 23, 500).astype(np.uint32)
    near = golay.indices(x)
    for a in range(0, 23):
        y = golay.indices(x ^ np.uint32(1 << a) ^ np.uint32(1 << (a + 5) % 23))
        assert (near[:, :, None] == y[:, None, :]).any((1, 2)).all()


def test_near_duplicates_against_brute_force(spark):
    r = random.Random(3)
    texts = {}
    for i in range(60):
        words = prose(r, 80).split()
        texts[f"d{i}"] = " ".join(words)
        for k in range(r.choice([0, 1, 2])):
            edited = words[:]
            for _ in range(r.choice([0, 2, 6])):
                edited[r.randrange(len(edited))] = "edit" + str(r.random())[2:8]
            texts[f"d{i}e{k}"] = " ".join(edited[r.choice([0, 5]) :])
    sets = {k: {tuple(w[i : i + 3]) for i in range(len(w) - 2)} for k, w in ((k, t.split()) for k, t in texts.items())}
    want = {(a, b) for a, b in combinations(sorted(sets), 2) if len(sets[a] & sets[b]) >= 0.5 * len(sets[a] | sets[b])}
    rows = [(k, t, 1) for k, t in texts.items()] + [("d0", texts["d0"], 2), ("n", None, 1), ("e", "", 1), ("s", "too short", 1), (None, texts["d1"], 1)]
    docs = spark.createDataFrame(rows, "document_id string, content string, rep int")
    members, links = golay.near_duplicates(docs, n=3, similarity=0.5, least=10)
    got = {tuple(x) for x in golay.document_pairs(members, links).collect()}
    alike = {(a, b) for a, b in want if len(sets[a] & sets[b]) >= 0.65 * len(sets[a] | sets[b])}
    assert got <= want and alike <= got and len(got) >= 0.95 * len(want) and len(want) > 30
    assert {x.document_id for x in members.collect()} == set(texts)
    members, links = golay.near_duplicates(docs.limit(0))
    assert members.count() == links.count() == 0


# 1: vectors


def test_neighbours_against_brute_force(spark):
    r = np.random.default_rng(5)
    base = r.normal(size=(60, 64))
    x = np.concatenate([base + s * r.normal(size=base.shape) for s in (0, 0.2, 0.2, 0.3, 0.4)] + [3 * base[:5]])
    rows = [(i, [float(v) for v in row], "z") for i, row in enumerate(x)]
    bad = [(900, None, "z"), (901, [], "z"), (902, [0.0] * 64, "z"), (903, [float("nan")] + [1.0] * 63, "z"), (904, [float("inf")] + [1.0] * 63, "z"), (None, rows[0][1], "z"), rows[7], rows[7]]
    df = spark.createDataFrame(rows + bad, "id bigint, embedding array<float>, cosine string")
    got = ivfpq.neighbours(df, k=5, probes=6).collect()
    u = x.astype(np.float32).astype(float)
    u /= np.linalg.norm(u, axis=1)[:, None]
    s = u @ u.T
    np.fill_diagonal(s, -2)
    want = {(i, int(j)) for i in range(len(x)) for j in np.argsort(-s[i])[:5]}
    found = {(g.id, g.other) for g in got}
    assert len(want & found) >= 0.9 * len(want)
    assert all(abs(g.cosine - s[g.id, g.other]) < 1e-6 for g in got) and max(Counter(g.id for g in got).values()) == 5
    high = {(g.id, g.other) for g in ivfpq.neighbours(df, k=5, floor=0.9, queries="id % 2 = 0").collect()}
    assert high and all(s[a, b] >= 0.9 and a % 2 == 0 for a, b in high)
    assert ivfpq.neighbours(df.limit(0)).count() == ivfpq.neighbours(spark.createDataFrame(bad[:5], df.schema)).count() == 0


def test_copies_of_a_vector_are_searched_once(spark):
    r = np.random.default_rng(9)
    x = r.normal(size=(40, 64))
    near = x[0] + 0.1 * r.normal(size=64)
    rows = [(i, [float(v) for v in row]) for i, row in enumerate(x)] + [(1000 + i, [float(v) for v in x[0]]) for i in range(200)] + [(500, [float(v) for v in near])] + [(2000 + i, [0.0] * 64) for i in range(9)]
    got = {}
    for g in ivfpq.neighbours(spark.createDataFrame(rows, "id bigint, embedding array<float>"), k=3, floor=0.9).collect():
        got.setdefault(g.id, []).append((g.rank, g.other))
    assert [o for _, o in sorted(got[0])] == [1000, 1001, 1002]
    assert [o for _, o in sorted(got[1000])] == [0, 1001, 1002] and [o for _, o in sorted(got[1199])] == [0, 1000, 1001]
    assert [o for _, o in sorted(got[500])] == [0, 1000, 1001]
    assert set(got) == {0, 500, *range(1000, 1200)}


# 8: packing


def test_plan_uses_every_piece_once_and_never_overfills():
    r = random.Random(2)
    h = {r.randrange(1, 65): r.randrange(1, 50) for _ in range(40)}
    slots, made = packing.plan(h, 64)
    assert Counter({n: c for n, c in h.items()}) == Counter({n: sum(s[2] for s in slots if s[0] == n) for n in h})
    used = Counter()
    for n, _, count, first, at in slots:
        for c in range(first, first + count):
            assert used[c] == at  # contiguous, nothing overlaps
            used[c] += n
    assert set(used) == set(range(made)) and max(used.values()) <= 64
    assert made <= 11 / 9 * max(sum(n * c for n, c in h.items()) / 64, sum(c for n, c in h.items() if n > 32)) + 1
    assert packing.plan({}, 64) == ([], 0)


def test_pack(spark):
    r = random.Random(4)
    rows = [(i, prose(r, r.randrange(1, 90)), "x") for i in range(150)] + [(500, prose(r, 900), "x"), (501, "", "x"), (502, None, "x"), (None, "a", "x"), (3, "again", "x")]
    rows = [x for x in rows if x[0] != 3] + [(3, "again", "x"), (3, "again", "x")]
    docs = spark.createDataFrame(rows, "doc_id bigint, text string, part string")
    got = packing.pack(docs, 512).collect()
    counts = {x.doc_id: x.n_tokens for x in packing.token_counts(docs).collect()}
    per = Counter()
    for x in got:
        per[x.doc_id] += x.n_tokens
        assert x.at + x.n_tokens <= 512 and x.first_token == 512 * x.piece
    assert per == Counter({k: v for k, v in counts.items() if v})
    assert all(x.piece == 0 for x in got if counts[x.doc_id] <= 512)
    spans = sorted((x.container, x.at, x.at + x.n_tokens) for x in got)
    assert all(a[0] != b[0] or a[2] <= b[1] for a, b in zip(spans, spans[1:]))
    assert sorted(map(tuple, got)) == sorted(map(tuple, packing.pack(docs.repartition(3), 512).collect()))
    assert packing.pack(docs.limit(0), 512).count() == 0
    assert packing.fill(packing.pack(docs, 512), 512).first().share > 0.9


# 10: residue


@pytest.fixture(scope="module")
def residue_models(spark):
    r = random.Random(5)
    return residue.fit(spark.createDataFrame([(". ".join(" ".join(r.choice(WORDS) for _ in range(9)) for _ in range(6)) + ".",) for _ in range(100)], "text string"))


@pytest.mark.parametrize("text, is_case", [("Hello {{name}}, the parcel left today.", True), ("The marker `{{name}}` is replaced later.", False), ("```\nprint('${x}')\n```\nThe listing shows it.", False), ("Title: -\nOwner: TBD\nTags: n/a\nSource: {0}", True), ("Title: Report\nOwner: Ann\nTags: a, b", False), ("See [notes] and [7].", False), ("", False), ("Dear [your name], welcome.", True), ("a < b and c > d, 5% of 10% each", False), ("Title: -\nOwner: TBD\nTags: n/a", True)])
def test_unfilled_places(residue_models, text, is_case):
    assert bool((residue_models.windows([text])[0] == 3).any()) == is_case


def test_spans_of_residue(residue_models):
    text = " ".join(WORDS[:9]) + ", {{first_name}}, " + " ".join(WORDS[9:18]) + "."
    kind, cover, marks, _ = residue_models.judged([text])
    assert kind[0] == 3 and 0 < cover[0] < 0.5 and text.index("{{") <= np.flatnonzero(marks == 3).mean() <= text.index("}}")


def test_residue(spark):
    r = random.Random(6)
    rows = [(i, ". ".join(" ".join(r.choice(WORDS) for _ in range(9)) for _ in range(6)) + ".", "x") for i in range(200)]
    cases = [(300, "Error 404: The page you requested could not be found.", "x"), (301, "Please enable JavaScript to view this page.", "x"), (302, "Lorem ipsum dolor sit amet, consectetur adipiscing elit, sed do eiusmod tempor.", "x"), (303, rows[0][1] + " Yours, {{sender}}", "x")]
    none = [(400, rows[1][1] + ' The message "Error 404: not found" is kept in the log. ' + rows[2][1], "x"), (401, None, "x"), (402, "", "x"), (403, "  \n", "x"), (None, "Error 404", "x"), (404, (rows[3][1] + " ") * 400, "x")]
    docs = spark.createDataFrame(rows + cases + none + cases[:1], "doc_id bigint, text string, kind string")
    got = {x.doc_id: x.kind for x in residue.residue(docs).collect()}
    assert got == {300: "notice", 301: "notice", 302: "filler", 303: "template"}
    assert residue.residue(docs.limit(0)).count() == 0
    assert residue.without_residue(docs).count() == len(rows) + len(none)


# 3: languages

EN = ["The parser checks every page of the report before the index is built.", "A second reviewer reads the notes and sends them to the team.", "This service stores the records until the owner agrees with the plan.", "The weekly summary was written by the people who run the archive."]
DE = ["Der Dienst prüft jede Seite des Berichts, bevor das Verzeichnis gebaut wird.", "Eine zweite Prüferin liest die Notizen und schickt sie an die Gruppe.", "Dieser Speicher hält die Einträge, bis der Eigentümer dem Plan zustimmt.", "Die wöchentliche Übersicht schreiben die Leute, die das Archiv führen."]


def test_labels():
    assert [language.code(x) for x in ("EN-us", "deu", "German", "es_MX", "", "und", None, " fr ")] == ["en", "de", "de", "es", None, None, None, "fr"]


def test_sentences_keep_initials_and_abbreviations_together():
    t = "Dr. R. Moss of Bolt Inc. called. He left"
    assert [t[a:b] for a, b in language.sentences(t)] == ["Dr. R. Moss of Bolt Inc. called.", "He left"]


def test_mislabelled(spark):
    r = random.Random(8)
    rows = []
    for i in range(120):
        lang, other = (("en", DE), ("de", EN))[i % 2]
        own = EN if lang == "en" else DE
        rows.append((f"d{i}", " ".join(r.sample(own, 3)), f'{{"lang": "{lang if i % 10 else ("de" if lang == "en" else "en")}"}}', 1))
    rows += [("mixed", " ".join(EN[:2] + DE[:2]), '{"lang": "en"}', 1), ("phrase", " ".join(EN[:3]) + ' "Guten Tag allerseits"', '{"lang": "en-GB"}', 1), ("missing", " ".join(DE[:2]), None, 1), ("missing", " ".join(DE[:2]), None, 1), ("blank", "  ", "{}", 1), ("null", None, "{}", 1), ("pdf", "%PDF-1.7 \0\0 " + EN[0] * 3, "{}", 1), ("log", "09:12 4c1d 0.3\n" * 20, "{}", 1), ("bad", " ".join(EN[:2]), "not json", 1), (None, EN[0], "{}", 1)]
    docs = spark.createDataFrame(rows, "document_id string, content string, metadata string, lang int")
    got = {(x.document_id, x.lang) for x in language.mislabelled(docs).collect()}
    want = {(f"d{i}", ("en", "de")[i % 2]) for i in range(0, 120, 10)} | {("mixed", "en"), ("mixed", "de"), ("missing", "de"), ("bad", "en")}
    assert got == want
    segs = [(x.segment, x.lang, x.sentences) for x in language.segments(docs).where("document_id = 'mixed'").orderBy("segment").collect()]
    assert segs == [(0, "en", 2), (1, "de", 2)]
    assert language.mislabelled(docs.limit(0)).count() == 0


# 5: variants


def test_edits():
    assert [variants.edits(a, b) for a, b in (("abc", "abc"), ("abc", "acb"), ("abc", "ab"), ("abc", "xyz"), ("", "a"))] == [0, 1, 1, 3, 1]


def test_variants(spark):
    same = [["Robert Pesnondin", "Bob Pesnondin", "Pesnondin, Robert", "ROBERT PESNONDIN", "Robert T. Pesnondin", "Robert Pesnonddin", "R. Pesnondin"], ["Margaret Pesnondin", "Peg Pesnondin"], ["James Pesnondin"], ["J. Fulgarsen"], ["Wilhelm Aratosk", "William Aratosk"][:1], ["William Aratosk"], ["W. Aratosk"]]
    orgs = [["Balmusfur Institute GmbH", "Balmusfur Inst. G.m.b.H.", "Balmufsur Institute GmbH", "The Balmusfur Institute"], ["Balmusfur Systems GmbH"]]
    rows = [("t", "PERSON", n, 0) for g in same for n in g] + [("t", "ORGANIZATION", n, 0) for g in orgs for n in g] + [("u", "PERSON", "Robert Pesnondin", 0), ("t", "PERSON", None, 0), (None, "PERSON", "A B", 0), ("t", "PERSON", " - ", 0), ("t", "PERSON", "Robert Pesnondin", 1)]
    df = spark.createDataFrame(rows, "tenant_id string, kind string, name string, grp int")
    got = {tuple(x) for x in variants.variant_pairs(variants.groups(df)).collect()}
    assert got == {("t", a, b) for g in same + orgs for a, b in combinations(sorted(g), 2)}
    assert variants.groups(df.limit(0)).count() == 0


def test_variants_in_either_order_with_errors_anywhere(spark):
    same = [["Jennifer Bendorrermor", "Bendorrermor Jennifer", "Dendorrermor, Jennifer", "Uennifer Bendorrermor", "Jenny Bendorrermor"], ["Anna Lee", "Anna Lea"], ["Hugo Smith", "Hugo Smyth", "Smith Hugo"], ["Clara Smith"], ["Smith, Charles", "C. Smith"][:1], ["Otto Hunt", "Hunt O."]]
    rows = [("t", "PERSON", n) for g in same for n in g] + [("t", "PERSON", f"{x}ian{y} Smith") for x in ("Dor", "Mar", "Bel") for y in ("a", "us")]
    got = {tuple(x)[1:] for x in variants.variant_pairs(variants.groups(spark.createDataFrame(rows, "tenant_id string, kind string, name string"))).collect()}
    assert got == {p for g in same for p in combinations(sorted(g), 2)}


def test_average_linkage_doesn_t_chain():
    pairs = {(i, i + 1): 0.9 for i in range(6)}
    assert max(map(len, variants._cluster(list(range(7)), pairs))) < 7


def test_wide_components_are_grouped_by_the_same_rule(spark, monkeypatch):
    # two families of spellings within typing errors of each other, all with different cores, and a chain between them
    pairs = {(1, 2): 0.9, (1, 3): 0.88, (2, 3): 0.86, (3, 4): 0.5, (4, 5): 0.51, (5, 6): 0.92, (6, 7): 0.89, (5, 7): 0.87}
    rows = [(a, b, s, False) for (a, b), s in pairs.items()]
    comps = spark.createDataFrame([(i, 1) for i in range(1, 8)], "id bigint, comp bigint")
    strong = spark.createDataFrame(rows, "a bigint, b bigint, sim double, exact boolean")
    want = {n: min(g) for g in variants._cluster(list(range(1, 8)), pairs) for n in g}
    monkeypatch.setattr(variants, "WIDEST", 3)
    assert {r.id: r.grp for r in variants._linked(comps, strong).collect()} == want
    assert len(set(want.values())) == 3


def test_scattered_edits_share_an_anchor_and_a_key():
    r = random.Random(1)
    texts, grams = [], lambda w: set(zip(w, w[1:], w[2:]))
    while len(texts) < 600:
        words = [f"w{r.randrange(10**6)}" for _ in range(120)]
        edited = words[:]
        for i in r.sample(range(120), r.randrange(8, 15)):
            edited[i] = f"x{r.randrange(10**6)}"
        a, b = grams(words), grams(edited)
        if 0.5 <= len(a & b) / len(a | b) < 0.6:
            texts += [" ".join(words), " ".join(edited)]
    slots = golay.fingerprints(texts, 3, 10)["slots"].view(np.int64)
    near = np.stack([golay.indices((slots[:, s] & 0x7FFFFF).astype(np.uint32)) for s in range(golay.SEGMENTS)], 1)
    key = (near[::2, :, :, None] == near[1::2, :, None, :]).any((2, 3))
    assert (key & (slots[::2] >> 23 == slots[1::2] >> 23)).any(1).mean() >= 0.92


def test_hot_anchors_and_the_exact_way_give_the_same_links(spark):
    r = random.Random(8)
    notice = " ".join(prose(r, 60).split())
    texts = {}
    for i in range(90):
        words = (notice if i % 3 == 0 else prose(r, 60)).split()
        for k in range(r.choice([1, 2])):
            edited = words[:]
            for _ in range(r.choice([1, 2])):
                edited[r.randrange(len(edited))] = f"e{i}x{k}"
            texts[f"d{i}k{k}"] = " ".join(edited)
    docs = spark.createDataFrame([*texts.items(), ("n", None)], "document_id string, content string").repartition(3)
    _, usual = golay.near_duplicates(docs, n=3, similarity=0.5, least=10, hot=100_000)
    _, spread = golay.near_duplicates(docs, n=3, similarity=0.5, least=10, hot=8)
    exact = golay.exact_links(docs, n=3, similarity=0.5, least=10)
    a, b, c = ({tuple(x)[:2] for x in df.collect()} for df in (usual, spread, exact))
    assert a == b and a <= c and len(a) >= 0.97 * len(c) and len(c) > 400
    sets = {k: {tuple(w[i : i + 3]) for i in range(len(w) - 2)} for k, w in ((k, t.split()) for k, t in texts.items())}
    assert c == {(x, y) for x, y in combinations(sorted(sets), 2) if sets[x] != sets[y] and 2 * len(sets[x] & sets[y]) >= len(sets[x] | sets[y])}


def test_a_class_of_many_copies_is_joined_in_parts(spark):
    members = spark.createDataFrame([(f"a{i:03d}", "a000") for i in range(40)] + [("b1", "b1"), ("c1", "c1"), ("c2", "c1")], "document_id string, rep string")
    links = spark.createDataFrame([("a000", "c1", 0.9)], "rep_a string, rep_b string, similarity double")
    got = [tuple(x) for x in golay.document_pairs(members, links, block=7).collect()]
    assert len(got) == len(set(got)) == 40 * 39 // 2 + 1 + 80 and all(a < b for a, b in got) and ("a003", "c2") in got
