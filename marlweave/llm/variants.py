"""Variant spellings of the names of persons and organisations.

Names are read by parts: family and given name, in either order where no comma tells it, or an organisation's own words,
sector and legal form. Family names and own words meet by a sparse join of weighted character n-gram vectors within their
tenant: n-grams are ordered from rare to frequent, and only those before the rest of a vector falls below COSINE are
joined, which loses no pair of that cosine; pairs one error apart, however short, meet by what is left of them without
one letter as well. Names whose parts differ by no more than typing errors and short forms are linked by the cosine of
the weighted n-gram vectors of the whole names, and the links grouped by average-linkage clustering. A name of which only
an initial is known joins the only group it fits.
"""

from __future__ import annotations

import re
from collections.abc import Iterator

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from ..session import materialize, ship, splits

GRAM, GRAMS, COSINE, LINKAGE, WIDEST = 4, (2, 3), 0.2, 0.2, 300

#: Given names with their usual short forms.
NICKNAMES = """alexander alex sandy sascha; alexandra alex sandra; andrew andy drew; anthony tony; antonio toni tonio; barbara barb babs; benjamin ben benny; catherine cathy cate; charles charlie chuck chas; christopher chris kit;
christine chris tina; daniel dan danny; david dave davy; deborah deb debbie debby; donald don donnie; edward ed eddie ned ted teddy; elizabeth beth betty eliza liz lizzie lisa bess; emily em emmy; eugene gene; francesca fran franca cesca; francisco paco pancho fran curro;
frederick fred freddie; friedrich fritz fred; gabriela gabi gaby; george georgie; giovanni gianni nino; giuseppe beppe pino peppe; gregory greg; heinrich heinz heiner; henry harry hank; isabel isa bella; jacqueline jackie; james jim jimmy jamie jem; jennifer jen jenny jenn;
jessica jess jessie; johannes hans hannes jo; john jack johnny; jonathan jon jonny; jose pepe; joseph joe joey jos; joshua josh; juan juanito; katherine kate kathy katie kat kitty kay; kenneth ken kenny; lawrence larry; leonardo leo nardo; luigi gigi; manuel manolo manu; margaret maggie meg peg peggy marge greta;
maria mia mariechen; matthew matt; michael mike mick mickey micky mitch; nicholas nick nicky nico klaus; oliver olli ollie ol; pamela pam; patricia pat patty tricia trish; patrick pat paddy; peter pete; philip phil; rebecca becky becca; richard rick dick rich ricky richie; robert bob rob bobby robbie bert; ronald ron ronnie;
samantha sam; samuel sam sammy; sebastian basti seb; stephen steve; stephanie steph; susan sue susie suzy; theodore ted teddy theo; theresa terry tess; thomas tom tommy; timothy tim; victoria vicky vicki tori vic; vincent vince vinnie; walter walt wally; wilhelm willi willy helm; william bill will billy willie liam"""
FORMAL: dict[str, tuple[str, ...]] = {}
for _line in NICKNAMES.split(";"):
    _full, *_short = _line.split()
    for _x in (_full, *_short):
        FORMAL[_x] = (*FORMAL.get(_x, ()), _full)
#: Titles, legal forms and abbreviations in names of organisations.
TITLES = set("dr prof professor mr mrs ms miss sir herr frau dott ing sra sr mme jr".split())
LEGAL = {"incorporated": "inc", "inc": "inc", "corporation": "corp", "corp": "corp", "company": "co", "co": "co", "limited": "ltd", "ltd": "ltd", "gmbh": "gmbh", "llc": "llc", "ag": "ag", "plc": "plc", "sa": "sa", "spa": "spa", "srl": "srl", "bv": "bv", "kg": "kg"}
EXPANDED = {
    "assoc": "associates", "assocs": "associates", "bros": "brothers", "dept": "department", "inst": "institute", "intl": "international", "int": "international", "lab": "laboratories", "labs": "laboratories", "mfg": "manufacturing", "sys": "systems", "tech": "technologies", "techs": "technologies",
    "univ": "university", "grp": "group", "svc": "services", "svcs": "services", "natl": "national", "mgmt": "management", "ind": "industries", "eng": "engineering", "hosp": "hospital", "assn": "association", "ctr": "center", "fdn": "foundation",
}
SECTORS = sorted(set(EXPANDED.values()) | {"holdings", "partners", "solutions", "consulting", "bank", "club", "college", "school", "agency", "studio", "works"})


def edits(a: str, b: str, most: int = 2) -> int:
    """Insertions, deletions, substitutions and swaps of neighbours that lead from a to b; most + 1 if there are more."""
    if a == b:
        return 0
    if abs(len(a) - len(b)) > most:
        return most + 1
    before, row = None, list(range(len(b) + 1))
    for i, x in enumerate(a, 1):
        now = [i]
        for j, y in enumerate(b, 1):
            cost = min(row[j] + 1, now[j - 1] + 1, row[j - 1] + (x != y))
            if before is not None and j > 1 and x == b[j - 2] and a[i - 2] == y:
                cost = min(cost, before[j - 2] + 1)
            now.append(cost)
        if min(now) > most:
            return most + 1
        before, row = row, now
    return min(row[-1], most + 1)


def _tokens(text: str) -> list[str]:
    return re.findall(r"[^\W_]+", text.replace("'", "").replace("’", ""))


def turned(p: tuple[str, str, str]) -> tuple[str, str, str]:
    """A person's parsed name read in the other order, family name first."""
    first, *rest = [p[1], *p[2].split(), *p[0].split()]
    return first, rest[0], " ".join(rest[1:])


def features(kind: str, p: tuple[str, str, str]) -> set[str]:
    """The n-grams of the words of a parsed name, and for given names the full forms."""
    out: set[str] = set()
    for word in " ".join(p if kind == "PERSON" else p[:2]).split():
        padded = f"#{word}#"
        out |= {padded[i : i + n] for n in GRAMS for i in range(len(padded) - n + 1)}
        out |= {f"={x}" for x in FORMAL.get(word, ())} if kind == "PERSON" else set()
    return out


def parse(kind: str, name: str) -> tuple[str, str, str] | None:
    """(core, given, more) of a name: of a person the family name, the given name and middle names, of an organisation its own words, sector and legal form."""
    low = re.sub(r"\s+", " ", name.strip().lower())
    if kind == "PERSON":
        family, comma, rest = low.partition(",")
        given = [t for t in _tokens(rest if comma else low) if t not in TITLES]
        if comma and given:
            last = [t for t in _tokens(family) if t not in TITLES]
        else:
            given = given or [t for t in _tokens(family) if t not in TITLES]
            first = len(given) > 1 and len(given[-1]) == 1 < len(given[0])  # an initial at the end is no family name
            last, given = (given[:1], given[1:]) if first else (given[-1:], given[:-1])
        if not last:
            return None
        return " ".join(last), given[0] if given else "", " ".join(given[1:])
    words = [t for t in _tokens(re.sub(r"\b((?:\w\.){2,})", lambda m: m[1].replace(".", "") + " ", low)) if t not in ("the", "and")]
    legal, sector, own = "", [], []
    for w in words:
        w = EXPANDED.get(w, w)
        if w in LEGAL:
            legal = LEGAL[w]
            continue
        near = [s for s in SECTORS if len(w) > 4 and abs(len(s) - len(w)) < 3 and edits(w, s) <= 1]
        near_legal = [v for k, v in LEGAL.items() if len(k) > 5 and len(w) > 5 and edits(w, k) <= 1]
        if near:
            sector.append(near[0])
        elif near_legal:
            legal = near_legal[0]
        else:
            own.append(w)
    core = own or sector
    return (" ".join(sorted(core)), " ".join(sorted(sector)), legal) if core else None


def similarity(kind: str, a: tuple[str, str, str], b: tuple[str, str, str]) -> float:
    """Of two parsed names: 1 for the same name, less for typing errors, 0 for different names or where only an initial speaks for it."""
    room = 2 if min(len(a[0]), len(b[0])) >= 8 else 1
    core = edits(a[0], b[0], room)
    if core > room:
        return 0.0
    if kind != "PERSON":
        if a[1] != b[1] or (a[2] and b[2] and a[2] != b[2]):
            return 0.0
        return (1.0, 0.9, 0.5)[core]
    if len(a[1]) < 2 or len(b[1]) < 2 or (a[2] and b[2] and a[2][0] != b[2][0]):
        return 0.0
    full_a, full_b = set(FORMAL.get(a[1], (a[1],))), set(FORMAL.get(b[1], (b[1],)))
    given = 0 if full_a & full_b else min(edits(x, y, 1) if min(len(x), len(y)) > 3 else 2 for x in full_a | {a[1]} for y in full_b | {b[1]})
    if given > 1:
        return 0.0
    total = core + given
    unsure = 0.1 if a[1] != b[1] and len(full_a | full_b) > 1 and not given else 0.0
    return (1.0, 0.9, 0.5, 0.3)[total] - unsure


def alike(kind: str, a: tuple[str, str, str], b: tuple[str, str, str], turn_a: bool, turn_b: bool) -> bool:
    """Whether two parsed names pass the check by parts, one of them in the other order if its order isn't certain."""
    return similarity(kind, a, b) > 0 or (turn_a and similarity(kind, turned(a), b) > 0) or (turn_b and similarity(kind, a, turned(b)) > 0)


def letters(given: str) -> set[str]:
    """First letters that a given name can have, as it stands or in full."""
    return {x[:1] for x in (given, *FORMAL.get(given, ()))}


def _near_keys(word: str) -> set[str]:
    """A word and all that is left of it without one letter: words one error apart share one."""
    return {word} | {word[:i] + word[i + 1 :] for i in range(len(word))}


def _cluster(names: list[int], pairs: dict[tuple[int, int], float]) -> list[list[int]]:
    """Average linkage: the two groups with the highest mean similarity merge while it reaches LINKAGE."""
    groups = {n: [n] for n in names}
    link = {k: v for k, v in pairs.items()}  # sums of similarities between groups
    while link:
        (x, y), best = max(((k, v / (len(groups[k[0]]) * len(groups[k[1]]))) for k, v in link.items()), key=lambda p: (p[1], -p[0][0], -p[0][1]))
        if best < LINKAGE:
            break
        groups[x] += groups.pop(y)
        del link[x, y]
        for k in [k for k in link if y in k]:
            z = k[0] if k[1] == y else k[1]
            key = (min(x, z), max(x, z))
            link[key] = link.get(key, 0) + link.pop(k)
    return list(groups.values())


def _grouped(pairs: dict[tuple[int, int], float]) -> list[tuple[int, int]]:
    """(name, group) of the names in pairs."""
    return [(n, min(g)) for g in _cluster(sorted({x for p in pairs for x in p}), pairs) for n in g]


def _components(nodes: DataFrame, edges: DataFrame) -> DataFrame:
    """(id, comp): the smallest id of each connected component, by passing labels along edges and their labels' labels."""
    both = materialize(edges.select("a", "b").unionByName(edges.select(F.col("b").alias("a"), F.col("a").alias("b"))), "edges")
    labels = materialize(both.select(F.col("a").alias("id")).distinct().withColumn("comp", F.col("id")), "labels")
    while True:
        near = both.join(labels.withColumnRenamed("id", "b"), "b").groupBy(F.col("a").alias("id")).agg(F.min("comp").alias("near"))
        step = labels.join(near, "id").select("id", F.least("comp", "near").alias("hop"), F.col("comp").alias("old"))
        jump = step.join(labels.select(F.col("id").alias("hop"), F.col("comp").alias("far")), "hop").select("id", F.least("hop", "far").alias("comp"), "old")
        jump = materialize(jump, "labels")
        if jump.where("comp <> old").isEmpty():
            break
        labels = jump.select("id", "comp")
    return nodes.select("id").join(labels, "id", "left").select("id", F.coalesce("comp", "id").alias("comp"))


def groups(names: DataFrame) -> DataFrame:
    """(tenant_id, kind, name, grp bigint): every name with the number of its group of variants within a tenant.

    names has tenant_id, kind (PERSON or another word for organisations) and name; other columns are ignored. Repeated
    rows count once; null tenants, kinds and names and names without a letter or digit give no row; a name without
    variants is a group of its own. A person's name without a comma is read in either order.
    """
    spark = names.sparkSession
    ship(spark)
    held = names.select("tenant_id", "kind", "name").where("tenant_id IS NOT NULL AND kind IS NOT NULL AND name IS NOT NULL").distinct()

    def parsed(it: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for pdf in it:
            p = [parse(k, n) for k, n in zip(pdf["kind"], pdf["name"])]
            ok = np.fromiter((x is not None for x in p), bool, len(p))
            if not ok.any():
                continue
            out = pdf[ok].reset_index(drop=True)
            for i, c in enumerate(("core", "given", "more")):
                out[c] = [x[i] for x in p if x]
            out["turns"] = [k == "PERSON" and g != "" and "," not in n for k, g, n in zip(out["kind"], out["given"], out["name"])]
            yield out

    items = held.mapInPandas(parsed, "tenant_id string, kind string, name string, core string, given string, more string, turns boolean")
    # names that are parsed alike are one item: however many spellings of it there are, it is compared once; a comma makes the order certain
    parts = ["tenant_id", "kind", "core", "given", "more"]
    spelled = materialize(items.withColumn("id", F.xxhash64(*parts)), "names")
    items = materialize(spelled.groupBy("id", *parts).agg(F.min("turns").alias("turns")), "items")
    strong = materialize(_strong(items), "strong-pairs")
    comps = materialize(_components(items.select("id"), strong), "components")
    clustered = materialize(_linked(comps, strong), "clusters")
    return spelled.select("tenant_id", "kind", "name", "id").join(_initials(items, clustered, materialize(_initial_pairs(items), "initials")), "id").select("tenant_id", "kind", "name", "grp")


def _near_cores(cores: DataFrame) -> DataFrame:
    """(tenant_id, kind, core_a, core_b), both ways round and each with itself: cores whose vectors can have a cosine of COSINE, or that are one error apart."""
    place = ["tenant_id", "kind"]
    pieces = lambda text, n: F.expr(f"transform(sequence(1, greatest(1, length({text}) - {n - 1})), i -> substring({text}, i, {n}))")
    grams = cores.withColumn("padded", F.concat(F.lit("#"), "core", F.lit("#"))).select(*place, "core", F.explode(F.array_distinct(pieces("padded", GRAM))).alias("gram"))
    total = float(max(cores.count(), 1))
    df = grams.groupBy("gram").agg(F.count("*").alias("df"))
    weighted = grams.join(df, "gram").withColumn("w2", F.pow(F.log(F.lit(1.0) + F.lit(total) / F.col("df")), 2))
    core = W.partitionBy(*place, "core")
    rest = core.orderBy(F.col("df").desc(), "gram").rowsBetween(W.unboundedPreceding, 0)
    prefix = weighted.withColumns({"norm2": F.sum("w2").over(core), "rest2": F.sum("w2").over(rest)}).where(F.col("rest2") >= F.col("norm2") * (COSINE * COSINE * (1 - 1e-9)))
    without = F.expr("concat(array(core), transform(sequence(1, length(core)), i -> concat(substring(core, 1, i - 1), substring(core, i + 1))))")
    keyed = prefix.select(*place, "core", F.concat(F.lit("n"), "gram").alias("key")).unionByName(cores.select(*place, "core", F.explode(F.array_distinct(without)).alias("key")).withColumn("key", F.concat(F.lit("w"), "key")))
    keyed = materialize(keyed.select(*place, "core", F.xxhash64("key").alias("key")), "core-keys")
    a, b = (keyed.withColumnRenamed("core", f"core_{x}") for x in "ab")
    met = a.join(b, [*place, "key"]).where("core_a < core_b AND abs(length(core_a) - length(core_b)) <= 2").select(*place, "core_a", "core_b").distinct()
    # no more than two errors, of which a swap of neighbours counts as two changes
    near = materialize(met.where("levenshtein(core_a, core_b, 4) >= 0"), "near-cores")
    back = near.select(*place, F.col("core_b").alias("core_a"), F.col("core_a").alias("core_b"))
    return near.unionByName(back).unionByName(cores.select(*place, F.col("core").alias("core_a"), F.col("core").alias("core_b")))


def _strong(items: DataFrame) -> DataFrame:
    """(a, b, sim): items of a tenant that pass the check by parts, with the cosine of their whole names; a < b.

    Items meet if their cores are near and their given names share a full form or what is left without one letter, or
    their sectors are the same."""
    place = ["tenant_id", "kind"]

    def keyed(it: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for pdf in it:
            out = []
            for tenant, kind, number, turns, *p in zip(*(pdf[c] for c in ("tenant_id", "kind", "id", "turns", "core", "given", "more"))):
                if kind != "PERSON":
                    out.append((tenant, kind, number, p[0], p[1]))
                elif len(p[1]) > 1 or turns:
                    for c, g, _ in {tuple(p)} | ({turned(tuple(p))} if turns else set()):
                        forms = {g, *FORMAL.get(g, ())} if len(g) > 1 and len(c) > 1 else set()
                        out += [(tenant, kind, number, c, k) for k in set().union(*({x} if len(x) < 4 else _near_keys(x) for x in forms))]
            yield pd.DataFrame(out, columns=[*place, "id", "core", "key"])

    kind = "tenant_id string, kind string, id bigint, core string, key string"
    rows = materialize(items.mapInPandas(keyed, kind).select(*place, "id", "core", F.xxhash64("key").alias("key")), "keyed-items")
    near = _near_cores(rows.select(*place, "core").distinct())
    a, b = (rows.select(*place, F.col("core").alias(f"core_{x}"), F.col("id").alias(x), "key") for x in "ab")
    met = a.join(near, [*place, "core_a"]).join(b, [*place, "core_b", "key"]).where("a < b").select("a", "b").distinct()
    used = materialize(met, "met")

    def grams(it: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for pdf in it:
            found = [list(features(k, p)) for k, *p in zip(pdf["kind"], pdf["core"], pdf["given"], pdf["more"])]
            n = np.fromiter(map(len, found), np.int64, len(found))
            yield pd.DataFrame({"id": np.repeat(pdf["id"].to_numpy(), n), "gram": [f"{k}{g}" for k, f in zip(pdf["kind"], found) for g in f]})

    held = items.mapInPandas(grams, "id bigint, gram string").select("id", F.xxhash64("gram").alias("gram"))
    df = held.groupBy("gram").agg(F.count("*").alias("df"))
    # the weights of those that are compared; frequencies are of all items
    wanted = used.select(F.explode(F.array("a", "b")).alias("id")).distinct()
    total = float(max(items.count(), 1))
    weighted = items.join(wanted, "id", "left_semi").mapInPandas(grams, "id bigint, gram string").select("id", F.xxhash64("gram").alias("gram")).join(df, "gram").withColumn("w", F.log(F.lit(1.0) + F.lit(total) / F.col("df")))
    vectors = weighted.groupBy("id").agg(F.sort_array(F.collect_list(F.struct("gram", "w"))).alias("v")).select("id", F.col("v.gram").alias("grams"), F.col("v.w").alias("weights"))
    cols = ["kind", "core", "given", "more", "turns", "grams", "weights"]
    full = materialize(items.join(vectors, "id").select("id", *cols), "vectors")
    x, y = (full.select(F.col("id").alias(c), *[F.col(n).alias(f"{n}_{c}") for n in cols]) for c in "ab")

    def judge(it: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for pdf in it:
            sim = np.zeros(len(pdf))
            rows = zip(*(pdf[f"{c}_{z}"] for z in "ab" for c in cols[1:]), pdf["kind_a"])
            for i, (ca, ga, ma, ta, fa, wa, cb, gb, mb, tb, fb, wb, kind) in enumerate(rows):
                if alike(kind, (ca, ga, ma), (cb, gb, mb), ta, tb):
                    _, at, bt = np.intersect1d(fa, fb, assume_unique=True, return_indices=True)
                    sim[i] = np.dot(wa[at], wb[bt]) / np.sqrt(np.dot(wa, wa) * np.dot(wb, wb))
            keep = sim > 0
            yield pd.DataFrame({"a": pdf["a"][keep], "b": pdf["b"][keep], "sim": sim[keep]})

    return used.join(x, "a").join(y, "b").mapInPandas(judge, "a bigint, b bigint, sim double")


def _initial_pairs(items: DataFrame) -> DataFrame:
    """(a, b, exact, both): items a of which only the initial of the given name is known with items b that it may stand for.

    Family names may differ by one error (exact: by none), middle names must not disagree; both: b has an initial too."""
    people = items.where("kind = 'PERSON' AND given <> ''")

    def keyed(it: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for pdf in it:
            out = []
            for tenant, number, core, given, more, turns in zip(pdf["tenant_id"], pdf["id"], pdf["core"], pdf["given"], pdf["more"], pdf["turns"]):
                for c, g, m in {(core, given, more)} | ({turned((core, given, more))} if turns else set()):
                    out += [(tenant, number, c, g, m, x, y) for y in letters(g) for x in _near_keys(c)]
            yield pd.DataFrame(out, columns=["tenant_id", "id", "core", "given", "more", "key", "letter"])

    kind = "tenant_id string, id bigint, core string, given string, more string, key string, letter string"
    short = people.where("length(given) = 1").withColumn("turns", F.lit(False)).mapInPandas(keyed, kind)
    cols = ["id", "core", "given", "more"]
    x, y = (df.select("tenant_id", "key", "letter", *[F.col(c).alias(f"{c}_{z}") for c in cols]) for z, df in (("a", short), ("b", people.mapInPandas(keyed, kind))))
    met = x.join(y, ["tenant_id", "key", "letter"]).where("id_a <> id_b").drop("key", "letter").distinct()

    def fit(it: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for pdf in it:
            ok = np.array([edits(p, q, 1) <= 1 and not (m and n and m[0] != n[0]) for p, q, m, n in zip(pdf["core_a"], pdf["core_b"], pdf["more_a"], pdf["more_b"])], bool)
            yield pd.DataFrame({"a": pdf["id_a"], "b": pdf["id_b"], "exact": pdf["core_a"] == pdf["core_b"], "both": pdf["given_b"].str.len() == 1})[ok]

    return met.mapInPandas(fit, "a bigint, b bigint, exact boolean, both boolean").distinct()


def _linked(comps: DataFrame, strong: DataFrame) -> DataFrame:
    """(id, grp): average-linkage groups within each component; those of more than WIDEST names are grouped by the same rule in distributed rounds."""
    sizes = comps.groupBy("comp").agg(F.count("*").alias("size")).where("size > 1")
    wide = sizes.where(F.col("size") > WIDEST)
    rows = strong.join(comps.join(sizes.where(F.col("size") <= WIDEST), "comp").select(F.col("id").alias("a"), "comp"), "a").select("comp", "a", "b", "sim")

    def link(it: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        last, pairs = None, {}  # the component that is being read, and its pairs
        for pdf in it:
            out = []
            for comp, a, b, s in zip(pdf["comp"].tolist(), pdf["a"].tolist(), pdf["b"].tolist(), pdf["sim"].tolist()):
                if comp != last:
                    out += _grouped(pairs)
                    last, pairs = comp, {}
                pairs[a, b] = s
            yield pd.DataFrame(out, columns=["id", "grp"])
        yield pd.DataFrame(_grouped(pairs), columns=["id", "grp"])

    # a number of partitions that is not adapted: many small components are more work than their bytes tell
    found = rows.repartition(splits(rows.sparkSession), "comp").sortWithinPartitions("comp").mapInPandas(link, "id bigint, grp bigint")
    if not wide.isEmpty():
        found = found.unionByName(_rounds(strong.join(comps.join(wide, "comp").select(F.col("id").alias("a")), "a")))
    return comps.select("id").join(found, "id", "left").select("id", F.coalesce("grp", "id").alias("grp"))


def _rounds(pairs: DataFrame) -> DataFrame:
    """(id, grp): average linkage as in _cluster(), of components of any size.

    A round merges all groups that are each other's best by mean similarity. As a merger never raises a mean above the
    higher of the two that it joins, this gives the groups of merging the best pair first, but for the order of ties: they
    go by a hash of the pair, so that many groups merge in a round where all are alike."""
    links = materialize(pairs.select(F.col("a").alias("x"), F.col("b").alias("y"), F.col("sim").alias("s")), "links")
    members = materialize(links.select(F.explode(F.array("x", "y")).alias("id")).distinct().withColumn("grp", F.col("id")), "members")
    while True:
        size = members.groupBy("grp").agg(F.count("*").alias("n"))
        x, y = (size.select(F.col("grp").alias(c), F.col("n").alias(f"n{c}")) for c in "xy")
        mean = links.join(x, "x").join(y, "y").withColumn("m", F.round(F.col("s") / (F.col("nx") * F.col("ny")), 9)).where(F.col("m") >= LINKAGE)
        best = mean.select(F.explode(F.array("x", "y")).alias("g"), F.struct("m", F.xxhash64("x", "y").alias("h"), "x", "y").alias("o")).groupBy("g").agg(F.max("o").alias("o"))
        merged = materialize(best.groupBy(F.col("o.x").alias("new"), F.col("o.y").alias("old")).agg(F.count("*").alias("n")).where("n = 2").select("new", "old"), "merged")
        if merged.isEmpty():
            return members

        def renamed(df: DataFrame, c: str) -> DataFrame:
            return df.join(merged.withColumnRenamed("old", c), c, "left").withColumn(c, F.coalesce("new", c)).drop("new")

        members = materialize(renamed(members, "grp").select("id", "grp"), "members")
        moved = renamed(renamed(links, "x"), "y").where("x <> y")
        links = materialize(moved.groupBy(F.least("x", "y").alias("x"), F.greatest("x", "y").alias("y")).agg(F.sum("s").alias("s")), "links")


def _initials(items: DataFrame, clustered: DataFrame, pairs: DataFrame) -> DataFrame:
    """Names with an initial join the only group that they fit; those that fit none join each other."""
    fits = pairs.where("NOT both").join(clustered.withColumnRenamed("id", "b"), "b").groupBy(F.col("a").alias("id")).agg(F.countDistinct(F.when(F.col("exact"), F.col("grp"))).alias("n_exact"), F.min(F.when(F.col("exact"), F.col("grp"))).alias("g_exact"), F.countDistinct("grp").alias("n"), F.min("grp").alias("g"))
    known = fits.select("id", F.when(F.col("n_exact") == 1, F.col("g_exact")).when((F.col("n_exact") == 0) & (F.col("n") == 1), F.col("g")).alias("to"))
    lone = pairs.where("both AND exact AND a < b").join(fits.select(F.col("id").alias("a")), "a", "left_anti").join(fits.select(F.col("id").alias("b")), "b", "left_anti")
    same = lone.groupBy(F.col("b").alias("id")).agg(F.min("a").alias("twin"))
    out = items.select("id").join(clustered, "id").join(known, "id", "left").join(same, "id", "left")
    return out.select("id", F.coalesce("to", "twin", "grp").alias("grp"))


def variant_pairs(grouped: DataFrame) -> DataFrame:
    """(tenant_id, name_a, name_b), name_a < name_b by code point: the pairs of names of each group."""
    a, b = (grouped.select("tenant_id", "grp", F.col("name").alias(f"name_{x}")) for x in "ab")
    return a.join(b, ["tenant_id", "grp"]).where("name_a < name_b").select("tenant_id", "name_a", "name_b").distinct()
