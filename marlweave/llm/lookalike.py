"""One consistent form for names that look the same.

Of each token the script sets are resolved: a letter can be read in its own script and in every script that has a
letter drawn alike, and the token in the intersection over its letters. A token that is readable in Latin is written
in Latin (mixed-script and whole-script confusables), else in the script that remains; a token readable in no single
script takes the Latin letter wherever there is one. Width forms, composition of accents, invisible characters, spaces
and hyphens are normalised besides. Letter case, accents, digits and other punctuation stay as they are.
"""

from __future__ import annotations

import re
import unicodedata
from functools import cache

import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..session import materialize, ship

#: Letters of other alphabets drawn like the Latin letter they are listed with.
ALIKE = {
    "CYRILLIC": {
        "А": "A", "В": "B", "Е": "E", "Ѕ": "S", "І": "I", "Ј": "J", "К": "K", "М": "M", "Н": "H", "О": "O", "Р": "P", "С": "C", "Т": "T", "У": "Y", "Х": "X", "Ԛ": "Q", "Ԝ": "W", "Ԍ": "G", "Ѵ": "V", "Ү": "Y",
        "а": "a", "е": "e", "ѕ": "s", "і": "i", "ј": "j", "о": "o", "р": "p", "с": "c", "у": "y", "х": "x", "һ": "h", "ԁ": "d", "ԛ": "q", "ԝ": "w", "ѵ": "v", "ү": "y", "ӏ": "l", "Ӏ": "I", "г": "r", "ց": "g",
    },
    "GREEK": {
        "Α": "A", "Β": "B", "Ε": "E", "Ζ": "Z", "Η": "H", "Ι": "I", "Κ": "K", "Μ": "M", "Ν": "N", "Ο": "O", "Ρ": "P", "Τ": "T", "Υ": "Y", "Χ": "X", "Ϲ": "C", "Ϳ": "J",
        "ο": "o", "ν": "v", "ι": "i", "α": "a", "υ": "u", "ρ": "p", "ϲ": "c", "ϳ": "j", "γ": "y", "κ": "k",
    },
    "ARMENIAN": {"Օ": "O", "օ": "o", "Տ": "S", "Ս": "U", "Լ": "L", "հ": "h", "ո": "n", "ս": "u", "յ": "j", "ց": "g", "զ": "q"},
    "CHEROKEE": {"Ꭺ": "A", "Ᏼ": "B", "Ꮯ": "C", "Ꭰ": "D", "Ꭼ": "E", "Ꮐ": "G", "Ꮋ": "H", "Ꭵ": "i", "Ꭻ": "J", "Ꮶ": "K", "Ꮮ": "L", "Ꮇ": "M", "Ꮲ": "P", "Ꮢ": "R", "Ꮪ": "S", "Ꭲ": "T", "Ꮩ": "V", "Ꮃ": "W", "Ꮓ": "Z"},
    "LATIN": {"ı": "i", "ɑ": "a", "ɡ": "g", "ſ": "f", "ɩ": "i"},
}
#: Characters drawn as a hyphen.
HYPHENS = "‐‑‒–−˗⁃﹘﹣－۔Ⲻ"
#: Compatibility forms that differ from their letters in width, style or breaking only.
FORMS = ("<wide>", "<narrow>", "<noBreak>", "<font>")


@cache
def _script(c: str) -> str:
    """The script of a letter, or an empty string."""
    return unicodedata.name(c, "").split(" ")[0] if unicodedata.category(c)[0] == "L" else ""


@cache
def _plain(c: str) -> str:
    """A character without width form, as an ordinary space or hyphen, or nothing if it is invisible."""
    form = unicodedata.decomposition(c)
    if form.startswith(FORMS) or "ﬀ" <= c <= "ﬆ":
        return "".join(_plain(x) for x in unicodedata.normalize("NFKC", c))
    kind = unicodedata.category(c)
    if kind == "Cf" or "︀" <= c <= "️" or c in "͏ᅟᅠ឴឵ㅤﾠ" or 0xE0000 <= ord(c) <= 0xE0FFF:
        return ""
    if kind == "Zs" or c == "\t":
        return " "
    return "-" if c in HYPHENS else c


@cache
def _latin(c: str) -> str | None:
    """The Latin letter that a letter is drawn like, itself if it is Latin."""
    script = _script(c)
    return ALIKE.get(script, {}).get(c, c if script == "LATIN" else None)


@cache
def _back(script: str) -> dict[str, str]:
    return {v: k for k, v in reversed(ALIKE.get(script, {}).items())}


def readable(c: str) -> set[str]:
    """The scripts in which a letter can be read."""
    out = {_script(c)}
    if latin := _latin(c):
        out |= {"LATIN"} | {s for s in ALIKE if s != "LATIN" and latin in _back(s)}
    return out


def resolve(token: str) -> tuple[str, bool]:
    """The token in one script, and whether letters of another script were in it. token is decomposed (NFD)."""
    letters = [c for c in token if _script(c)]
    if not letters:
        return token, False
    scripts = set.intersection(*map(readable, letters))
    own = {_script(c) for c in letters}
    if "LATIN" in scripts or not scripts:
        return "".join((_latin(c) or c) if _script(c) else c for c in token), own != {"LATIN"}
    script = min(scripts & own or scripts)
    return "".join(_back(script).get(_latin(c) or c, c) if _script(c) not in ("", script) else c for c in token), own != {script}


def consistent(name: str | None) -> str | None:
    """The consistent form of a name; null stays null, an empty name stays empty."""
    if name is None or name.isascii() and "\t" not in name:
        return name
    plain = unicodedata.normalize("NFD", "".join(map(_plain, name)))
    return unicodedata.normalize("NFC", "".join(resolve(t)[0] for t in re.split(r"([ \-]+)", plain)))


def consistent_form(name: str):
    """consistent() of a column, as a column."""

    def forms(names: pd.Series) -> pd.Series:
        return names.map(consistent, na_action="ignore")

    return F.pandas_udf(forms, "string")(name)


def consistent_names(nodes: DataFrame) -> DataFrame:
    """(tenant_id string, name string, form string): every different stored name of a tenant with its consistent form.

    Null names and tenants give no row; a blank name is a name. Repeated rows count once; other columns are ignored.
    Plain ASCII names are their own form and don't leave the JVM."""
    ship(nodes.sparkSession)
    names = nodes.select("tenant_id", "name").where("tenant_id IS NOT NULL AND name IS NOT NULL").distinct()
    odd = F.col("name").rlike(r"[^\x00-\x08\x0a-\x7f]")
    return names.where(~odd).withColumn("form", F.col("name")).unionByName(names.where(odd).withColumn("form", consistent_form("name")))


def lookalike_names(nodes: DataFrame) -> DataFrame:
    """(tenant_id, form, name_a, name_b): different names of a tenant that look the same; name_a < name_b by code point.

    Only names whose form occurs twice are paired, so that a group has as many pairs as spellings, not as nodes.
    Blank names are in no pair."""
    forms = materialize(consistent_names(nodes), "forms")
    twice = forms.groupBy("tenant_id", "form").agg(F.count("*").alias("n")).where("n > 1 AND form <> '' AND form NOT RLIKE '^ +$'").drop("n")
    held = forms.join(twice, ["tenant_id", "form"])
    other = held.select("tenant_id", "form", F.col("name").alias("name_b"))
    return held.withColumnRenamed("name", "name_a").join(other, ["tenant_id", "form"]).where("name_a < name_b")


def lookalike_nodes(nodes: DataFrame, block: int = 1000) -> DataFrame:
    """(entity_id_a bigint, entity_id_b bigint), smaller id first: two nodes of one tenant whose names differ but look the same.

    A node delivered again counts once; null ids give no row. A name of more than `block` nodes is joined in parts, on
    either side."""
    pairs = materialize(lookalike_names(nodes).drop("form"), "name-pairs")
    used = pairs.select("tenant_id", F.explode(F.array("name_a", "name_b")).alias("name")).distinct()
    held = nodes.select("entity_id", "tenant_id", "name").where("entity_id IS NOT NULL").join(used, ["tenant_id", "name"], "left_semi").dropDuplicates(["entity_id"])
    held = materialize(held, "named-nodes")
    parts = held.groupBy("tenant_id", "name").agg(F.expr(f"cast(ceil(count(*) / {block}) as int)").alias("parts"))
    placed = held.join(parts, ["tenant_id", "name"]).withColumn("part", F.expr("cast(pmod(xxhash64(entity_id), parts) as int)"))
    rows = pairs
    for x in "ab":
        rows = rows.join(parts.select("tenant_id", F.col("name").alias(f"name_{x}"), F.col("parts").alias(f"parts_{x}")), ["tenant_id", f"name_{x}"]).withColumn(f"part_{x}", F.explode(F.expr(f"sequence(0, parts_{x} - 1)")))
    for x in "ab":
        side = placed.select("tenant_id", F.col("name").alias(f"name_{x}"), F.col("part").alias(f"part_{x}"), F.col("entity_id").alias(x))
        rows = rows.join(side, ["tenant_id", f"name_{x}", f"part_{x}"])
    return rows.select(F.least("a", "b").alias("entity_id_a"), F.greatest("a", "b").alias("entity_id_b")).distinct()


def lookalike_classes(nodes: DataFrame) -> DataFrame:
    """(tenant_id, entity_id bigint, form string, spellings bigint): every node whose name looks like a different name of its tenant, with the form they share and how many spellings it has.

    One row for each node: the form is the class, and no pairs are made."""
    forms = consistent_names(nodes)
    held = forms.groupBy("tenant_id", "form").agg(F.count("*").alias("spellings")).where("spellings > 1 AND form <> '' AND form NOT RLIKE '^ +$'")
    named = forms.join(held, ["tenant_id", "form"])
    rows = nodes.select(F.col("entity_id").cast("bigint"), "tenant_id", "name").where("entity_id IS NOT NULL").dropDuplicates(["entity_id"])
    return rows.join(named, ["tenant_id", "name"]).select("tenant_id", "entity_id", "form", "spellings")
