"""Scalar functions of names, keys, metadata and contents, as columns."""

from __future__ import annotations

import json
import random
import re

from pyspark.sql import Column
from pyspark.sql import functions as F

SPACE = r"^[\s\p{Z}\u0085\u001c-\u001f]+|[\s\p{Z}\u0085\u001c-\u001f]+$"
#: The header of a catalogue card, the signature of a PDF file, the share of damaged characters, and the limits of an accumulated text.
CARD_HEADER, PDF_HEADER, DAMAGED_SHARE, DAMAGED_WITHIN, TEXT_LIMIT = "# CATALOGUE CARD", "%PDF", 0.1, 4096, 12_000


def strip(c) -> Column:
    """A string without outer white space of any kind."""
    return F.regexp_replace(c, SPACE, "")


def normalize_name(c) -> Column:
    """Lower case, stripped, without one leading article."""
    return F.regexp_replace(strip(F.lower(c)), r"^(the|a|an)\s+", "")


def entity_key(tenant, name) -> Column:
    """Identity of an entity: md5 of tenant and normalized name; the type plays no part."""
    return F.md5(F.concat_ws(":", tenant, normalize_name(name)))


def provenance_key(source, chat) -> Column:
    """The key of a source: its name, or that within a chat."""
    return F.when(chat.isNull(), source).otherwise(F.concat(F.lit("chat:"), chat, F.lit(":"), source))


def next_generation(c) -> Column:
    """vN to vN+1; what can't be read becomes v2."""
    number = F.regexp_extract(c, r"^v(\d{1,9})$", 1)
    return F.when(number == "", F.lit("v2")).otherwise(F.concat(F.lit("v"), (number.cast("bigint") + 1).cast("string")))


def versioned(name: str, generation) -> Column:
    """A name with its generation."""
    return F.concat(F.lit(name + "_"), generation)


def is_blank(c) -> Column:
    return c.isNull() | (F.length(strip(c)) == 0)


def is_binary(c) -> Column:
    """A NUL, a PDF signature, or a tenth of the first 4096 characters damaged."""
    head = F.substring(c, 1, DAMAGED_WITHIN)
    lost = F.length(head) - F.length(F.translate(head, "�", ""))
    return F.contains(c, F.lit("\0")) | F.startswith(F.regexp_replace(c, r"^\s+", ""), F.lit(PDF_HEADER)) | ((F.length(head) > 0) & (lost >= DAMAGED_SHARE * F.length(head)))


def is_card(c) -> Column:
    return F.startswith(F.regexp_replace(c, r"^\s+", ""), F.lit(CARD_HEADER))


def field(metadata, name: str) -> Column:
    """A field of metadata in JSON; null if it is missing or the metadata can't be read."""
    return F.get_json_object(metadata, f"$.{name}")


def fragment(name: str, value) -> str:
    """How a pair of metadata stands in its serialized form."""
    return f"{json.dumps(name)}: {json.dumps(value)}"


def has_pairs(metadata, pairs: dict, exact: bool = True) -> Column:
    """Whether metadata has all pairs; exact=False looks for the serialized pairs as substrings, so that 1 also meets 10."""
    out = F.lit(True)
    for k, v in pairs.items():
        text = v if isinstance(v, str) else json.dumps(v)
        out = out & (field(metadata, k) == F.lit(text) if exact else F.contains(metadata, F.lit(fragment(k, v))))
    return F.coalesce(out, F.lit(False))


def stored_metadata(metadata) -> Column:
    """Metadata as a map of strings without the tenant; an empty map if it can't be read."""
    parsed = F.from_json(metadata, "map<string,string>")
    return F.coalesce(F.map_filter(parsed, lambda k, v: k != "tenant_id"), F.create_map().cast("map<string,string>"))


def proximity_type(between) -> Column:
    """The relation told by the text between two entities."""
    t = F.lower(between)
    return F.when(F.contains(t, F.lit("is a")) | F.contains(t, F.lit("are a")), "IS_A").when(F.contains(t, F.lit("based on")), "BASED_ON").otherwise("RELATED_TO")


def backoff(attempt: int, base: float = 0.1, cap: float = 5.0, jitter: random.Random | None = None) -> float:
    """Seconds to wait before an attempt: doubling, capped, with up to as much again by chance."""
    wait = min(cap, base * 2**attempt)
    return wait * (1 + (jitter or random).random())


def definitions(text: str) -> dict[str, str]:
    """Definitions from lines `KEY: text`; comments, blank lines and lines without a colon are skipped."""
    rows = (line.strip() for line in text.splitlines())
    pairs = (line.partition(":") for line in rows if line and not line.startswith("#") and ":" in line)
    return {k.strip().upper(): v.strip() for k, _, v in pairs if k.strip()}


FENCE = re.compile(r"^\s*```[\w-]*\s*\n(.*?)\n?\s*```\s*$", re.S)


def unfenced(text: str) -> str:
    """A text without the code fence around it."""
    m = FENCE.match(text)
    return m[1] if m else text
