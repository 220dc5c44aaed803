"""Languages of texts and of their mixed stretches: nearest centroid over TF-IDF vectors of character n-grams.

Sentences become normalised TF-IDF vectors of hashed character trigrams. Each language has several centroids, found by
spherical k-means over the sentences of a bounded sample of labelled texts; because labels may be wrong, sentences first
move to the nearest language for some rounds. A sentence takes the language of the centroid with the highest cosine, and
is rejected if that cosine or its lead over the next language is too small.
"""

from __future__ import annotations

import re
from collections.abc import Iterator

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..session import ship
from . import vec

BITS, CENTROIDS, SAMPLE, ROUNDS = 13, 3, 2500, 4
NEAREST, LEAD, WORDS = 0.12, 0.12, 5
#: Share of the labelled sample that a language needs to get centroids; below it, its labels are taken for errors.
LEAST_SHARE = 0.005

#: Codes and English names of languages (two letters, three letters, name).
LANGUAGES = """en eng english; de deu ger german; fr fra fre french; es spa spanish; it ita italian; pt por portuguese; nl nld dut dutch; pl pol polish; sv swe swedish;
da dan danish; no nor norwegian; fi fin finnish; cs ces cze czech; hu hun hungarian; ro ron rum romanian; tr tur turkish; ru rus russian; el ell gre greek; ca cat catalan"""
NAMES = {name: words[0] for words in (x.split() for x in LANGUAGES.split(";")) for name in words}
#: Abbreviations after which a full stop ends no sentence, and articles and the like that begin sentences.
SHORT = "Dr Mr Ms Mrs Prof St No Nr Inc Co Ltd Corp Inst Dept Assoc Sys Intl Int Lab Labs Bros Tech Techs Grp Univ Svc Svcs Ind Mgmt Natl Mfg Ing Sra Sr Dott Mme"
OPENERS = "The This That Our Der Die Das Ein Eine Unser Unsere Dieses Diese Le Les La Une Un Notre Cette Ce El Los Las Una Nuestra Nuestro Esta Este Il Lo Gli Questa Questo Uno O Os As A Uma Um"
_SHORT = frozenset(SHORT.split())
#: A sentence may end at a mark or a line break, or where a capital follows.
MARK = re.compile(r"[.!?…][\"”»)]?\s+|\n+")
CAPITAL = re.compile(r"\s(?=[A-ZÀ-Þ])")
#: What begins a sentence although no mark ends the one before: an opener, or a label with a colon; after a bracket any word.
OPENER = re.compile(rf"(?:{'|'.join(OPENERS.split())})\s|L['’]|[^\W\d_]+(?:\s[^\W\d_]+){{0,3}}\s?(?:\([^()\n]{{3,60}}\))?\s?:\s")
ANY_WORD = re.compile(r"[^\W\d_]+\s")
WORD = re.compile(r"[^\W\d_]+")


def code(label: str | None) -> str | None:
    """The two-letter code that a label names; None if it names none."""
    if label is None:
        return None
    return NAMES.get(re.split(r"[-_ (.@]", label.strip().lower())[0])


def _cuts(text: str) -> list[tuple[int, int]]:
    """Where sentences end and the next ones begin. An initial, an abbreviation and a mark before a small letter end none."""
    out = []
    for m in MARK.finditer(text):
        a, b = m.span()
        if text[a] == "\n" or "\n" in text[a:b]:
            out.append((a if text[a] == "\n" else a + 1, b))
            continue
        if text[a] == ".":
            word = text[max(0, a - 7) : a].rpartition(" ")[2].lstrip("(\"'«“")
            if len(word) == 1 or word in _SHORT or word[-2:-1] == ".":
                continue
        if b < len(text) and not ("a" <= text[b] <= "z" or text[b] == "("):
            out.append((a + 1, b))
    for m in CAPITAL.finditer(text):
        a = m.start()
        before = text[a - 1 : a]
        if before == ")" and ANY_WORD.match(text, a + 1) or before.islower() and OPENER.match(text, a + 1):
            out.append((a, a + 1))
    return sorted(out)


def sentences(text: str) -> list[tuple[int, int]]:
    """Start and end of each sentence or line."""
    out, at = [], 0
    for a, b in _cuts(text):
        if a > at:
            out.append((at, a))
        at = max(at, b)
    if at < len(text):
        out.append((at, len(text)))
    return out


def readable(text: str) -> bool:
    """Whether a text isn't binary."""
    return not ("\0" in text or text.lstrip().startswith("%PDF") or text[:4096].count("�") * 10 >= max(1, len(text[:4096])))


def _vectors(texts: list[str]) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Sparse counts of the trigrams of each text: text, trigram, count; only trigrams with a letter count."""
    codes, offsets = vec.points([t.lower() for t in texts])
    letter = vec.alnum()[codes] & ~((codes >= 48) & (codes <= 57)) if len(codes) else np.empty(0, bool)
    c = np.where(letter, codes, 32).astype(np.uint32)
    if len(c) < 3:
        return np.empty(0, np.int64), np.empty(0, np.int64), np.empty(0)
    h = c[:-2] * np.uint32(0x85EBCA6B) ^ c[1:-1] * np.uint32(0xC2B2AE35) ^ c[2:] * np.uint32(0x27D4EB2F)
    h ^= h >> np.uint32(15)
    h *= np.uint32(0x2C1B3C6D)
    h >>= np.uint32(32 - BITS)
    doc = np.repeat(np.arange(len(texts), dtype=np.uint32), np.diff(offsets))
    keep = (letter[1:-1] | (letter[:-2] & letter[2:])) & (doc[:-2] == doc[2:])
    key = np.sort((doc[:-2][keep].astype(np.uint64) << np.uint64(BITS)) | h[keep])
    first = np.flatnonzero(np.concatenate([[True], key[1:] != key[:-1]])) if len(key) else np.empty(0, np.int64)
    count = np.diff(np.concatenate([first, [len(key)]]))
    key = key[first]
    return (key >> np.uint64(BITS)).astype(np.int64), (key & np.uint64((1 << BITS) - 1)).astype(np.int64), count


class Model:
    """Centroids of languages: codes, the centroids' languages, inverse document frequencies and the centroids."""

    def __init__(self, codes: list[str], of: np.ndarray, idf: np.ndarray, centroids: np.ndarray) -> None:
        self.codes, self.of, self.idf, self.centroids = codes, of, idf.astype(np.float32), np.ascontiguousarray(centroids.astype(np.float32))

    def cosines(self, texts: list[str]) -> np.ndarray:
        """(texts, languages): the cosine with the nearest centroid of each language; 0 for a text without letters."""
        best = np.zeros((len(texts), len(self.codes)), np.float32)
        doc, gram, count = _vectors(texts)
        if len(doc):
            value = (1 + np.log(count)).astype(np.float32) * self.idf[gram]
            first = np.flatnonzero(np.concatenate([[True], doc[1:] != doc[:-1]]))
            norm = np.sqrt(np.maximum(np.add.reduceat(value * value, first), 1e-12))
            score = np.add.reduceat(self.centroids[gram] * value[:, None], first, axis=0) / norm[:, None]
            for k in range(len(self.codes)):
                best[doc[first], k] = score[:, self.of == k].max(axis=1)
        return best

    def classify(self, texts: list[str]) -> tuple[np.ndarray, np.ndarray]:
        """Number of the language (-1: rejected) and confidence of each text."""
        if not len(self.codes):
            return np.full(len(texts), -1), np.zeros(len(texts))
        score = self.cosines(texts)
        k = score.argmax(axis=1)
        top = score.max(axis=1)
        rest = score.copy()
        rest[np.arange(len(k)), k] = 0
        second = rest.max(axis=1) if len(self.codes) > 1 else np.zeros(len(k))
        lead = np.where(top > 0, (top - second) / np.maximum(top, 1e-9), 0)
        return np.where((top >= NEAREST) & (lead >= LEAD), k, -1), np.clip(lead, 0, 1)


def fit(texts: list[str], labels: list[str]) -> Model:
    """A model from labelled texts, some of whose labels are wrong."""
    parts, langs = [], []
    codes = sorted(set(labels))
    for t, label in zip(texts, labels):
        for a, b in sentences(t):
            if len(WORD.findall(t[a:b])) >= WORDS:
                parts.append(t[a:b])
                langs.append(codes.index(label))
    size = 1 << BITS
    if not parts:
        return Model([], np.empty(0, int), np.zeros(size), np.zeros((size, 0)))
    doc, gram, count = _vectors(parts)
    df = np.bincount(gram, minlength=size)
    idf = np.where(df > 0, np.log((1 + len(parts)) / (1 + df)) + 0.1, 0)
    value = (1 + np.log(count)) * idf[gram]
    value /= np.sqrt(np.bincount(doc, value * value, len(parts)))[doc]
    lang = np.array(langs)

    def centre(rows: np.ndarray) -> np.ndarray:
        used = rows[doc]
        c = np.bincount(gram[used], value[used], size)
        return c / max(np.sqrt((c * c).sum()), 1e-12)

    def against(c: np.ndarray) -> np.ndarray:
        return np.bincount(doc, value * c[gram], len(parts))

    for _ in range(ROUNDS):  # wrong labels give way to the nearest language
        score = np.stack([against(centre(lang == k)) for k in range(len(codes))])
        lang = score.argmax(axis=0)
    held, of = [], []
    for k in range(len(codes)):
        rows = np.flatnonzero(lang == k)
        if not len(rows):
            continue
        cs = [centre(lang == k)]
        while len(cs) < min(CENTROIDS, len(rows)):  # farthest sentence as the next seed
            near = np.max([against(c)[rows] for c in cs], axis=0)
            pick = np.zeros(len(parts), bool)
            pick[rows[np.argsort(near)[: max(1, len(rows) // 10)]]] = True
            cs.append(centre(pick))
        for _ in range(ROUNDS):
            mine = np.stack([against(c)[rows] for c in cs]).argmax(axis=0)
            for i in range(len(cs)):
                if (mine == i).any():
                    pick = np.zeros(len(parts), bool)
                    pick[rows[mine == i]] = True
                    cs[i] = centre(pick)
        held += cs
        of += [k] * len(cs)
    return Model(codes, np.array(of), idf, np.stack(held, axis=1))


def label_of(metadata: str):
    """The label in a metadata column."""
    return F.get_json_object(metadata, "$.lang")


def fit_on(docs: DataFrame, sample: int = SAMPLE, least_share: float = LEAST_SHARE) -> Model:
    """A model fitted on at most 2 * sample texts whose label names a language, taken by the hash of document_id.

    A language whose labels are less than least_share of them, or on one text only, gets no centroid; its texts are rejected or take the nearest language."""
    rows = docs.select("document_id", "content", label_of("metadata").alias("label")).where("document_id IS NOT NULL AND content IS NOT NULL AND label IS NOT NULL")
    slots = max(1, rows.count() // sample)
    held = rows.where(F.pmod(F.xxhash64("document_id"), F.lit(slots)) == 0).limit(2 * sample).collect()
    pairs = [(r["content"], code(r["label"])) for r in held]
    pairs = [(t, c) for t, c in pairs if c and readable(t)]
    counts = pd.Series([c for _, c in pairs]).value_counts() if pairs else pd.Series(dtype=int)
    common = set(counts[counts >= max(2, least_share * len(pairs))].index)
    pairs = [(t, c) for t, c in pairs if c in common]
    return fit([t for t, _ in pairs], [c for _, c in pairs])


def segments(docs: DataFrame, model: Model | None = None, sample: int = SAMPLE) -> DataFrame:
    """(document_id string, segment int, start_char int, end_char int, lang string, confidence double, sentences int).

    Stretches of one language in each text, in order; sentences is the number of whole sentences (WORDS words or more
    that were not rejected). Rejected sentences, headings and single phrases belong to the stretch around them and
    count for nothing. docs needs document_id, content and metadata; other columns are ignored. Null ids, null, blank
    and binary texts and texts without a classified sentence give no row; a document delivered again gives its rows
    once. Texts are read whole; offsets are in code points.
    """
    spark = docs.sparkSession
    ship(spark)
    shared = spark.sparkContext.broadcast(model or fit_on(docs, sample))
    rows = docs.select(F.col("document_id").cast("string"), "content").where("document_id IS NOT NULL AND content IS NOT NULL")

    def run(it: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        model = shared.value
        for pdf in it:
            texts = pdf["content"].tolist()
            ids = pdf["document_id"].tolist()
            for lo, hi in vec.batches(texts, 1_000_000):
                parts, where = [], []
                for i in range(lo, hi):
                    if readable(texts[i]):
                        for a, b in sentences(texts[i]):
                            s = texts[i][a:b]
                            if s.count(" ") >= WORDS - 1 and len(WORD.findall(s)) >= WORDS:
                                parts.append(s)
                                where.append((i, a, b))
                k, sure = model.classify(parts)
                out: list[list] = []
                for (i, a, b), lang, p in zip(where, k.tolist(), sure.tolist()):
                    if lang < 0:
                        continue
                    if out and out[-1][0] == ids[i] and out[-1][4] == model.codes[lang]:
                        out[-1][3] = b
                        out[-1][5] += p
                        out[-1][6] += 1
                    else:
                        n = out[-1][1] + 1 if out and out[-1][0] == ids[i] else 0
                        out.append([ids[i], n, a, b, model.codes[lang], p, 1])
                f = pd.DataFrame(out, columns=["document_id", "segment", "start_char", "end_char", "lang", "confidence", "sentences"])
                f["confidence"] /= f["sentences"].clip(lower=1)
                yield f

    return rows.mapInPandas(run, "document_id string, segment int, start_char int, end_char int, lang string, confidence double, sentences int").dropDuplicates(["document_id", "segment"])


def languages(docs: DataFrame, least: int = 2, sample: int = SAMPLE) -> DataFrame:
    """(document_id, lang, sentences, confidence): languages with at least `least` whole sentences in a document."""
    per = segments(docs, sample=sample).groupBy("document_id", "lang").agg(F.sum("sentences").alias("sentences"), (F.sum(F.col("confidence") * F.col("sentences")) / F.sum("sentences")).alias("confidence"))
    return per.where(F.col("sentences") >= least)


def mislabelled(docs: DataFrame, least: int = 2, sample: int = SAMPLE) -> DataFrame:
    """(document_id, lang, confidence): the languages of documents whose label is missing, names another language or doesn't tell of a mixture."""
    names = F.create_map(*[F.lit(x) for pair in NAMES.items() for x in pair])
    label = names[F.split(F.lower(F.trim(label_of("metadata"))), r"[-_ (.@]")[0]]
    labels = docs.select(F.col("document_id").cast("string"), label.alias("label")).where("document_id IS NOT NULL").groupBy("document_id").agg(F.min("label").alias("label"))
    found = languages(docs, least, sample)
    per = found.groupBy("document_id").agg(F.collect_list(F.struct("lang", "confidence")).alias("all")).join(labels, "document_id")
    wrong = per.where((F.size("all") > 1) | F.col("label").isNull() | ~F.exists("all", lambda x: x["lang"] == F.col("label")))
    return wrong.select("document_id", F.explode("all").alias("x")).select("document_id", "x.lang", "x.confidence")
