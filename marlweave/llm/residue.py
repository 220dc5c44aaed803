"""Template residue, filler, error pages and script notices.

Character n-gram models of four kinds are fitted: filler, notices (error pages, script notices and their page furniture),
unfilled places of a template, and natural prose. Every text is read through windows of the likelihood ratio against
prose. A text whose windows are covered by filler or notices is residue, and so is one with a window of an unfilled place,
which is short: its model has the shapes of characters beside the characters, a narrower window, and reads texts with
quotations and listings blanked out, as what stands there is mentioned, not left unfilled.

The models begin with the seeds below against all n-grams of the corpus; a second pass counts anew what they take for
each kind, so that they learn the corpus' own prose and its own kinds of residue. Both passes read every text.
"""

from __future__ import annotations

import re
from collections.abc import Iterator
from functools import cache

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..session import ship
from . import vec

ORDER, BITS, SHAPE_BITS, WINDOW, PLACE_WINDOW = 4, 18, 18, 40, 10
#: Mean ratio of a window, share of a text in such windows, share and ratio at which a text is counted anew, and what a model takes from that of prose.
RATIO, PLACE_RATIO, COVERAGE, ADOPT, PLACE_ADOPT, MIX, PLACE_MIX = 0.5, 1.75, 0.5, 0.3, 2.5, 0.3, 0.7
#: Weight of the seeds beside what is counted anew, and the floor of prose.
SEEDS, FLOOR = 3, 0.02
BLOCK, FAN = 1 << 13, 256
#: A character of private use that stands for what is quoted; it counts as a letter.
HIDDEN = "\ue000"

#: Seed phrases of notices in the languages of the corpus, with page furniture.
NOTICES = """
Error 404: Not found. The page you requested could not be found. The page does not exist or has been moved.
Error 500: Internal server error. Something went wrong, please try again later. An unexpected error occurred.
503 Service unavailable. The server is temporarily unavailable. Bad gateway. Gateway timeout. The request timed out.
Access denied. You do not have permission to view this page. 403 Forbidden. Unauthorized. Your session has expired, please log in again.
Too many requests. Rate limit exceeded. Connection refused. Oops! We are sorry.
Please enable JavaScript to view this page. JavaScript is disabled in your browser. This app needs JavaScript to run. You need to turn on scripts to continue.
Checking your browser before you continue. Cookies must be enabled. Scripts and cookies must be allowed; enable them and reload. Some features need scripts.
We noticed that scripting is disabled. Some features cannot be shown without it. Your browser does not support scripts. You do not have permission to open this resource. The request was cancelled. at module (line 0) Traceback.
Start > Library > Home. Home | Search | Help | Contact. Skip to main content. Back to the start page. Reference: 0000. Time: 00:00 UTC. Request id. Log in. Menu.
Fehler 404: Seite nicht gefunden. Die gewünschte Seite gibt es nicht mehr. Interner Serverfehler, bitte später noch einmal versuchen. Zugriff verweigert. Ihre Sitzung ist abgelaufen. Dienst nicht verfügbar. Zu viele Anfragen.
Bitte aktivieren Sie JavaScript, um diese Seite zu sehen. JavaScript ist in Ihrem Browser ausgeschaltet. Diese Anwendung benötigt JavaScript.
Erreur 404 : Page introuvable. La page demandée n'existe pas ou a été déplacée. Erreur interne du serveur, veuillez réessayer plus tard. Accès refusé. Votre session a expiré. Service indisponible. Trop de requêtes.
Veuillez activer JavaScript pour afficher cette page. JavaScript est désactivé dans votre navigateur. Cette application nécessite JavaScript.
Error 404: Página no encontrada. La página solicitada no existe. Error interno del servidor, inténtelo de nuevo más tarde. Acceso denegado. Su sesión ha caducado. Servicio no disponible. Demasiadas peticiones.
Active JavaScript para ver esta página. JavaScript está desactivado en su navegador. Esta aplicación necesita que los scripts estén permitidos.
Errore 404: Pagina non trovata. La pagina richiesta non esiste più. Errore interno del server, riprova più tardi. Accesso negato. La sessione è scaduta. Servizio non disponibile. Troppe richieste.
Attiva JavaScript per vedere questa pagina. JavaScript è disattivato nel browser. Questa applicazione richiede JavaScript.
Erro 404: Página não encontrada. A página pedida não existe. Erro interno do servidor, tente novamente mais tarde. Acesso negado. A sua sessão expirou. Serviço indisponível. Demasiados pedidos.
Ative o JavaScript para ver esta página. O JavaScript está desativado no navegador. Esta aplicação precisa de JavaScript.
"""
#: Seed phrases of filler.
FILLER = """
Lorem ipsum dolor sit amet, consectetur adipiscing elit, sed do eiusmod tempor incididunt ut labore et dolore magna aliqua.
Ut enim ad minim veniam, quis nostrud exercitation ullamco laboris nisi ut aliquip ex ea commodo consequat. Duis aute irure dolor.
Sit amet lorem. Ipsum sit lorem. Amet dolor consectetur adipi lorem sit. Vivamus fusce ornare magna vestibulum ante posuere cubilia.
Placeholder text. Text goes here. Sample text. Insert text here. Dummy text. Content goes here. Your text here. To be added. Coming soon. Under construction.
Platzhaltertext. Beispieltext. Hier steht später Text. Blindtext. Text folgt. Inhalt folgt.
Texte provisoire. Texte à venir. Texte de remplissage. Contenu à venir. Exemple de texte.
Texto de ejemplo. Texto de relleno. Texto provisional. Aquí va el texto. Contenido pendiente.
Testo segnaposto. Testo di prova. Testo di esempio. Qui va il testo. Contenuto in arrivo.
Texto de exemplo. Texto provisório. Texto de preenchimento. Aqui vai o texto. Conteúdo em breve.
foo bar baz test test test blah blah bla xxx 000 foo bla test bar blah foo foo bar
asdf qwer asdfasdf jkl hjkl sdfg xcvb qwerty asdfjkl qwerasdf sdfghjkl zxcv hjklasdf yxcv uiop
"""
#: Marks in prose that are no places.
PROSE = """See [notes] and [7]. Compare [3, 4] with [a], (see below) and [12]: as in [the list], [both]. It holds where a < b and c > d, 5% of 10% each, 20 % in all.
#1 and #2, item_no_3, read_me, a/b, C++, C#, R&D, Q&A, $5, $20.50, 100%, x = {1, 2}, {a, b}, **bold**, *so*, __init__, a_b, ~10, ^2, a@b.org, https://a.org/b?c=d&e=f#g.
array[0], x[i], [link](page.html), <b>bold</b>, <p class="a">, <br/>, ## Heading, - item, * item, | a | b |, --- and ... or e.g. (i.e. this), key: value; [sic], [...], [2024-01-01]."""
#: How templates write a place (x: its name), how a field is left blank, and names of places.
PLACES = """{{x}} {{ x }} ${x} #{x} {%x%} {% x %} <%= x %> <%x%> %%X%% %x% @@x@@ __X__ [[x]] %(x)s %(x)d {0} {1} {12} {x} &lt;x&gt; &lt; x &gt;""".split(" ")
PHRASES = "<x goes here>; <x comes here>; [INSERT X HERE]; [YOUR X HERE]; [ENTER X]; [ADD X]; [your x]; [your x here]; [insert x]; [insert x here]; [enter x]; [add x here]; <your x>; <insert x>; <enter x>".split("; ")
BLANKS = ": -; : --; : ...; : ___; : ???; : n/a; : N/A; : TBD; : TODO; : xxx".split("; ")
FIELDS = "name date title city order.id first_name team amount summary company due_date price subject address user.name product".split()
QUOTED = re.compile(r"```.*?(?:```|\Z)|~~~.*?(?:~~~|\Z)|`[^`\n]*`|\"[^\"\n]{1,200}\"|“[^”\n]{1,200}”|„[^“”\n]{1,200}[“”]|«[^»\n]{1,200}»", re.S)


def _places() -> list[str]:
    """Places with a name each and what may stand around them."""
    filled = [f.replace("x", n, 1).replace("X", n.upper()) for f in PLACES for n in FIELDS]
    return [f"so {f} and {f}, so {f}. So\n{f} is {f}\nso ({f}): so" for f in filled] + [f"{n}{b}\n{n}{b}\nso" for n in FIELDS for b in BLANKS]


def _phrases() -> list[str]:
    """The words of places that are written out, without the names."""
    return [f"so{b}\nso" for b in BLANKS] + [part for f in PHRASES for part in re.split(r"\bx\b", f" {f} ", flags=re.I) if len(part) > 4]


def outside(text: str) -> str:
    """The text with HIDDEN in place of quotations and listings; nothing else moves."""
    if not any(c in text for c in ("`", '"', "“", "„", "«", "~~~")):
        return text
    return QUOTED.sub(lambda m: HIDDEN * len(m[0]), text)


def _lower(text: str) -> str:
    """In small letters, as many characters as before."""
    low = text.lower()
    return low if len(low) == len(text) else "".join(c.lower() if len(c.lower()) == 1 else c for c in text)


@cache
def _kinds() -> np.ndarray:
    """What each code point looks like: a letter, a digit, a blank, or itself."""
    out = np.arange(0x110000, dtype=np.uint32)
    for c in range(0x110000):
        x = chr(c)
        if x.isalpha() or x == HIDDEN:
            out[c] = 97
        elif x.isdigit():
            out[c] = 48
        elif x.isspace():
            out[c] = 32
    return out


def _hashed(c: np.ndarray, bits: int, offsets: np.ndarray) -> np.ndarray:
    """The hashed n-gram that ends at each character; 0 where it would begin before its text."""
    h = np.zeros(len(c), np.uint32)
    for i in range(min(ORDER, len(c))):
        h *= np.uint32(0x01000193)
        h[i:] += c[: len(c) - i]
    h ^= h >> np.uint32(15)
    h *= np.uint32(0x2C1B3C6D)
    h >>= np.uint32(32 - bits)
    for i in range(ORDER - 1):
        h[np.minimum(offsets[:-1] + i, offsets[1:] - 1)] = 0
    return h


def _grams(texts: list[str]) -> tuple[np.ndarray, np.ndarray]:
    """The n-gram that ends at each character, and where the texts start. Digits count as one character."""
    codes, offsets = vec.points([_lower(t or "") for t in texts])
    c = codes.astype(np.uint32)
    c[(c >= 48) & (c <= 57)] = 48
    c[(c == 9) | (c == 10) | (c == 13)] = 32
    return _hashed(c, BITS, offsets), offsets


def _shapes(texts: list[str]) -> np.ndarray:
    """The n-gram of shapes that ends at each character."""
    codes, offsets = vec.points(texts)
    return _hashed(_kinds()[codes], SHAPE_BITS, offsets)


def _count(g: np.ndarray, bits: int, used: np.ndarray | None = None) -> np.ndarray:
    out = np.bincount(g if used is None else g[used], minlength=1 << bits).astype(np.float64)
    out[0] = 0  # no n-gram
    return out


def _share(counts: np.ndarray) -> np.ndarray:
    return (1 - FLOOR) * counts / max(counts.sum(), 1) + FLOOR / len(counts)


def _ratio(counts: np.ndarray, prose: np.ndarray, mix: float) -> np.ndarray:
    """Log-likelihood ratio of each n-gram against prose; a model that has seen little falls back on prose."""
    base = _share(prose)
    out = np.log((1 - mix) * counts / max(counts.sum(), 1) / base + mix).astype(np.float32)
    out[0] = 0
    return out


def _means(r: np.ndarray, offsets: np.ndarray, window: int, least: int = 1) -> np.ndarray:
    """The mean of r in the window around each character, within its text; a window of less than `least` counts as so long."""
    n, half = len(r), window // 2
    sums = np.zeros(n + 1)
    np.cumsum(r, dtype=np.float64, out=sums[1:])
    out = np.zeros(n)
    if n > 2 * half:
        out[half : n - half] = (sums[2 * half : n] - sums[: n - 2 * half]) / max(2 * half, least)
    # characters near the ends of their text have a shorter window
    near = np.arange(half + 1)
    first, last = offsets[:-1, None] + near, offsets[1:, None] - 1 - near
    at = np.concatenate([first[first < offsets[1:, None]], last[last >= offsets[:-1, None]]])
    doc = np.searchsorted(offsets, at, "right") - 1
    lo, hi = np.maximum(at - half, offsets[doc]), np.minimum(at + half, offsets[doc + 1] - 1)
    hi = np.maximum(hi, lo + 1)
    out[at] = (sums[hi] - sums[lo]) / np.maximum(hi - lo, least)
    return out


#: The counts that a pass over the corpus makes: name and bits.
COUNTS = {"filler": BITS, "notice": BITS, "prose": BITS, "prose_shape": SHAPE_BITS}


def seeds() -> dict[str, np.ndarray]:
    """The counts of the seed phrases."""
    filler, notices, places, phrases = FILLER.strip().split("\n"), NOTICES.strip().split("\n"), _places(), _phrases()
    return {"filler": _count(_grams(filler)[0], BITS), "notice": _count(_grams(notices)[0], BITS), "place": _count(_grams(phrases)[0], BITS), "place_shape": _count(_shapes(places), SHAPE_BITS), "prose": _count(_grams([PROSE])[0], BITS), "prose_shape": _count(_shapes([PROSE]), SHAPE_BITS)}


class Models:
    """Log-likelihood ratios of filler, notices and places against prose, for each n-gram."""

    def __init__(self, counts: dict[str, np.ndarray]) -> None:
        some = {k: v if v.sum() else v + 1 for k, v in counts.items()}
        self.filler, self.notice = (_ratio(some[k], some["prose"], MIX) for k in ("filler", "notice"))
        self.place, self.place_shape = _ratio(some["place"], some["prose"], PLACE_MIX), _ratio(some["place_shape"], some["prose_shape"], PLACE_MIX)

    def judged(self, texts: list[str]) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
        """Of each text its kind (0: none, 1: filler, 2: notice, 3: template) and coverage, and windows()."""
        marks, offsets, _ = self.windows(texts)
        cover = _coverage(marks, offsets)
        full = cover[:, :2].sum(axis=1) >= COVERAGE
        kind = np.where(full, np.where(cover[:, 0] >= cover[:, 1], 1, 2), np.where(cover[:, 2] > 0, 3, 0))
        blank = np.fromiter((not t or t.isspace() for t in texts), bool, len(texts))
        return np.where(blank, 0, kind), cover.sum(axis=1), marks, offsets

    def windows(self, texts: list[str], place_ratio: float = PLACE_RATIO) -> tuple[np.ndarray, np.ndarray, dict[str, np.ndarray]]:
        """For each character whether it is of filler (1), a notice (2), a place (3) or none of these (0), where the texts start, and the n-grams."""
        g, offsets = _grams(texts)
        plain = [outside(t or "") for t in texts]
        shape = _shapes(plain)
        hidden = vec.points(plain)[0] == ord(HIDDEN)
        out = np.zeros(len(g), np.uint8)
        if not len(g):
            return out, offsets, {"g": g, "shape": shape}
        filler, notice = _means(self.filler[g], offsets, WINDOW), _means(self.notice[g], offsets, WINDOW)
        over = np.maximum(filler, notice) > RATIO
        out[over & (filler >= notice)] = 1
        out[over & (filler < notice)] = 2
        words = self.place[g]
        for i in range(ORDER if hidden.any() else 0):  # n-grams that reach into what is hidden don't count
            words[i:][hidden[: len(g) - i]] = 0
        place = _means(words + self.place_shape[shape], offsets, PLACE_WINDOW, PLACE_WINDOW) > place_ratio
        out[place & ~hidden] = 3
        out[offsets[1:] - 1] = 0
        return out, offsets, {"g": g, "shape": shape}


def _coverage(marks: np.ndarray, offsets: np.ndarray) -> np.ndarray:
    """(texts, 3): the share of each text's characters that are of filler, notices and places."""
    length = np.maximum(np.diff(offsets) - 1, 1)
    return np.stack([np.add.reduceat((marks == k).astype(np.int64), offsets[:-1]) / length for k in (1, 2, 3)], axis=1) if len(length) else np.zeros((0, 3))


def counts(rows: DataFrame, models: Models | None = None) -> dict[str, np.ndarray]:
    """Counts of n-grams over all texts of rows (text): of all of them as prose, or by what models take each text for.

    Every task adds up its own texts; blocks of the counters are summed in three steps."""
    shared = rows.sparkSession.sparkContext.broadcast(models)

    def run(it: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        models, held = shared.value, {k: np.zeros(1 << b, np.int64) for k, b in COUNTS.items()}
        for pdf in it:
            texts = pdf["text"].tolist()
            for lo, hi in vec.batches(texts, 2_000_000):
                part = texts[lo:hi]
                if models is None:
                    held["prose"] += _count(_grams(part)[0], BITS).astype(np.int64)
                    held["prose_shape"] += _count(_shapes([outside(t) for t in part]), SHAPE_BITS).astype(np.int64)
                    continue
                marks, offsets, found = models.windows(part, PLACE_ADOPT)
                cover = _coverage(marks, offsets)
                full = cover[:, :2].sum(axis=1) >= ADOPT
                kind = np.where(full, np.where(cover[:, 0] >= cover[:, 1], 1, 2), np.where(cover[:, 2] > 0, 3, 0))
                of = np.repeat(kind, np.diff(offsets))
                g, shape = found["g"], found["shape"]
                for name, used in (("filler", of == 1), ("notice", of == 2), ("prose", of == 0)):
                    held[name] += _count(g, BITS, used).astype(np.int64)
                held["prose_shape"] += _count(shape, SHAPE_BITS, of == 0).astype(np.int64)
        out = [(k, i, v[i * BLOCK : (i + 1) * BLOCK].tobytes()) for k, v in held.items() for i in range(len(v) // BLOCK) if v[i * BLOCK : (i + 1) * BLOCK].any()]
        yield pd.DataFrame(out, columns=["kind", "block", "counts"])

    def total(pdf: pd.DataFrame) -> pd.DataFrame:
        summed = np.zeros(BLOCK, np.int64)
        for c in pdf["counts"]:
            summed += np.frombuffer(c, np.int64)
        return pd.DataFrame({"kind": pdf["kind"].iloc[:1], "block": pdf["block"].iloc[:1], "counts": [summed.tobytes()], "task": int(pdf["task"].iloc[0]) // FAN})

    kind = "kind string, block int, counts binary"
    summed = rows.select("text").mapInPandas(run, kind).withColumn("task", F.spark_partition_id())
    for _ in range(2):  # no group holds the blocks of more than FAN tasks, nor of more than FAN groups
        summed = summed.groupBy("kind", "block", F.expr(f"task div {FAN}").cast("int").alias("task")).applyInPandas(total, f"{kind}, task int")
    summed = summed.groupBy("kind", "block").applyInPandas(total, f"{kind}, task int")
    out = {k: np.zeros(1 << b) for k, b in COUNTS.items()}
    for r in summed.collect():  # a fixed number of counters
        out[r["kind"]][r["block"] * BLOCK : (r["block"] + 1) * BLOCK] = np.frombuffer(r["counts"], np.int64)
    return out


def fit(rows: DataFrame) -> Models:
    """Models from the seeds and all texts of rows (text): first against all n-grams, then against what was taken for prose."""
    start, whole = seeds(), counts(rows)
    again = counts(rows, Models(start | {k: whole[k] + SEEDS * start[k] for k in ("prose", "prose_shape")}))
    # places are as many as names: their model stays that of the seeds, and only learns what prose is
    return Models({k: again[k] + SEEDS * start[k] for k in COUNTS} | {k: start[k] for k in ("place", "place_shape")})


def residue(docs: DataFrame, models: Models | None = None) -> DataFrame:
    """(doc_id bigint, kind string, coverage double, spans array<struct<start int, end int, kind string>>): texts that are template residue, filler or notices.

    kind is `template`, `filler` or `notice`; spans are where the windows of each kind lie, in code points. docs needs
    doc_id and text; other columns are ignored. Texts are read whole. Null ids and null or blank texts give no row, a
    repeated row gives one.
    """
    spark = docs.sparkSession
    ship(spark)
    rows = docs.select(F.col("doc_id").cast("bigint"), "text").where("doc_id IS NOT NULL AND text IS NOT NULL")
    shared = spark.sparkContext.broadcast(models or fit(rows.select("text")))
    names = np.array(["", "filler", "notice", "template"], object)

    def scan(it: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        models = shared.value
        for pdf in it:
            texts, ids, out = pdf["text"].tolist(), pdf["doc_id"].tolist(), []
            for lo, hi in vec.batches(texts, 2_000_000):
                kind, cover, marks, offsets = models.judged(texts[lo:hi])
                for i in np.flatnonzero(kind).tolist():
                    m = marks[offsets[i] : offsets[i + 1]]
                    edge = np.flatnonzero(np.diff(m, prepend=0)).tolist()
                    spans = [{"start": a, "end": b, "kind": names[m[a]]} for a, b in zip(edge, [*edge[1:], len(m)]) if m[a]]
                    out.append((ids[lo + i], names[kind[i]], float(cover[i]), spans))
            yield pd.DataFrame(out, columns=["doc_id", "kind", "coverage", "spans"])

    return rows.mapInPandas(scan, "doc_id bigint, kind string, coverage double, spans array<struct<start:int,end:int,kind:string>>").dropDuplicates(["doc_id"])


def without_residue(docs: DataFrame, models: Models | None = None) -> DataFrame:
    """The rows whose texts are not residue; all columns, repeated rows and null texts stay."""
    found = residue(docs, models).select(F.col("doc_id").alias("_residue"))
    return docs.join(found, F.col("doc_id") == F.col("_residue"), "left_anti")
