"""Language of documents and of segments in mixed documents by cross-parsing entropy.

For each language a suffix automaton is built over a bounded sample of labelled text. A
sentence is parsed greedily into the longest phrases that occur in that text; the language
that needs the fewest phrases, normalised by the size of its sample, wins. Without suffix
links greedy parsing is a walk through a finite table, so whole batches of sentences are
parsed against all languages at once in numpy.
"""

from __future__ import annotations

import re
import unicodedata
from collections.abc import Iterator

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from pagewright.session import cut, once

LANGS = ("en", "fr", "es", "de", "pt")
SAMPLE_CHARS = 20_000  # bound of the labelled sample per language
SAMPLE_ITEMS = 400  # items drawn per language to fill it
SHORT = 24  # characters under which a piece says little: it follows its neighbours unless its margin is wide
MARGIN = 0.04  # a foreign sentence must beat the filing's language by this share
SHORT_MARGIN = 0.3  # and a short one by this

# Labels in use for each language, compared in lower case without region.
LABELS = {
    "en": "en eng english anglais englisch inglés ingles inglês",
    "fr": "fr fre fra french français francais französisch francés",
    "es": "es spa spanish español espanol espagnol castellano",
    "de": "de ger deu german deutsch allemand",
    "pt": "pt por portuguese português portugues portugais",
}
# Function words that tell the five languages apart; they vet the labels of the sample.
FUNCTION_WORDS = {
    "en": "the of and to in is was were that for with has have been by on at from which not are this will",
    "fr": "le la les des du et est dans que qui pour avec une sur par au aux ne pas été sont cette ces",
    "es": "el los las del y es en que para con una por se al no más ha está sobre desde este fue la lo su sus ha han sido nuestra muy",
    "de": "der die das und ist in den von zu mit dem des nicht wurde wird für auf ein eine sich hat noch",
    "pt": "o os as do da dos das e em que para com uma por no na ao não foi mais há pelo ainda a às aos foram pela nossa nosso seu sua deve ser sido muito",
}
# A little text of each language, so that a language without labelled text has a model.
SEED = {
    "en": "The company will file the report before the work begins. We have lived here for many years and the water has not been tested. When the road was closed, nobody told us what would happen to the fields. ",
    "fr": "La société déposera le rapport avant le début des travaux. Nous vivons ici depuis plusieurs années et l'eau n'a pas été analysée. Lorsque la route a été fermée, personne ne nous a dit ce qui arriverait aux champs. ",
    "es": "La empresa presentará el informe antes de que comiencen las obras. Vivimos aquí desde hace muchos años y el agua no se ha analizado. Cuando se cerró el camino, nadie nos dijo qué pasaría con los campos. ",
    "de": "Das Unternehmen wird den Bericht vor Beginn der Arbeiten einreichen. Wir leben seit vielen Jahren hier und das Wasser wurde nicht geprüft. Als die Straße gesperrt wurde, sagte uns niemand, was mit den Feldern geschehen würde. ",
    "pt": "A empresa apresentará o relatório antes do início das obras. Vivemos aqui há muitos anos e a água não foi analisada. Quando a estrada foi fechada, ninguém nos disse o que aconteceria com os campos. ",
}


def label_language(c: Column) -> Column:
    """The language a label names, null where it names none of the five."""
    short = F.regexp_replace(F.lower(F.trim(c)), r"[-_].*$", "")
    out = F.lit(None).cast("string")
    for lang, names in LABELS.items():
        out = F.when(short.isin(*names.split()), F.lit(lang)).otherwise(out)
    return out


# ---------------------------------------------------------------- automata

# A letter, then a break mark at a line end, then a letter: the word continues.
_BROKEN = re.compile(r"(?<=\w)[-‐\xad¬]\s*\n\s*(?=\w)")


def clean(text: str) -> str:
    text = unicodedata.normalize("NFC", text)
    return " ".join((_BROKEN.sub("", text) if "\n" in text else text).split())


class Model:
    """Automata of all languages in one transition table over a common alphabet."""

    def __init__(self, samples: dict[str, str]):
        self.langs = list(samples)
        texts = {k: clean(v).lower() for k, v in samples.items()}
        letters = sorted({c for t in texts.values() for c in t if c.isalpha()})
        # Class 0 other, 1 space, 2 digit, 3 punctuation; numbers and marks are the same in all languages.
        self.classes = {c: i + 4 for i, c in enumerate(letters)}
        self.width = len(letters) + 4
        self._ascii = np.zeros(0x250, dtype=np.int16)
        for o in range(0x250):
            self._ascii[o] = self._class(chr(o))
        tables, starts, self.bits = [], [], []
        base = 0
        for k in self.langs:
            t = self._automaton(self.encode(texts[k]))
            missing = t < 0
            t = np.where(missing, np.maximum(t[0], 0)[None, :], t) + base
            tables.append((t.astype(np.int64) * 2 + missing).astype(np.int32))
            starts.append(base)
            base += len(t)
            self.bits.append(np.log2(max(len(texts[k]), 2)))
        self.table = np.concatenate(tables).ravel()
        self.starts = np.array(starts, dtype=np.int64)
        self.bits = np.array(self.bits)

    def _class(self, c: str) -> int:
        c = c.lower()
        return self.classes.get(c, 1 if c.isspace() else 2 if c.isdigit() else 0 if c.isalpha() else 3) if len(c) == 1 else 0

    def encode(self, s: str) -> np.ndarray:
        o = np.frombuffer(s.encode("utf-32-le"), dtype=np.uint32)
        return np.where(o < 0x250, self._ascii[np.minimum(o, 0x24F)], 0)

    def _automaton(self, seq: np.ndarray) -> np.ndarray:
        """Suffix automaton of ``seq`` as a dense state x class table, -1 where there is no transition."""
        nxt: list[dict[int, int]] = [{}]
        link, length, last = [-1], [0], 0
        for c in seq.tolist():
            cur = len(nxt)
            nxt.append({})
            link.append(0)
            length.append(length[last] + 1)
            p = last
            while p >= 0 and c not in nxt[p]:
                nxt[p][c] = cur
                p = link[p]
            if p >= 0:
                q = nxt[p][c]
                if length[p] + 1 == length[q]:
                    link[cur] = q
                else:
                    clone = len(nxt)
                    nxt.append(dict(nxt[q]))
                    link.append(link[q])
                    length.append(length[p] + 1)
                    while p >= 0 and nxt[p].get(c) == q:
                        nxt[p][c] = clone
                        p = link[p]
                    link[q] = link[cur] = clone
            last = cur
        out = np.full((len(nxt), self.width), -1, dtype=np.int64)
        for s, d in enumerate(nxt):
            if d:
                out[s, list(d)] = list(d.values())
        return out

    def entropy(self, pieces: list[str]) -> np.ndarray:
        """Bits a character for each piece and language: phrases x log2(sample) / length."""
        size = np.array([len(p) for p in pieces], dtype=np.int64)
        whole, ends = self.encode("".join(pieces)), np.cumsum(size)
        codes = [whole[e - n : e] for e, n in zip(ends, size)]
        order = np.argsort(-size, kind="stable")
        out = np.zeros((len(pieces), len(self.langs)))
        # Lanes of like length go together, so that the table of codes stays small whatever the lengths.
        for at in range(0, len(order), 512):
            lanes = order[at : at + 512]
            longest = int(size[lanes[0]])
            text = np.zeros((longest, len(lanes)), dtype=np.int64)
            for j, i in enumerate(lanes):
                text[: size[i], j] = codes[i]
            live = np.searchsorted(-size[lanes], -np.arange(longest), side="left")  # lanes with a char at t
            state = np.repeat(self.starts[:, None], len(lanes), axis=1)
            phrases = np.ones((len(self.starts), len(lanes)))
            for t in range(longest):
                n = int(live[t])
                v = self.table[state[:, :n] * self.width + text[t, :n]]
                phrases[:, :n] += v & 1
                state[:, :n] = v >> 1
            out[lanes] = (phrases * self.bits[:, None] / np.maximum(size[lanes], 1)).T
        return out


# ---------------------------------------------------------------- segments

_END = re.compile(r"[.?!][\"'»”)]*\s+(?=[¿¡«\"“(]*[A-ZÀ-ÖØ-ÞŒ0-9])")
_CONSONANTS = tuple("bcdfgkmnprstvz")
_ABBREVIATION = re.compile(r"\b(?:Inc|Ltd|Corp|Co|Mr|Mrs|Ms|Dr|St|No|Mme|M|Sr|Sra|Nr|bzw|[A-Z])\.$")


def sentences(text: str) -> list[tuple[str, bool]]:
    """(piece, is a full sentence) of an item; lines are joined first."""
    out, held = [], ""
    text, parts, at = clean(text), [], 0
    for m in _END.finditer(text):
        parts.append(text[at : m.start() + 1])
        at = m.end()
    for part in [*parts, text[at:]]:
        part = f"{held} {part}".strip() if held else part
        held = ""
        words = part.split()
        if len(words) < 4 and _ABBREVIATION.search(part):
            held = part
            continue
        # Scans may show the first letter as a digit or a small l; only a lower-case start of the item is a remainder.
        first = part.lstrip("¿¡«\"“(")[:2]
        whole = first[:1].isupper() or first[:1].isdigit() or first[:1] == "l" and first[1:] in _CONSONANTS
        full = len(words) >= 3 and part[-1:] in ".?!" and (whole or bool(out))
        out.append((part, full))
    if held:
        out.append((held, False))
    return out


def _votes(text: str) -> dict[str, int]:
    words = re.findall(r"[^\W\d_]+", text.lower())
    return {k: sum(w in s for w in words) for k, s in _FUNCTION_SETS.items()}


_FUNCTION_SETS = {k: frozenset(v.split()) for k, v in FUNCTION_WORDS.items()}


def items(gz: DataFrame) -> DataFrame:
    """(doc_id, lang_label, text_ix, text) of all text items with a text."""
    rows = once(gz.select("gz_id", "doc_id", "lang_label", "texts"), "gz_id")
    return rows.select("doc_id", "lang_label", F.posexplode("texts").alias("text_ix", "item")).where(F.col("item.text").isNotNull() & F.col("doc_id").isNotNull()).select("doc_id", "lang_label", "text_ix", F.col("item.text").alias("text"))


def training_sample(gz: DataFrame, sample_items: int = SAMPLE_ITEMS, sample_chars: int = SAMPLE_CHARS) -> dict[str, str]:
    """Labelled text per language, at most ``sample_chars`` each, vetted by function words.

    The sample is bounded: the top distinct texts per language by a hash, so that copies of one text do not fill it.
    """
    rows = gz.select(label_language(F.col("lang_label")).alias("lang"), F.explode("texts.text").alias("text")).where(F.col("lang").isNotNull() & F.length("text").between(80, 2000)).withColumn("h", F.xxhash64("text"))
    # Only hashes are compared to find the sample; the texts are fetched for those that are in it.
    ranked = rows.select("lang", "h").distinct().withColumn("n", F.row_number().over(Window.partitionBy("lang").orderBy("h"))).where(F.col("n") <= sample_items)
    last = {r.lang: r.h for r in ranked.groupBy("lang").agg(F.max("h").alias("h")).collect()}
    inside = F.lit(False)
    for lang, h in last.items():
        inside = inside | (F.col("lang") == lang) & (F.col("h") <= h)
    rows = rows.where(inside).select("lang", "h", "text").distinct().orderBy("lang", "h", "text").collect()  # at most languages x sample_items texts
    labelled = list(dict.fromkeys((r.lang, p) for r in rows for p, full in sentences(r.text) if full))
    got: dict[str, list[str]] = {k: [] for k in LANGS}
    for lang, piece in labelled:
        votes = _votes(piece)
        if votes[lang] >= 3 and sorted(votes.values())[-2] < votes[lang]:
            got[lang].append(piece)
    join = lambda: {k: (" ".join(got[k]) + " " + SEED[k])[-sample_chars:] for k in LANGS}
    # Labels are wrong here and there: a second round keeps the sentences that a model of the first agrees with.
    first = Model(join())
    h = first.entropy([p for _, p in labelled])
    got = {k: [] for k in LANGS}
    for (lang, piece), row in zip(labelled, h):
        own = LANGS.index(lang)
        if row[own] < 0.97 * np.delete(row, own).min():
            got[lang].append(piece)
    return join()


_MODELS: dict[int, Model] = {}


def _model(samples: dict[str, str]) -> Model:
    """One model a worker process, built from the broadcast sample on first use."""
    key = hash(tuple(samples.items()))
    if key not in _MODELS:
        _MODELS.clear()
        _MODELS[key] = Model(samples)
    return _MODELS[key]


def classify(rows: DataFrame, samples: dict[str, str], carry: list[str]) -> DataFrame:
    """Per item and piece: language, characters, whether it is a full sentence, and the confidence.

    ``rows`` has ``text`` and the columns in ``carry``. Every piece gives a row; texts without a
    letter give none. Confidence is the margin to the next language as a share, 0 to 1. A short
    piece without a wide margin takes the language of the piece before it in its item, or behind
    it, with confidence 0. Equal pieces of a batch are parsed once.
    """
    sent = rows.sparkSession.sparkContext.broadcast(samples)
    schema = ", ".join(f"`{c}` {rows.schema[c].dataType.simpleString()}" for c in carry) + ", piece int, lang string, chars int, full boolean, confidence double, margins array<double>"

    def scan(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        model = _model(sent.value)
        for b in batches:
            at, which, fulls, no, distinct = [], [], [], [], {}
            for i, t in enumerate(b["text"]):
                for k, (p, full) in enumerate(sentences(t)):
                    if any(c.isalpha() for c in p):
                        at.append(i)
                        which.append(distinct.setdefault(p, len(distinct)))
                        fulls.append(full)
                        no.append(k)
            if not at:
                continue
            h = model.entropy(list(distinct))
            two = np.sort(h, axis=1)[:, :2]
            best, size = np.argmin(h, axis=1), np.array([len(p) for p in distinct], dtype=np.int32)
            margin = 1 - two[:, 0] / np.maximum(two[:, 1], 1e-9)
            lang, sure = best[which], (size >= SHORT)[which] | (margin >= SHORT_MARGIN)[which]
            confidence = margin[which]
            for step in (1, -1):  # from the piece before, then from the piece behind
                order = range(len(at)) if step > 0 else range(len(at) - 1, -1, -1)
                for j in order:
                    if not sure[j] and 0 <= j - step < len(at) and sure[j - step] and at[j - step] == at[j]:
                        confidence[j] = 0.0 if lang[j] != lang[j - step] else confidence[j]
                        lang[j], sure[j] = lang[j - step], True
            out = b[carry].iloc[at].reset_index(drop=True)
            out["piece"] = np.array(no, dtype=np.int32)
            out["lang"] = [model.langs[k] for k in lang]
            out["chars"] = size[which]
            out["full"] = fulls
            out["confidence"] = confidence
            out["margins"] = list((1 - two[:, :1] / np.maximum(h, 1e-9))[which])
            yield out

    return rows.select(*carry, "text").mapInPandas(scan, schema)


def pieces(gz: DataFrame, samples: dict[str, str] | None = None) -> DataFrame:
    """All pieces of all items with their language; checkpointed, as two results read them."""
    return cut(classify(items(gz), samples or training_sample(gz), ["doc_id", "lang_label", "text_ix"]))


def documents(found: DataFrame) -> DataFrame:
    """(doc_id, lang_label, lang, confidence): the language of most of a filing's characters.

    Confidence is the share of characters in that language times the mean margin found there.
    """
    per = found.groupBy("doc_id", "lang").agg(F.sum("chars").alias("chars"), F.sum(F.col("confidence") * F.col("chars")).alias("weight"), F.max("lang_label").alias("lang_label"))
    return per.groupBy("doc_id").agg(
        F.max_by("lang", F.struct("chars", "lang")).alias("lang"), F.max("lang_label").alias("lang_label"),
        (F.max_by("weight", F.struct("chars", "lang")) / F.sum("chars")).alias("confidence"),
    )


def foreign(found: DataFrame, mains: DataFrame, margin: float = MARGIN) -> DataFrame:
    """(doc_id, text_ix, lang, confidence) of items with a full sentence in another language than the filing's."""
    order = F.array(*[F.lit(k) for k in LANGS])
    against = F.col("margins")[F.array_position(order, F.col("main")).cast("int") - 1]
    least = F.when(F.col("chars") < SHORT, F.lit(SHORT_MARGIN)).otherwise(F.lit(margin))
    joined = found.where("full").join(mains.select("doc_id", F.col("lang").alias("main")), "doc_id").where((F.col("lang") != F.col("main")) & (against >= least))
    return joined.groupBy("doc_id", "text_ix", "lang").agg(F.max("confidence").alias("confidence"))


def segments(found: DataFrame) -> DataFrame:
    """(doc_id, text_ix, first_piece, last_piece, lang, chars, confidence): runs of one language in an item."""
    w = Window.partitionBy("doc_id", "text_ix").orderBy("piece")
    runs = found.withColumn("_new", (~F.col("lang").eqNullSafe(F.lag("lang").over(w))).cast("int")).withColumn("_run", F.sum("_new").over(w))
    return runs.groupBy("doc_id", "text_ix", "_run", "lang").agg(
        F.min("piece").alias("first_piece"), F.max("piece").alias("last_piece"), F.sum("chars").alias("chars"), F.round(F.sum(F.col("confidence") * F.col("chars")) / F.sum("chars"), 4).alias("confidence")
    ).drop("_run")
