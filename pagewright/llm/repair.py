"""Repair of text from scanned pages: broken words, misread characters, running heads, page numbers.

An averaged-perceptron character editor scores the operations keep, replace, delete, insert and
line-join. Its evidence is the operation, the characters around it and how the word stands in the
corpus before and after; it is trained on clean words that reader confusions and single random edits
spoil, so no labels are needed. Furniture is told by perceptrons over page-position features, trained
on what recurrence and sequence settle in long filings.

A filing is one row with all its items in reading order, so page context needs no shuffle. Passes
over the stored rows: word counts over all filings, then the repair. Between them every word form is
decided once, by its exact counts.
"""

from __future__ import annotations

import random
import re
import uuid
from collections import Counter, defaultdict
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from pagewright.session import cut, spread, store

MIN_SHARE = 1e-6  # a word of this share of all words is one that edits may lead to, which bounds the lexicon at a million
MAX_FIXES = 200_000  # decisions that are broadcast; more are joined to the filings that need them
SAMPLE_FILINGS = 300  # bound of the filings the furniture is trained on
TRAIN_WORDS = 1500  # bound of the words the editor is trained on
EPOCHS = 4
LEAST_FREE = 5  # an edit off the list is tried on words of so many letters
FREE_SHARE = 1e-5  # and leads to words of this share of all

# What a reader prints (left) for what stands on the page (right).
CONFUSIONS = (
    ("c", "e"), ("e", "c"), ("1", "i"), ("1", "l"), ("l", "1"), ("I", "l"), ("l", "I"), ("f", "t"), ("t", "f"), ("0", "o"), ("O", "0"), ("o", "0"), ("0", "O"),
    ("5", "s"), ("5", "S"), ("S", "5"), ("o", "a"), ("a", "o"), ("ri", "n"), ("rn", "m"), ("m", "rn"), ("cl", "d"), ("d", "cl"), ("ii", "u"), ("q", "g"), ("g", "q"),
    ("6", "é"), ("6", "b"), ("b", "6"), ("b", "h"), ("h", "b"), ("vv", "w"), ("v", "y"), ("y", "v"), ("h", "li"), ("li", "h"), ("u", "ii"), ("n", "ri"), ("8", "B"), ("B", "8"),
    ("Z", "2"), ("2", "Z"), ("3", "é"), ("9", "g"), ("g", "9"), ("i", "1"), ("I", "1"), ("rri", "m"), ("c", "o"), ("tl", "d"), ("E", "F"), ("F", "E"), ("G", "6"), ("D", "O"),
)
LISTED = {" ".join(f"{seen[k : k + 1]}>{true[k : k + 1]}" for k in range(max(len(seen), len(true)))) for seen, true in CONFUSIONS}
HYPHENS = "-‐\xad¬"
WORD = re.compile(r"[^\W_]+(?:['’][^\W_]+)*")
COMPOUND = re.compile(r"[^\W_]+(?:['’][^\W_]+)*(?:-[^\W_]+(?:['’][^\W_]+)*)+")
LEFT = re.compile(rf"([^\W_]+(?:['’-][^\W_]+)*)([{HYPHENS}])$")
DECIMAL = re.compile(r"(?<![^\W_])(\d+)([.,])([0-9]*[OolISB][0-9OolISB]*)(?![^\W_])")
FIRST_WORD = re.compile(r"\s*([^\W_]+(?:['’-][^\W_]+)*)")

# ---------------------------------------------------------------- averaged perceptron


class Perceptron:
    """Averaged perceptron over sparse string features for yes/no decisions on scored candidates."""

    def __init__(self):
        self.w: dict[str, float] = defaultdict(float)
        self._sum: dict[str, float] = defaultdict(float)
        self._at: dict[str, int] = defaultdict(int)
        self._step = 0

    def score(self, feats) -> float:
        w = self.w
        return sum(w.get(f, 0.0) for f in feats)

    def update(self, feats, by: float) -> None:
        for f in feats:
            self._sum[f] += (self._step - self._at[f]) * self.w[f]
            self._at[f] = self._step
            self.w[f] += by

    def tick(self) -> None:
        self._step += 1

    def average(self) -> "Perceptron":
        for f in list(self.w):
            self._sum[f] += (self._step - self._at[f]) * self.w[f]
            self.w[f] = self._sum[f] / max(self._step, 1)
        self.w = dict(self.w)
        return self


# ---------------------------------------------------------------- editor


def _kind(c: str) -> str:
    return "_" if not c else "9" if c.isdigit() else "A" if c.isupper() else "a" if c.isalpha() else "."


class Editor:
    """Character edits and line joins, trained on the lexicon.

    An edit turns ``seen`` at one place into ``true``; it is a sequence of character operations
    (replace, delete, insert; every other character is kept), each scored by the perceptron together
    with what the corpus says of the word before and after. Evidence is in ratios only, so the same
    texts any number of times give the same decisions.
    """

    def __init__(self, lexicon: dict[str, tuple[int, int]], seed: int = 11):
        self._take(lexicon, sum(c for c, _ in lexicon.values()) / max(1, sum(n for _, n in lexicon.values())))
        self.edit = Perceptron()
        self.join = Perceptron()
        self._train(random.Random(seed))

    def _take(self, lexicon: dict[str, tuple[int, int]], share: float) -> None:
        self.lex, self.share = lexicon, share  # word -> (times on clean pages, times anywhere); share of clean pages
        self._memo: dict[str, str] = {}
        self._near: dict[str, list[str]] | None = None
        self.fixes: dict[str, str] | None = None

    @classmethod
    def of(cls, model: tuple) -> "Editor":
        e = cls.__new__(cls)
        e._take(model[0], model[1])
        e.edit, e.join = Perceptron(), Perceptron()
        e.edit.w, e.join.w = model[2], model[3]
        return e

    def model(self) -> tuple:
        return self.lex, self.share, self.edit.w, self.join.w

    def count(self, w: str) -> tuple[int, int]:
        n = self.lex.get(w)
        if n is None and w[:1].isupper():
            n = self.lex.get(w[0].lower() + w[1:]) or (self.lex.get(w.capitalize()) or self.lex.get(w.lower()) if w.isupper() and len(w) > 1 else None)
        return n or (0, 0)

    def standing(self, own: tuple[int, int]) -> str:
        """absent, usual (as often on clean pages as words are), seldom there, or never there."""
        clean, n = own
        return "absent" if not n else "never" if not clean else "seldom" if clean < 0.1 * self.share * n else "usual"

    @staticmethod
    def candidates(w: str) -> Iterator[tuple[int, str, str]]:
        """(place, seen, true) for every place a listed confusion could have struck."""
        for seen, true in CONFUSIONS:
            at = w.find(seen)
            while at >= 0:
                yield at, seen, true
                at = w.find(seen, at + 1)

    def neighbours(self, w: str) -> Iterator[tuple[int, str, str]]:
        """(place, seen, true) of any one replacement, deletion or insertion that leads to a well attested word."""
        if self._near is None:
            total = sum(n for _, n in self.lex.values())
            self._near = {}
            for x, own in self.lex.items():
                if len(x) >= LEAST_FREE and own[1] >= FREE_SHARE * total and self.standing(own) != "never" and x.isalpha():
                    for k in {x[:i] + x[i + 1 :] for i in range(len(x))} | {x}:
                        self._near.setdefault(k, []).append(x)
        if len(w) < LEAST_FREE or not w.isalpha():
            return
        tried = {w}
        for k in [w, *(w[:i] + w[i + 1 :] for i in range(len(w)))]:
            for x in self._near.get(k, ()):
                if x in tried or abs(len(x) - len(w)) > 1:
                    continue
                tried.add(x)
                i = 0
                while i < min(len(x), len(w)) and x[i] == w[i]:
                    i += 1
                j = 0
                while j < min(len(x), len(w)) - i and x[-1 - j] == w[-1 - j]:
                    j += 1
                if len(w) - i - j <= 1 and len(x) - i - j <= 1:
                    yield i, w[i : len(w) - j], x[i : len(x) - j]

    def _features(self, w: str, own: tuple[int, int], place: tuple[int, str, str], onward: bool = False) -> list[str]:
        at, seen, true = place
        edited = w[:at] + true + w[at + len(seen) :]
        own2 = self.count(edited)
        n, n2 = own[1], own2[1]
        a, b = self.standing(own), self.standing(own2)
        gain = "none" if not n2 else 12 if not n else max(-1, min(12, int(np.floor(np.log2(n2 / n)))))
        digits = edited.isdigit() and not w.isdigit()
        mixed = any(c.isdigit() for c in w) and any(c.isalpha() for c in w)
        ops = [f"{seen[k : k + 1]}>{true[k : k + 1]}" for k in range(max(len(seen), len(true)))]  # replace, delete (x>), insert (>x), a kept character (x>x)
        kinds = "".join("K" if o[0] == o[-1] else "I" if o[0] == ">" else "D" if o[-1] == ">" else "R" for o in ops)
        around = _kind(w[at - 1 : at] if at else "") + _kind(w[at + len(seen) : at + len(seen) + 1])
        return [
            *(f"op:{o}" for o in ops), f"ops:{' '.join(ops)}", f"around:{kinds}:{around}:{_kind(seen[:1])}{_kind(true[:1])}", f"gain:{gain}", f"stand:{a}:{b}", f"gain:{gain}:{a}:{b}", f"mixed:{mixed}:{digits}:{b}",
            f"len:{min(len(w), 7)}:{b}", f"onward:{onward}:{b}", f"digits:{digits}:{len(w) > 1}", f"free:{' '.join(ops) in LISTED}:{a}:{b}:{min(len(w), 7)}",
        ]

    def _best(self, w: str, own: tuple[int, int]) -> tuple[float, str, list[str]]:
        best = (0.0, w, [])
        if len(w) > 2 and w.isalpha() and self.standing(own) == "usual":
            return best  # a word like any other on clean pages is kept
        listed = list(self.candidates(w))
        free = [] if self.standing(own) in ("usual", "seldom") else [x for x in self.neighbours(w) if x not in listed]
        for place in listed + free:
            at, seen, true = place
            edited = w[:at] + true + w[at + len(seen) :]
            onward = False
            if len(w) > 4 and self.count(edited)[1] == 0 and self.standing(own) in ("absent", "never"):
                onward = any(self.count(edited[:i] + t + edited[i + len(s) :])[1] > 0 for i, s, t in self.candidates(edited) if edited[:i] + t + edited[i + len(s) :] != w)
            feats = self._features(w, own, place, onward)
            s = self.edit.score(feats)
            if s > best[0]:
                best = (s, edited, feats)
        return best

    def decide(self, w: str, own: tuple[int, int]) -> str:
        """The word as it stood on the page, given how often its form was seen."""
        got, at = w, own
        for _ in range(3):
            s, edited, _f = self._best(got, at)
            if s <= 0:
                break
            got, at = edited, self.count(edited)
        # Several edits count only where they arrive at an attested word or a number.
        return w if got != w and not (got.isdigit() or self.count(got)[1] > 0) else got

    def decided(self, w: str) -> str:
        """The word as it stood on the page, by the lexicon's counts; kept per word form."""
        got = self._memo.get(w)
        if got is None:
            if len(self._memo) > 400_000:
                self._memo.clear()
            got = self._memo[w] = self.decide(w, self.count(w))
        return got

    def fix(self, w: str) -> str:
        """The decision for a form of the corpus: as given for all forms, else by the lexicon."""
        return self.decided(w) if self.fixes is None else self.fixes.get(w, w)

    @staticmethod
    def _spoil(w: str, rng: random.Random) -> tuple[str, tuple[int, str, str]] | None:
        """A misread form of the word and the edit that mends it: mostly a listed confusion, at times any single character."""
        if len(w) >= LEAST_FREE and w.isalpha() and rng.random() < 0.15:
            at, c, how = rng.randrange(len(w)), rng.choice("abcdefghijklmnopqrstuvwxyz"), rng.randrange(3)
            place = (at, c, w[at]) if how == 0 else (at, "", w[at]) if how == 1 else (at, c, "")
            return w[:at] + place[1] + w[at + len(place[2]) :], place
        ways = [(seen, true) for seen, true in CONFUSIONS if true in w]
        if not ways:
            return None
        seen, true = rng.choice(ways)
        at = rng.choice([i for i in range(len(w)) if w.startswith(true, i)])
        return w[:at] + seen + w[at + len(true) :], (at, seen, true)

    def _words(self) -> list[str]:
        """Words to train on: such as stand on clean pages like any other; without clean pages the most frequent."""
        usual = [w for w, own in self.lex.items() if self.standing(own) == "usual"]
        return sorted(usual) if usual else sorted(sorted(self.lex, key=lambda w: (-self.lex[w][1], w))[: 2 * TRAIN_WORDS])

    def _train(self, rng: random.Random) -> None:
        every = self._words()
        words = [w for w in every if "-" not in w]
        rng.shuffle(words)
        words = words[:TRAIN_WORDS] + [str(rng.randrange(1, 10 ** rng.randrange(2, 5))) for _ in range(160)]
        for _ in range(EPOCHS):
            for w in words:
                own = self.count(w)
                for spoil in (False, True):
                    seen, place = (self._spoil(w, rng) or (None, None)) if spoil else (w, None)
                    if seen is None or spoil and (seen == w or seen.isdigit() or self.standing(self.count(seen)) in ("usual", "seldom")):
                        continue
                    # A misread form is rare beside its word; a rare word may not be attested at all.
                    at = (0, own[1] * rng.choice((0, 0.001, 0.004, 0.02))) if spoil else own if rng.random() < 0.8 else (0, 0)
                    self.edit.tick()
                    s, edited, feats = self._best(seen, at)
                    if s > 0 and edited != w:
                        self.edit.update(feats, -1.0)
                    if spoil and edited != w:
                        self.edit.update(self._features(seen, at, place), 1.0)
        self.edit.average()
        compounds = [w for w in every if "-" in w][:TRAIN_WORDS]
        for _ in range(EPOCHS):
            for w in words:
                if len(w) > 4 and w.isalpha():
                    k = rng.randrange(2, len(w) - 1)
                    self._learn_join(w[:k], "-", w[k:], True)
            for w in compounds:
                cut_at = [i for i, c in enumerate(w) if c == "-"]
                k = rng.choice(cut_at)
                self._learn_join(w[:k], "-", w[k + 1 :], False)
                self._learn_join(str(rng.randrange(1, 99)), "-", w[k + 1 :], False)
        self.join.average()

    def _join_features(self, left: str, mark: str, right: str) -> list[str]:
        whole, kept = self.count(left + right), self.count(f"{left}-{right}")
        tail = left.rsplit("-", 1)[-1]
        near = self.count(self.decided(left + right)) if whole == (0, 0) and kept == (0, 0) else whole
        return [
            f"whole:{whole[1] > 0}:{kept[1] > 0}", f"more:{whole[1] > kept[1]}", f"near:{near[1] > 0}:{kept[1] > 0}", f"parts:{self.count(tail)[1] > 0}:{self.count(right)[1] > 0}:{near[1] > 0}",
            f"digit:{tail[-1:].isdigit() or right[:1].isdigit()}", f"upper:{right[:1].isupper()}:{near[1] > 0}", f"mark:{mark}",
        ]

    def _learn_join(self, left: str, mark: str, right: str, gold: bool) -> None:
        feats = self._join_features(left, mark, right)
        self.join.tick()
        if (self.join.score(feats) > 0) != gold:
            self.join.update(feats, 1.0 if gold else -1.0)

    def joins(self, left: str, mark: str, right: str) -> bool:
        """Whether the mark at the line end breaks a word; soft marks never belong to one."""
        if mark != "-":
            return True
        if right[:1].isupper() and not left.isupper() or right.isdigit() or left.isdigit():
            return False
        key = f"{left}\n{right}"
        got = self._memo.get(key)
        if got is None:
            got = self._memo[key] = "1" if self.join.score(self._join_features(left, mark, right)) > 0 else ""
        return bool(got)

    def joined(self, text: str) -> tuple[str, bool]:
        """The text with broken words joined and lines flowing, and whether a word was broken."""
        if "\n" not in text:
            return text, False
        broken = False
        lines = text.split("\n")
        out = [lines[0].rstrip()]
        for line in lines[1:]:
            line = line.strip()
            before = out[-1]
            if not before or not line or before[-1] not in HYPHENS:
                out += [" ", line] if before and line else [line]
                continue
            left, right = LEFT.search(before.rsplit(None, 1)[-1]), FIRST_WORD.match(line)
            if left and right:
                if self.joins(left[1], left[2], right[1]):
                    broken = True
                    out[-1] = before[:-1]
                out.append(line)
            else:
                out += [" ", line]
        return "".join(out), broken

    def decimals(self, text: str) -> str:
        """Letters behind a decimal mark are digits if the whole number edits to one."""

        def mend(m: re.Match) -> str:
            whole = self.decided(m[1] + m[3])
            return m[1] + m[2] + whole[len(m[1]) :] if whole.isdigit() and len(whole) == len(m[1]) + len(m[3]) else m[0]

        return DECIMAL.sub(mend, text)

    def clean(self, token: str, ok: dict[str, bool]) -> bool:
        """Whether no word within white space needs an edit; ``ok`` keeps the decisions."""
        got = all(self.fix(w) == w for w in WORD.findall(token)) and self.decimals(token) == token
        if len(ok) > 400_000:
            ok.clear()
        ok[token] = got
        return got


# ---------------------------------------------------------------- furniture

# Shapes of printed page numbers; N stands for digits or what is misread for them.
_N = r"(?P<n>[0-9OolISBZq]{1,5}|[ivxlcIVXLC1]{1,7})"
_M = r"[0-9OolISBZq]{1,5}"
STYLES = [
    ("dash", re.compile(rf"^[-–—~]\s*{_N}\s*[-–—~]$")), ("bracket", re.compile(rf"^[\[({{]\s*{_N}\s*[\])}}]$")), ("bar", re.compile(rf"^{_N}\s*[|/]\s*[Pp]ag[e0a]\w*$")),
    ("of", re.compile(rf"^(?:[Pp][aá]g[e0ci]\w*|[Ss]eite|[Pp]\.?|PAGE)\s*[:.]?\s*{_N}\s*(?:of|de|sur|von|/|dc|0f)\s*{_M}$")), ("page", re.compile(rf"^(?:[Pp][aá]g[e0ci]\w*|[Ss]eite|[Pp]g?\.|PAGE)\s*[:.]?\s*{_N}$")),
    ("slash", re.compile(rf"^{_N}\s*(?:of|de|/)\s*{_M}$")), ("bare", re.compile(rf"^{_N}\.?$")),
]
_DIGITS = str.maketrans("OolISBZqsgb", "00115829596")
_ROMAN = {"i": 1, "v": 5, "x": 10, "l": 50, "c": 100}
_SUFFIX = re.compile(rf"[\s|,–-]*(?:(?:[Pp][aá]g[e0ci]\w*|[Ss]eite|[Pp]\.)\s*{_M}|\b{_M})\s*(?:(?:of|de|/)\s*{_M})?\s*$")
_FOLD = [("rn", "m"), ("ri", "n"), ("ii", "u"), ("cl", "d"), ("vv", "w"), ("li", "h")]
_FOLD_CHARS = str.maketrans("a0ce1iIl5sSftqg9bh6vyéèêB8Oo", "ooceiiiisssffgggbbbvveeeBBoo".replace("c", "e"))


def numeral(text: str) -> tuple[str, int | None] | None:
    """(style, value) of an item that is nothing but a page number, misread digits included."""
    t = " ".join(text.split())
    if not t or len(t) > 24:
        return None
    for style, shape in STYLES:
        m = shape.match(t)
        if m:
            n = m["n"]
            digits = n.translate(_DIGITS)
            low = n.lower().replace("1", "i")
            if all(c in _ROMAN for c in low) and not n.isdigit() and not (n.strip("lI1O0o") == "" and n not in ("i", "ii", "iii", "I", "II", "III", "l")):
                total = 0
                vals = [_ROMAN[c] for c in low]
                for a, b in zip(vals, vals[1:] + [0]):
                    total += -a if a < b else a
                return style + "-roman", total
            return (style, int(digits)) if digits.isdigit() else None
    return None


def skeleton(text: str) -> str:
    """A head line without its page number and blind to misread characters."""
    t = " ".join(text.split())
    cutoff = _SUFFIX.sub("", t)
    t = cutoff if len(cutoff) >= 4 else t
    for a, b in _FOLD:
        t = t.replace(a, b)
    return re.sub(r"[\W_]+", "", t.translate(_FOLD_CHARS).lower())


def _step(x: float, *at: float) -> int:
    return sum(x >= a for a in at)


class Layout:
    """Where the items of a filing stand: features of those that may be furniture, and a sure verdict where recurrence or sequence leave no doubt."""

    def __init__(self, texts: list[str | None], pages: list[int | None]):
        self.texts = texts
        self.on: dict[int, list[int]] = defaultdict(list)
        page = None
        for i, t in enumerate(texts):
            page = pages[i] if pages[i] is not None else page
            if t is not None and t.strip():
                self.on[page if page is not None else -1].append(i)
        self.place: dict[int, tuple[int, int]] = {}
        self.where: dict[int, int] = {}
        for p, ix in self.on.items():
            for k, i in enumerate(ix):
                if k <= 2 or len(ix) - 1 - k <= 2:
                    self.place[i] = (k, len(ix) - 1 - k)
                    self.where[i] = p
        self.numbers = {i: n for i in self.place if (n := numeral(texts[i]))}

    def edge(self, i: int, beside) -> str:
        """top or bottom where nothing but one item of ``beside`` stands between the item and the page's edge, else inside."""
        (top, bottom), ix = self.place[i], self.on[self.where[i]]
        return "top" if top == 0 or top == 1 and ix[0] in beside else "bottom" if bottom == 0 or bottom == 1 and ix[-1] in beside else "inside"

    def heads(self) -> dict[int, tuple[list[str], bool | None]]:
        """Features of lines near the page's edge that may be running heads."""
        texts, skel = self.texts, {}
        at: dict[str, set[int]] = defaultdict(set)
        edges = {}
        for i in self.place:
            t = texts[i]
            if i in self.numbers or len(t) > 140 or t.count("\n") > 1:
                continue
            edges[i] = self.edge(i, self.numbers)
            s = skeleton(t)
            if edges[i] != "inside" and len(s) >= 4:
                skel[i] = s
                at[s].add(self.where[i])
        recurring = {s for s, on_pages in at.items() if len(on_pages) >= 2}
        longest = max((len(texts[i]) for i, s in skel.items() if s in recurring), default=0)
        body = Counter(skeleton(t) for i, t in enumerate(texts) if t and len(t) <= longest and i not in skel and t.rstrip()[-1:] not in ".?!") if recurring else Counter()
        self.skel, out, total = skel, {}, len(self.on)
        for i, s in skel.items():
            n, t = len(at[s]), texts[i]
            end = t.rstrip()[-1:] in ".?!"
            numbered = bool(_SUFFIX.search(" ".join(t.split())) and re.search(r"[Pp]ag", t) and not end)
            times, share, inner, few = min(n, 3), _step(n / total, 0.25, 0.5, 0.8), 0 if not body[s] else 1 if 3 * body[s] < n else 2 if body[s] <= n else 3, min(total, 3)
            feats = [
                f"h:times:{times}:{few}", f"h:share:{share}:{times}", f"h:body:{inner}:{times}", f"h:share:{share}:{inner}", f"h:numbered:{numbered}:{few}:{times}", f"h:end:{end}:{times}", f"h:edge:{edges[i]}:{times}",
                f"h:long:{_step(len(t), 15, 40, 80)}:{times}",
            ]
            sure = None
            if times == 3 and share >= 2 and not inner or numbered and n > 1:
                sure = True
            elif n == 1 and not numbered and total > 3 or inner == 3:
                sure = False
            out[i] = (feats, sure)
        return out

    def page_numbers(self, heads) -> dict[int, tuple[list[str], bool | None]]:
        """Features of numerals near the page's edge, beside a head at most; a constant distance to the page's place speaks for a page number."""
        edges = {i: self.edge(i, heads) for i in self.numbers}
        runs: dict[tuple[str, str], Counter] = defaultdict(Counter)
        for i, (style, value) in self.numbers.items():
            if edges[i] != "inside":
                runs[style, edges[i]][value - self.where[i]] += 1
        out = {}
        for i, (style, value) in self.numbers.items():
            if edges[i] == "inside":
                continue
            offset = value - self.where[i]
            run = runs[style, edges[i]]
            own, total, most = run[offset], sum(run.values()), max(run.values())
            shape = "bare" if style.startswith("bare") else "marked"
            few, times, share, leads, near = min(len(self.on), 3), min(own, 3), _step(own / total, 0.2, 0.5, 0.8), own == most, _step(abs(offset), 2, 10)
            feats = [
                f"n:shape:{shape}", f"n:style:{style}", f"n:run:{shape}:{times}:{share}", f"n:leads:{shape}:{leads}:{share}", f"n:most:{shape}:{min(most, 3)}:{leads}:{_step(most / total, 0.5)}", f"n:edge:{shape}:{edges[i]}:{times}",
                f"n:alone:{shape}:{total == 1}:{few}:{near}", f"n:alone:{shape}:{total == 1}:{edges[i]}:{near}", f"n:pages:{shape}:{few}:{times}",
            ]
            sure = None
            if shape == "marked" and own > 1 or shape == "bare" and own > 2 and share >= 2:
                sure = True
            elif shape == "bare" and total > 3 and own == 1 and most > 2:
                sure = False
            out[i] = (feats, sure)
        return out


class Furniture:
    """Averaged perceptrons over page-position features that tell running heads and page numbers from text.

    Trained without labels: in long filings recurrence and sequence settle many items; what is sure
    there is learnt from views of one to three of the same pages, as short filings show no more.
    """

    def __init__(self, filings: list[tuple[list, list]] = (), seed: int = 5):
        self.w = Perceptron()
        rng = random.Random(seed)
        examples = []
        for texts, pages in [*filings, *(self._made(rng) for _ in range(30))]:
            whole = Layout(texts, pages)
            heads = whole.heads()
            sure_heads = {i for i, (_f, sure) in heads.items() if sure}
            numbers = whole.page_numbers(sure_heads)
            sure = {i: s for group in (heads, numbers) for i, (_f, s) in group.items() if s is not None}
            examples += [(f, s) for group in (heads, numbers) for f, s in group.values() if s is not None]
            order = sorted(whole.on)
            for k in (1, 2, 3):
                if len(order) > 2 * k:
                    first = rng.randrange(len(order) - k + 1)
                    at = [(i, p) for p in order[first : first + k] for i in whole.on[p]]
                    view = Layout([texts[i] for i, _ in at], [p for _, p in at])
                    h = view.heads()
                    n = view.page_numbers({j for j in h if sure.get(at[j][0])})
                    # A head that the view shows once only can't be told there, unless a page number ends it.
                    told = {j: s for j in {**h, **n} if (s := sure.get(at[j][0])) is not None and not (s and j in h and f"h:numbered:False:{min(k, 3)}:1" in h[j][0])}
                    examples += [(f, told[j]) for group in (h, n) for j, (f, _s) in group.items() if j in told]
        for _ in range(EPOCHS):
            rng.shuffle(examples)
            for feats, gold in examples:
                self.w.tick()
                if (self.w.score(feats) > 0) != gold:
                    self.w.update(feats, 1.0 if gold else -1.0)
        self.w.average()

    @staticmethod
    def _made(rng: random.Random) -> tuple[list[str], list[int]]:
        """A filing with a head and page numbers of one style, so that a few short filings can be told as well."""
        texts, pages = [], []
        style = rng.choice(("- {} -", "Page {}", "{}", "{} | Page", "[{}]", "Page {} of 40"))
        head, first, on_top = f"{rng.choice(('Annual', 'Northern', 'Interim'))} {rng.choice(('Report', 'Review', 'Statement'))} {rng.randrange(100)}", rng.randrange(1, 9), rng.random() < 0.5
        for p in range(1, rng.randrange(5, 14)):
            made = [f"Line {rng.random()} of the text goes on for some words." if rng.random() < 0.8 else rng.choice(("Summary", "Scope", str(rng.randrange(900)), f"Table {rng.randrange(30)}", "A well.")) for _ in range(rng.randrange(2, 7))]
            number = style.format(p + first)
            made = [head, number, *made] if on_top else [head, *made, number]
            texts += made
            pages += [p] * len(made)
        return texts, pages

    def __call__(self, texts: list[str | None], pages: list[int | None]) -> dict[int, str]:
        """text_ix -> running_header or page_number for one filing."""
        seen = Layout(texts, pages)
        out = {i: "running_header" for i, (feats, _s) in seen.heads().items() if self.w.score(feats) > 0}
        out |= {i: "page_number" for i, (feats, _s) in seen.page_numbers(set(out)).items() if self.w.score(feats) > 0}
        # An item without a page has no place: it is furniture if it looks like what is furniture elsewhere.
        known_heads = {seen.skel[i] for i, kind in out.items() if kind == "running_header"}
        known_styles = {seen.numbers[i][0] for i, kind in out.items() if kind == "page_number" and not seen.numbers[i][0].startswith("bare")}
        for i, t in enumerate(texts):
            if pages[i] is None and t and i not in out and len(t) <= 140:
                n = numeral(t)
                if n and n[0] in known_styles:
                    out[i] = "page_number"
                elif not n and skeleton(t) in known_heads:
                    out[i] = "running_header"
        return out


# ---------------------------------------------------------------- filings


def _odd(editor: Editor, text: str, skip_first: bool, skip_last: bool) -> bool:
    """Whether a word of the text is misread; fragments at its ends are left out."""
    tokens = text.split()
    if skip_first:
        tokens = tokens[1:]
    if skip_last:
        tokens = tokens[:-1]
    ok = editor.__dict__.setdefault("_ok", {})
    for t in tokens:
        got = ok.get(t)
        if not (editor.clean(t, ok) if got is None else got):
            return True
    return False


def repair(texts: list[str | None], pages: list[int | None], editor: Editor, furniture: Furniture, write: bool = True) -> tuple[list[tuple[int, str]], str]:
    """(text_ix, kind) of all items needing repair, and with ``write`` the filing's text in paragraphs.

    Null and blank items are no case. Furniture leaves the text; a word broken over two items
    joins them into one paragraph.
    """
    out = furniture(texts, pages)
    found = list(out.items())
    body = [i for i, t in enumerate(texts) if t is not None and t.strip() and i not in out]
    paragraphs: list[str] = []
    opened = ""  # first part of a word that goes on in the next item
    for k, i in enumerate(body):
        text = texts[i]
        mended, broken = editor.joined(text)
        before, opened = opened, ""
        end = mended.rstrip()
        m = LEFT.search(end.rsplit(None, 1)[-1]) if end[-1:] in HYPHENS and end else None
        if m and k + 1 < len(body):
            right = FIRST_WORD.match(texts[body[k + 1]])
            if right and right[1][:1].islower() and editor.joins(m[1], m[2], right[1]):
                broken, opened = True, m[1]
        if broken:
            found.append((i, "hyphenation"))
        if _odd(editor, mended, bool(before), bool(m)):
            found.append((i, "misread"))
        if not write:
            continue
        start = FIRST_WORD.match(mended) if before else None
        if start:
            mended = mended[start.end() :]
        if opened:
            mended = re.sub(rf"[^\W_]+[{HYPHENS}]\s*$", "", mended) if len(end) > len(m[0]) or not start else ""
        fixed = WORD.sub(lambda w: editor.fix(w[0]), editor.decimals(mended))
        if before and paragraphs:
            paragraphs[-1] += editor.decided(before.rsplit("-", 1)[-1] + (start[1] if start else "")) + fixed
        else:
            paragraphs.append(fixed)
    return found, "\n\n".join(paragraphs)


# ---------------------------------------------------------------- operators


def filings(gz: DataFrame, meta: DataFrame) -> DataFrame:
    """(doc_id, gz_id, texts, pages, clean): items, their pages, and the pages read from a text layer.

    Whole repeated rows count once. A filing without a run in ``meta`` has no clean page. The long
    rows are shuffled once, grouped by the join's keys, and stored for the passes that follow.
    """
    flat = gz.where(F.col("doc_id").isNotNull() & F.col("texts").isNotNull()).select(
        "gz_id", "doc_id", "run_id", F.transform("texts", lambda t: t["text"]).alias("texts"), F.transform("texts", lambda t: F.try_element_at(t["prov"], F.lit(1))["page_no"]).alias("pages")
    )
    rows = flat.groupBy("doc_id", "run_id").agg(F.collect_set(F.struct("gz_id", "texts", "pages")).alias("g"))
    runs = (
        meta.select("doc_id", "run_id", F.transform(F.filter("pages", lambda p: p["staging"] == "as-is"), lambda p: p["page"]).alias("clean"))
        .groupBy("doc_id", "run_id").agg(F.array_distinct(F.flatten(F.collect_list("clean"))).alias("clean"))
    )
    return store(rows.join(runs, ["doc_id", "run_id"], "left").select("doc_id", F.explode("g").alias("g"), "clean").select("doc_id", "g.gz_id", "g.texts", "g.pages", "clean"))


def forms(texts: list[str | None]) -> Iterator[tuple[int, list[str], list[str]]]:
    """(item, tokens, parts and joins of words at line ends): the latter are forms to decide on, but no evidence."""
    hyphen = False
    for i, t in enumerate(texts):
        if t is None:
            continue
        if "\n" not in t and not hyphen and t.rstrip()[-1:] not in HYPHENS:
            yield i, t.split(), []
            continue
        tokens, loose = [], []
        for line in t.split("\n"):
            own = line.split()
            if not own:
                continue
            if hyphen:
                first = own.pop(0)
                loose += [first, *([hyphen[:-1] + first] if hyphen is not True else [])]
            hyphen = False
            last = own[-1] if own else first
            if last[-1] in HYPHENS:
                hyphen = last
                loose.append(last)
                own = own[:-1]
            tokens += own
        yield i, tokens, loose


def word_counts(rows: DataFrame) -> DataFrame:
    """(word, clean, n): how often a word stands on clean pages and anywhere. Parts and joins of broken words come with 0."""
    schema = pa.schema([("word", pa.string()), ("clean", pa.int64()), ("n", pa.int64())])

    def flush(clean_n: Counter, n: Counter) -> pa.RecordBatch:
        words: dict[str, list[int]] = {}
        for token, times in n.items():
            parts = WORD.findall(token)
            for w in parts + (COMPOUND.findall(token) if "-" in token else []):
                at = words.setdefault(w, [0, 0])
                at[0] += clean_n[token]
                at[1] += times
        return pa.RecordBatch.from_pydict({"word": list(words), "clean": [x[0] for x in words.values()], "n": [x[1] for x in words.values()]}, schema=schema)

    def scan(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        clean_n, n = Counter(), Counter()
        for b in batches:
            for texts, pages, clean in zip(*(b.column(c).to_pylist() for c in ("texts", "pages", "clean"))):
                good = set(clean or ())
                page = None
                page_of = [page := p if p is not None else page for p in pages]
                for i, tokens, loose in forms(texts):
                    n.update(tokens)
                    for x in loose:
                        n[x] += 0
                    if page_of[i] in good:
                        clean_n.update(tokens)
            if len(n) > 300_000:
                yield flush(clean_n, n)
                clean_n, n = Counter(), Counter()
        yield flush(clean_n, n)

    return rows.mapInArrow(scan, "word string, clean long, n long").groupBy("word").agg(F.sum("clean").alias("clean"), F.sum("n").alias("n"))


def lexicon(counts: DataFrame, min_share: float = MIN_SHARE) -> dict[str, tuple[int, int]]:
    """Words of a share of all, twice at least: no more than 1 / min_share words whatever the data. They are what edits lead to."""
    total = counts.agg(F.sum("n")).first()[0] or 0
    return {r.word: (r.clean, r.n) for r in counts.where(F.col("n") >= max(2, total * min_share)).collect()}


def _model(sent, kept: dict = {}):  # noqa: B006
    """The worker's editor and furniture for a broadcast, built once."""
    if kept.get("id") != sent.value["id"]:
        editor, furniture = Editor.of(sent.value["editor"]), Furniture()
        editor.fixes, furniture.w.w = sent.value["fixes"], sent.value["furniture"]
        kept.update(id=sent.value["id"], both=(editor, furniture))
    return kept["both"]


def decisions(counts: DataFrame, editor: Editor) -> DataFrame:
    """(word, fixed) for every form of the corpus that is misread, by its own exact counts."""
    sent = counts.sparkSession.sparkContext.broadcast({"id": uuid.uuid4().hex, "editor": editor.model(), "fixes": None, "furniture": {}})

    def scan(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        editor, _ = _model(sent)
        for b in batches:
            got = [(w, f) for w, c, n in zip(*(b.column(x).to_pylist() for x in ("word", "clean", "n"))) if (f := editor.decide(w, (c, n) if n else editor.count(w))) != w]
            yield pa.RecordBatch.from_pydict({"word": pa.array([w for w, _ in got], pa.string()), "fixed": pa.array([f for _, f in got], pa.string())})

    return counts.mapInArrow(scan, "word string, fixed string")


def furniture_model(rows: DataFrame, most: int = SAMPLE_FILINGS) -> Furniture:
    """Furniture trained on a bounded sample: ``most`` filings of 20 to 400 items, by the hash of their id."""
    fit = rows.where(F.size("texts").between(20, 400)).withColumn("_h", F.xxhash64("doc_id", "gz_id"))
    first = [r[0] for r in fit.select("_h").orderBy("_h").limit(most).collect()]  # the hashes alone, so no task sends texts that are not used
    sample = fit.where(F.col("_h") <= first[-1]).select("texts", "pages", "_h").collect() if first else []
    return Furniture([(r.texts, r.pages) for r in sorted(sample, key=lambda r: r["_h"])])


def _per_filing(rows: DataFrame, fixes: DataFrame) -> DataFrame:
    """rows with the decisions their own words need, for more decisions than are broadcast."""

    def scan(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            ids, words = [], []
            for g, texts in zip(b.column("_row").to_pylist(), b.column("texts").to_pylist()):
                own = {w for _i, tokens, loose in forms(texts) for token in tokens + loose for w in WORD.findall(token)}
                ids += [g] * len(own)
                words += own
            yield pa.RecordBatch.from_pydict({"_row": pa.array(ids, pa.string()), "word": pa.array(words, pa.string())})

    keyed = rows.withColumn("_row", F.sha2(F.to_json(F.struct("doc_id", "gz_id", "texts")), 256))
    needed = keyed.select("_row", "texts").mapInArrow(scan, "_row string, word string").join(fixes, "word")
    return keyed.join(needed.groupBy("_row").agg(F.map_from_entries(F.collect_set(F.struct("word", "fixed"))).alias("fixes")), "_row", "left").drop("_row")


def _apply(rows: DataFrame, what: str, most: int) -> DataFrame:
    counts = cut(word_counts(rows))
    editor = Editor(lexicon(counts))
    fixes = cut(decisions(spread(counts, "word"), editor))
    small = fixes.count() <= most
    if not small:
        rows = _per_filing(rows, fixes)
    sent = rows.sparkSession.sparkContext.broadcast({"id": uuid.uuid4().hex, "editor": editor.model(), "fixes": {r.word: r.fixed for r in fixes.collect()} if small else {}, "furniture": furniture_model(rows).w.w})

    def scan(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        editor, furniture = _model(sent)
        for b in batches:
            ids, ix, kinds, whole = [], [], [], []
            own = [None] * b.num_rows if small else b.column("fixes").to_pylist()
            for d, texts, pages, fix in zip(*(b.column(c).to_pylist() for c in ("doc_id", "texts", "pages")), own):
                if not small:
                    editor.fixes = dict(fix or ())
                    editor.__dict__.pop("_ok", None)
                found, text = repair(texts, pages, editor, furniture, what == "text")
                if what == "text":
                    ids.append(d)
                    whole.append(text)
                for i, kind in found if what == "found" else ():
                    ids.append(d)
                    ix.append(i)
                    kinds.append(kind)
            if what == "text":
                yield pa.RecordBatch.from_pydict({"doc_id": pa.array(ids, pa.string()), "text": pa.array(whole, pa.string())})
            else:
                yield pa.RecordBatch.from_pydict({"doc_id": pa.array(ids, pa.string()), "text_ix": pa.array(ix, pa.int32()), "kind": pa.array(kinds, pa.string())})

    used = rows.select("doc_id", "texts", "pages", *([] if small else ["fixes"]))
    return used.mapInArrow(scan, "doc_id string, text string" if what == "text" else "doc_id string, text_ix int, kind string")


def found(gz: DataFrame, meta: DataFrame, most_fixes: int = MAX_FIXES) -> DataFrame:
    """(doc_id, text_ix, kind) of items needing repair. Empty tables give no row."""
    return _apply(filings(gz, meta), "found", most_fixes)


def repaired(gz: DataFrame, meta: DataFrame, most_fixes: int = MAX_FIXES) -> DataFrame:
    """(doc_id, text): every filing as continuous paragraphs, an empty text where nothing is left."""
    return _apply(filings(gz, meta), "text", most_fixes)
