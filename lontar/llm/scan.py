"""Noise in text from scanned pages.

Method. Words are counted over all texts; those frequent enough are known. On a bounded
sample the unknown words that differ from a much more frequent known one in a window of two
characters are aligned with it, and an averaged perceptron learns from them which character
to keep, replace, delete or insert; the windows seen often are the confusions it is asked
about. The same kind of perceptron learns from lines that recur in a document which lines
are page furniture, by their place in the text, the lines around them and their form. Then
every text is read once: furniture that interrupts it is taken out, words broken at a line
end are joined unless the hyphen is their own, and words the editor changes to a known word
are misread.
"""

from __future__ import annotations

import re
import zlib
from collections import Counter, defaultdict
from collections.abc import Callable, Iterable, Iterator
from functools import partial

import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from lontar.operators.nested import _nodes, parse, text

KNOWN = 4e-5  # part of all words that makes a word known
SEEN = 5e-6  # the same where no confusion leads to a much more frequent word; at most 1 / SEEN words are held
TIMES = 20  # "much more frequent"
# Bounds of what the perceptrons are fitted on; rows beyond them are left out by a hash, so what is
# kept is spread over all words and texts.
SAMPLE = 20_000  # texts
ALIGNED = 6_000  # misread words beside their known ones
CLEAN = 3_000  # known words that stay as they are
HYPHENED = 500  # known words with a hyphen
JOINS = 20_000  # line ends
FURNITURE = 5_000  # lines that recur in their document
BODY = 15_000  # lines that do not
EPOCHS = 3
FLUSH = 200_000  # distinct words a task holds before it gives their counts out
MARKS = "-\xad¬‐‑‒–"  # fixed value: marks that break a word at a line end

_EDGE = ".,;:()[]\"'!?"
_ROMAN = r"(?=[ivxlc])(?:xc|xl|l?x{0,3})(?:ix|iv|v?i{0,3})"
PAGE = re.compile(rf"^(?:(?:hal(?:aman)?|page|p|hlm)\b\.?\s*)?[-–—~\[(]*\s*(?:\d{{1,4}}|{_ROMAN})(?:\s*(?:/|dari|of)\s*\d{{1,4}})?\s*[-–—~\])]*$", re.I)
_TAIL_PAGE = re.compile(rf"^(.*\S)\s{{2,}}(?:(?:hal(?:aman)?|page)\b\.?\s*)?[-–—~\[(]*\s*(?:\d{{1,4}}|{_ROMAN})\s*[-–—~\])]*$", re.I)
_INSIDE = "_@|'-"
_FIRST = re.compile(r"[ \t]*([\w@|'-]*[^\W_])")
_LETTER = re.compile(r"[^\W\d_]")
_INNER = re.compile(r"(?<=[^\W\d_])[\d@|$!](?=[^\W\d_])|^[\d@|$](?=[^\W\d_]{3})|(?<=[^\W\d_]{4})[\d@|$]$")


class Perceptron:
    """An averaged perceptron over named features, for a few classes; it also learns from what
    it gets right by less than a margin of one."""

    def __init__(self):
        self.w: dict[tuple[str, str], float] = defaultdict(float)
        self.total: dict[tuple[str, str], float] = defaultdict(float)
        self.t = 0

    def score(self, features: list[str], label: str) -> float:
        return sum(self.w.get((f, label), 0.0) for f in features)

    def learn(self, features: list[str], label: str, labels: list[str]) -> None:
        self.t += 1
        guess, best = "", float("-inf")
        for y in labels:
            if y != label and (x := self.score(features, y)) > best:
                guess, best = y, x
        if best > self.score(features, label) - 1.0:
            for f in features:
                for y, step in ((label, 1.0), (guess, -1.0)):
                    self.w[f, y] += step
                    self.total[f, y] += step * self.t

    def averaged(self) -> dict[tuple[str, str], float]:
        return {k: v - self.total[k] / max(1, self.t) for k, v in self.w.items()}


def _some(rows: Iterable, most: int, key: Callable = repr) -> list:
    """At most ``most`` of the rows, those of the least hash, in the order they come in."""
    rows = list(rows)
    least = sorted(range(len(rows)), key=lambda i: (zlib.crc32(key(rows[i]).encode()), i))[:most] if len(rows) > most else range(len(rows))
    return [rows[i] for i in sorted(least)]


def _features(word: str, i: int) -> list[str]:
    """What the editor sees at a character: it, its neighbours, and their kinds."""
    a, b = word[i - 1] if i else "^", word[i]
    c, d = (word[j] if j < len(word) else "$" for j in (i + 1, i + 2))
    kind = "a" if b.isalpha() else "9" if b.isdigit() else "@"
    around = ("a" if a.isalpha() else ".") + ("a" if c.isalpha() else ".")
    return [f"0{b}", f"1{a}{b}", f"2{b}{c}", f"3{a}{b}{c}", f"4{b}{c}{d}", f"5{kind}{around}"]


def _edited(at: int, wrong: str, right: str) -> list[tuple[int, str]]:
    """An operation for each character of ``wrong`` at a place, that make ``right`` of it."""
    ops = []
    for k in range(len(wrong)):
        if k < len(right):
            op = "keep" if wrong[k] == right[k] else f"replace {right[k]}"
            if k == len(wrong) - 1 and len(right) > len(wrong):
                op = f"replace {right[k]} insert {right[k + 1 :]}"
            ops.append((at + k, op))
        else:
            ops.append((at + k, "delete"))
    return ops


def _operations(word: str, at: int, wrong: str, right: str) -> list[tuple[int, str]]:
    """The same with the characters around, which are kept."""
    return [(i, "keep") for i in range(len(word)) if not at <= i < at + len(wrong)] + _edited(at, wrong, right)


class Model:
    """What a worker needs to read a text."""

    def __init__(self, known: set[str], confusions: dict[str, list[str]], editor: dict, furniture: dict):
        self.known, self.confusions, self.editor, self.furniture = known, confusions, editor, furniture
        self.join: dict[tuple[str, str], float] = {}
        widths = sorted({len(x) for x in confusions}, reverse=True)
        self.places = [re.compile("(?=(" + "|".join(re.escape(x) for x in sorted(confusions) if len(x) == n) + "))") for n in widths]
        self.longest = max(map(len, known), default=0)
        self.shrinks = max((len(a) - len(b) for a, bs in confusions.items() for b in bs), default=0)
        self.cache: dict[str, str | None] = {}
        # of each kind of feature of a line, how much it can speak for furniture at most
        self.line_weight = {f: furniture.get((f, "yes"), 0.0) - furniture.get((f, "no"), 0.0) for f, _ in furniture}
        self.most: dict[str, float] = defaultdict(float)
        for f, w in self.line_weight.items():
            self.most[f.split(" ")[0]] = max(self.most[f.split(" ")[0]], w)
        self.rest = sum(w for kind, w in self.most.items() if kind in ("place", "broken", "before", "after", "short", "apart"))

    def __getstate__(self) -> dict:
        return self.__dict__ | {"cache": {}}

    def mended(self, token: str) -> str | None:
        """The word a token is a misreading of; None if it is none."""
        if token not in self.cache:
            if len(self.cache) > 300_000:
                self.cache.clear()
            self.cache[token] = self._mended(token)
        return self.cache[token]

    def _mended(self, token: str) -> str | None:
        word = token.strip(_EDGE)
        if len(word) < 3 or word in self.known or not _LETTER.search(word):
            return None
        if "-" in word.strip("-"):
            parts = word.split("-")
            if all(p in self.known or p.isdigit() for p in parts):
                return None
            new = [self._word(p) or p for p in parts]
            joined = "-".join(new)
            return joined if new != parts and (joined in self.known or all(p in self.known for p in new)) else None
        return self._word(word)

    def _word(self, word: str) -> str | None:
        if word in self.known or len(word) < 3:
            return None
        best = None
        near = len(word) <= self.longest + 2 * self.shrinks  # two edits make no known word of a longer one
        for new, at, wrong, right in self._edits(word) if near else ():
            if new in self.known:
                margin = self._margin(word, at, wrong, right)
                if best is None or margin > best[0]:
                    best = (margin, new)
        if best is None and len(word) > 5 and near:
            for once, at, wrong, right in self._edits(word):
                if self._margin(word, at, wrong, right) > 0:
                    for new, at2, wrong2, right2 in self._edits(once):
                        if new in self.known and (margin := self._margin(once, at2, wrong2, right2)) > 0 and (best is None or margin > best[0]):
                            best = (margin, new)
        if best is not None and (best[0] > 0 or _INNER.search(word)):
            return best[1]
        odd = sum(not c.isalpha() for c in word)
        if _INNER.search(word) and odd * 4 <= len(word):  # no known word, but no letter either
            out = list(word)
            for m in _INNER.finditer(word):
                rights = [r for r in self.confusions.get(m[0], []) if len(r) == 1]
                if not rights:
                    return None
                out[m.start()] = max(rights, key=lambda r: self._margin(word, m.start(), m[0], r))
            return "".join(out)
        return None

    def _edits(self, word: str) -> Iterator[tuple[str, int, str, str]]:
        for places in self.places:
            for m in places.finditer(word):
                i, wrong = m.start(), m[1]
                for right in self.confusions[wrong]:
                    yield word[:i] + right + word[i + len(wrong) :], i, wrong, right

    def _margin(self, word: str, at: int, wrong: str, right: str) -> float:
        """By how much the editor prefers the operations of an edit to keeping the characters."""
        out = 0.0
        for i, op in _edited(at, wrong, right):
            if op != "keep":
                fs = _features(word, i)
                out += sum(self.editor.get((f, op), 0.0) - self.editor.get((f, "keep"), 0.0) for f in fs)
        return out

    def is_header(self, lines: list[str], i: int) -> bool:
        weight = self.line_weight
        # most lines are settled by their case and known words, whatever the other features say
        line = lines[i].strip()
        words = line.split()
        lower = [w for w in words if w[0].islower()]
        caps = not lower and all(w[0].isupper() for w in words if w[0].isalpha())
        low = sum(w in self.known and w.islower() for w in lower[:4]) > 1
        got = (f"caps {caps}", f"low {low}", f"upper {line.isupper()}", f"ends {line[-1:] in '.;:,'}", f"first {words[0] if words else ''}", "bias")
        if sum([weight.get(f, 0.0) for f in got]) + self.rest <= 0:
            return False
        return sum(weight.get(f, 0.0) for f in line_features(lines, i, self.known)) > 0

    def mend_all(self, words: list[str]) -> list[str]:
        """Words with those that are misread replaced; the same list if none is."""
        cache, out = self.cache, words
        for i, w in enumerate(words):
            m = cache.get(w, "")
            if m == "":
                m = self.mended(w)
            if m is not None:
                out = list(words) if out is words else out
                out[i] = w.replace(w.strip(_EDGE), m)
        return out


def line_features(lines: list[str], i: int, known: set[str]) -> list[str]:
    """Place and form of a line: where it stands, how the lines around it end and begin, its case."""
    line = lines[i].strip()
    before = next((x.strip() for x in reversed(lines[:i]) if x.strip() and not PAGE.match(x.strip())), "")
    after = next((x.strip() for x in lines[i + 1 :] if x.strip() and not PAGE.match(x.strip())), "")
    words = line.split()
    letters = [w for w in words if w[:1].isalpha()]
    caps = sum(w[0].isupper() for w in letters)
    longest = max(map(len, lines))
    return [
        "bias",
        "place " + ("first" if not before else "last" if not after else "mid"),
        f"caps {caps == len(letters)}",
        f"upper {line.isupper()}",
        f"low {sum(w in known and w.islower() for w in [x for x in letters if x[0].islower()][:4]) > 1}",
        f"ends {line[-1:] in '.;:,'}",
        f"broken {bool(_broken(lines[i]))}",
        f"before {before[-1:] in '.;:' if before else 'none'}",
        f"after {after[0].islower() if after else 'none'}",
        f"short {len(line) * 3 < longest * 2}",
        f"first {words[0] if words else ''}",
        f"apart {(i > 0 and not lines[i - 1].strip()) or (i + 1 < len(lines) and not lines[i + 1].strip())}",
    ]


def _broken(line: str) -> tuple[str, str] | None:
    """The word broken at the end of a line, and its mark: the letters, digits and marks of words
    before it, from the first letter or digit on."""
    if line[-1:] not in MARKS or not line:
        return None
    at = end = len(line) - 1
    while at and (line[at - 1].isalnum() or line[at - 1] in _INSIDE):
        at -= 1
    while at < end and line[at] in _INSIDE:
        at += 1
    return (line[at:end], line[-1]) if at < end else None


def _plain(line: str) -> str:
    """A line without the page number behind it, digits masked: what recurs from page to page."""
    m = _TAIL_PAGE.match(line.strip())
    return re.sub(r"\d+", "9", (m[1] if m else line.strip()).lower())


def read(raw: str, model: Model) -> tuple[set[str], str]:
    """Kinds of noise in a text, and the text repaired: its paragraphs, parted by a blank line, each
    on one line. Furniture that interrupts is taken out; what stands at the beginning or the end
    interrupts nothing and stays as it is."""
    kinds: set[str] = set()
    if "\n" not in raw:
        words = raw.split(" ")
        out = model.mend_all(words)
        if out is not words:
            kinds.add("misread")
        return kinds, " ".join(out)
    lines = raw.replace("\r\n", "\n").replace("\r", "\n").split("\n")
    body: list[tuple[str, bool]] = []  # (line, whether a blank line and nothing else parts it from the one before)
    marks = []
    blank = furniture = False
    for i, line in enumerate(lines):
        s = line.strip()
        if not s:
            blank = True
            continue
        if PAGE.match(s):
            names = ("page_number",)
        elif "  " in s and (m := _TAIL_PAGE.match(s)) and model.is_header([*lines[:i], m[1], *lines[i + 1 :]], i):
            names = ("running_header", "page_number")
        elif len(lines) > 1 and model.is_header(lines, i):
            names = ("running_header",)
        else:
            body.append((line, blank and not furniture))
            blank = furniture = False
            continue
        marks.append((len(body), names, s))
        furniture = True
    for at, names, _ in marks:  # only what interrupts the text
        if 0 < at < len(body):
            kinds.update(names)
    lead, trail = ([s for at, _, s in marks if at == end] for end in (0, len(body)))
    if not body:
        return kinds, "\n".join(lead)
    paragraphs = [[body[0][0].strip()]]
    for line, apart in body[1:]:
        parts = paragraphs[-1]
        line, last = line.strip(), parts[-1]
        m = _broken(last) if last[-1:] in MARKS else None
        n = _FIRST.match(line) if m else None
        if not n:
            if apart:
                paragraphs.append([line])
            else:
                parts.append(" " + line)
        elif n[1][0].isdigit() or _own_hyphen(m[0], n[1], m[1], model):
            parts.append(line)
        else:
            kinds.add("split_word")
            parts[-1] = last[:-1]
            parts.append(line)
    out = []
    for parts in paragraphs:
        words = "".join(parts).split()
        new = model.mend_all(words)
        if new is not words:
            kinds.add("misread")
        out.append(" ".join(new))
    return kinds, "\n\n".join(["\n".join(x) for x in (lead,) if x] + out + ["\n".join(x) for x in (trail,) if x])


def join_features(a: str, b: str, mark: str, known: set[str], mended) -> list[str]:
    """What the editor sees at a line end: the mark, and whether the word is known when joined,
    when it keeps its hyphen, and in its parts."""
    whole, hyphen = a + b, f"{a}-{b}"
    has = lambda w: w in known or w.lower() in known
    return [
        "bias",
        f"mark {'-' if mark == '-' else 'other'}",
        f"whole {has(whole) or bool(mended(whole))}",
        f"hyphen {has(hyphen) or bool(mended(hyphen))}",
        f"a {has(a)}",
        f"b {has(b)}",
        f"twice {a.lower() == b.lower()}",
    ]


def _own_hyphen(a: str, b: str, mark: str, model: Model) -> bool:
    """Whether the hyphen between two parts of a word belongs to it, as the editor predicts."""
    if mark != "-":
        return False
    weight = model.join
    return sum(weight.get((f, "keep"), 0.0) - weight.get((f, "join"), 0.0) for f in join_features(a, b, mark, model.known, model.mended)) > 0


# ---- fitting ------------------------------------------------------------------------


def _count(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
    """Counts of the words of a partition; parts of words broken at a line end are left out."""
    counts: Counter = Counter()
    n_texts = 0

    def out() -> pd.DataFrame:
        plain: Counter = Counter()
        for w, n in counts.items():
            w = w.strip(_EDGE)
            if len(w) > 2 and _LETTER.search(w):
                plain[w] += n
        counts.clear()
        return pd.DataFrame({"word": pd.Series(list(plain), dtype=object), "n": pd.Series(list(plain.values()), dtype="int64")})

    for d in batches:
        n_texts += len(d)
        for raw in d["text"]:
            if "\n" in raw:
                skip = False
                for line in raw.split("\n"):
                    words = line.split()
                    if skip and words:
                        words = words[1:]
                    skip = bool(words) and words[-1][-1] in MARKS
                    counts.update(words[:-1] if skip else words)
            else:
                counts.update(raw.split())
            if len(counts) > FLUSH:
                yield out()
    yield out()
    yield pd.DataFrame({"word": [""], "n": [n_texts]})  # the number of texts, under no word


def _windows(word: str) -> Iterator[tuple[tuple[str, str], str]]:
    for n in (1, 2):
        for i in range(len(word) - n + 1):
            yield (word[:i], word[i + n :]), word[i : i + n]


def fit(counts: dict[str, int], total: float, sample: list[tuple[str, str]]) -> Model:
    """A model from the words seen often enough, the number of all words, and (document, text)
    of a sample."""
    known = {w for w, n in counts.items() if n >= max(3, KNOWN * total)}
    alpha = {w for w in known if w.isalpha() and len(w) > 3}
    index: dict[tuple[str, str], set[tuple[str, str]]] = defaultdict(set)
    for w in alpha:
        for key, mid in _windows(w):
            index[key].add((w, mid))
    longest = max(map(len, alpha), default=0) + 2  # nothing longer differs from a known word in one window
    here = Counter(w.strip(_EDGE) for _, t in sample for w in t.split())
    pairs: dict[tuple[str, str], set[str]] = defaultdict(set)
    aligned: list[tuple[str, int, str, str]] = []
    for w, n in here.items():
        if not 4 <= len(w) <= longest or "-" in w or not _LETTER.search(w):
            continue
        n = max(n, counts.get(w, 0))
        found = {(k, len(key[0]), mid, right) for key, mid in _windows(w) for k, right in index.get(key, ()) if mid != right and not (mid[0] == right[0] or mid[-1] == right[-1]) and len(mid) + len(right) <= 4 and counts[k] >= TIMES * n}
        words = {k for k, *_ in found}
        if len(words) == 1:
            for _, at, mid, right in found:
                pairs[mid, right].add(w)
                aligned.append((w, at, mid, right))
    least = max(2, len(aligned) // 400)
    confusions: dict[str, list[str]] = defaultdict(list)
    for (mid, right), ws in pairs.items():
        if len(ws) >= least and not (len(mid) == len(right) == 2):
            confusions[mid].append(right)
    editor = Perceptron()
    aligned = _some((x for x in sorted(aligned) if x[3] in confusions.get(x[2], ())), ALIGNED)
    clean = _some(sorted(alpha), CLEAN)
    labels = sorted({op for w, at, a, b in aligned for _, op in _operations(w, at, a, b)} | {"keep"})
    for _ in range(EPOCHS):
        for w, at, a, b in aligned:
            for i, op in _operations(w, at, a, b):
                if at - 1 <= i <= at + len(a):
                    editor.learn(_features(w, i), op, labels)
        for w in clean:
            for i in range(len(w)):
                if any(w[i : i + k] in confusions for k in (1, 2)):
                    editor.learn(_features(w, i), "keep", labels)
    furniture = _fit_furniture(sample, known)
    model = Model(known, dict(confusions), editor.averaged(), furniture)
    # the less frequent words too, and none that a confusion makes of a much more frequent one
    often = sorted(w for w, n in counts.items() if n >= max(3, SEEN * total))
    model.longest = max(map(len, often), default=0)
    for w in often:
        known.discard(w)
        better = model._mended(w)
        if not (better and counts.get(better, 0) >= TIMES * counts[w]) and not _INNER.search(w):
            known.add(w)
    model.cache.clear()
    model.join = _fit_joins(sample, model)
    return model


def _fit_joins(sample: list[tuple[str, str]], model: Model) -> dict:
    """Known words broken on purpose, at their hyphen or in the middle, and the words broken at
    line ends of the sample that are known either joined or with the hyphen, not both ways. A
    word repeated with itself keeps its hyphen."""
    p = Perceptron()
    rows = [(["bias", "mark -", "whole False", "hyphen False", "a True", "b True", "twice True"], "keep"), (["bias", "mark -", "whole False", "hyphen False", "a False", "b False", "twice False"], "join")]
    hyphened = _some((w for w in sorted(model.known) if re.fullmatch(r"[^\W\d_]+-[^\W\d_]+", w)), HYPHENED)
    plain = _some((w for w in sorted(model.known) if w.isalpha() and len(w) > 5), max(20, len(hyphened)))
    for w in hyphened:
        rows.append((join_features(*w.split("-"), "-", model.known, model.mended), "keep"))
    for w in plain:
        rows.append((join_features(w[: len(w) // 2], w[len(w) // 2 :], "-", model.known, model.mended), "join"))
    seen = []
    for _, t in sample:
        lines = [x.strip() for x in t.split("\n")] if "\n" in t else []
        for one, two in zip(lines, lines[1:], strict=False):
            m = _broken(one) if one[-1:] == "-" else None
            n = _FIRST.match(two) if m else None
            if n and not n[1][0].isdigit():
                fs = join_features(m[0], n[1], "-", model.known, model.mended)
                if ("whole True" in fs) != ("hyphen True" in fs):
                    seen.append((f"{m[0]}-{n[1]}", (fs, "join" if "whole True" in fs else "keep")))
    rows += [r for _, r in _some(seen, JOINS, lambda r: r[0])]
    for _ in range(EPOCHS):
        for fs, label in rows:
            p.learn(fs, label, ["join", "keep"])
    return p.averaged()


def _fit_furniture(sample: list[tuple[str, str]], known: set[str]) -> dict:
    """Lines that recur in a document and hardly in others, digits aside, against the rest."""
    recur: dict[tuple[str, str], int] = Counter()
    many = [(doc, t.replace("\r\n", "\n").split("\n")) for doc, t in sample if "\n" in t]
    for doc, lines in many:
        recur.update({(doc, _plain(x)) for x in lines if len(x.strip()) > 5})
    everywhere: Counter = Counter()
    for (_, line), n in recur.items():
        everywhere[line] += n
    p = Perceptron()
    rows = []
    for doc, lines in many:
        for i, line in enumerate(lines):
            s = line.strip()
            if len(s) > 5 and not PAGE.match(s):
                n, m = recur[doc, _plain(line)], _TAIL_PAGE.match(s)
                own = n >= 3 and 2 * n > everywhere[_plain(line)]
                if own or n != 2:
                    rows.append((line_features([*lines[:i], m[1] if m else line, *lines[i + 1 :]], i, known), "yes" if own else "no", f"{doc} {i} {s}"))
    yes = _some((r for r in rows if r[1] == "yes"), FURNITURE, lambda r: r[2])
    first = {f for fs, *_ in yes for f in fs if f.startswith("first ")}
    # a line seen once that begins like a recurring one tells nothing: it may be the only page of its document
    no = _some((r for r in rows if r[1] == "no" and not first & set(r[0])), BODY, lambda r: r[2])
    step = max(1, len(no) // max(1, len(yes)))
    mixed = [r for k, y in enumerate(yes) for r in (y, *no[k * step : (k + 1) * step])] or no
    for _ in range(EPOCHS):
        for fs, label, _ in mixed:
            p.learn(fs, label, ["no", "yes"])
    return p.averaged()


# ---- texts and operators ---------------------------------------------------------------


def _raw_texts(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
    for d in batches:
        rows = []
        for rid, raw in zip(d["record"], d["raw"], strict=True):
            record = parse(raw)
            if isinstance(record, dict):
                for node, _ in _nodes(record.get("structure"), ""):
                    if node["node_id"] is not None and isinstance(node.get("text_raw"), str) and node["text_raw"]:
                        rows.append(("raw_extractions", f"{rid}/{text(node['node_id'])}", str(rid), text(node["text_raw"])))
        yield pd.DataFrame(rows, columns=["item_table", "item_key", "doc", "text"])


def record_texts(df: DataFrame, record: str, raw: str) -> DataFrame:
    """text_raw of the nodes inside JSON records, in the form that :func:`noise` reads."""
    rows = df.select(F.col(record).cast("string").alias("record"), F.col(raw).alias("raw")).filter(F.col("raw").isNotNull())
    return rows.mapInPandas(_raw_texts, "item_table string, item_key string, doc string, text string")


def fitted(texts: DataFrame) -> Model:
    """A model for ``texts`` (item_table, item_key, doc, text): counts over all of them, fitted on
    a sample of SAMPLE texts in whole stretches of documents."""
    rows = texts.filter(F.length("text") > 0)
    counted = rows.select("text").mapInPandas(_count, "word string, n long").groupBy("word").agg(F.sum("n").alias("n"))
    counted = counted.persist()
    total = counted.filter("word <> ''").agg(F.sum("n")).first()[0] or 0
    often = {r.word: r.n for r in counted.filter((F.col("n") >= max(3, SEEN * total)) | (F.col("word") == "")).collect()}  # at most 1 / SEEN words
    counted.unpersist()
    n_texts = often.pop("", 0)
    # whole stretches of documents, those of the least hash; a quarter more than needed is looked at
    block = F.pmod(F.xxhash64("doc", F.pmod(F.xxhash64("item_key"), F.lit(8))), F.lit(1 << 20))
    share = int((1 << 20) * min(1.0, 1.25 * SAMPLE / max(1, n_texts))) + 1
    some = rows.withColumns({"block": block, "order": F.xxhash64("item_key", "text")}).filter(F.col("block") < share)
    some = some.orderBy("block", "order", "item_key").limit(SAMPLE).select("doc", "text").collect()
    return fit(often, total, [(r.doc, r.text) for r in some])


def _noise(batches: Iterator[pd.DataFrame], model: Model) -> Iterator[pd.DataFrame]:
    for d in batches:
        rows = [(a, k, kind) for a, k, t in zip(d["item_table"], d["item_key"], d["text"], strict=True) for kind in read(t, model)[0]]
        yield pd.DataFrame(rows, columns=["item_table", "item_key", "noise"])


def _repair(batches: Iterator[pd.DataFrame], model: Model) -> Iterator[pd.DataFrame]:
    for d in batches:
        yield pd.DataFrame({"item_table": d["item_table"], "item_key": d["item_key"], "text": [read(t, model)[1] for t in d["text"]]})


def noise(texts: DataFrame, model: Model | None = None) -> DataFrame:
    """item_table, item_key, noise: one row for each kind of noise in a text.

    ``texts`` has item_table, item_key, doc (lines recurring in one doc are furniture), text.
    Null and empty texts have no noise; texts of any length are read as a whole; repeated rows
    count once; null keys are kept; an empty table gives an empty result; further columns are
    not read.
    """
    model = model or fitted(texts)
    rows = texts.select("item_table", "item_key", "text").filter(F.length("text") > 0)
    return rows.mapInPandas(partial(_noise, model=model), "item_table string, item_key string, noise string").distinct()


def repaired(texts: DataFrame, model: Model | None = None) -> DataFrame:
    """item_table, item_key, text: the texts as continuous paragraphs (see :func:`read`); null and
    empty ones left out."""
    model = model or fitted(texts)
    rows = texts.select("item_table", "item_key", "text").filter(F.length("text") > 0)
    return rows.mapInPandas(partial(_repair, model=model), "item_table string, item_key string, text string").distinct()
