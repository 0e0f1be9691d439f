"""Template residue and error-page text.

Method. One Aho-Corasick automaton holds the error, filler and script phrases of all
languages and the marks that open or make up an unfilled slot. A text is read once.
Phrases count by coverage: a text goes out when the covered part of its letters is large,
taken over the whole text or over a whole sentence of it, so a real sentence that mentions
an error page stays. A phrase that can only begin a notice covers the sentence it begins.
Marks of slots are looked at more closely at the places where the automaton found them:
what a pair of brackets holds, and what follows a run of dots, decide.
"""

from __future__ import annotations

import re
from collections.abc import Iterator
from functools import cache

import pandas as pd
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

# Phrases, in lower case.
ERRORS = """
page not found|halaman tidak ditemukan|access denied|akses ditolak|internal server error|terjadi kesalahan pada server
bad gateway|service unavailable|layanan sedang tidak tersedia|layanan tidak tersedia|sesi anda telah berakhir|your session has expired
too many requests|terlalu banyak permintaan|waktu permintaan habis|request timed out|the document could not be loaded|dokumen tidak dapat dimuat
gateway timeout|forbidden|something went wrong|error: value not found|#ref!|#n/a|#value!|#name?
"""
AROUND_ERRORS = "http|error|oops|silakan coba lagi nanti|please try again later|kode rujukan|reference code|hubungi administrator|contact the administrator|request id|galat"
NOTICES = """
please enable javascript|aktifkan javascript|javascript diperlukan untuk|javascript is required|javascript is disabled
you need to turn on scripting in your browser|this viewer requires scripts|peramban anda tidak mengizinkan skrip|skrip dinonaktifkan|nyalakan skrip untuk|memuat...
placeholder text|dummy paragraph|dummy text|sample text|filler text|paragraf pengisi|teks pengisi|tuliskan di sini|ganti paragraf ini|ganti teks ini
lorem ipsum|replace this paragraph|write here
"""
MASH = "qwerty|qwer|asdfgh|asdf|zxcv|jkl|isi contoh|contoh teks|teks contoh|teks isi"
# Marks of slots, and the words that name what a slot waits for.
MARKS = "{{|${|<|«|%|[|(|__|....|……|. . .|xxxx|tbd|tba"
SLOT_WORDS = """
nama nomor tanggal jabatan alamat nilai kontrak kantor perusahaan penyedia pekerjaan bank pejabat wakil sah ppk gelar isi di sini diisi
lokasi sumber dana tahun bulan pihak tempat telepon jumlah uraian lengkap terang jelas tanda tangan name date start end vendor number
contract address value amount title person company office signature insert here your to be filled later kemudian menyusul
""".split()
LEADING = {"lihat", "see", "sebagaimana", "sesuai", "vide", "sic", "rp", "idr"}
FLAGS = ["template_placeholder", "placeholder_unfilled", "filler_text", "error_page", "script_required"]
COVERED = 0.6  # least covered part of a text's letters
COVERED_SENTENCE = 0.8  # the same of one sentence

_BRACKETS = {"{{": re.compile(r"\{\{[^{}]+\}\}"), "${": re.compile(r"\$\{[^{}]+\}"), "«": re.compile(r"«[^«».;!?]+»"), "%": re.compile(r"%[a-z][a-z0-9_]+%"), "<": re.compile(r"<{1,2}\s*([a-z][a-z0-9_ \n-]*)>{1,2}"), "[": re.compile(r"\[([^\[\]]*)\]"), "(": re.compile(r"\(([^()]*)\)")}
_CUT = {"{{": re.compile(r"\{\{[^{}]*$"), "${": re.compile(r"\$\{[^{}]*$"), "«": re.compile(r"«[^«»]*$"), "<": re.compile(r"<{1,2}[a-z][a-z0-9_ ]*$"), "(": re.compile(r"\((?:belum )?diisi\b[^()]*$"), "[": re.compile(r"\[([a-z][a-z ]*)$"), "%": re.compile(r"%[a-z]+(?:_[a-z]*)?$")}
_LEADER = re.compile(r"[ .…]*\s*(?:\d{1,4}|[ivxlc]{1,7})[ \t\r]*(?=\n|$)")
_WORD = re.compile(r"[^\W\d_]+")
_SENTENCE = re.compile(r"[^.!?]*(?:[.!?]+(?=\s|$)|[.!?]+|$)")
_CROSSES = re.compile(r"x{4,}(?!\w)")
_CODE = re.compile(r"\b(?=[0-9a-f]*\d)[0-9a-f]{6,}\b")
_ALNUM = re.compile(r"[^\W_]")


def _phrases(block: str) -> list[str]:
    return [p for line in block.strip().splitlines() for p in line.split("|") if p]


@cache
def _automaton():
    import ahocorasick

    a = ahocorasick.Automaton()
    for kind, phrases in (("around", _phrases(AROUND_ERRORS)), ("mash", _phrases(MASH)), ("error", _phrases(ERRORS)), ("notice", _phrases(NOTICES)), ("mark", _phrases(MARKS))):
        for p in phrases:
            a.add_word(p, (kind, p))
    a.make_automaton()
    return a


def _slot_name(content: str) -> bool:
    """Whether brackets hold the name of something to fill in, and not something filled in."""
    words = _WORD.findall(content.lower())
    if not words:
        return not re.search(r"\d", content) and bool(re.search(r"[●•._…_]", content) or not content.strip())
    if re.search(r"\d", content) or words[0] in LEADING:
        return False
    return all(w in SLOT_WORDS or w == "dan" for w in words)


def _is_slot(text: str, at: int, mark: str, cut: bool) -> bool:
    """Whether an unfilled slot lies where the automaton found ``mark`` in the lower-case text."""
    if mark in ("{{", "${", "«", "%"):
        return bool(_BRACKETS[mark].match(text, at) or cut and _CUT[mark].match(text, at))
    if mark == "<":
        m = _BRACKETS["<"].match(text, at)
        return bool(m and all(w in SLOT_WORDS for w in re.findall(r"[a-z]+", m[1])) or cut and _CUT["<"].match(text, at))
    if mark == "[":
        m = _BRACKETS["["].match(text, at)
        return _slot_name(m[1]) if m else bool(cut and (m := _CUT["["].match(text, at)) and _slot_name(m[1]))
    if mark == "(":
        m = _BRACKETS["("].match(text, at)
        if m:
            words = _WORD.findall(m[1])
            told = words[:1] == ["diisi"] or words[:2] in (["belum", "diisi"], ["to", "be"], ["tanda", "tangan"], ["nama", "dan"], ["nama", "lengkap"], ["nama", "jelas"], ["isi", "di"])
            return bool(told and _slot_name(m[1]) or words in (["belum", "diisi"], ["diisi"]) or re.fullmatch(r"[.…_ ]{3,}", m[1]))
        return bool(cut and _CUT["("].match(text, at))
    if mark in ("....", "……", ". . ."):
        end = at
        while end < len(text) and text[end] in ".… ":
            end += 1
        line = text[text.rfind("\n", 0, at) + 1 : at]
        # a contents line: a heading, the leader, a page number at the line's end
        return not (_LEADER.match(text, at) and _WORD.search(line) and ":" not in line)
    if mark == "__":
        return text.startswith("___", at)
    if mark == "xxxx":
        return bool(_CROSSES.match(text, at)) and not (at and text[at - 1].isalnum())
    before, after = text[at - 1] if at else " ", text[at + 3] if at + 3 < len(text) else " "
    return not (before.isalnum() or after.isalnum())


def is_residue(text: str | None, cut: bool = False) -> bool:
    """Whether a text holds a slot, filler, an error message or a script notice. ``cut``: the
    text may break off, so a slot may be open at its end."""
    if not text:
        return False
    low = text.lower()
    spans, core = [], False
    for end, (kind, p) in _automaton().iter(low):
        start = end - len(p) + 1
        if kind == "mark":
            if p in ("....", "……", ". . .", "__", "xxxx") and start and low[start - 1] == p[0]:
                continue  # inside a run that has been looked at
            if p in ("tbd", "tba", "xxxx") and not text[start].isupper():
                continue
            if _is_slot(low, start, p, cut):
                return True
            continue
        if start and low[start - 1].isalnum() and p[0].isalnum() or (end + 1 < len(low) and low[end + 1].isalnum() and p[-1].isalnum()):
            continue
        core = core or kind != "around"
        spans.append((start, end + 1, kind))
    if not core:
        return False
    covered = bytearray(len(low))
    for start, end, kind in spans:
        if kind == "notice":  # a notice covers the sentence that it begins
            lead = low[max(low.rfind(c, 0, start) for c in ".!?") + 1 : start]
            if not _WORD.search(lead):
                end = max(end, _SENTENCE.match(low, start).end())
        covered[start:end] = b"\x01" * (end - start)
    for m in _CODE.finditer(low):
        covered[m.start() : m.end()] = b"\x02" * (m.end() - m.start())

    def part(a: int, b: int) -> float:
        letters = [i for i in range(a, b) if low[i].isalpha() and covered[i] < 2]
        return sum(covered[i] for i in letters) / len(letters) if letters else 0.0

    if part(0, len(low)) >= COVERED:
        return True
    return any(m.end() > m.start() and part(m.start(), m.end()) >= COVERED_SENTENCE for m in _SENTENCE.finditer(low))


def _is_name_residue(text: str | None) -> bool:
    """The same for a person's name, where a bare label or a line to sign on is a slot too."""
    if not text or not text.strip():
        return False
    low = text.strip().lower()
    words = _WORD.findall(low)
    if not words:
        return not re.search(r"\d", low)  # only lines, dots or marks
    if re.fullmatch(r"x{3,}|tbd|tba|undefined|null|n/a", low) or is_residue(text):
        return True
    return all(w in SLOT_WORDS or w == "dan" for w in words) and len(set(words)) == len(words) and not (len(words) == 1 and words[0] not in ("nama", "name", "jabatan", "ppk", "diisi", "menyusul"))


def _scan(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
    seen: dict[tuple, bool] = {}
    for d in batches:
        hits = []
        for kind, text in zip(d["item_table"], d["text"], strict=True):
            if kind == "document_parties":
                key = (kind, text)
                if key not in seen:
                    if len(seen) > 100_000:
                        seen.clear()
                    seen[key] = _is_name_residue(text)
                hits.append(seen[key])
            else:
                hits.append(is_residue(text, cut=kind == "snapshot_nodes"))
        yield d.loc[hits, ["item_table", "item_key"]]


def flagged(flags: Column) -> Column:
    """Whether an array of flags names residue, however the flag is spelt."""
    plain = F.transform(F.coalesce(flags, F.array().cast("array<string>")), lambda f: F.lower(F.regexp_replace(f, "[^A-Za-z]+", "_")))
    return F.coalesce(F.arrays_overlap(plain, F.array(*map(F.lit, FLAGS))), F.lit(False))


def residue(texts: DataFrame) -> DataFrame:
    """Keys of the texts that hold residue, each once: columns item_table, item_key.

    ``texts`` has item_table, item_key, text. Null, empty and blank texts hold none; a text
    of any length is read as a whole; repeated rows count once; null keys are kept; an empty
    table gives an empty result; further columns are not read.
    """
    return texts.select("item_table", "item_key", "text").filter(F.length("text") > 0).mapInPandas(_scan, "item_table string, item_key string").distinct()
