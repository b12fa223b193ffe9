"""Statistics of one text that tell running prose from lists, tables and junk; plain Python, used inside Arrow functions."""

from __future__ import annotations

import re
import unicodedata
from typing import NamedTuple

from quirework.llm.lookalike import CYRILLIC, GREEK, LIGATURES, LOOKS

WORD = re.compile(r"[^\W_]+")
# Vowels of the alphabets of the texts.
VOWELS = frozenset("aeiouyäöåüõéèêëàâôîïûùáóíúæøœаеёиоуыэюяіοι")
_MARKED = re.compile(r"\s*(?:[•\-*–—·◦▪‣]|\(?\d{1,3}[.)]|\(?[^\W\d_][.)]|\(?[ivxlc]+[.)])\s+\S", re.I)
_ENDS = re.compile(r"[.!?;:]|[-¬=⸗\xad‐–—]$")
_CELL_MARK = re.compile(r";(?=\S)|\.{3,}|\s{3,}")
_FORMS = {a: b for a, b in (LOOKS | LIGATURES).items() if a != "\t" and a not in CYRILLIC[0] + GREEK[0]}
# characters beyond the first plane would slow the search down for all others, so they have a pattern of their own
_ODD = re.compile("[" + re.escape("".join(c for c in _FORMS if c <= "\uffff")) + "]")
_FAR = re.compile("[" + min(c for c in _FORMS if c > "\uffff") + "-" + max(_FORMS) + "]")
_LETTERS = {a: b for a, b in LOOKS.items() if a in CYRILLIC[0] + GREEK[0]}
_ALIKE = re.compile("[" + "".join(_LETTERS) + "]")
# Latin letters that print like Cyrillic ones, and letters that are surely Cyrillic or Latin
_BACK = str.maketrans({b: a for a, b in zip("аеорсухАВЕКМНОРСТУХ", "aeopcyxABEKMHOPCTYX", strict=True)} | {"o": "о", "ο": "о", "Ο": "О"})
_FORTH = str.maketrans(_LETTERS)
_RUN = re.compile(r"[^\W\d_]+")
_SURELY_CYRILLIC = re.compile("[бвгджзийклмнптфцчшщъыьэюяБГДЖЗИЙЛПФЦЧШЩЪЫЬЭЮЯ]")


def plain(text: str) -> str:
    """The text composed, without invisible characters, in forms and spaces of usual width. Letters stay as stored."""
    return text if text.isascii() else unicodedata.normalize("NFC", _formed(text))


def _formed(text: str) -> str:
    if _ODD.search(text):
        text = _ODD.sub(lambda m: _FORMS[m[0]], text)
    return _FAR.sub(lambda m: _FORMS.get(m[0], m[0]), text) if _FAR.search(text) else text


_LATIN_OR_GREEK = re.compile(r"[a-zA-ZͰ-Ͽ]")


class Scripts(NamedTuple):
    """What ``readable`` asks of a whole text."""

    alike: bool
    cyrillic: bool
    latin: bool


def script_counts(text: str) -> tuple[int, int, bool, bool]:
    """Surely Cyrillic letters, characters, whether there are look-alikes, and Latin or Greek letters: of parts of a text, to add up."""
    text = _formed(text)
    return len(_SURELY_CYRILLIC.findall(text)), len(text), _ALIKE.search(text) is not None, _LATIN_OR_GREEK.search(text) is not None


def readable(text: str, of: Scripts | None = None) -> str:
    """``plain``, with look-alike letters in the script of their word; words of look-alikes alone follow the text.

    ``of``: the scripts of the whole text, if ``text`` is some of its lines.
    """
    if text.isascii():
        return text
    text = _formed(text)
    if of.alike if of else _ALIKE.search(text):  # before accents are composed: a Cyrillic letter with a Latin accent has a form of its own
        cyrillic = of.cyrillic if of else 5 * len(_SURELY_CYRILLIC.findall(text)) > len(text)
        if not cyrillic or (of.latin if of else _LATIN_OR_GREEK.search(text)):
            to: dict[str, str] = {}
            for w in set(_RUN.findall(text)):
                if w.isascii():
                    continue
                mixed, alike = _LATIN_OR_GREEK.search(w), _ALIKE.search(w)
                if mixed and _SURELY_CYRILLIC.search(w):
                    to[w] = w.translate(_BACK)
                elif mixed and alike:
                    back = w.translate(_BACK)
                    to[w] = back if cyrillic and not _LATIN_OR_GREEK.search(back) else w.translate(_FORTH)
                elif alike and not cyrillic and not _SURELY_CYRILLIC.search(w):
                    to[w] = w.translate(_FORTH)
            if to:
                text = _RUN.sub(lambda m: to.get(m[0], m[0]), text)
    return unicodedata.normalize("NFC", text)


def word_like(word: str) -> bool:
    """A number, or letters with vowels as often as words have them."""
    if word.isdigit():
        return True
    if len(word) < 2 or not word.isalpha():
        return False
    return 6 * sum(c in VOWELS for c in word.lower()) >= len(word)


class Lengths(dict):
    """Length of a word if it is word-like, else 0, remembered for the words met last."""

    def __missing__(self, word: str) -> int:
        if len(self) > 200_000:
            self.clear()
        n = self[word] = len(word) if word_like(word) else 0
        return n


_LENGTH = Lengths()


def word_like_share(words: list[str], visible: int) -> float:
    """Characters in word-like words among all characters but spaces."""
    return sum(map(_LENGTH.__getitem__, words)) / visible if visible else 0.0


def visible_chars(text: str) -> int:
    return sum(map(len, text.split()))


def n_cells(line: str) -> int:
    """The most cells that one kind of separator makes of the line."""
    s = line.strip()
    marks: dict[str, int] = {}
    for m in _CELL_MARK.findall(s):
        marks[m[0]] = marks.get(m[0], 0) + 1
    spaces = marks.pop(" ", 0)
    return 1 + max(s.count("\t"), s.strip("|").count("|"), spaces, *marks.values(), 0)


def _is_marked(s: str) -> bool:
    """Quickly no for a line that begins with three letters and has no bracket or stop near."""
    head = s[:3]
    if head.isalpha() and ")" not in s[:8] and "." not in s[:8]:
        return False
    return _MARKED.match(s) is not None


def line_shares(text: str) -> tuple[int, float, float, float, float]:
    """Lines with content, and the shares of list entries, table rows, lines ending in punctuation, and marked ones."""
    lines = [x for x in map(str.strip, text.split("\n")) if x]
    n = len(lines)
    if not n:
        return 0, 0.0, 0.0, 0.0, 0.0
    cells = "\t" in text or "|" in text or "..." in text or text.count(";") > text.count("; ") + text.count(";\n") + 1
    cells = cells or any("   " in x for x in lines)
    entries = rows = ended = marked = 0
    for x in lines:
        if _is_marked(x):
            marked += 1
            entries += 1
        elif x.count(" ") <= 5 and len(WORD.findall(x)) <= 4 and not _ENDS.search(x):
            entries += 1
        if cells and n_cells(x) >= 3:
            rows += 1
        if x[-1] in ".!?;:,…":
            ended += 1
    return n, entries / n, rows / n, ended / n, marked / n


# Limits of the kinds; the statistics have no values near them (see README).
JUNK_BELOW, ROWS_ABOVE, ENTRIES_ABOVE = 0.2, 0.5, 0.75


def is_junk(text: str) -> bool:
    t = plain(text)
    return word_like_share(WORD.findall(t), visible_chars(t)) < JUNK_BELOW


def kind_of(text: str) -> str | None:
    """'junk', 'table', 'list' or None by the fixed limits, for operators that leave such texts out."""
    t = plain(text)
    if word_like_share(WORD.findall(t), visible_chars(t)) < JUNK_BELOW:
        return "junk"
    n, entries, rows, _, _ = line_shares(t)
    if rows > ROWS_ABOVE:
        return "table"
    return "list" if n > 1 and entries > ENTRIES_ABOVE else None
