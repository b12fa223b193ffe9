"""Problem 3: noise in text from scanned pages, found line by line and repaired into paragraphs.

Furniture. Page headings have a title's form and come again in the document, page numbers stand alone and count up
or have a form of their own. A word is divided if its line ends in a letter and a division sign and the next line of
text goes on in lower case.

Misread words. All texts give word counts and skip-gram counts (words of the lexicon with the words around them). Skip-
gram vectors are learned from these by full-batch gradient descent with the expected negative samples. Every word
outside the lexicon is linked to the lexicon words from which plausible glyph edits make it, if it is rare beside
them in all texts or in the distinct ones, where copies of a misread text count once. Where it stands the context
decides: the source whose vector suits the neighbours best, less a cost for more than one edit, replaces the word if it
suits them better than the average word of the lexicon does; else the word stays. Without any known neighbour the
links decide alone.

Repair drops furniture, joins divided words, corrects misread ones and reflows lines into paragraphs.

Null and blank texts, lists, tables and junk have no noise and are returned as they are. Misread words are those of
scanned pages, whose text is cut into lines: at least a third of the line ends that can be told fall inside a sentence. Repeated rows are judged each
by itself. An empty table gives no rows. Without lexicon no word is misread.
"""

from __future__ import annotations

import re
from collections import Counter
from collections.abc import Container, Iterable, Iterator
from difflib import SequenceMatcher

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from quirework.llm import textkind as K
from quirework.runtime import save, small

# What a glyph is often read as.
GLYPHS = [
    ("a", "o"), ("e", "c"), ("c", "e"), ("n", "u"), ("u", "n"), ("i", "1"), ("i", "!"), ("l", "1"), ("l", "|"), ("i", "l"), ("l", "i"),
    ("t", "f"), ("s", "f"), ("f", "s"), ("o", "0"), ("h", "b"), ("b", "h"), ("g", "9"), ("v", "y"), ("b", "6"), ("s", "5"), ("z", "2"),
    ("m", "rn"), ("rn", "m"), ("k", "lc"), ("d", "cl"), ("cl", "d"), ("h", "li"), ("li", "h"), ("w", "vv"), ("m", "in"),
    ("ä", "a"), ("å", "a"), ("ö", "o"), ("ü", "u"), ("ü", "ii"), ("õ", "o"), ("é", "e"), ("è", "e"), ("ê", "e"), ("à", "a"), ("ç", "c"), ("â", "a"), ("ô", "o"), ("î", "i"),
    ("о", "0"), ("а", "д"), ("и", "н"), ("н", "и"), ("е", "с"), ("л", "п"), ("п", "л"), ("ь", "ъ"), ("т", "г"), ("в", "8"), ("з", "3"), ("б", "6"), ("ш", "щ"), ("ц", "ч"), ("ё", "е"), ("й", "и"),
]
DIVISION = "-¬=⸗­‐"
_SOFT = re.compile(r"\xad(?=\s*\n)")
LEXICON_LIMIT = 65_536
CONTEXTS = 256
WINDOW = 2
#: A task sends its word counts when it has met more distinct words.
FLUSH_WORDS = 500_000
#: A word is rare beside another if it has less than this share of its count, in all texts or in the distinct ones.
RARE = 0.1
#: Cost of each edit after the first, in the score's unit (logarithms of likelihood).
COST = 3.0
#: A word may be misread by one edit for this many of its characters.
CHARS_AN_EDIT = 3

_BACK: dict[str, list[str]] = {}
_FORTH: dict[str, list[str]] = {}
for _true, _seen in GLYPHS:
    _BACK.setdefault(_seen, []).append(_true)
    _FORTH.setdefault(_true, []).append(_seen)
_TOKEN = re.compile(r"[^\W_]+(?:[!|]+[^\W_]+)*[!|]?|[!|][^\W_]+")
_DIVIDED = re.compile(rf"[^\W\d_][{DIVISION}]\s*$")
_ACROSS = re.compile(rf"[{DIVISION}](?<=[^\W\d_].)\s*\n\s*(?=[^\W\d_])")
_D = r"[\d·OoIlSB|]{1,4}"
_NUMBER = re.compile(rf"^\s*(?:[-–—]\s*{_D}\s*[-–—]|\[\s*{_D}\s*\]|(?:Pag|pag|fol|Fol|p|S|s)\.\s*{_D}[rv]?\.?)\s*$|^\s{{6,}}{_D}\.?\s*$")
_BARE = re.compile(r"^\s{0,5}(\d{1,4})(\.?)\s*$")
_SIDE = re.compile(r"^\s*[\d·]{1,4}[·\s]{2,}(?=\S)|(?<=\S)[·\s]{2,}[\d·]{1,4}\s*$")
_S = r"[ ·]"
_TITLES = (
    re.compile(rf"[§·]{_S}?[\d·]{{1,3}}[.·]?{_S}\S+{_S}\S+"),
    re.compile(rf"[^\d\s]{{2,}}{_S}[\d·]{{3,4}}"),  # capitals and a year
    re.compile(r"[^\d\s,;:!?]{3,}"),  # capitals
    re.compile(rf"\S+{_S}\S+{_S}[P·][.·]{_S}\S+"),
    re.compile(rf"[^\W\d_][^\s.]*[.·]{_S}[^\W\d_]\S*{_S}[^\s.,;:!?]+"),
)


def _title(line: str) -> str | None:
    """The line without a page number beside it, if it has a title's form."""
    if line.count(" ") > 30 or line[-1] in ",;:!?-":
        return None
    s = _SIDE.sub("", line, count=1).strip()
    if not 3 <= len(s) <= 70 or s[-1] in ",;:!?" or s.count(" ") > 5:
        return None
    for i, p in enumerate(_TITLES):
        if p.fullmatch(s):
            if i in (1, 2) and (s != s.upper() or s == s.lower()):
                continue
            if i in (3, 4) and not (s[0].isupper() or s[0] == "·"):
                continue
            return s
    return None


def _letters(s: str) -> str:
    return "".join(filter(str.isalpha, s.lower()))


def _alike(a: str, b: str) -> bool:
    if abs(len(a) - len(b)) > 3 or not a or not b:
        return False
    return a == b or SequenceMatcher(None, a, b, autojunk=False).ratio() >= 0.8


def furniture(lines: list[str]) -> dict[int, str]:
    """Line numbers of page headings and page numbers."""
    out: dict[int, str] = {}
    titles = {i: t for i, x in enumerate(lines) if 3 <= len(x) <= 90 and (t := _title(x))}
    if titles:
        forms = Counter(_letters(t) for t in titles.values())
        lengths = {len(f) for f in forms}
        near = range(min(lengths) - 3, max(lengths) + 4)
        least, most = min(map(len, titles.values())) - 4, max(map(len, titles.values())) + 5
        other = {}
        for i, x in enumerate(lines):
            # a speck may hide a heading's form, but hardly changes its length
            if i not in titles and "·" in x and len(x) <= 90 and least <= len(_SIDE.sub("", x, count=1)) <= most:
                s = _letters(_SIDE.sub("", x, count=1))
                if len(s) in near and any(_alike(s, f) for f in forms):
                    other[i] = s
        letters = {i: _letters(t) for i, t in titles.items()} | other
        known = sorted(set(letters.values()))
        again = {f for f in known if sum(1 for v in letters.values() if v == f) > 1 or any(_alike(f, g) for g in known if g is not f)}
        several = len(letters) > 1 and 0 in letters
        for i, f in letters.items():
            if f in again or (several and i in titles):
                out[i] = "header"
    bare = {}
    for i, x in enumerate(lines):
        if i in out or len(x) > 60 or x.isspace() or len(x.strip()) > 14:
            continue
        if _NUMBER.match(x):
            out[i] = "page_number"
        elif m := _BARE.match(x):
            bare[i] = (int(m[1]), m[2])
    values = set(bare.values())
    for i, (v, dot) in bare.items():  # lone numbers count up from page to page; other ones end a sentence
        if (v - 1, dot) in values or (v + 1, dot) in values:
            out[i] = "page_number"
    return out


def layout(lines: list[str], marks: dict[int, str]) -> tuple[list[int], set[int]]:
    """Numbers of the lines of text, and of those whose last word is divided."""
    text = [i for i, x in enumerate(lines) if i not in marks and x and not x.isspace()]
    divided = set()
    for a, b in zip(text, text[1:], strict=False):
        if lines[a].rstrip()[-1] in DIVISION and _DIVIDED.search(lines[a]):
            s = lines[b].lstrip()
            if s[0].islower():
                divided.add(a)
    return text, divided


def cut_into_lines(lines: list[str], text: list[int]) -> bool:
    """Whether at least a third of the line ends fall inside a sentence, of those that end one or are followed by a small letter."""
    inside = ended = 0
    for a, b in zip(text, text[1:], strict=False):
        if lines[a].rstrip()[-1] in ".!?…":
            ended += 1
        elif lines[b].lstrip()[0].islower():
            inside += 1
    return inside > 0 and 2 * inside >= ended


def joined(lines: list[str], text: list[int], divided: set[int]) -> tuple[str, list[tuple[int, int]]]:
    """The lines of text as one string, divided words joined, and (start, line) of each line in it."""
    parts, starts, at, glue = [], [], 0, False
    for i in text:
        s = lines[i].strip() if glue or not parts else " " + lines[i].strip()
        if i in divided:
            s = s.rstrip()[:-1]
        starts.append((at, i))
        parts.append(s)
        at += len(s)
        glue = i in divided
    return "".join(parts), starts


# Counts over all texts


def _prepared(text: str) -> tuple[list[str], dict[int, str], list[int], set[int], bool] | None:
    """Lines in readable characters, furniture, lines of text, divided ones, whether it is cut into lines; None if blank.

    Whether it is running text is for the caller to ask, if there is anything to find.
    """
    if not text or text.isspace():
        return None
    # a soft hyphen that divides a word must outlive the removal of invisible characters
    lines = K.readable(_SOFT.sub("-", text)).split("\n")
    marks = furniture(lines)
    body, divided = layout(lines, marks)
    return lines, marks, body, divided, cut_into_lines(lines, body)


def _sent(counts: Counter[str], again: Counter[str]) -> pd.DataFrame:
    return pd.DataFrame({"word": list(counts), "n": list(counts.values()), "once": [float(n - again[w]) for w, n in counts.items()], "around": None})


def with_copies(docs: DataFrame, text: str) -> DataFrame:
    """Texts that are not null, and of how many rows they are the text: ``text, copies``. Copies are found by hashes."""
    t = docs.where(F.col(text).isNotNull()).select(F.col(text).alias("text"))
    t = t.withColumns({"_k1": F.xxhash64("text"), "_k2": F.hash("text", F.lit(7))})
    several = save(t.groupBy("_k1", "_k2").agg(F.count(F.lit(1)).alias("copies")).where("copies > 1")).df
    return t.join(small(several), ["_k1", "_k2"], "left").select("text", F.coalesce("copies", F.lit(1)).alias("copies"))


def _counting(lexicon: list[str]):
    at = {w: i for i, w in enumerate(lexicon)}
    bucket = np.array([sum(map(ord, w)) * 31 % 8191 % CONTEXTS for w in lexicon], dtype=np.int64)

    def run(frames: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        counts: Counter[str] = Counter()
        again: Counter[str] = Counter()  # the share of copies in the counts
        grid = np.zeros(len(lexicon) * CONTEXTS, dtype=np.int64)
        for f in frames:
            ids: list[int] = []
            for t, copies in zip(f["text"], f["copies"], strict=True):
                words = _TOKEN.findall(K.readable(_ACROSS.sub("", t)).lower())
                bare = [w.rstrip("!|") for w in words if w[-1] in "!|"] if "!" in t or "|" in t else []
                counts.update(words)
                counts.update(bare)
                if copies > 1:  # all of them together count once among the distinct texts
                    for w, k in Counter(words + bare).items():
                        again[w] += k * (1 - 1 / copies)
                ids += [at.get(w, -1) for w in words]
                ids += [-1] * WINDOW
            if len(at):
                x = np.asarray(ids, dtype=np.int64)
                for k in range(1, WINDOW + 1):
                    a, b = x[:-k], x[k:]
                    both = (a >= 0) & (b >= 0)
                    for u, v in ((a[both], b[both]), (b[both], a[both])):
                        grid += np.bincount(u * CONTEXTS + bucket[v], minlength=len(grid))
            if len(counts) > FLUSH_WORDS:
                yield _sent(counts, again)
                counts, again = Counter(), Counter()
        if counts:
            yield _sent(counts, again)
        # apart from the counts, which may have been sent and cleared
        rows = grid.reshape(len(lexicon), CONTEXTS).astype(np.int32)
        met = np.flatnonzero(rows.any(axis=1))
        for part in np.split(met, range(4096, len(met), 4096)):
            if len(part):
                yield pd.DataFrame({"word": [lexicon[i] for i in part], "n": 0, "once": 0.0, "around": [rows[i].tobytes() for i in part]})

    return run


def _summed(key: tuple, frame: pd.DataFrame) -> pd.DataFrame:
    total = np.zeros(CONTEXTS, dtype=np.int64)
    for b in frame["around"]:
        total += np.frombuffer(b, dtype=np.int32)
    return pd.DataFrame({"word": [key[0]], "around": [total.astype(np.int64).tobytes()]})


def learn_vectors(counts: np.ndarray, size: int = 16, steps: int = 150, negatives: float = 5.0, seed: int = 3) -> tuple[np.ndarray, np.ndarray]:
    """Skip-gram vectors of words [n, size] and contexts [CONTEXTS, size] from their counts."""
    rng = np.random.default_rng(seed)
    n = counts.astype(float)
    total = max(n.sum(), 1.0)
    expected = negatives * np.outer(n.sum(axis=1), n.sum(axis=0)) / total  # negative samples drawn by context frequency
    w, c = rng.normal(0, 0.1, (len(n), size)), rng.normal(0, 0.1, (n.shape[1], size))
    gw, gc = np.zeros_like(w), np.zeros_like(c)
    for _ in range(steps if counts.any() else 0):
        p = 1 / (1 + np.exp(-np.clip(w @ c.T, -20, 20)))
        g = (n + expected) * p - n
        scale = n + expected
        dw = (g @ c) / np.maximum(scale.sum(axis=1, keepdims=True), 1e-9)
        dc = (g.T @ w) / np.maximum(scale.sum(axis=0)[:, None], 1e-9)
        gw, gc = 0.9 * gw - 2.0 * dw, 0.9 * gc - 2.0 * dc
        w, c = w + gw, c + gc
    return w, c


def glyph_forms(words: Iterable[str]) -> dict[str, list[str]]:
    """What one glyph edit makes of the words: form to its words. Bounded by the lexicon: a word has few such forms."""
    forms: dict[str, list[str]] = {}
    for w in words:
        for i in range(len(w)):
            for true in (w[i], w[i : i + 2]) if i + 1 < len(w) else (w[i],):
                for seen in _FORTH.get(true, ()):
                    f = w[:i] + seen + w[i + len(true) :]
                    if w not in forms.setdefault(f, []):
                        forms[f].append(w)
    return forms


def glyph_sources(word: str, forms: dict[str, list[str]]) -> dict[str, int]:
    """Lexicon words that one glyph edit turns into ``word``, or two in a word long enough, with the least number of edits."""
    found: dict[str, int] = {}
    if len(word) >= 2 * CHARS_AN_EDIT:  # undo one edit; what is left must be one edit from a word
        for i in range(len(word)):
            for seen in (word[i], word[i : i + 2]) if i + 1 < len(word) else (word[i],):
                for true in _BACK.get(seen, ()):
                    for w in forms.get(word[:i] + true + word[i + len(seen) :], ()):
                        if w != word:
                            found[w] = 2
    found.update(dict.fromkeys(forms.get(word, ()), 1))
    return found


def _linking(counts: dict[str, int], once: dict[str, int]):
    """Distinct rare words to (word, source, edits). ``once``: counts of distinct texts."""
    forms = glyph_forms(counts)

    def run(frames: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for f in frames:
            rows = []
            for w, n, o in zip(f["word"], f["n"], f["once"], strict=True):
                bare = w.strip("!|")
                if len(bare) < 2 or bare in counts or w.isdigit() or not any(map(str.isalpha, w)):
                    continue
                for t, e in glyph_sources(w, forms).items():
                    if n < RARE * counts[t] or o < RARE * once[t]:
                        rows.append((w, t, e))
            yield pd.DataFrame(rows, columns=["word", "source", "edits"])

    return run


class Corrector:
    """Links of misread words, with vectors that decide in context."""

    def __init__(self, links: dict[str, list[tuple[str, int]]], lexicon: list[str], words: np.ndarray, contexts: np.ndarray):
        self.links, self.words, self.contexts = links, words.astype(np.float32), contexts.astype(np.float32)
        self.average = self.words.mean(axis=0) if len(lexicon) else np.zeros(self.contexts.shape[1], dtype=np.float32)
        self.at = {w: i for i, w in enumerate(lexicon)}
        self.bucket = [sum(map(ord, w)) * 31 % 8191 % CONTEXTS for w in lexicon]

    def correct(self, word: str, around: list[str]) -> str | None:
        """The source of a misread word among its neighbours; None if it is none or if the context speaks for the word as it is."""
        options = self.links.get(word)
        if not options:
            return None
        near = [self.bucket[self.at[x]] for x in around if x in self.at]
        if not near:
            return min(options, key=lambda o: (o[1], o[0]))[0]
        here = self.contexts[near].mean(axis=0)
        best = max(options, key=lambda o: (float(self.words[self.at[o[0]]] @ here) - COST * (o[1] - 1), o[0]))
        return best[0] if float(self.words[self.at[best[0]]] @ here) - COST * (best[1] - 1) > float(self.average @ here) else None


def fit(docs: DataFrame, text: str, lexicon: DataFrame) -> Corrector:
    """Counts over all documents, vectors, and links. ``lexicon``: ``word``, at most ``LEXICON_LIMIT`` of them."""
    words = sorted(r[0] for r in lexicon.where("word is not null and word <> ''").select("word").distinct().limit(LEXICON_LIMIT + 1).collect())
    if len(words) > LEXICON_LIMIT:
        raise ValueError(f"at most {LEXICON_LIMIT} words in the lexicon")
    spark = docs.sparkSession
    saved = save(with_copies(docs, text).mapInPandas(_counting(words), "word string, n long, once double, around binary"))
    counted = saved.df.groupBy("word").agg(F.sum("n").alias("n"), F.round(F.sum("once")).cast("long").alias("once"))
    known = spark.createDataFrame([(w,) for w in words], "word string")
    # rows of the lexicon only: at most LEXICON_LIMIT
    n_of, once_of = {}, {}
    for r in counted.join(F.broadcast(known), "word").toLocalIterator():
        n_of[r["word"]], once_of[r["word"]] = r["n"], r["once"]
    grid = np.zeros((len(words), CONTEXTS), dtype=np.int64)
    at = {w: i for i, w in enumerate(words)}
    for r in saved.df.where("around is not null").groupBy("word").applyInPandas(_summed, "word string, around binary").toLocalIterator():
        grid[at[r["word"]]] = np.frombuffer(r["around"], dtype=np.int64)
    w, c = learn_vectors(grid)
    links: dict[str, list[tuple[str, int]]] = {}
    # bounded by the lexicon: each of its words has so many glyph edits
    for r in counted.mapInPandas(_linking(n_of, once_of), "word string, source string, edits int").toLocalIterator():
        links.setdefault(r["word"], []).append((r["source"], r["edits"]))
    saved.drop()
    return Corrector(links, words, w, c)


def misread(whole: str, corrector: Corrector) -> list[tuple[int, str, str]]:
    """(position of the word's first changed character, word as written, correction)."""
    links = corrector.links
    if not any(w in links or (w[-1] in "!|" and w.rstrip("!|") in links) for w in _TOKEN.findall(whole.lower())):
        return []
    found = [(m.start(), m[0]) for m in _TOKEN.finditer(whole)]
    lower = [w.lower() for _, w in found]
    out = []
    for k, ((start, written), w) in enumerate(zip(found, lower, strict=True)):
        if w not in links:
            w = w.rstrip("!|")
            if w not in links:
                continue
            written = written.rstrip("!|")
        better = corrector.correct(w, lower[max(0, k - WINDOW) : k] + lower[k + 1 : k + 1 + WINDOW])
        if better is not None:
            same = next((i for i, (a, b) in enumerate(zip(w, better, strict=False)) if a != b), min(len(w), len(better)) - 1)
            out.append((start + same, written, better))
    return out


def _line_of(starts: list[tuple[int, int]], at: int) -> int:
    line = starts[0][1]
    for s, i in starts:
        if s > at:
            break
        line = i
    return line


def noise(text: str | None, corrector: Corrector) -> list[tuple[int, str]]:
    """(line, kind of noise) of one text."""
    p = _prepared(text) if text else None
    if p is None:
        return []
    lines, marks, body, divided, cut = p
    out = {(i, k) for i, k in marks.items()} | {(i, "hyphen") for i in divided}
    if cut:
        whole, starts = joined(lines, body, divided)
        for at, _, _ in misread(whole, corrector):
            out.add((_line_of(starts, at), "misread"))
    return sorted(out) if out and K.kind_of(text) is None else []


def repair(text: str | None, corrector: Corrector) -> str | None:
    """Paragraphs of the text in its readable characters: no furniture, no divided or misread words; a blank or indented line begins a new one."""
    p = _prepared(text) if text else None
    if p is None or K.kind_of(text) is not None:
        return text
    lines, marks, _, divided, cut = p
    paragraphs: list[list[str]] = [[]]
    usual = min((len(x) - len(x.lstrip()) for i, x in enumerate(lines) if x.strip() and i not in marks), default=0)
    glue = False
    for i, x in enumerate(lines):
        if i in marks:
            continue
        s = x.strip()
        if not s:
            if not glue:
                paragraphs.append([])
            continue
        if not glue and (not cut or len(x) - len(x.lstrip()) > usual):
            paragraphs.append([])
        part = s.rstrip()[:-1] if i in divided else s
        if glue and paragraphs[-1]:
            paragraphs[-1][-1] += part
        else:
            paragraphs[-1].append(part)
        glue = i in divided
    out = []
    for q in paragraphs:
        if not q:
            continue
        s = " ".join(q)
        if cut:
            for at, written, better in reversed(misread(s, corrector)):
                start = max(0, at - len(written))
                k = s.find(written, start)
                if k >= 0:
                    s = s[:k] + (better[:1].upper() + better[1:] if written[:1].isupper() else better) + s[k + len(written) :]
        out.append(s)
    return "\n\n".join(out)


def find_noise(docs: DataFrame, doc_id: str, text: str, corrector: Corrector) -> DataFrame:
    """One row per line and kind: ``doc_id, line_no, noise_kind`` (header, page_number, hyphen, misread)."""
    shared = docs.sparkSession.sparkContext.broadcast(corrector)

    def run(frames: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        c = shared.value
        for f in frames:
            rows = [(d, i, k) for d, t in zip(f["doc_id"], f["text"], strict=True) for i, k in noise(t, c)]
            yield pd.DataFrame(rows, columns=["doc_id", "line_no", "noise_kind"])

    d = docs.select(F.col(doc_id).cast("long").alias("doc_id"), F.col(text).alias("text")).where("doc_id is not null and text is not null")
    return d.mapInPandas(run, "doc_id long, line_no int, noise_kind string")


def repaired(docs: DataFrame, doc_id: str, text: str, corrector: Corrector) -> DataFrame:
    """``doc_id, text``: every document as continuous paragraphs."""
    shared = docs.sparkSession.sparkContext.broadcast(corrector)

    def run(frames: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        c = shared.value
        for f in frames:
            yield pd.DataFrame({"doc_id": f["doc_id"], "text": [repair(t, c) for t in f["text"]]})

    d = docs.select(F.col(doc_id).cast("long").alias("doc_id"), F.col(text).alias("text")).where("doc_id is not null")
    return d.mapInPandas(run, "doc_id long, text string")
