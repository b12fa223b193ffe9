"""Problem 5: languages of documents, pages and their passages.

Error-correcting output codes: each language has a codeword; for each bit a binary classifier over hashed character
n-grams of words (logistic regression) predicts it. Loss-weighted decoding adds, over the words of a passage, the
logistic loss of every bit against every codeword, each bit weighted by how well it separates the training words;
the nearest codeword wins. The loss it leads by gives the confidence, and a small lead flags the passage ambiguous.

The classifiers are fitted on at most about ``train_rows`` labelled documents, drawn by a hash of their ids; a
second fit leaves out documents whose label the first one contradicts. All texts are read, whole.

Null and blank texts, and texts without letters, have no language. Labels are normalized by their spelling; labels
that name no language of the model count as naming another one if they are language codes, else as missing. Repeated
lines count once. An empty table gives no rows. A passage of one word or of names alone is ambiguous.
"""

from __future__ import annotations

import re
import zlib
from collections.abc import Iterator

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from quirework.llm import textkind as K

# The languages, and spellings of their names (two- and three-letter codes, English and own names).
SPELLINGS = {
    "sv": ["sv", "swe", "swedish", "svenska"],
    "fi": ["fi", "fin", "finnish", "suomi"],
    "en": ["en", "eng", "english"],
    "de": ["de", "deu", "ger", "german", "deutsch"],
    "ru": ["ru", "rus", "russian", "русский"],
    "et": ["et", "est", "estonian", "eesti"],
    "fr": ["fr", "fra", "fre", "french", "français"],
    "la": ["la", "lat", "latin", "lingua latina"],
}
LANGUAGES = list(SPELLINGS)
# Labels that say nothing.
PLACEHOLDERS = ["", "und", "unknown", "unk", "none", "null", "n/a", "na", "-", "?", "xx", "zxx", "mis", "mul", "auto", "other"]
_BITS = 15
_BUCKETS = 1 << 15
_TOKEN = re.compile(r"[^\W\d_]+|[.!?;]|\n[^\S\n]*\n")
_DIVIDED = re.compile(r"[-¬=⸗­‐](?<=\w.)\n\s*(?=[^\W\d_])")
LEAST_WORDS = 4


def label_language(label: Column) -> Column:
    """The code of a label in any spelling; null for placeholders, '?' for other languages."""
    base = F.regexp_extract(F.lower(F.trim(label)), r"^([^_\-]*(?:-$)?)", 1)
    code = None
    for lang, names in SPELLINGS.items():
        test = base.isin(names)
        code = F.when(test, F.lit(lang)) if code is None else code.when(test, F.lit(lang))
    return F.when(label.isNull() | base.isin(PLACEHOLDERS), F.lit(None).cast("string")).otherwise(code.otherwise(F.lit("?")))


def codewords(n: int, bits: int = _BITS, seed: int = 7) -> np.ndarray:
    """Rows of +-1 with a large least distance between rows, no column constant, columns pairwise different."""
    rng = np.random.default_rng(seed)
    best, found = -1, None
    for _ in range(3000):
        c = rng.choice([-1, 1], size=(n, bits))
        if n > 1 and (np.abs(c.sum(axis=0)) == n).any():
            continue
        dist = (bits - c @ c.T) // 2
        least = int(dist[np.triu_indices(n, 1)].min(initial=bits))
        if least > best:
            best, found = least, c
    return found if found is not None else np.ones((n, bits), dtype=int)


def features(word: str) -> list[int]:
    """Buckets of the word itself and of its n-grams of two to four characters, its bounds included."""
    s = f"^{word}$"
    grams = [s]
    for n in (2, 3, 4):
        grams += [s[i : i + n] for i in range(len(s) - n + 1)]
    return [zlib.crc32(g.encode()) % _BUCKETS for g in set(grams)]


class Model:
    """Bit classifiers and codewords; words are scored once and remembered."""

    def __init__(self, weights: np.ndarray, bias: np.ndarray, codes: np.ndarray, bit_weight: np.ndarray):
        self.weights, self.bias, self.codes, self.bit_weight = weights, bias, codes, bit_weight
        self._clear()

    def __getstate__(self):
        return {"weights": self.weights.astype(np.float32), "bias": self.bias, "codes": self.codes, "bit_weight": self.bit_weight}

    def __setstate__(self, state):
        self.__dict__.update(state)
        self._clear()

    def _clear(self) -> None:
        self.at: dict[str, int] = {}
        self.table = np.zeros((1 << 12, len(self.codes)), dtype=np.float32)

    def losses(self, words: list[str]) -> np.ndarray:
        """[word, language] weighted loss against each codeword, less its mean over languages."""
        lists = [features(w) for w in words]
        size = np.array([len(x) for x in lists])
        start = np.concatenate([[0], np.cumsum(size)[:-1]])
        flat = np.fromiter((f for x in lists for f in x), dtype=np.int64, count=int(size.sum()))
        margins = np.add.reduceat(self.weights[flat], start, axis=0) / np.sqrt(size)[:, None] + self.bias
        loss = np.logaddexp(0, -margins[:, None, :] * self.codes[None, :, :]) @ self.bit_weight
        return loss - loss.mean(axis=1, keepdims=True)

    def rows(self, words: list[str]) -> np.ndarray:
        """Rows of ``table`` of the words."""
        at = self.at
        new = [w for w in dict.fromkeys(words) if w not in at]
        if new:
            if len(at) + len(new) > 400_000:
                self._clear()
                at, new = self.at, list(dict.fromkeys(words))
            start, end = len(at), len(at) + len(new)
            if end > len(self.table):
                grown = np.zeros((max(end, 2 * len(self.table)), self.table.shape[1]), dtype=np.float32)
                grown[:start] = self.table[:start]
                self.table = grown
            self.table[start:end] = self.losses(new)
            at.update(zip(new, range(start, end), strict=True))
        return np.fromiter(map(at.__getitem__, words), dtype=np.int64, count=len(words))

    def total(self, words: list[str]) -> np.ndarray:
        """Summed losses of all words."""
        rows = self.rows(words)
        return self.table[rows].sum(axis=0)


def fit(counts: dict[str, np.ndarray], steps: int = 150, ridge: float = 1e-3) -> Model:
    """Classifiers from word counts per language (in the order of ``LANGUAGES``), by accelerated gradient descent."""
    codes = codewords(len(LANGUAGES))
    words = [w for w, c in counts.items() if c.sum() >= 2] or list(counts)
    c = np.array([counts[w] for w in words], dtype=float).reshape(-1, len(LANGUAGES))
    c = c / np.maximum(c.sum(axis=0), 1) * max(c.sum(), 1) / len(LANGUAGES)  # each language weighs the same
    weight = np.log1p(c.sum(axis=1))
    part = c / np.maximum(c.sum(axis=1, keepdims=True), 1e-9)
    y = part @ (codes > 0)  # share of +1 for each bit
    lists = [features(w) for w in words]
    flat = np.array([f for x in lists for f in x], dtype=np.int64)
    size = np.array([len(x) for x in lists], dtype=np.int64)
    start = np.concatenate([[0], np.cumsum(size)[:-1]]) if len(size) else np.zeros(0, dtype=np.int64)
    used, flat = np.unique(flat, return_inverse=True)
    scale = 1 / np.sqrt(size)
    w = np.zeros((len(used), codes.shape[1]))
    bias, speed, bias_speed = np.zeros(codes.shape[1]), np.zeros_like(w), np.zeros(codes.shape[1])
    owner = np.repeat(np.arange(len(words)), size)
    order = np.argsort(flat, kind="stable")
    owner_by_feature = owner[order]
    first = np.searchsorted(flat[order], np.arange(len(used)))
    total = max(weight.sum(), 1.0)
    rate = 40.0
    for step in range(steps if len(words) else 0):
        m = np.add.reduceat(w[flat], start, axis=0) * scale[:, None] + bias
        g = (1 / (1 + np.exp(-np.clip(m, -30, 30))) - y) * weight[:, None] / total
        gs = g * scale[:, None]
        gw = np.add.reduceat(gs[owner_by_feature], first, axis=0) + ridge * w / total
        speed = 0.9 * speed - rate * gw
        bias_speed = 0.9 * bias_speed - g.sum(axis=0)
        w, bias = w + speed, bias + bias_speed
    full = np.zeros((_BUCKETS, codes.shape[1]), dtype=np.float32)
    full[used] = w
    model = Model(full, bias, codes, np.ones(codes.shape[1]))
    if len(words):
        m = np.add.reduceat(w[flat], start, axis=0) * scale[:, None] + bias
        right = (((m > 0) == (y > 0.5)) * weight[:, None]).sum(axis=0) / total
        model.bit_weight = np.log(np.clip(right, 0.55, 0.999) / (1 - np.clip(right, 0.55, 0.999)))
        model.bit_weight /= model.bit_weight.sum()
    return model


def passages(texts: list[str | None], model: Model, sentences: bool = True) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Passages of all texts, each a sentence or a whole text: owner, number of words, summed losses per language."""
    words: list[str] = []
    passage, owner, at = [], [], 0
    for i, t in enumerate(texts):
        if not t:
            continue
        tokens = _TOKEN.findall(K.readable(_DIVIDED.sub("", t)).lower())
        if sentences:
            for w in tokens:
                if w[0].isalpha():
                    words.append(w)
                    passage.append(at)
                elif not owner or at == len(owner) - 1:
                    at = len(owner)
                if len(owner) == at and passage and passage[-1] == at:
                    owner.append(i)
        else:
            mine = [w for w in tokens if w[0].isalpha()]
            words += mine
            passage += [at] * len(mine)
            if mine:
                owner.append(i)
        at = len(owner)
    if not words:
        return np.zeros(0, dtype=np.int64), np.zeros(0, dtype=np.int64), np.zeros((0, len(LANGUAGES)))
    rows = model.rows(words)
    p = np.asarray(passage)
    first = np.flatnonzero(np.concatenate([[True], p[1:] != p[:-1]]))
    return np.asarray(owner), np.diff(np.append(first, len(words))), np.add.reduceat(model.table[rows], first, axis=0)


def decide(loss: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Language and lead (in loss, over the second best) of each passage."""
    best = loss.argmin(axis=1)
    two = np.partition(loss, 1, axis=1)[:, :2]
    return best, two[:, 1] - two[:, 0]


def confidence(lead: float) -> float:
    """From 0.5 without a lead up to 1."""
    return float(1 / (1 + np.exp(-min(lead, 50.0))))


#: A passage is sure of its language with this lead, in all and per word, and so many words.
LEAST_LEAD, LEAST_LEAD_PER_WORD = 2.0, 0.3


def _settled(n: np.ndarray, owner: np.ndarray, loss: np.ndarray, texts: int) -> tuple[np.ndarray, np.ndarray]:
    """Language of each passage, and main language of each text."""
    lang, _ = decide(loss)
    k = len(LANGUAGES)
    words = np.bincount(owner * k + lang, weights=n, minlength=texts * k).reshape(-1, k)
    main = words.argmax(axis=1)
    over = loss[np.arange(len(n)), main[owner]] - loss.min(axis=1)
    sure = (over >= LEAST_LEAD) & (over >= LEAST_LEAD_PER_WORD * n) & (n >= LEAST_WORDS)
    return np.where(sure, lang, main[owner]), main  # passages that hardly differ go with the main language


def languages_of(texts: list[str | None], model: Model) -> list[list[tuple[str, float, int, bool]]]:
    """Per text: (language, confidence, words, ambiguous) of its main language, then of each with a whole sentence."""
    owner, n, loss = passages(texts, model)
    out: list[list[tuple[str, float, int, bool]]] = [[] for _ in texts]
    if not len(n):
        return out
    lang, main = _settled(n, owner, loss, len(texts))
    first = np.concatenate([[0], np.flatnonzero(owner[1:] != owner[:-1]) + 1, [len(owner)]])
    for a, b in zip(first[:-1], first[1:], strict=True):
        i = owner[a]
        kinds = [main[i]] if (lang[a:b] == main[i]).all() else list(dict.fromkeys([int(main[i]), *lang[a:b].tolist()]))
        for x in kinds:
            mine = lang[a:b] == x
            total = loss[a:b][mine].sum(axis=0)
            two = np.sort(total)[:2]
            gap = float(two[1] - two[0])
            out[i].append((LANGUAGES[x], confidence(gap), int(n[a:b][mine].sum()), gap < LEAST_LEAD))
    return out


def passages_of(texts: list[str | None], model: Model) -> pd.DataFrame:
    """The passages of all texts in order, as ``languages_of`` counts them.

    Columns: ``owner`` (which text), ``passage`` (from 0 in its text), ``first_word`` (from 0 in its text), ``n_words, lang,
    confidence, ambiguous``. The confidence is under 0.5 where the passage alone speaks for another language than its own.
    """
    owner, n, loss = passages(texts, model)
    lang, _ = _settled(n, owner, loss, len(texts))
    each = np.arange(len(n))
    others = loss.copy()
    others[each, lang] = np.inf
    gap = others.min(axis=1) - loss[each, lang]
    start = np.flatnonzero(np.concatenate([[True], owner[1:] != owner[:-1]]))
    own = np.repeat(start, np.diff(np.append(start, len(n))))  # the first passage of the same text
    before = np.cumsum(n) - n
    return pd.DataFrame(
        {
            "owner": owner, "passage": each - own, "first_word": before - before[own], "n_words": n, "lang": np.array(LANGUAGES)[lang],
            "confidence": 1 / (1 + np.exp(-np.clip(gap, -50, 50))), "ambiguous": (gap < LEAST_LEAD) | (n < 2),
        }
    )


def segments_of(texts: list[str | None], model: Model) -> pd.DataFrame:
    """The segments of all texts: runs of passages of one language, after ambiguous passages have joined their neighbours.

    A passage that is ambiguous alone takes the language of the sure passages next to it, of two that of the stronger
    lead; a text without any sure passage is one segment. Columns: ``owner, segment`` (from 0), ``first_word, last_word``
    (of the text, from 0), ``lang, confidence`` (of its passages together), ``ambiguous``.
    """
    owner, n, loss = passages(texts, model)
    lang, _ = _settled(n, owner, loss, len(texts))
    rows = []
    ends = np.concatenate([[0], np.flatnonzero(owner[1:] != owner[:-1]) + 1, [len(owner)]]) if len(n) else np.zeros(1, dtype=int)
    for a, b in zip(ends[:-1], ends[1:], strict=True):
        part, own = loss[a:b], lang[a:b].copy()
        gap = np.partition(part, 1, axis=1)[:, 1] - part.min(axis=1)
        sure = np.flatnonzero((gap >= LEAST_LEAD) & (n[a:b] > 1))
        if len(sure):
            each = np.arange(b - a)
            after = np.searchsorted(sure, each)
            left, right = sure[np.maximum(after - 1, 0)], sure[np.minimum(after, len(sure) - 1)]
            near = np.where((after == 0) | ((after < len(sure)) & (gap[right] > gap[left])), right, left)
            unsure = np.ones(b - a, dtype=bool)
            unsure[sure] = False
            own[unsure] = own[near[unsure]]
        else:
            own[:] = int(part.sum(axis=0).argmin())
        start = np.concatenate([[0], np.cumsum(n[a:b])])
        cuts = np.concatenate([[0], np.flatnonzero(own[1:] != own[:-1]) + 1, [b - a]])
        for k, (i, j) in enumerate(zip(cuts[:-1], cuts[1:], strict=True)):
            total = part[i:j].sum(axis=0)
            lead = float(np.delete(total, own[i]).min() - total[own[i]])
            rows.append((owner[a], k, int(start[i]), int(start[j]) - 1, LANGUAGES[own[i]], float(1 / (1 + np.exp(-np.clip(lead, -50, 50)))), lead < LEAST_LEAD))
    return pd.DataFrame(rows, columns=["owner", "segment", "first_word", "last_word", "lang", "confidence", "ambiguous"])


def document_segments(docs: DataFrame, doc_id: str, text: str, model: Model) -> DataFrame:
    """One row per segment of each document: ``record_id`` and the columns of ``segments_of``."""
    shared = docs.sparkSession.sparkContext.broadcast(model)

    def run(frames: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        m = shared.value
        for f in frames:
            out = segments_of(f["text"].tolist(), m)
            out.insert(0, "record_id", f["record_id"].to_numpy()[out.pop("owner").to_numpy(dtype=np.int64)])
            yield out

    d = docs.select(F.col(doc_id).cast("long").alias("record_id"), F.col(text).alias("text")).where("record_id is not null")
    return d.mapInPandas(run, "record_id long, segment long, first_word long, last_word long, lang string, confidence double, ambiguous boolean")


def words_by_label(text: str) -> list[str]:
    return [t for t in _TOKEN.findall(K.readable(_DIVIDED.sub("", text)).lower()) if t[0].isalpha()]


def fit_labelled(rows: pd.DataFrame) -> Model:
    """rows: ``text, lang`` (codes). Fits twice; the second fit leaves out contradicted labels."""
    texts = [words_by_label(t) for t in rows["text"]]
    at = [LANGUAGES.index(x) for x in rows["lang"]]

    def counted(keep: list[bool]) -> dict[str, np.ndarray]:
        c: dict[str, np.ndarray] = {}
        for words, k, ok in zip(texts, at, keep, strict=True):
            if ok:
                for w in words:
                    if w not in c:
                        c[w] = np.zeros(len(LANGUAGES))
                    c[w][k] += 1
        return c

    model = fit(counted([True] * len(texts)))
    agree = [bool(t) and int(model.total(t).argmin()) == k for t, k in zip(texts, at, strict=True)]
    return fit(counted(agree)) if any(agree) else model


def train(docs: DataFrame, doc_id: str, text: str, label: str, train_rows: int = 3000) -> Model:
    """A model from at most about ``train_rows`` labelled documents, those with the least hash of their id."""
    d = docs.select(F.col(doc_id).alias("_id"), F.col(text).alias("text"), label_language(F.col(label)).alias("lang"))
    d = d.where(F.col("lang").isin(LANGUAGES) & F.col("text").isNotNull())
    n = d.select("_id").count()
    share = min(1.0, train_rows / max(n, 1))
    pick = d.where(F.pmod(F.xxhash64("_id"), F.lit(1_000_000)) < int(share * 1_000_000) + 1).select("text", "lang")
    return fit_labelled(pick.limit(2 * train_rows).toPandas())


def document_languages(docs: DataFrame, doc_id: str, text: str, label: str, model: Model) -> DataFrame:
    """One row for the main language of each document and for each further one with a whole sentence.

    Columns: ``record_id, label`` (normalized), ``lang, confidence, n_words, ambiguous, is_main, n_langs, junk``. Junk
    is told for documents whose label is not the main language or that have several.
    """
    shared = docs.sparkSession.sparkContext.broadcast(model)

    def run(frames: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        m = shared.value
        for f in frames:
            rows = []
            texts = f["text"].tolist()
            for i, lab, t, found in zip(f["record_id"], f["label"], texts, languages_of(texts, m), strict=True):
                odd = bool(found) and (len(found) > 1 or lab != found[0][0]) and K.is_junk(t)
                for j, (lang, conf, n, amb) in enumerate(found):
                    rows.append((i, lab, lang, conf, n, amb, j == 0, len(found), odd))
            yield pd.DataFrame(rows, columns=["record_id", "label", "lang", "confidence", "n_words", "ambiguous", "is_main", "n_langs", "junk"])

    d = docs.select(F.col(doc_id).cast("long").alias("record_id"), label_language(F.col(label)).alias("label"), F.col(text).alias("text")).where("record_id is not null")
    return d.mapInPandas(run, "record_id long, label string, lang string, confidence double, n_words long, ambiguous boolean, is_main boolean, n_langs int, junk boolean")


def document_passages(docs: DataFrame, doc_id: str, text: str, model: Model) -> DataFrame:
    """One row per passage of each document: ``record_id`` and the columns of ``passages_of``.

    Passages are sentences or parts between blank lines that hold words. Words are runs of letters, divided ones joined.
    """
    shared = docs.sparkSession.sparkContext.broadcast(model)

    def run(frames: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        m = shared.value
        for f in frames:
            out = passages_of(f["text"].tolist(), m)
            out.insert(0, "record_id", f["record_id"].to_numpy()[out.pop("owner").to_numpy()])
            yield out

    d = docs.select(F.col(doc_id).cast("long").alias("record_id"), F.col(text).alias("text")).where("record_id is not null")
    return d.mapInPandas(run, "record_id long, passage long, first_word long, n_words long, lang string, confidence double, ambiguous boolean")


def line_languages(lines: DataFrame, model: Model) -> DataFrame:
    """lines: ``page_id, line_id, text``. Per distinct line: ``page_id, line_id, lang, n_words, lead, sure``."""
    shared = lines.sparkSession.sparkContext.broadcast(model)

    def run(frames: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        m = shared.value
        for f in frames:
            owner, n, loss = passages(f["text"].tolist(), m, sentences=False)
            lang, lead = decide(loss) if len(n) else (np.zeros(0, dtype=int), np.zeros(0))
            yield pd.DataFrame(
                {
                    "page_id": f["page_id"].to_numpy()[owner],
                    "line_id": f["line_id"].to_numpy()[owner],
                    "lang": np.array(LANGUAGES)[lang],
                    "n_words": n,
                    "lead": lead.astype(float),
                    "sure": (lead >= LEAST_LEAD) & (lead >= LEAST_LEAD_PER_WORD * n) & (n >= LEAST_WORDS - 1),
                }
            )

    d = lines.where("page_id is not null and line_id is not null and text is not null").select("page_id", "line_id", "text")
    per = d.mapInPandas(run, "page_id long, line_id long, lang string, n_words long, lead double, sure boolean")
    return per.groupBy("page_id", "line_id").agg(*(F.first(c).alias(c) for c in ("lang", "n_words", "lead", "sure")))


def page_passages(lines: DataFrame, model: Model) -> DataFrame:
    """One row per distinct line with words: ``page_id, line_id, lang, confidence, n_words, ambiguous``.

    The language is that of the line alone, also where the line is ambiguous.
    """
    conf = 1 / (1 + F.exp(-F.least(F.col("lead"), F.lit(50.0))))
    ambiguous = (F.col("lead") < LEAST_LEAD) | (F.col("n_words") < 2)
    return line_languages(lines, model).select("page_id", "line_id", "lang", conf.alias("confidence"), "n_words", ambiguous.alias("ambiguous"))


def page_languages(lines: DataFrame, model: Model, least_lines: int = 2) -> DataFrame:
    """Per page its main language (that of most words) and each further one of at least ``least_lines`` sure lines.

    Columns: ``page_id, lang, confidence, n_words, n_lines, ambiguous, is_main, n_langs``. Pages are pre-aggregated by language,
    so a page of any number of lines costs one row per language and map task.
    """
    per = line_languages(lines, model).groupBy("page_id", "lang").agg(
        F.sum("n_words").alias("n_words"), F.sum(F.col("sure").cast("int")).alias("n_lines"), F.sum("lead").alias("_lead")
    )
    lang = F.struct(F.col("n_words"), F.col("n_lines"), F.col("lang"), F.col("_lead"))
    page = per.groupBy("page_id").agg(F.sort_array(F.collect_list(lang), asc=False).alias("_l"))  # one per language
    page = page.withColumn("_l", F.filter("_l", lambda x, i: (i == 0) | (x["n_lines"] >= least_lines)))
    one = page.select("page_id", F.size("_l").alias("n_langs"), F.posexplode("_l").alias("_i", "_x"))
    conf = 1 / (1 + F.exp(-F.least(F.col("_x._lead"), F.lit(50.0))))
    return one.select("page_id", "_x.lang", conf.alias("confidence"), "_x.n_words", "_x.n_lines", (F.col("_x._lead") < LEAST_LEAD).alias("ambiguous"), (F.col("_i") == 0).alias("is_main"), "n_langs")
