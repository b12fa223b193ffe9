"""Problem 4: texts that look alike but are stored with different characters.

Look-alike letters, full-width forms, ligatures, spaces of other widths and invisible characters are mapped by one
``translate``; values are then composed (NFC) and grouped under the accent-sensitive and case-sensitive UNICODE
collation. The least stored text of each class is its canonical member and is joined back to the records.

All texts are not shuffled for this: a coarse block key (a hash of the text without accents, marks, spaces,
punctuation and the letters that ligatures hide) is grouped first, on rows of a few numbers. Texts equal in looks
have equal block keys, whatever the script and however characters are composed, so only blocks that hold different
stored texts are read again and compared in full. Texts of those letters alone have a key with the ligatures written
out instead.

Null and blank texts, and texts without letters or digits, have no look-alikes. Exact copies are one text: they are
no pair. Repeated rows of one id and text count once. An empty table gives no rows. Null ids never pair.
"""

from __future__ import annotations

import unicodedata
from functools import cache

import pandas as pd
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from quirework.runtime import save, small

# Letters of other scripts that print like a Latin letter.
CYRILLIC = ("аеорсухіѕјһԁԛԝӏАВЕКМНОРСТУХІЅЈԌԚԜӀёЁїЇ", "aeopcyxisjhdqwlABEKMHOPCTYXISJGQWIëËïÏ")
GREEK = ("ονΑΒΕΖΗΙΚΜΝΟΡΤΥΧϳ", "ovABEZHIKMNOPTYXj")
# Ligatures and what they stand for.
LIGATURES = {"ﬀ": "ff", "ﬁ": "fi", "ﬂ": "fl", "ﬃ": "ffi", "ﬄ": "ffl", "ﬅ": "st", "ﬆ": "st"}

_SCAN = [*range(0x80, 0x600), *range(0x1E00, 0x2070), *range(0x2FF0, 0x3001), *range(0xFE00, 0xFE10), 0xFEFF, *range(0xFF01, 0xFF5F)]


def _looks() -> dict[str, str]:
    """Character to the one it is shown as; '' for invisible ones."""
    m = {}
    for cp in _SCAN:
        c = chr(cp)
        kind = unicodedata.category(c)
        if kind == "Zs":
            m[c] = " "
        elif kind == "Cf" or 0xFE00 <= cp < 0xFE10:
            m[c] = ""
        elif cp >= 0xFF01:
            m[c] = unicodedata.normalize("NFKC", c)
    # letters and digits of other fonts and widths, by their decomposition
    for cp in [*range(0x2100, 0x2150), *range(0xFF5F, 0xFFEF), *range(0x1D400, 0x1D800)]:
        c = chr(cp)
        if unicodedata.decomposition(c).startswith(("<font>", "<wide>", "<narrow>")) and len(to := unicodedata.normalize("NFKC", c)) == 1:
            m[c] = to
    m["\t"] = " "
    m["‐"] = m["‑"] = "-"
    for a, b in (CYRILLIC, GREEK):
        m.update(zip(a, b, strict=True))
    return m


LOOKS = _looks()


@cache
def _composed() -> tuple[dict[str, str], frozenset[str]]:
    """All characters that Unicode decomposes, with their parts, and all characters that join another: marks and later parts."""
    every = [chr(cp) for cp in range(0x80, 0x30000) if not 0xD800 <= cp < 0xE000]
    parts = {c: d for c in every if (d := unicodedata.normalize("NFD", c)) != c}
    return parts, frozenset(c for c in every if unicodedata.combining(c)).union(*(d[1:] for d in parts.values()))


@cache
def _coarse(hidden: str = "filst") -> dict[str, str]:
    """Character to its block letter: also without accents, with nothing but letters and digits, none of them ``hidden``.

    A composed character has the block letter of its first part, and the others none, so that it does not matter how or in
    what order a text is composed.
    """
    m = dict(LOOKS)
    for cp in [*range(0x20), *range(0x21, 0x80)]:
        c = chr(cp)
        if not c.isalnum() or c in hidden:
            m[c] = ""
    for cp in [*range(0x80, 0x600), *range(0x1E00, 0x1F00), 0xFB00, 0xFB01, 0xFB02, 0xFB03, 0xFB04, 0xFB05, 0xFB06, *range(0x2010, 0x2070)]:
        c = chr(cp)
        base = "".join(x for x in unicodedata.normalize("NFD", c) if not unicodedata.combining(x))
        base = "".join(LOOKS.get(x, x) for x in base)
        keep = len(base) == 1 and base.isalnum() and c not in LIGATURES
        m[c] = base if keep and base not in hidden else ""
    for c, to in LOOKS.items():
        if to == " " or to in hidden or (to and not to.isalnum()):
            m[c] = ""
        elif len(to) == 1 and to:
            m[c] = "".join(x for x in unicodedata.normalize("NFD", to) if not unicodedata.combining(x))
    m[" "] = ""
    parts, joining = _composed()
    m.update(dict.fromkeys(joining, ""))
    shown = {c: LOOKS.get(c, c) for c in [*parts, *LOOKS]}
    first = {c: parts.get(x, x)[0] for c, x in shown.items() if x}
    m.update({c: m.get(x, x) for c, x in first.items()})
    return {a: b for a, b in m.items() if a != b}


def _translate(c: Column, m: dict[str, str]) -> Column:
    kept = [(a, b) for a, b in m.items() if b]
    gone = [a for a, b in m.items() if not b]
    return F.translate(c, "".join(a for a, _ in kept) + "".join(gone), "".join(b for _, b in kept))


def block_text(c: Column) -> Column:
    return _translate(c, _coarse())


def mapped(c: Column) -> Column:
    """The text in the characters it shows: equal looks are equal under the UNICODE collation."""
    out = _translate(c, {a: b for a, b in LOOKS.items() if a != b})
    for a, b in LIGATURES.items():
        out = F.replace(out, F.lit(a), F.lit(b))
    return F.regexp_replace(out, " {2,}", " ")


def block_key(c: Column) -> Column:
    """``block_text``; of texts of which it leaves nothing, their letters f, i, l, s and t, or one key for all of joining letters.

    Empty without letters and digits.
    """
    letters = F.nullif(_translate(mapped(c), _coarse("")), F.lit(""))
    return F.coalesce(F.nullif(block_text(c), F.lit("")), letters, F.when(mapped(c).rlike(r"[\p{L}\p{N}]"), "?").otherwise(""))


def _block(b: Column) -> list[Column]:
    return [F.xxhash64(b).alias("_k1"), F.hash(b, F.lit(7)).alias("_k2")]


@F.pandas_udf(T.StringType())
def _nfc(text: pd.Series) -> pd.Series:
    return text.map(lambda t: t if t.isascii() else unicodedata.normalize("NFC", t))


def _marks(c: Column) -> Column:
    """The marks in their places: the collation does not see some of them (those of chant and recitation), a reader does."""
    seen = F.regexp_replace(c, r"[\x01-\x08\x0e-\x1f\x7f-\x84\x86-\x9f\x{34f}]", "")
    return F.regexp_replace(seen, r"(?s)[^\p{M}]", ".")


def classes(records: DataFrame) -> DataFrame:
    """Classes of at least two different stored texts that look the same.

    records: ``record_kind, id, text``. Returns ``record_kind, id, text, form, class_id`` with the canonical member's
    text as ``form`` and its least id as ``class_id``, one row per record.
    """
    r = records.select("record_kind", F.col("id").cast("long").alias("id"), "text").where(F.col("text").isNotNull() & F.col("id").isNotNull())
    key = block_key(F.col("text"))
    narrow = r.select("record_kind", "id", key.alias("_b"), F.xxhash64("text").alias("_h")).where("_b <> ''")
    narrow = narrow.select("record_kind", "id", "_h", *_block(F.col("_b")))
    blocks = narrow.groupBy("record_kind", "_k1", "_k2").agg(F.min("_h").alias("_lo"), F.max("_h").alias("_hi")).where("_lo <> _hi").drop("_lo", "_hi")
    blocks = save(blocks).df
    ids = save(narrow.join(small(blocks), ["record_kind", "_k1", "_k2"]).select("record_kind", "id", "_k1", "_k2").distinct()).df
    # an id may have several texts: only those of the block come with it
    full = r.join(small(ids.select("record_kind", "id").distinct()), ["record_kind", "id"]).distinct()
    full = full.select("record_kind", "id", "text", *_block(key), mapped(F.col("text")).alias("_m"))
    full = full.join(small(blocks), ["record_kind", "_k1", "_k2"], "left_semi").withColumn("_m", _nfc("_m"))
    full = save(full.withColumn("_v", _marks(F.col("_m")))).df
    spark = records.sparkSession
    return spark.sql(
        """
        WITH looks AS (SELECT record_kind, id, _k1, _k2, _v, text, _m COLLATE UNICODE AS look FROM {full}),
        canon AS (
            SELECT record_kind, _k1, _k2, _v, look, min(struct(text, id)) AS c
            FROM looks GROUP BY record_kind, _k1, _k2, _v, look HAVING min(text) <> max(text))
        SELECT l.record_kind, l.id, l.text, canon.c.text AS form, canon.c.id AS class_id
        FROM looks l JOIN canon ON l.record_kind = canon.record_kind AND l._k1 = canon._k1 AND l._k2 = canon._k2 AND l._v = canon._v AND l.look = canon.look
        """,
        full=full,
    )


#: Members of a class that one task pairs with the others.
TOGETHER = 4096


def pairs(members: DataFrame) -> DataFrame:
    """Pairs of records of one class with different stored texts: ``record_kind, id_a, id_b`` (id_a < id_b).

    A class of more than ``TOGETHER`` members is split: one side of the join is salted by id, the other repeated for each
    salt, so no class of any size meets in one task.
    """
    m = save(members.select("record_kind", "class_id", F.sha2("form", 256).alias("_f"), "id", F.sha2("text", 256).alias("_t"))).df
    salts = m.groupBy("record_kind", "class_id", "_f").agg(F.ceil(F.count(F.lit(1)) / F.lit(TOGETHER)).cast("int").alias("_n"))
    m = m.join(salts, ["record_kind", "class_id", "_f"])
    a = m.withColumn("_salt", F.explode(F.sequence(F.lit(0), F.col("_n") - 1))).alias("a")
    b = m.withColumn("_salt", F.pmod(F.xxhash64("id"), F.col("_n").cast("long")).cast("int")).alias("b")
    same = F.lit(True)
    for c in ("record_kind", "class_id", "_f", "_salt"):
        same = same & (F.col(f"a.{c}") == F.col(f"b.{c}"))
    j = a.join(b, same & (F.col("a.id") < F.col("b.id")) & (F.col("a._t") != F.col("b._t")))
    return j.select(F.col("a.record_kind").alias("record_kind"), F.col("a.id").alias("id_a"), F.col("b.id").alias("id_b"))


def sql_look(text: str, looks: dict[str, str] | None = None, one_space: bool = True) -> str:
    """``mapped`` as SQL for DuckDB, composed: equal looks give equal strings. ``looks``: another map than ``LOOKS``."""
    quote = lambda x: "'" + x.replace("'", "''") + "'"
    looks = {a: b for a, b in (LOOKS if looks is None else looks).items() if a != b}
    kept = {a: b for a, b in looks.items() if b}
    gone = [a for a, b in looks.items() if not b]
    out = f"translate({text}, {quote(''.join(kept) + ''.join(gone))}, {quote(''.join(kept.values()))})"
    for a, b in LIGATURES.items():
        out = f"replace({out}, {quote(a)}, {quote(b)})"
    return f"nfc_normalize(regexp_replace({out}, ' {{2,}}', ' ', 'g'))" if one_space else f"nfc_normalize({out})"
