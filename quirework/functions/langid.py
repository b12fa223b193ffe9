"""A small language scorer for pages: character trigrams, naive Bayes, trained from labelled texts by Spark counts."""

from __future__ import annotations

import math
import zlib
from collections.abc import Callable

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

#: Trigrams are hashed to so many buckets: all of them count, and the driver holds a bounded table per label.
BUCKETS = 1 << 16


def bucket(gram: str) -> int:
    return zlib.crc32(gram.encode()) % BUCKETS


def trigram_counts(texts: DataFrame, text: str, label: str) -> dict[str, dict[int, int]]:
    """Counts of hashed trigrams of each label; at most ``BUCKETS`` rows per label reach the driver."""
    padded = F.concat(F.lit(" "), F.lower(F.regexp_replace(F.col(text), r"[^\p{L}]+", " ")), F.lit(" "))
    n = F.length("_t") - 2
    grams = F.transform(F.sequence(F.lit(1), n), lambda i: F.substr(F.col("_t"), i, F.lit(3)))
    d = texts.where(F.col(text).isNotNull() & F.col(label).isNotNull()).select(F.col(label).alias("_l"), padded.alias("_t")).where(n >= 1)
    at = F.pmod(F.crc32(F.col("_g").cast("binary")), F.lit(BUCKETS)).cast("int")
    c = d.select("_l", F.explode(grams).alias("_g")).groupBy("_l", at.alias("_b")).count()
    out: dict[str, dict[int, int]] = {}
    for r in c.toLocalIterator():
        out.setdefault(r["_l"], {})[r["_b"]] = r["count"]
    return out


def scorer(counts: dict[str, dict[int, int]]) -> Callable[[], Callable[[list[str]], list[str | None]]]:
    """A factory of a function from texts to labels; null for texts without letters or without any model."""

    def make() -> Callable[[list[str]], list[str | None]]:
        labels = sorted(counts)
        total = {l: sum(counts[l].values()) + len(counts[l]) + 1 for l in labels}
        floor = {l: -math.log(total[l]) for l in labels}
        table: dict[int, list[float]] = {}
        for k, l in enumerate(labels):
            for g, n in counts[l].items():
                table.setdefault(g, [floor[x] for x in labels])[k] = math.log((n + 1) / total[l])
        base = [floor[l] for l in labels]

        def one(text: str) -> str | None:
            t = " " + " ".join("".join(c if c.isalpha() else " " for c in text.lower()).split()) + " "
            if not labels or len(t) < 3 or t.isspace():
                return None
            score = [0.0] * len(labels)
            for i in range(len(t) - 2):
                for k, v in enumerate(table.get(bucket(t[i : i + 3]), base)):
                    score[k] += v
            return labels[max(range(len(labels)), key=score.__getitem__)]

        return lambda texts: [one(t) for t in texts]

    return make
