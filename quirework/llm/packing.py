"""Problem 8: filling containers of fixed capacity with documents.

A document larger than the capacity is cut into full pieces, each a container of its own, and a remainder; all
other documents stay whole. What is left is bin packing, and a packing depends on the documents only by the number
of documents of each size. That histogram has at most ``capacity`` rows however many documents there are; it is
counted by Spark, and the histogram of each profile is packed by one task, none by the driver:

1. Reduction by dominance (Martello-Toth): from the largest size down, sets that provably dominate every other set
   holding that size are fixed at once: alone where nothing fits beside it, with the one size that fills the
   container exactly, with the largest partner where only one fits, or where the partner is worth any two that fit.
2. The remaining, smaller instance is packed best-fit decreasing, containers of equal content at a time.

The packing comes out as a table of runs (size, first rank, last rank, first container). Documents get a rank within
their size, counted over salted buckets so that one frequent size is spread over many tasks, and join their run by
size and block of ranks, so neither a frequent size nor one of many runs meets in one task.

Null texts have 0 tokens; documents of 0 tokens share the first container. Documents with null ids are packed like
others. Profiles with null or non-positive capacity give no rows, nor does an empty table. Equal sizes are ranked
by doc_id. Only the named columns are read, so clashing extra columns do no harm.
"""

from __future__ import annotations

from bisect import bisect_left, insort

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from quirework.runtime import save

#: The histogram of one profile has at most this many rows.
MAX_CAPACITY = 8_000_000
SALT = 256
#: Ranks of a size that are joined with their runs together.
BLOCK = 256


def byte_tokens(text: Column) -> Column:
    """One token a byte of the UTF-8 text; null has 0."""
    return F.coalesce(F.octet_length(text), F.lit(0)).cast("long")


class _Present:
    """Sizes with items left; the largest at or below a bound is found by path compression, as sizes only vanish."""

    def __init__(self, counts: np.ndarray):
        self.n = counts
        self.up = list(range(len(counts)))
        for s in range(1, len(counts)):
            if counts[s] == 0:
                self.up[s] = s - 1
        self.up[0] = 0  # size 0 stands for none

    def at_most(self, s: int) -> int:
        up, root = self.up, s
        while up[root] != root:
            root = up[root]
        while up[s] != root and s != root:
            up[s], s = root, up[s]
        return root

    def take(self, s: int, k: int) -> None:
        self.n[s] -= k
        if self.n[s] == 0:
            self.up[s] = s - 1


def _smallest(n: np.ndarray, start: int, want: int) -> tuple[list[int], int]:
    """The ``want`` smallest items left, and where to go on looking."""
    while start < len(n) and n[start] == 0:
        start += 1
    got, s = [], start
    while s < len(n) and len(got) < want:
        got += [s] * int(min(n[s], want - len(got)))
        s += 1
    return got, start


def reduce_by_dominance(counts: np.ndarray, capacity: int) -> list[tuple[int, list[tuple[int, int]]]]:
    """Fixes dominating sets, taking their items out of ``counts``. Returns groups (containers, [(size, each), ...])."""
    left, fixed, start = _Present(counts), [], 1
    j = left.at_most(capacity)
    while j:
        c = int(counts[j])
        least, start = _smallest(counts, start, 4)
        others = list(least)
        if j in others:
            others.remove(j)
        room = capacity - j
        if not others or others[0] > room:
            fixed.append((c, [(j, 1)]))
            left.take(j, c)
        else:
            k = left.at_most(room)
            only_one = len(others) < 2 or others[0] + others[1] > room
            worth = False
            if j + k < capacity and not only_one and (len(others) < 3 or sum(others[:3]) > room):
                sizes = np.flatnonzero(counts[1 : room + 1]) + 1
                fit = np.searchsorted(sizes, room - sizes, side="right") - 1
                ok = fit >= 0
                worth = not ok.any() or k >= int((sizes[ok] + sizes[fit[ok]]).max())
            if k and (j + k == capacity or only_one or worth):
                if k == j:
                    if c >= 2:
                        fixed.append((c // 2, [(j, 2)]))
                        left.take(j, c // 2 * 2)
                    else:  # the size's last item: its partner is the next smaller size, judged anew
                        k = left.at_most(min(room, j - 1))
                        if k and (j + k == capacity or only_one):
                            fixed.append((1, [(j, 1), (k, 1)]))
                            left.take(j, 1)
                            left.take(k, 1)
                else:
                    m = min(c, int(counts[k]))
                    fixed.append((m, [(j, 1), (k, 1)]))
                    left.take(j, m)
                    left.take(k, m)
                    if counts[j]:
                        continue
        j = left.at_most(j - 1) if j > 1 else 0
    return fixed


def best_fit(counts: np.ndarray, capacity: int) -> list[tuple[int, list[tuple[int, int]]]]:
    """Best-fit decreasing over a histogram; containers of equal content are handled as one group."""
    rooms: list[int] = []  # sorted distinct rooms of open groups
    groups: dict[int, list[tuple[int, tuple]]] = {}  # room -> (containers, linked content)
    closed: list[tuple[int, tuple]] = []

    def put(room: int, n: int, content: tuple) -> None:
        if room == 0:
            closed.append((n, content))
            return
        if room not in groups:
            insort(rooms, room)
            groups[room] = []
        groups[room].append((n, content))

    for s in np.flatnonzero(counts[1:])[::-1] + 1:
        s, c = int(s), int(counts[s])
        while c:
            i = bisect_left(rooms, s)
            if i == len(rooms):
                break
            room = rooms[i]
            n, content = groups[room].pop()
            if not groups[room]:
                del groups[room]
                rooms.pop(i)
            # as many of the size as the container takes: best fit would return to it, its room being the least
            each = min(room // s, -(-c // n)) if c >= n else 1
            m = min(n, c // each)
            if m < n:
                put(room, n - m, content)
            c -= m * each
            put(room - each * s, m, (content, s, each))
        if c:
            per = capacity // s
            if c // per:
                put(capacity - per * s, c // per, (None, s, per))
            if c % per:
                put(capacity - c % per * s, 1, (None, s, c % per))
    out = []
    for n, content in [*closed, *(g for room in rooms for g in groups[room])]:
        items = []
        while content is not None:
            content, s, each = content
            items.append((s, each))
        out.append((n, items))
    return out


def pack_histogram(counts: np.ndarray, capacity: int) -> tuple[list[tuple[int, list[tuple[int, int]]]], int]:
    """All groups of containers for ``counts[size]`` items of each size from 1 to ``capacity``, those fixed by dominance
    first, and how many these are."""
    counts = counts.copy()
    fixed = reduce_by_dominance(counts, capacity)
    return fixed + best_fit(counts, capacity), len(fixed)


_RUNS = "profile string, size long, first long, last long, container long, each long, placed_by string"


def _planned(key: tuple, frame: pd.DataFrame) -> pd.DataFrame:
    """Runs of one profile from its histogram ``size, n``."""
    profile, capacity = key[0], int(key[1])
    counts = np.zeros(capacity + 1, dtype=np.int64)
    np.add.at(counts, frame["size"].to_numpy(), frame["n"].to_numpy())
    groups, n_fixed = pack_histogram(counts, capacity)
    rows = [(profile, 0, 0, int(counts[0]), 0, int(counts[0]), "best_fit")] if counts[0] else []
    rank: dict[int, int] = {}
    container = 0
    for i, (n, items) in enumerate(groups):
        for s, each in items:
            first = rank.get(s, 0)
            rank[s] = first + n * each
            rows.append((profile, s, first, first + n * each, container, each, "dominance" if i < n_fixed else "best_fit"))
        container += n
    return pd.DataFrame(rows, columns=[c.split(" ")[0] for c in _RUNS.split(", ")])


def pack(docs: DataFrame, doc_id: str, tokens: Column, profiles: DataFrame, profile: str = "profile", capacity: str = "capacity") -> DataFrame:
    """One row for each piece of each document and profile.

    Columns: ``profile, doc_id, n_pieces, piece`` (from 0), ``piece_tokens, container, placed_by`` (full, dominance or
    best_fit). Containers named ``f:<doc>:<piece>`` hold one full piece, ``s:<n>`` are shared. Profiles, at most 10,000,
    are read by the driver; a capacity is at most ``MAX_CAPACITY``.
    """
    caps = {
        r[0]: int(r[1])
        for r in profiles.select(profile, capacity).where(F.col(capacity) > 0).where(F.col(profile).isNotNull()).distinct().limit(10_001).collect()
    }
    if len(caps) > 10_000 or max(caps.values(), default=0) > MAX_CAPACITY:
        raise ValueError(f"at most 10,000 profiles, of a capacity of at most {MAX_CAPACITY}")
    each_cap = F.array(*(F.struct(F.lit(p).alias("profile"), F.lit(c).cast("long").alias("cap")) for p, c in caps.items()))
    base = docs.select(F.col(doc_id).alias("doc_id"), tokens.cast("long").alias("_t"))
    if not caps:
        base, each_cap = base.limit(0), F.array(F.struct(F.lit("").alias("profile"), F.lit(1).cast("long").alias("cap")))
    saved = save(base)
    per = saved.df.select("doc_id", "_t", F.explode(each_cap).alias("_p")).select("doc_id", "_t", "_p.profile", "_p.cap")
    n_full = F.when(F.col("_t") > F.col("cap"), F.expr("_t div cap")).otherwise(F.lit(0))
    per = per.withColumns({"_full": n_full, "size": F.col("_t") - n_full * F.col("cap")})
    shared = per.where((F.col("size") > 0) | (F.col("_t") == 0))
    hist = shared.groupBy("profile", "cap", "size").agg(F.count(F.lit(1)).alias("n"))
    runs = save(hist.groupBy("profile", "cap").applyInPandas(_planned, _RUNS)).df
    blocks = F.explode(F.sequence(F.expr(f"first div {BLOCK}"), F.expr(f"(last - 1) div {BLOCK}"))).alias("_block")
    runs = runs.select("profile", "size", blocks, "first", "last", "container", "each", "placed_by")

    w = Window.partitionBy("profile", "size", "_salt")
    salted = shared.select("profile", "doc_id", "size", "_full", F.pmod(F.xxhash64("doc_id"), F.lit(SALT)).alias("_salt"))
    offsets = salted.groupBy("profile", "size", "_salt").agg(F.count(F.lit(1)).alias("_c"))
    offsets = offsets.withColumn("_off", F.sum("_c").over(Window.partitionBy("profile", "size").orderBy("_salt")) - F.col("_c")).drop("_c")
    ranked = salted.withColumn("_r", F.row_number().over(w.orderBy("doc_id")) - 1).join(offsets.hint("merge"), ["profile", "size", "_salt"])
    ranked = ranked.withColumn("_r", F.col("_r") + F.col("_off")).withColumn("_block", F.expr(f"_r div {BLOCK}"))
    placed = ranked.join(runs.hint("merge"), ["profile", "size", "_block"]).where((F.col("_r") >= F.col("first")) & (F.col("_r") < F.col("last")))
    rest = placed.select(
        "profile",
        "doc_id",
        (F.col("_full") + 1).alias("n_pieces"),
        F.col("_full").alias("piece"),
        F.col("size").alias("piece_tokens"),
        F.concat(F.lit("s:"), (F.col("container") + F.floor((F.col("_r") - F.col("first")) / F.col("each"))).cast("long").cast("string")).alias("container"),
        "placed_by",
    )
    full = per.where(F.col("_full") > 0).select(
        "profile",
        "doc_id",
        (F.col("_full") + F.when(F.col("size") > 0, 1).otherwise(0)).alias("n_pieces"),
        F.explode(F.sequence(F.lit(0).cast("long"), F.col("_full") - 1)).alias("piece"),
        F.col("cap").alias("piece_tokens"),
    )
    full = full.withColumns({"container": F.concat_ws(":", F.lit("f"), F.col("doc_id").cast("string"), F.col("piece").cast("string")), "placed_by": F.lit("full")})
    out = rest.unionByName(full)
    return out.select("profile", "doc_id", F.col("n_pieces").cast("int").alias("n_pieces"), F.col("piece").cast("int").alias("piece"), "piece_tokens", "container", "placed_by")


def fill(pieces: DataFrame, profiles: DataFrame) -> DataFrame:
    """Per profile: ``capacity, n_containers, tokens, least_containers`` (tokens over capacity) and ``fill`` in percent."""
    per = pieces.groupBy("profile", "container").agg(F.sum("piece_tokens").alias("_t"))
    tot = per.groupBy("profile").agg(F.count(F.lit(1)).alias("n_containers"), F.sum("_t").alias("tokens"), F.max("_t").alias("fullest"))
    return tot.join(profiles.select("profile", F.col("capacity").cast("long").alias("capacity")), "profile").select(
        "profile",
        "capacity",
        "n_containers",
        "tokens",
        "fullest",
        F.ceil(F.col("tokens") / F.col("capacity")).alias("least_containers"),
        F.round(100 * F.col("tokens") / (F.col("n_containers") * F.col("capacity")), 3).alias("fill"),
    )


def placements(pieces: DataFrame) -> DataFrame:
    """Per profile and ``placed_by``: ``n_pieces, n_containers, tokens``."""
    per = pieces.groupBy("profile", "placed_by", "container").agg(F.count(F.lit(1)).alias("_n"), F.sum("piece_tokens").alias("_t"))
    return per.groupBy("profile", "placed_by").agg(F.sum("_n").alias("n_pieces"), F.count(F.lit(1)).alias("n_containers"), F.sum("_t").alias("tokens"))


def wholeness(pieces: DataFrame, profiles: DataFrame) -> DataFrame:
    """Per profile, as counted in the packing: ``tokens``, ``n_docs`` (ids placed), ``n_cut``, ``n_over`` (containers over capacity),
    ``n_loose`` (pieces of cut documents but for the last that fill no container)."""
    c = profiles.select("profile", F.col("capacity").cast("long").alias("_cap"))
    p = pieces.join(c, "profile")
    per = p.groupBy("profile", "container", "_cap").agg(F.sum("piece_tokens").alias("_t"))
    over = per.groupBy("profile").agg(F.sum("_t").alias("tokens"), F.count_if(F.col("_t") > F.col("_cap")).alias("n_over"))
    docs = p.groupBy("profile", "doc_id").agg(F.max("piece").alias("_last"), F.count_if(F.col("piece_tokens") < F.col("_cap")).alias("_part"))
    docs = docs.groupBy("profile").agg(F.count(F.lit(1)).alias("n_docs"), F.count_if(F.col("_last") > 0).alias("n_cut"), F.count_if((F.col("_part") > 1)).alias("n_loose"))
    return over.join(docs, "profile").select("profile", "tokens", "n_docs", "n_cut", "n_over", "n_loose")
