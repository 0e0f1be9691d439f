"""Long exact spans shared between records.

Method. A de Bruijn graph over a sampled alphabet. Of every WINDOW neighbouring character
k-grams the one with the smallest hash is a token, so any two texts with a common run of
``least`` = k + window - 1 characters have a token in common, at the same place of the run,
and its choice depends on nothing outside of the run. Tokens that lie in more than one text
are nodes; neighbouring tokens and the distance between them are edges. A path whose nodes
have one way in and one way out, in all their places, is compacted to its first node by
pointer doubling through joins. Texts that have a path in common give one alignment for the
whole path; the characters along that alignment then decide, so nothing rests on hashes.

Equal texts are one text here: the first of them stands for its class, and pairs are
given for classes or, expanded, for all members.
"""

from __future__ import annotations

from collections.abc import Iterator
from functools import partial

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from lontar.stage import Stages

LEAST = 240  # characters of a span
GRAM = 120  # characters of a token; a window has LEAST - GRAM + 1 of them
SEGMENT = 400_000  # characters hashed at once

_BASE = 0x9E3779B97F4A7C15
_INVERSE = pow(_BASE, -1, 1 << 64)
_TOP = np.uint64(0xFFFFFFFFFFFFFFFF)


def _codes(text: str) -> np.ndarray:
    return np.frombuffer(text.encode("utf-32-le", "surrogatepass"), np.uint32)


def _powers(base: int, n: int) -> np.ndarray:
    p = np.full(n, base, np.uint64)
    p[0] = 1
    return np.cumprod(p)


def gram_hashes(codes: np.ndarray, k: int) -> np.ndarray:
    """A 64-bit hash of each k-gram: a polynomial in an odd base, from prefix sums, then mixed."""
    n = len(codes)
    c = (codes.astype(np.uint64) + np.uint64(1)) * np.uint64(0xD6E8FEB86659FD93)
    c ^= c >> np.uint64(32)
    c *= _powers(_INVERSE, n)
    sums = np.zeros(n + 1, np.uint64)
    np.cumsum(c, out=sums[1:])
    h = (sums[k:] - sums[:-k]) * _powers(_BASE, n - k + 1)
    for shift, factor in ((31, 0x7FB5D329728EA185), (27, 0x81DADEF4BC2DD44D)):
        h ^= h >> np.uint64(shift)
        h *= np.uint64(factor)
    return h ^ (h >> np.uint64(33))


def _slide(a: np.ndarray, w: int, f: np.ufunc, fill: np.uint64) -> np.ndarray:
    """f over every w neighbours, from running values inside blocks of w."""
    n = len(a)
    p = np.full(-(-n // w) * w + w, fill, np.uint64)
    p[:n] = a
    blocks = p.reshape(-1, w)
    before = f.accumulate(blocks, axis=1).ravel()
    after = np.ascontiguousarray(f.accumulate(blocks[:, ::-1], axis=1)[:, ::-1]).ravel()
    return f(after[: n - w + 1], before[w - 1 : n])


def tokens(texts: list[str], k: int, w: int) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """(index of the text, position, hash) of the tokens of texts, ordered by text and position."""
    codes = _codes("".join(texts))
    size = np.array([len(t) for t in texts])
    start = np.cumsum(size) - size
    least = k + w - 1
    if len(codes) < least:
        none = np.zeros(0, np.int64)
        return none, none, none.astype(np.uint64)
    h = gram_hashes(codes, k)
    owner = np.repeat(np.arange(len(texts)), size)
    lowest = _slide(h, w, np.minimum, _TOP)
    lowest[owner[: len(lowest)] != owner[least - 1 : least - 1 + len(lowest)]] = 0  # windows over two texts
    pad = np.zeros(w - 1, np.uint64)
    chosen = _slide(np.concatenate([pad, lowest, pad]), w, np.maximum, np.uint64(0))
    at = np.flatnonzero((chosen == h) & (h > 0))
    return owner[at], at - start[owner[at]], h[at]


def _chains(doc: np.ndarray, pos: np.ndarray, h: np.ndarray, w: int) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """(index of the first token, gap, count). Equal tokens less than a window apart mean text that
    repeats itself. Those of one gap are one chain; where the gap changes a token is in both chains."""
    order = np.lexsort((pos, h, doc))
    d, p, x = doc[order], pos[order], h[order]
    near = (d[1:] == d[:-1]) & (x[1:] == x[:-1]) & (p[1:] - p[:-1] < w)
    gap = np.zeros(len(p) + 1, np.int64)  # to the token before; 0 without one
    gap[1 : len(p)] = np.where(near, p[1:] - p[:-1], 0)
    here = gap[:-1]
    alone = np.flatnonzero((here == 0) & (gap[1:] == 0))
    begins = np.flatnonzero((here > 0) & (here != np.r_[0, here[:-1]]))
    ends = np.flatnonzero((here > 0) & (here != gap[1:]))
    one = np.ones(len(alone), np.int64)
    return order[np.r_[alone, begins - 1]], np.r_[one * 0, here[begins]], np.r_[one, ends - begins + 2]


def _token_rows(batches: Iterator[pd.DataFrame], k: int, w: int) -> Iterator[pd.DataFrame]:
    least = k + w - 1

    def rows(part: list[tuple[int, int, str]]) -> pd.DataFrame:
        owner, pos, h = tokens([x[2] for x in part], k, w)
        doc = np.array([x[0] for x in part], np.int64)[owner]
        pos = pos + np.array([x[1] for x in part], np.int64)[owner]
        first, gap, n = _chains(owner, pos, h, w)
        return pd.DataFrame({"h": h[first].view(np.int64), "doc": doc[first], "pos": pos[first].astype(np.int32), "gap": gap.astype(np.int32), "n": n.astype(np.int32)})

    for b in batches:
        part, chars = [], 0
        for doc, text in zip(b["doc"], b["text"], strict=True):
            for at in range(0, len(text) - least + 1, SEGMENT):
                piece = text[at : at + SEGMENT + least - 1]
                part.append((doc, at, piece))
                chars += len(piece)
                if chars >= SEGMENT:
                    yield rows(part)
                    part, chars = [], 0
        if part:
            yield rows(part)


def _runs(batches: Iterator[pd.DataFrame], least: int) -> Iterator[pd.DataFrame]:
    """Common runs along the alignments of two texts: text_a at i lies on text_b at i - shift."""
    for d in batches:
        out = []
        for a, b, ways, text_a, text_b in zip(d["doc_a"], d["doc_b"], d["ways"], d["text_a"], d["text_b"], strict=True):
            x, y = _codes(text_a), _codes(text_b)
            each = [(low + np.arange(n) * gap)[:, None] + np.arange(n2) * gap2 for low, gap, n, gap2, n2 in ways]
            for shift in np.unique(np.concatenate([e.ravel() for e in each])).tolist():
                from_a = max(0, shift)
                n = min(len(x) - from_a, len(y) - (from_a - shift))
                if n < least:
                    continue
                same = x[from_a : from_a + n] == y[from_a - shift : from_a - shift + n]
                edge = np.flatnonzero(np.diff(np.r_[False, same, False].astype(np.int8)))
                for s, e in zip(edge[::2], edge[1::2], strict=True):
                    if e - s >= least:
                        out.append((a, b, from_a + s, from_a + s - shift, e - s))
        yield pd.DataFrame(out, columns=["doc_a", "doc_b", "start_a", "start_b", "length"])


def compact(places: DataFrame, stages: Stages) -> DataFrame:
    """Paths of the graph over ``places`` (h, doc, pos): for each node that is not the first of
    its path the first node and the distance to it."""
    w = Window.partitionBy("doc").orderBy("pos", "h")
    steps = places.select("h", F.struct(F.lag("h").over(w).alias("h"), (F.col("pos") - F.lag("pos").over(w)).alias("gap")).alias("back"), F.struct(F.lead("h").over(w).alias("h"), (F.lead("pos").over(w) - F.col("pos")).alias("gap")).alias("on"))
    one = lambda s: [F.min(f"{s}.h").alias(f"{s}_h"), F.max(f"{s}.h").alias(f"{s}_h2"), F.min(f"{s}.gap").alias(f"{s}_gap"), F.max(f"{s}.gap").alias(f"{s}_gap2"), F.count(f"{s}.h").alias(f"{s}_n")]
    nodes = steps.groupBy("h").agg(F.count("*").alias("n"), *one("back"), *one("on"))
    sole = lambda s: (F.col(f"{s}_n") == F.col("n")) & (F.col(f"{s}_h") == F.col(f"{s}_h2")) & (F.col(f"{s}_gap") == F.col(f"{s}_gap2"))
    nodes = stages.write(nodes.select("h", F.when(sole("back"), F.col("back_h")).alias("back"), F.when(sole("back"), F.col("back_gap")).alias("gap"), F.when(sole("on"), F.col("on_h")).alias("on")), "nodes")
    before = nodes.select(F.col("h").alias("back"), F.col("on").alias("their_on"))
    links = nodes.filter("back is not null and back <> h").join(before, "back").filter(F.col("their_on") == F.col("h"))
    links = stages.write(links.select("h", F.col("back").alias("first"), F.col("gap").cast("long").alias("off")), "links0")
    rounds = int(links.count()).bit_length() + 1
    for i in range(rounds):
        far = links.select(F.col("h").alias("first"), F.col("first").alias("far"), F.col("off").alias("more"))
        new = stages.write(links.join(far, "first", "left").select("h", F.coalesce("far", "first").alias("first"), (F.col("off") + F.coalesce("more", F.lit(0))).alias("off"), F.col("far").isNotNull().alias("moved")), f"links{i + 1}")
        stages.drop(f"links{i}")
        moved = not new.filter("moved").isEmpty()
        links = new.drop("moved")
        if not moved:
            return links
    # what still moves runs in circles; there each node is a path of its own
    return links.join(links.select(F.col("h").alias("first")), "first", "left_anti")


def shared_runs(texts: DataFrame, least: int = LEAST, gram: int = GRAM) -> DataFrame:
    """Maximal common runs of at least ``least`` characters between different texts of
    ``texts`` (doc bigint, text string; texts distinct): doc_a, doc_b, start_a, start_b, length."""
    stages = Stages(texts.sparkSession, "spans")
    width = least - gram + 1
    long = texts.filter(F.length("text") >= least)
    rows = stages.write(long.mapInPandas(partial(_token_rows, k=gram, w=width), "h long, doc long, pos int, gap int, n int"), "tokens")
    common = rows.groupBy("h").agg(F.min("doc").alias("a"), F.max("doc").alias("b")).filter("a <> b").select("h")
    places = stages.write(rows.join(common, "h", "left_semi"), "places")
    stages.drop("tokens")
    links = compact(places, stages)
    on_path = places.join(links, "h", "left").select(F.coalesce("first", "h").alias("path"), "doc", (F.col("pos") - F.coalesce("off", F.lit(0))).alias("start"), "gap", "n").distinct()
    on_path = stages.write(on_path, "paths")
    a, b = (on_path.select("path", *[F.col(c).alias(f"{c}_{x}") for c in ("doc", "start", "gap", "n")]) for x in "ab")
    # all differences of two chains: of one gap they are a chain again, else every token meets every token
    both_ways = (F.col("n_a") > 1) & (F.col("n_b") > 1) & (F.col("gap_a") != F.col("gap_b"))
    low = F.col("start_a") - F.col("start_b") - (F.col("n_b") - 1) * F.col("gap_b")
    one = [F.greatest("gap_a", "gap_b"), F.col("n_a") + F.col("n_b") - 1, F.lit(0), F.lit(1)]
    way = F.when(both_ways, F.array(*[c.cast("long") for c in (low, F.col("gap_a"), F.col("n_a"), F.col("gap_b"), F.col("n_b"))])).otherwise(F.array(*[c.cast("long") for c in (low, *one)]))
    pairs = a.join(b, "path").filter("doc_a < doc_b").groupBy("doc_a", "doc_b").agg(F.collect_set(way).alias("ways"))
    pairs = stages.write(pairs, "pairs")
    named = pairs.select(F.explode(F.array("doc_a", "doc_b")).alias("doc")).distinct()
    held = stages.write(long.join(named, "doc", "left_semi").select("doc", "text"), "held")
    both = pairs.join(held.select(F.col("doc").alias("doc_a"), F.col("text").alias("text_a")), "doc_a").join(held.select(F.col("doc").alias("doc_b"), F.col("text").alias("text_b")), "doc_b")
    return both.mapInPandas(partial(_runs, least=least), "doc_a long, doc_b long, start_a int, start_b int, length int")


def classes(df: DataFrame, key: str, text: str) -> DataFrame:
    """key bigint, rep bigint: the smallest key with the same text. Null texts have no class."""
    rows = df.filter(F.col(text).isNotNull() & F.col(key).isNotNull()).select(F.col(key).cast("long").alias("key"), F.sha2(text, 256).alias("sha"))
    least = rows.groupBy("sha").agg(F.min("key").alias("rep"))
    return rows.join(least, "sha").select("key", "rep").distinct()


def shared_spans(df: DataFrame, key: str, text: str, least: int = LEAST, gram: int = GRAM) -> tuple[DataFrame, DataFrame]:
    """Runs between class representatives, and the classes (key, rep, n characters).

    Null texts and null keys take no part; empty and short texts share nothing; repeated rows
    count once; a text of any length is read as a whole; an empty table gives empty results;
    further columns are not read.
    """
    stages = Stages(df.sparkSession, "classes")
    members = stages.write(classes(df, key, text), "members")
    texts = df.select(F.col(key).cast("long").alias("doc"), F.col(text).alias("text"))
    # a copy differs from its representative only in its key; the others need no look at a text
    copies = members.filter("key <> rep").select(F.col("key").alias("doc"))
    texts = texts.filter(F.col("text").isNotNull() & F.col("doc").isNotNull()).join(copies, "doc", "left_anti")
    return shared_runs(texts, least, gram), members
