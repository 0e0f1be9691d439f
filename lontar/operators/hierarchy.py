"""Parent-child rows to full hierarchies.

Every row names its parent inside a group (here a document). The operator returns each
node's root, depth, path, Euler-tour interval and number of descendants, and reports
circular and broken links.

Method. Rows are range-partitioned on (group, node), so a block holds neighbouring rows and
a group of any size is spread over blocks. Inside a block, leaves are peeled until only
cycles remain, the Euler tour of every tree is linked, and the tour is ranked by pointer
doubling in numpy. Groups that lie wholly inside a block are finished there. For groups
cut by a block border the block contracts its part of the tour to sublists; the sublists
are ranked by doubling (in one task while they fit a block, with joins beyond that), and
the ranks are sent back. Entry and exit then order the nodes of a tree; a chunk of that
order, opened by the ancestors whose interval spans its start, yields paths, the class of
the root and (ancestor, descendant) pairs.
"""

from __future__ import annotations

from collections.abc import Iterator
from functools import partial

import numpy as np
import pandas as pd
from pyspark import TaskContext
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T
from pyspark.sql.window import Window

from lontar.stage import Stages

BLOCK = 40_000  # rows of a block; what one task holds in memory
PEEL_ROUNDS = 12  # join rounds of peeling before pointer doubling settles the rest
SHIFT = 1 << 32

OUT = "grp string, node string, parent string, label string, stored_depth int, stored_path string, status string, root string, depth int, path array<string>, path_ok boolean, entry long, exit long"
LINKED = "vid long, lpar long, ext string, grp string, node string, parent string, label string, stored_depth int, stored_path string, closed boolean, status string, root string, depth int, path array<string>, path_ok boolean, entry long, exit long"
SLICE = 200_000  # path elements given out at once
PAIRS = "grp string, ancestor string, descendant string, distance int"


def path_key(path: Column) -> Column:
    """An array of labels as one unambiguous string: each element behind its length."""
    one = lambda x: F.concat(F.coalesce(F.length(x), F.lit(-1)).cast("string"), F.lit(":"), F.coalesce(x, F.lit("")))
    return F.array_join(F.transform(path, one), "")


# ---- one block, in numpy -------------------------------------------------------------


def peel(par: np.ndarray, held: np.ndarray | None = None) -> np.ndarray:
    """Remove nodes without remaining children until none is left to remove; True for the
    nodes that stay. ``par`` holds positions, -1 for none; ``held`` nodes are never removed."""
    n = len(par)
    children = np.bincount(par[par >= 0], minlength=n)
    if held is not None:
        children = children + held
    stay = np.ones(n, bool)
    front = np.flatnonzero(children == 0)
    while len(front):
        stay[front] = False
        up = par[front]
        up = up[up >= 0]
        np.subtract.at(children, up, 1)
        up = np.unique(up)
        front = up[children[up] == 0]
    return stay


def tour(par: np.ndarray) -> np.ndarray:
    """Successors in the Euler tours of a forest: element 2v enters v, 2v+1 leaves it; -1 ends."""
    n = len(par)
    nxt = np.empty(2 * n, np.int64)
    v = np.arange(n)
    nxt[2 * v] = 2 * v + 1
    nxt[2 * v + 1] = np.where(par >= 0, 2 * par + 1, -1)
    kids = np.flatnonzero(par >= 0)
    kids = kids[np.argsort(par[kids], kind="stable")]
    if len(kids):
        same = par[kids[1:]] == par[kids[:-1]]
        nxt[2 * kids[:-1][same] + 1] = 2 * kids[1:][same]
        first = kids[np.r_[True, ~same]]
        nxt[2 * par[first]] = 2 * first
    return nxt


def rank(nxt: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Pointer doubling over successor lists: number of elements to the end, sum of +1 for an
    entry and -1 for an exit over them, and the last element of each element's list."""
    n = len(nxt)
    count = np.ones(n + 1, np.int64)
    weight = np.where(np.arange(n + 1) % 2 == 0, 1, -1)
    count[n] = weight[n] = 0
    jump = np.append(np.where(nxt < 0, n, nxt), n)
    last = np.arange(n + 1)
    while True:
        active = jump[:n] < n
        if not active.any():
            return count[:n], weight[:n], last[:n]
        at = np.flatnonzero(active)
        to = jump[at]
        count[at] += count[to]
        weight[at] += weight[to]
        last[at] = last[to]
        jump[at] = jump[to]


def _rows(batches: Iterator[pd.DataFrame]) -> pd.DataFrame | None:
    parts = [b for b in batches if len(b)]
    return pd.concat(parts, ignore_index=True) if parts else None


def _blocks(batches: Iterator[pd.DataFrame], mode: str) -> Iterator[pd.DataFrame]:
    """One range partition: drop repeated keys, resolve parents inside it, finish the groups
    that lie wholly inside. In mode "found" of a finished group only faulty rows go on."""
    d = _rows(batches)
    if d is None:
        return
    d["g"] = ["" if x is None else "\x01" + x for x in d["grp"]]
    d["v"] = ["" if x is None else "\x01" + x for x in d["node"]]
    d = d.sort_values(["g", "v", "at"], ascending=[True, True, False], kind="stable", na_position="last")
    d = d.drop_duplicates(["g", "v"]).reset_index(drop=True)
    n = len(d)
    gcode = pd.factorize(d["g"])[0]
    closed = (gcode != gcode[0]) & (gcode != gcode[-1])
    where = {k: i for i, k in enumerate(zip(gcode.tolist(), d["node"].tolist(), strict=True)) if k[1] is not None}
    named = [None if p is None or p == "" else p for p in d["parent"]]
    par = np.array([-1 if p is None else where.get((c, p), -2) for c, p in zip(gcode.tolist(), named, strict=True)], np.int64)
    base = TaskContext.get().partitionId() * SHIFT
    d["vid"] = base + np.arange(n)
    d["closed"] = closed
    opened = d[~closed].copy()
    opened["lpar"] = pd.array(np.where(par[~closed] >= 0, base + par[~closed], 0), dtype="Int64")
    opened.loc[par[~closed] < 0, "lpar"] = pd.NA
    opened["ext"] = [p if q == -2 else None for p, q in zip([named[i] for i in np.flatnonzero(~closed)], par[~closed], strict=True)]
    for c in ("status", "root", "path", "path_ok"):
        opened[c] = None
    for c in ("depth", "entry", "exit"):
        opened[c] = pd.array([pd.NA] * len(opened), dtype="Int64")
    cols = [c.split()[0] for c in LINKED.split(", ")]
    yield opened[cols]
    at = np.flatnonzero(closed)
    if not len(at):
        return
    inner = np.full(n, -1, np.int64)
    inner[at] = np.arange(len(at))
    lp = par[at]
    up = np.where(lp >= 0, inner[np.maximum(lp, 0)], -1)
    orphan = lp == -2
    cycle = peel(up)
    cut = np.where(cycle, -1, up)
    count, weight, last = rank(tour(cut))
    own = np.arange(len(at))
    root = last[2 * own] // 2
    total = count[2 * root]
    done = d.iloc[at].copy()
    done["entry"], done["exit"] = total - count[2 * own], total - count[2 * own + 1]
    done["lpar"], done["ext"] = pd.array([pd.NA] * len(at), dtype="Int64"), None
    done["cls"] = np.where(cycle, "cycle", np.where(orphan, "orphan", "root"))
    done["depth"], done["tree"] = -weight[2 * own], root
    for out in _walk(done.iloc[np.lexsort((done["entry"].to_numpy(), root))], [], mode == "nodes"):
        yield (out[_faulty(out)] if mode == "found" else out)[cols]


def _piece(label: str | None) -> str:
    """What a label adds to the key of a path, as in :func:`path_key`."""
    return "" if label is None else f"{len(label)}:{label}"


def _walk(d: pd.DataFrame, stack: list[tuple], listed: bool) -> Iterator[pd.DataFrame]:
    """Nodes in order of (tree, entry): the open intervals are the ancestors. ``stack`` has
    (tree, exit, node, label, class, stored path if it is the true one) of those still open and is
    carried on. A stored path is compared with the nearest true one above and the labels below
    that, so no path is built where the stored ones are right; with ``listed`` the paths are given
    out, in slices of bounded size."""
    status, roots, paths, right, begun, held = [], [], [], [], 0, 0

    def made(end: int) -> pd.DataFrame:
        part = d.iloc[begun:end]
        return part.assign(status=status, root=roots, path=pd.Series(paths, index=part.index, dtype=object), path_ok=pd.Series(right, index=part.index, dtype=object))

    names = ("tree", "entry", "exit", "node", "label", "cls", "stored_path")
    for at, (tree, entry, exit_, node, label, cls, stored) in enumerate(zip(*[d[c] for c in names], strict=True)):
        while stack and (stack[-1][0] != tree or stack[-1][1] < entry):
            stack.pop()
        kind = stack[-1][4] if stack else cls
        status.append("ok" if kind == "root" else f"below_{kind}" if stack else kind)
        roots.append(stack[0][2] if stack else node)
        if isinstance(stored, str):
            end, k = len(stored), len(stack)
            piece = _piece(label)
            ok = stored.endswith(piece)
            end -= len(piece)
            while ok and k and stack[k - 1][5] is None:
                k -= 1
                piece = _piece(stack[k][3])
                ok = stored.endswith(piece, 0, max(end, 0)) and end >= len(piece)
                end -= len(piece)
            known = stack[k - 1][5] if k else ""
            ok = ok and end == len(known) and stored.startswith(known)
        else:
            ok = None
        right.append(ok)
        stack.append((tree, exit_, node, label, kind, stored if ok else None))
        path = [x[3] for x in stack if x[3] is not None] if listed else None
        paths.append(path)
        held += len(path) if path else 0
        if held > SLICE:
            yield made(at + 1)
            status, roots, paths, right, begun, held = [], [], [], [], at + 1, 0
    if begun < len(d):
        yield made(len(d))


def _faulty(d: pd.DataFrame) -> pd.Series:
    """Rows with a broken link, or whose stored depth or path is not the true one."""
    depth = d["stored_depth"].notna() & (d["stored_depth"].fillna(-1).astype("int64") != d["depth"].astype("int64"))
    path = np.array([x is False for x in d["path_ok"]], bool)
    return (d["status"] != "ok") | depth | path


# ---- groups cut by block borders ----------------------------------------------------


def _peel_block(d: pd.DataFrame) -> pd.DataFrame:
    d = d.sort_values("vid").reset_index(drop=True)
    here = pd.Series(np.arange(len(d)), index=d["vid"])
    par = here.reindex(d["par"].fillna(-1).astype("int64")).fillna(-1).to_numpy().astype(np.int64)
    stay = peel(par, d["held"].to_numpy().astype(np.int64))
    return d.loc[stay, ["vid", "par"]]


def _peel_rest(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
    d = _rows(batches)
    if d is not None:
        yield _peel_block(d.assign(held=0))[["vid"]]


def _cycles(left: DataFrame, stages: Stages, block: int) -> DataFrame:
    """Of nodes that survived peeling inside their blocks, those on cycles."""
    n = left.count()
    if n <= block:
        return left.repartition(1).mapInPandas(_peel_rest, "vid long")
    for i in range(PEEL_ROUNDS):
        kept = stages.write(left.join(left.select(F.col("par").alias("vid")).distinct(), "vid", "left_semi"), f"peel{i}")
        m = kept.count()
        if m == n:
            return left.select("vid")
        left, n = kept, m
        if n <= block:
            return left.repartition(1).mapInPandas(_peel_rest, "vid long")
    jump = left.filter(F.col("par").isNotNull()).select("vid", F.col("par").alias("to"))
    for i in range(int(n).bit_length()):  # after 2^i >= n steps every target lies on a cycle
        jump = stages.write(jump.alias("a").join(jump.select(F.col("vid").alias("to"), F.col("to").alias("far")), "to").select("vid", F.col("far").alias("to")), f"jump{i}")
    return jump.select(F.col("to").alias("vid")).distinct()


def _part(d: pd.DataFrame, over: pd.DataFrame):
    """A block's part of the tours: its nodes, the rank inside their sublists, and each
    element's successor outside the block (-1 for the end of a tour)."""
    d = d.sort_values("vid").reset_index(drop=True)
    vid = d["vid"].to_numpy()
    here = pd.Series(np.arange(len(d)), index=vid)
    pv = d["par"].fillna(-1).astype("int64").to_numpy()
    par = here.reindex(pv).fillna(-1).to_numpy().astype(np.int64)
    outside = np.where((pv >= 0) & (par < 0), pv, -1)
    sibling = tour(np.where(outside >= 0, -1, par))
    # children of one parent in another block follow each other too
    far = np.flatnonzero(outside >= 0)
    far = far[np.argsort(outside[far], kind="stable")]
    same = outside[far[1:]] == outside[far[:-1]]
    sibling[2 * far[:-1][same] + 1] = 2 * far[1:][same]
    leave = np.full(2 * len(d), -1, np.int64)
    if len(over):
        gid = over["gid"].to_numpy()
        at = 2 * here.reindex(gid // 2).to_numpy().astype(np.int64) + gid % 2
        to = over["to"].to_numpy()
        tv = here.reindex(to // 2).fillna(-1).to_numpy().astype(np.int64)
        sibling[at] = np.where(tv >= 0, 2 * tv + to % 2, -1)
        leave[at] = np.where(tv >= 0, -1, to)
    count, weight, last = rank(sibling)
    return d, vid, sibling, leave, count, weight, last


def _sublists(key: tuple, d: pd.DataFrame, over: pd.DataFrame) -> pd.DataFrame:
    d, vid, nxt, leave, count, weight, last = _part(d, over)
    entered = np.zeros(len(nxt), bool)
    entered[nxt[nxt >= 0]] = True
    head = np.flatnonzero(~entered)
    end = last[head]
    return pd.DataFrame({"head": 2 * vid[head // 2] + head % 2, "to": leave[end], "n": count[head], "w": weight[head], "tail": 2 * vid[end // 2] + end % 2})


def _finish(key: tuple, d: pd.DataFrame, over: pd.DataFrame) -> pd.DataFrame:
    links, ranks = over[over["kind"] == 0], over[over["kind"] == 1]
    d, vid, nxt, leave, count, weight, last = _part(d, links)
    tail = pd.DataFrame({"gid": 2 * vid[last // 2] + last % 2}).merge(ranks[["gid", "n_after", "w_after", "total", "end"]], on="gid", how="left")
    n, w = count + tail["n_after"].to_numpy(), weight + tail["w_after"].to_numpy()
    total, own = tail["total"].to_numpy(), np.arange(len(d))
    return pd.DataFrame({"vid": vid, "tree": tail["end"].to_numpy()[2 * own] // 2, "entry": (total - n)[2 * own], "exit": (total - n)[2 * own + 1], "depth": -w[2 * own]})


def _rank_rest(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
    d = _rows(batches)
    if d is None:
        return
    here = pd.Series(np.arange(len(d)), index=d["head"])
    m = len(d)
    jump = np.append(here.reindex(d["to"]).fillna(m).to_numpy().astype(np.int64), m)
    n, w, last = np.append(d["n"].to_numpy(), 0), np.append(d["w"].to_numpy(), 0), np.arange(m + 1)
    while (at := np.flatnonzero(jump[:m] < m)).size:
        to = jump[at]
        n[at], w[at], last[at], jump[at] = n[at] + n[to], w[at] + w[to], last[to], jump[to]
    end = d["tail"].to_numpy()[last[:m]]
    total = pd.Series(n[:m]).groupby(end).transform("max").to_numpy()
    yield pd.DataFrame({"tail": d["tail"], "n_after": n[:m] - d["n"], "w_after": w[:m] - d["w"], "total": total, "end": end})


def _rank_sublists(lists: DataFrame, stages: Stages, block: int) -> DataFrame:
    """Elements and weight behind each sublist up to the end of its tour, and the tour's length."""
    n = lists.count()
    out = "tail long, n_after long, w_after long, total long, end long"
    if n <= block:
        return lists.repartition(1).mapInPandas(_rank_rest, out)
    now = lists.select("head", "to", F.col("n").alias("an"), F.col("w").alias("aw"), F.col("tail").alias("end"))
    for i in range(2 * int(n).bit_length()):
        b = now.select(F.col("head").alias("to"), F.col("to").alias("t2"), F.col("an").alias("n2"), F.col("aw").alias("w2"), F.col("end").alias("e2"))
        now = stages.write(
            now.join(b, "to", "left").select(
                "head", F.coalesce("t2", F.lit(-1)).alias("to"), (F.col("an") + F.coalesce("n2", F.lit(0))).alias("an"),
                (F.col("aw") + F.coalesce("w2", F.lit(0))).alias("aw"), F.coalesce("e2", "end").alias("end")), f"rank{i}")
        if now.filter(F.col("to") >= 0).isEmpty():
            break
    totals = now.groupBy("end").agg(F.max("an").alias("total"))
    return lists.join(now.select("head", "an", "aw", "end"), "head").join(totals, "end").select("tail", (F.col("an") - F.col("n")).alias("n_after"), (F.col("aw") - F.col("w")).alias("w_after"), "total", "end")


def _chunks(batches: Iterator[pd.DataFrame], mode: str) -> Iterator[pd.DataFrame]:
    """Rows sorted by (tree, chunk, entry); the rows that only open a chunk are not given out."""
    stack: list[tuple] = []
    for d in batches:
        d = d.assign(tree=list(zip(d["tree"], d["chunk"], strict=True)))  # another chunk starts with its own openers
        for out in _walk(d, stack, mode == "nodes"):
            out = out[out["own"]]
            yield (out[_faulty(out)] if mode == "found" else out)[[c.split()[0] for c in OUT.split(", ")]]


def _across_blocks(opened: DataFrame, stages: Stages, block: int, mode: str) -> DataFrame:
    names = opened.filter(F.col("node").isNotNull()).select(F.col("grp").alias("g2"), F.col("node").alias("name"), F.col("vid").alias("far"))
    links = opened.filter(F.col("ext").isNotNull()).select("vid", "grp", "ext").join(names, F.col("grp").eqNullSafe(F.col("g2")) & (F.col("ext") == F.col("name"))).select("vid", "far")
    links = stages.write(links, "links")
    rows = opened.select("vid", "lpar", F.col("ext").isNotNull().alias("seeks")).join(links, "vid", "left")
    rows = rows.join(links.select(F.col("far").alias("vid"), F.lit(1).alias("held")).distinct(), "vid", "left")
    rows = stages.write(
        rows.select("vid", F.shiftright("vid", 32).cast("int").alias("blk"), F.coalesce("lpar", "far").alias("par"), (F.col("seeks") & F.col("far").isNull()).alias("orphan"), F.coalesce("held", F.lit(0)).alias("held")), "rows")
    left = stages.write(rows.groupBy("blk").applyInPandas(_peel_block, "vid long, par long"), "left")
    cycle = stages.write(_cycles(left, stages, block), "cycle")
    rows = stages.write(
        rows.join(cycle.withColumn("cyc", F.lit(True)), "vid", "left").select("vid", "blk", F.when(F.col("cyc").isNull(), F.col("par")).alias("par"), F.when(F.col("cyc"), "cycle").when(F.col("orphan"), "orphan").otherwise("root").alias("cls")), "cut")
    # children of a parent that has children in other blocks: a run of them for each block; counted
    # together first, so a parent of very many children is a row for each block
    runs = rows.filter("par is not null").groupBy("par", "blk").agg(F.min("vid").alias("first"), F.max("vid").alias("final"))
    every = Window.partitionBy("par")
    runs = runs.withColumn("abroad", F.max(F.shiftright("par", 32) != F.col("blk")).over(every)).filter("abroad")
    w = every.orderBy("blk")
    runs = runs.withColumns({"after": F.lead("first").over(w), "k": F.row_number().over(w)})
    over = runs.select((F.col("final") * 2 + 1).alias("gid"), F.coalesce(F.col("after") * 2, F.col("par") * 2 + 1).alias("to"))
    over = over.unionByName(runs.filter("k = 1").select((F.col("par") * 2).alias("gid"), (F.col("first") * 2).alias("to")))
    over = stages.write(over.withColumn("blk", F.shiftright("gid", 33).cast("int")), "over")
    lists = rows.groupBy("blk").cogroup(over.groupBy("blk")).applyInPandas(_sublists, "head long, to long, n long, w long, tail long")
    lists = stages.write(lists, "lists")
    ranks = _rank_sublists(lists, stages, block)
    blank = F.lit(None).cast("long")
    back = over.select("blk", F.lit(0).alias("kind"), "gid", "to", *[blank.alias(c) for c in ("n_after", "w_after", "total", "end")]).unionByName(
        ranks.select(F.shiftright("tail", 33).cast("int").alias("blk"), F.lit(1).alias("kind"), F.col("tail").alias("gid"), blank.alias("to"), "n_after", "w_after", "total", "end"))
    spans = rows.groupBy("blk").cogroup(back.groupBy("blk")).applyInPandas(_finish, "vid long, tree long, entry long, exit long, depth int")
    spans = spans.join(rows.select("vid", "cls"), "vid")
    named = opened.select("vid", "grp", "node", "parent", "label", "stored_depth", "stored_path").join(spans, "vid")
    size = F.lit(2 * block)
    own = F.floor(F.col("entry") / size)
    named = named.withColumn("chunk", F.explode(F.sequence(own, F.floor(F.col("exit") / size)))).withColumn("own", F.col("chunk") == own)
    named = named.repartition("tree", "chunk").sortWithinPartitions("tree", "chunk", "entry")
    return named.mapInPandas(partial(_chunks, mode=mode), OUT)


def hierarchy(df: DataFrame, group: str, node: str, parent: str, label: str, *, depth: str | None = None, path: str | None = None, at: str | None = None, mode: str = "nodes", block: int = BLOCK) -> DataFrame:
    """Roots, depths, paths and intervals of all nodes of the trees in ``df``.

    ``group`` and ``node`` identify a row; a row repeated with the same key counts once (the
    latest by ``at``). A null or empty ``parent`` marks a root. ``depth`` and ``path`` name
    stored values to compare with. Nulls: a null group is a group of its own; a null node is
    a node that no parent can name; a null label adds nothing to a path; a null stored depth
    or path is not compared. An empty table gives an empty result. Only the named columns
    are read, so further columns of any name are harmless.

    mode "nodes": one row per node: grp, node, parent, label, stored_depth, stored_path (as
    :func:`path_key`), status (ok, cycle, below_cycle, orphan, below_orphan), root, depth,
    path, path_ok (whether the stored path is the true one, null without a stored one), entry,
    exit; depth and path of nodes that are not ok count from the cycle or orphan above them. A
    node a has the descendants d of the same root with a.entry < d.entry < a.exit. mode "found":
    the same columns, path null, only rows that have a fault.
    """
    spark = df.sparkSession
    stages = Stages(spark, "hierarchy")
    col = lambda c, kind: (F.col(c) if c else F.lit(None)).cast(kind)
    rows = df.select(col(group, "string").alias("grp"), col(node, "string").alias("node"), col(parent, "string").alias("parent"), col(label, "string").alias("label"), col(depth, "int").alias("stored_depth"), (path_key(F.col(path)) if path else col(None, "string")).alias("stored_path"), col(at, "timestamp").alias("at"))
    count = max(1, -(-df.count() // block))
    ranged = rows.repartitionByRange(count, "grp", "node")
    local = stages.write(ranged.mapInPandas(partial(_blocks, mode=mode), LINKED), "blocks")
    names = [c.split()[0] for c in OUT.split(", ")]
    far = _across_blocks(local.filter("not closed"), stages, block, mode)
    return local.filter("closed").select(names).unionByName(far.select(names))


def _pairs(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
    stack: list[tuple] = []
    at = None
    for d in batches:
        rows = []
        for grp, root, chunk, entry, exit_, node, own in d[["grp", "root", "chunk", "entry", "exit", "node", "own"]].itertuples(index=False, name=None):
            if (grp, root, chunk) != at:
                stack, at = [], (grp, root, chunk)
            while stack and stack[-1][0] < entry:
                stack.pop()
            if own:
                rows.extend((grp, s[1], node, len(stack) - i) for i, s in enumerate(stack))
            stack.append((exit_, node))
        yield pd.DataFrame(rows, columns=["grp", "ancestor", "descendant", "distance"])


def descendants(nodes: DataFrame, block: int = BLOCK) -> DataFrame:
    """Every (ancestor, descendant) pair, with their distance, from the intervals of
    :func:`hierarchy`. A tree of any size is read in chunks of its entry order."""
    size = F.lit(2 * block)
    own = F.floor(F.col("entry") / size)
    rows = nodes.select("grp", "root", "node", "entry", "exit").withColumn("chunk", F.explode(F.sequence(own, F.floor(F.col("exit") / size)))).withColumn("own", F.col("chunk") == own)
    return rows.repartition("grp", "root", "chunk").sortWithinPartitions("grp", "root", "chunk", "entry").mapInPandas(_pairs, PAIRS)
