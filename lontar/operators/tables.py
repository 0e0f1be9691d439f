"""Tables: rows to search, parts of pages, grids of rules, and two readings of one page of words."""

from __future__ import annotations

from collections.abc import Iterator
from functools import partial

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from lontar.functions.text import row_id, skeleton, squash
from lontar.operators.layout import PAGE, upper_median

# Tolerances in points, least numbers, parts.
CROSS, SPAN, CROSSED, GRID, GRID_CELLS, SPLIT = 2.0, 0.20, 2, 2, 2, 3.0
OVERLAP, ROW = 0.30, 0.4


def cells_text(cells: Column) -> Column:
    """Cells as one text, white space squashed, empty ones left out."""
    plain = F.transform(cells, lambda c: squash(F.coalesce(c, F.lit(""))))
    return F.array_join(F.filter(plain, lambda c: c != ""), " | ")


def page_parts(nodes: DataFrame) -> DataFrame:
    """document_key, page, part: the most frequent part among the nodes of a page, the one met first in case of
    ties; a page without nodes has the part of the page before, from page 1 on."""
    each = nodes.select("document_key", F.explode("pages").alias("page"), "sub_document", F.struct("reading_order", "node_id").alias("at"))
    counted = each.groupBy("document_key", "page", "sub_document").agg(F.count("*").alias("n"), F.min("at").alias("first"))
    w = Window.partitionBy("document_key", "page").orderBy(F.desc("n"), "first")
    best = counted.withColumn("k", F.row_number().over(w)).filter("k = 1").select("document_key", "page", "sub_document", F.lit(True).alias("met"))
    pages = best.groupBy("document_key").agg(F.max("page").alias("last")).filter("last >= 1").select("document_key", F.explode(F.sequence(F.lit(1), F.col("last"))).alias("page"))
    d = pages.join(best, ["document_key", "page"], "left")
    run = Window.partitionBy("document_key").orderBy("page").rowsBetween(Window.unboundedPreceding, 0)
    return d.select("document_key", "page", F.last(F.when(F.col("met"), F.struct("sub_document")), ignorenulls=True).over(run)["sub_document"].alias("part"))


def table_rows(tables: DataFrame, parts: DataFrame | None = None) -> DataFrame:
    """A row for each header and row of tables (document_key, table_no, table_id, page, row_no, is_header, cells):
    embedding_id, document_key, node_type, sub_document, hierarchy_path, page, text. A header that a document
    has had before and rows without text are left out; equal rows differ by their occurrence."""
    d = tables.withColumn("text", cells_text(F.col("cells"))).filter("text <> ''")
    again = Window.partitionBy("document_key", "is_header", "text").orderBy("table_no", "row_no")
    d = d.withColumn("again", F.row_number().over(again)).filter("not is_header or again = 1").drop("again")
    d = d.join(parts.select("document_key", "page", F.col("part").alias("sub_document")), ["document_key", "page"], "left") if parts is not None else d.withColumn("sub_document", F.lit(None).cast("string"))
    d = d.withColumn("hierarchy_path", F.array("table_id", F.when(F.col("is_header"), "h").otherwise(F.col("row_no").cast("string"))))
    w = Window.partitionBy("document_key", F.coalesce("sub_document", F.lit("")), "page", "hierarchy_path", "text").orderBy("table_no", "row_no")
    d = d.withColumn("occurrence", F.row_number().over(w) - 1)
    made = row_id(F.col("document_key"), F.col("sub_document"), F.col("page"), F.col("hierarchy_path"), F.lit(None).cast("string"), F.col("text"), F.col("occurrence"))
    return d.select(made.alias("embedding_id"), "document_key", F.lit("table_row").alias("node_type"), "sub_document", "hierarchy_path", "page", "text")


# ---- grids of rules --------------------------------------------------------------------


def rule_grid(rules: DataFrame, pages: DataFrame) -> DataFrame:
    """doc, page, is_grid, rows, columns: positions of the rules that make up a grid, from rules (doc, page,
    horizontal, position, start, end) on pages (doc, page, width). Long horizontal rules count;
    vertical ones that cross two of them; horizontal ones that cross two of these. Without a grid the
    long horizontal rules are given. A page's rules are few, so they meet within their page."""
    long = rules.filter("horizontal").join(pages.select(*PAGE, "width"), PAGE).filter(F.col("end") - F.col("start") >= SPAN * F.col("width"))
    h = long.select(*PAGE, F.col("position").alias("y"), F.col("start").alias("hx0"), F.col("end").alias("hx1"))
    v = rules.filter("not horizontal").select(*PAGE, F.col("position").alias("x"), F.col("start").alias("y0"), F.col("end").alias("y1"))
    cross = F.col("x").between(F.col("hx0") - CROSS, F.col("hx1") + CROSS) & F.col("y").between(F.col("y0") - CROSS, F.col("y1") + CROSS)
    met = v.join(h, PAGE).filter(cross)
    rule_v, rule_h = ["x", "y0", "y1"], ["y", "hx0", "hx1"]
    good_v = met.groupBy(*PAGE, *rule_v).agg(F.count("*").alias("n")).filter(F.col("n") >= CROSSED).drop("n")
    good_h = met.join(good_v, [*PAGE, *rule_v], "left_semi").groupBy(*PAGE, *rule_h).agg(F.count("*").alias("n")).filter(F.col("n") >= GRID).drop("n")
    sorted_ = lambda c: F.array_sort(F.collect_list(c))
    grid = good_h.groupBy(*PAGE).agg(sorted_("y").alias("rows")).join(good_v.groupBy(*PAGE).agg(sorted_("x").alias("columns")), PAGE)
    grid = grid.filter((F.size("rows") >= GRID) & (F.size("columns") >= GRID) & ((F.size("rows") - 1) * (F.size("columns") - 1) >= GRID_CELLS)).withColumn("is_grid", F.lit(True))
    d = h.groupBy(*PAGE).agg(sorted_("y").alias("lines")).join(grid, PAGE, "left")
    none = F.array().cast("array<double>")
    return d.select(*PAGE, F.coalesce("is_grid", F.lit(False)).alias("is_grid"), F.coalesce("rows", "lines").alias("rows"), F.coalesce("columns", none).alias("columns"))


def row_groups(lines: Column) -> Column:
    """Sorted row lines as groups: a gap much larger than the median gap parts two tables; a group has
    two lines at least."""
    gaps = F.zip_with(F.slice(lines, 2, F.greatest(F.size(lines) - 1, F.lit(0))), F.slice(lines, 1, F.greatest(F.size(lines) - 1, F.lit(0))), lambda b, a: b - a)
    middle = F.try_element_at(F.array_sort(gaps), (F.floor(F.size(gaps) / 2) + 1).cast("int"))
    begin = F.struct(F.array(F.array(F.element_at(lines, 1))).alias("done"))
    step = lambda acc, z: F.struct(F.when(z["gap"] > SPLIT * middle, F.concat(acc["done"], F.array(F.array(z["line"])))).otherwise(F.concat(F.slice(acc["done"], 1, F.size(acc["done"]) - 1), F.array(F.concat(F.element_at(acc["done"], -1), F.array(z["line"]))))).alias("done"))
    pairs = F.zip_with(F.slice(lines, 2, F.greatest(F.size(lines) - 1, F.lit(0))), gaps, lambda x, g: F.struct(x.alias("line"), g.alias("gap")))
    split = F.filter(F.aggregate(pairs, begin, step, lambda acc: acc["done"]), lambda g: F.size(g) >= 2)
    none = F.array().cast("array<array<double>>")
    return F.when(F.size(lines) < 2, none).when((F.size(lines) < 3) | (middle <= 0), F.array(lines)).otherwise(split)


# ---- two readings of a page ------------------------------------------------------------


def reconcile(text1: Column, conf1: Column, text2: Column, conf2: Column) -> Column:
    """Which of two readings of a word is kept, as (text, conf): the first, unless both have the same letters
    and digits; then the longer one if only marks at the end differ, else the surer one."""
    first, second = F.struct(text1.alias("text"), conf1.alias("conf")), F.struct(text2.alias("text"), conf2.alias("conf"))
    bare = lambda t: F.regexp_replace(t, r"[.,;:)\]}]+$", "")
    same = skeleton(text1) == skeleton(text2)
    ends = bare(text1) == bare(text2)
    return F.when(text1 == text2, first).when(~same, first).when(ends, F.when(F.length(text1) >= F.length(text2), first).otherwise(second)).when(conf2 > conf1, second).otherwise(first)


def two_readings(first: DataFrame, second: DataFrame, cell: float = 40.0) -> DataFrame:
    """Words (doc, page, idx, text, x0, top, x1, bottom, conf) of two readings as one: a word of the second that lies
    on one of the first (a part of the smaller area is common) is reconciled with the first such word, other
    words are added. Result: doc, page, idx, text, conf, source (first, corrected, recovered). Words meet in
    cells of the page; the second readings of one word are taken in order."""
    at = lambda d, s: d.select(*PAGE, *[F.col(c).alias(f"{c}{s}") for c in ("idx", "text", "x0", "top", "x1", "bottom", "conf")])
    tiles = lambda d, s: d.withColumn("tile", F.explode(F.flatten(F.transform(F.sequence(F.floor(F.col(f"x0{s}") / cell), F.floor(F.col(f"x1{s}") / cell)), lambda i: F.transform(F.sequence(F.floor(F.col(f"top{s}") / cell), F.floor(F.col(f"bottom{s}") / cell)), lambda j: F.struct(i.alias("i"), j.alias("j")))))))
    a, b = tiles(at(first, "1"), "1"), tiles(at(second, "2"), "2")
    low, high = lambda c: F.greatest(f"{c}1", f"{c}2"), lambda c: F.least(f"{c}1", f"{c}2")
    ix, iy = high("x1") - low("x0"), high("bottom") - low("top")
    area = lambda s: F.greatest(F.lit(1e-6), (F.col(f"x1{s}") - F.col(f"x0{s}")) * (F.col(f"bottom{s}") - F.col(f"top{s}")))
    met = b.join(a, [*PAGE, "tile"]).filter((ix > 0) & (iy > 0) & (ix * iy / F.least(area("1"), area("2")) >= OVERLAP))
    on = met.groupBy(*PAGE, "idx2").agg(F.min("idx1").alias("idx1"))
    given = at(second, "2").select(*PAGE, "idx2", "text2", "conf2").join(on, [*PAGE, "idx2"], "left")
    over = given.filter("idx1 is not null").groupBy(*PAGE, "idx1").agg(F.array_sort(F.collect_list(F.struct("idx2", "text2", "conf2"))).alias("again"))
    d = at(first, "1").join(over, [*PAGE, "idx1"], "left")
    start = F.struct(F.col("text1").alias("text"), F.col("conf1").cast("double").alias("conf"))
    kept = F.aggregate(F.coalesce("again", F.array().cast("array<struct<idx2:bigint,text2:string,conf2:double>>")), start, lambda acc, x: reconcile(acc["text"], acc["conf"], x["text2"], x["conf2"]))
    d = d.withColumn("kept", kept)
    # a word whose text stays keeps its own confidence
    words = d.select(*PAGE, F.col("idx1").alias("idx"), F.col("kept.text").alias("text"), F.when(F.col("kept.text") == F.col("text1"), F.col("conf1")).otherwise(F.col("kept.conf")).alias("conf"), F.when(F.col("kept.text") == F.col("text1"), "first").otherwise("corrected").alias("source"))
    new = given.filter("idx1 is null").select(*PAGE, F.col("idx2").alias("idx"), F.col("text2").alias("text"), F.col("conf2").alias("conf"), F.lit("recovered").alias("source"))
    return words.unionByName(new)


def paired_readings(words: DataFrame) -> DataFrame:
    """As :func:`two_readings`, for words (doc, page, first, second) of which either reading, a structure of idx, text,
    x0, top, x1, bottom, conf, may be null. The words of a page stand side by side in order of their idx, as a scan
    gives them (one that is no larger than that before begins a page), so nothing is shuffled or written."""
    kind = dict(words.dtypes)["doc"]
    met = words.select(*PAGE, "first", "second").mapInArrow(partial(_meet, cell=40.0), f"doc {kind}, page int, idx long, text string, conf double, new boolean, again array<struct<text2: string, conf2: double>>")
    one = F.element_at("again", 1)
    start = F.struct("text", "conf")
    kept = F.when(F.size("again") == 0, start).when(F.size("again") == 1, reconcile(F.col("text"), F.col("conf"), one["text2"], one["conf2"]))
    kept = kept.otherwise(F.aggregate("again", start, lambda acc, x: reconcile(acc["text"], acc["conf"], x["text2"], x["conf2"])))
    d = met.withColumn("kept", kept)
    same = F.col("kept.text") == F.col("text")
    source = F.when(F.col("new"), "recovered").when(same, "first").otherwise("corrected")
    return d.select(*PAGE, "idx", F.col("kept.text").alias("text"), F.when(same, F.col("conf")).otherwise(F.col("kept.conf")).alias("conf"), source.alias("source"))


def _whole_pages(batches: Iterator[pa.RecordBatch]) -> Iterator[tuple[pa.RecordBatch, np.ndarray]]:
    """Batches that end where a page ends, and the number of the page of each row."""
    rest: list[pa.RecordBatch] = []

    def numbered(d: pa.RecordBatch) -> np.ndarray:
        idx = pc.coalesce(pc.struct_field(d["first"], "idx"), pc.struct_field(d["second"], "idx")).to_numpy(zero_copy_only=False)
        new = np.diff(idx) <= 0
        for c in PAGE:
            new |= np.diff(d[c].dictionary_encode(null_encoding="encode").indices.to_numpy()) != 0
        return np.r_[0, np.cumsum(new)]

    for batch in batches:
        if not batch.num_rows:
            continue
        rest.append(batch)
        # a page of many batches is put together once it ends
        if len(rest) > 1 and len(set(numbered(pa.concat_batches([rest[-2].slice(rest[-2].num_rows - 1), batch])))) == 1:
            continue
        d = pa.concat_batches(rest)
        page = numbered(d)
        n = int(np.searchsorted(page, page[-1]))
        rest = [d.slice(n)]
        if n:
            yield d.slice(0, n), page[:n]
    if rest:
        d = pa.concat_batches(rest)
        yield d, numbered(d)


def _tiles(page: np.ndarray, box: dict[str, np.ndarray], cell: float) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
    """Word, page, column and row of the cells that words cover; words without an area cover none."""
    some = np.flatnonzero((box["x1"] > box["x0"]) & (box["bottom"] > box["top"]))
    i0, i1, j0, j1 = (np.floor(box[c][some] / cell).astype(np.int64) for c in ("x0", "x1", "top", "bottom"))
    n = (i1 - i0 + 1) * (j1 - j0 + 1)
    of = np.repeat(np.arange(len(some)), n)
    k = np.arange(len(of)) - np.repeat(np.cumsum(n) - n, n)
    rows = (j1 - j0 + 1)[of]
    return some[of], page[some][of], i0[of] + k // rows, j0[of] + k % rows


def _meet(batches: Iterator[pa.RecordBatch], cell: float) -> Iterator[pa.RecordBatch]:
    """The words of the first reading, each with those of the second that lie on it, and the others of the second."""
    for d, page in _whole_pages(batches):
        sides = []
        for name in ("first", "second"):
            at = np.flatnonzero(d[name].is_valid().to_numpy(zero_copy_only=False))
            s = d[name].take(pa.array(at))
            sides.append((at, s, {c: s.field(c).cast(pa.float64()).to_numpy(zero_copy_only=False) for c in ("x0", "top", "x1", "bottom")}))
        (at1, s1, a), (at2, s2, b) = sides
        t1, t2 = _tiles(page[at1], a, cell), _tiles(page[at2], b, cell)
        key, n = np.zeros(len(t1[0]) + len(t2[0]), np.int64), 1
        for x, y in zip(t1[1:], t2[1:], strict=True):  # one number for page, column and row
            z = np.concatenate([x, y])
            z = z - z.min() if len(z) else z
            if len(z) and n * (int(z.max()) + 1) >= 1 << 62:
                z, key = np.unique(z, return_inverse=True)[1], np.unique(key, return_inverse=True)[1]
                n = int(key.max()) + 1
            m = int(z.max()) + 1 if len(z) else 1
            key, n = key * m + z, n * m
        k1, k2 = key[: len(t1[0])], key[len(t1[0]) :]
        order = np.argsort(k1, kind="stable")
        lo, hi = np.searchsorted(k1[order], k2, "left"), np.searchsorted(k1[order], k2, "right")
        n = hi - lo
        i = t1[0][order[np.arange(n.sum()) - np.repeat(np.cumsum(n) - n - lo, n)]]
        j = np.repeat(t2[0], n)
        ix = np.minimum(a["x1"][i], b["x1"][j]) - np.maximum(a["x0"][i], b["x0"][j])
        iy = np.minimum(a["bottom"][i], b["bottom"][j]) - np.maximum(a["top"][i], b["top"][j])
        area = [np.maximum(1e-6, (x["x1"] - x["x0"]) * (x["bottom"] - x["top"])) for x in (a, b)]
        on = (ix > 0) & (iy > 0)
        i, j, ix, iy = i[on], j[on], ix[on], iy[on]
        on = ix * iy / np.minimum(area[0][i], area[1][j]) >= OVERLAP
        # places of the first reading are in order of page and idx, those of the second too
        first = np.full(len(at2), len(at1), np.int64)
        np.minimum.at(first, j[on], i[on])
        met = np.flatnonzero(first < len(at1))
        met = met[np.argsort(first[met], kind="stable")]
        start = np.r_[0, np.cumsum(np.bincount(first[met], minlength=len(at1)))].astype(np.int32)
        new = np.flatnonzero(first == len(at1))
        text2, conf2 = s2.field("text"), s2.field("conf").cast(pa.float64())
        again = pa.StructArray.from_arrays([text2.take(pa.array(met)), conf2.take(pa.array(met))], ["text2", "conf2"])
        none = pa.ListArray.from_arrays(pa.array(np.zeros(len(new) + 1, np.int32)), again.slice(0, 0))
        for at, s, rows, lists in ((at1, s1, None, pa.ListArray.from_arrays(pa.array(start), again)), (at2, s2, pa.array(new), none)):
            text, conf, idx = s.field("text"), s.field("conf").cast(pa.float64()), s.field("idx").cast(pa.int64())
            if rows is not None:
                at, text, conf, idx = at[new], text.take(rows), conf.take(rows), idx.take(rows)
            if len(at):
                yield pa.RecordBatch.from_arrays([d["doc"].take(pa.array(at)), d["page"].take(pa.array(at)).cast(pa.int32()), idx, text, conf, pa.array(np.full(len(at), rows is not None)), lists], ["doc", "page", "idx", "text", "conf", "new", "again"])


def row_tops(words: DataFrame) -> DataFrame:
    """doc, page, idx, top, bottom of words put level by row: in order of their middles a word joins the row while its
    middle is near the mean of the row's, and has the row's top and bottom. A page's words are one fold."""
    item = F.struct(((F.col("top") + F.col("bottom")) / 2).alias("c"), "idx", F.col("top").cast("double").alias("top"), F.col("bottom").cast("double").alias("bottom"))
    g = words.groupBy(*PAGE).agg(F.array_sort(F.collect_list(item)).alias("ws"), upper_median(F.collect_list(F.col("bottom") - F.col("top")), 1.0).alias("h"))
    begin = F.struct(F.lit(-1).alias("row"), F.lit(0.0).alias("sum"), F.lit(0).alias("n"), F.array().cast("array<int>").alias("rows"))

    def step(acc: Column, w: Column) -> Column:
        joins = (acc["n"] > 0) & (F.abs(w["c"] - acc["sum"] / acc["n"]) <= F.col("h") * ROW)
        row = F.when(joins, acc["row"]).otherwise(acc["row"] + 1)
        return F.struct(row.alias("row"), F.when(joins, acc["sum"] + w["c"]).otherwise(w["c"]).alias("sum"), F.when(joins, acc["n"] + 1).otherwise(1).alias("n"), F.concat(acc["rows"], F.array(row)).alias("rows"))

    d = g.select(*PAGE, F.explode(F.arrays_zip(F.col("ws").alias("w"), F.aggregate("ws", begin, step, lambda acc: acc["rows"]).alias("row"))).alias("z")).select(*PAGE, "z.w.idx", "z.w.top", "z.w.bottom", "z.row")
    w = Window.partitionBy(*PAGE, "row")
    return d.select(*PAGE, "idx", F.min("top").over(w).alias("level_top"), F.max("bottom").over(w).alias("level_bottom"))


# Headers of columns that name clauses, and the numbers of clauses.
KEYED, DOTTED, ANY = r"(?i)\b(?:pasal|ssuk|sskk|klausul|ketentuan|ref)\b", r"\b\d{1,3}(?:\.\d{1,3}){1,2}\b", r"\b\d{1,3}(?:\.\d{1,3}){0,2}\b"


def table_refs(tables: DataFrame, labels: DataFrame) -> DataFrame:
    """document_key, table_id, row_no, position, raw, resolved_node_id: clause numbers in the first cells of tables
    (document_key, table_id, row_no, is_header, cells) with the node of ``labels`` (document_key, label, target). In a
    column that names clauses, by its header or by a dotted number in it, every number counts, else
    dotted ones only. Headers give none."""
    key = ["document_key", "table_id"]
    d = tables.select(*key, "row_no", "is_header", F.coalesce(F.try_element_at("cells", F.lit(1)), F.lit("")).alias("cell"))
    d = d.withColumn("names", F.size(F.regexp_extract_all("cell", F.lit(DOTTED), F.lit(0))) + F.when(F.col("is_header"), F.size(F.regexp_extract_all("cell", F.lit(KEYED), F.lit(0)))).otherwise(0))
    keyed = d.groupBy(*key).agg((F.sum("names") > 0).alias("keyed"))
    every = lambda p: F.regexp_extract_all("cell", F.lit(p), F.lit(0))
    d = d.filter("not is_header").join(keyed, key).select(*key, "row_no", F.posexplode(F.when(F.col("keyed"), every(ANY)).otherwise(every(DOTTED))).alias("position", "raw"))
    return d.join(labels.select("document_key", F.col("label").alias("raw"), F.col("target").alias("resolved_node_id")), ["document_key", "raw"], "left").select(*key, "row_no", "position", "raw", "resolved_node_id")
