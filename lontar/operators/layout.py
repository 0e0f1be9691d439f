"""Pages of placed words: routing, lines, columns, layout types, text blocks, ruled tables.

Words are rows (doc, page, idx, text, x0, top, x1, bottom, size, bold). All order-dependent
steps are window functions over one page, whose words are bounded by the page.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from lontar.stage import Stages

# Thresholds of the layout rules, in points or parts of the page width.
LINE_HEIGHT = 12.0
LINE_TOLERANCE = 0.25
BINS, COVERAGE_BINS = 50, 80
BLANK, RULED = 50, 20
DOMINANT, LEFT_START, COLUMN_GAP = 0.40, 0.25, 0.15
GAP_COVERAGE, GAP_WIDTH, SIDE, GAP_SPACING = 0.01, 0.02, 0.30, 3.0
NATIVE_CHARS, SCAN_CHARS, SCAN_COVERAGE = 50, 5, 0.80
BUCKET, MARGIN = 6.0, 6.0
PAGE = ["doc", "page"]


def upper_median(values: Column, default: float = LINE_HEIGHT) -> Column:
    """Of the positive values of an array the one at the upper middle."""
    v = F.array_sort(F.filter(values, lambda x: x > 0))
    return F.coalesce(F.try_element_at(v, (F.floor(F.size(v) / 2) + 1).cast("int")), F.lit(default))


def route(probes: DataFrame) -> DataFrame:
    """doc, page, method: native with text and fonts, ocr_needed for a picture of a page, else hybrid_review."""
    method = F.when((F.col("char_count") > NATIVE_CHARS) & (F.size("fonts") > 0), "native").when((F.col("char_count") <= SCAN_CHARS) & (F.col("image_coverage") >= SCAN_COVERAGE), "ocr_needed").otherwise("hybrid_review")
    return probes.select(*PAGE, method.alias("method"))


def lines(words: DataFrame) -> DataFrame:
    """Words with ``line``: a new one where the top is farther from that of the word before than a
    part of the page's median word height."""
    height = words.groupBy(*PAGE).agg(upper_median(F.collect_list(F.col("bottom") - F.col("top"))).alias("height"))
    w = Window.partitionBy(*PAGE).orderBy("top", "x0", "idx")
    d = words.join(height, PAGE).withColumn("before", F.lag("top").over(w))
    d = d.withColumn("starts", (F.col("before").isNull() | (F.abs(F.col("top") - F.col("before")) > F.col("height") * LINE_TOLERANCE)).cast("int"))
    return d.withColumn("line", F.sum("starts").over(w.rowsBetween(Window.unboundedPreceding, 0))).drop("before", "starts", "height")


def line_sums(words: DataFrame) -> DataFrame:
    """doc, page, line, n_words, top of the lines that :func:`lines` finds. A line depends only on the tops of its
    words, so those of a page at one top and of one height are counted before anything is shuffled. Every word has a top."""
    d = words.groupBy(*PAGE, "top", (F.col("bottom") - F.col("top")).alias("h")).agg(F.count("*").alias("n"))
    page, up = Window.partitionBy(*PAGE), Window.partitionBy(*PAGE).orderBy("h").rangeBetween(Window.unboundedPreceding, Window.currentRow)
    positive = F.when(F.col("h") > 0, F.col("n")).otherwise(0)
    d = d.withColumns({"upto": F.sum(positive).over(up), "of": F.sum(positive).over(page)})
    # of the positive heights the one at the upper middle
    d = d.withColumn("height", F.coalesce(F.min(F.when((F.col("h") > 0) & (F.col("upto") > F.floor(F.col("of") / 2)), F.col("h"))).over(page), F.lit(LINE_HEIGHT)))
    w = page.orderBy("top")
    d = d.withColumn("before", F.lag("top").over(w))
    starts = (F.col("before").isNull() | (F.abs(F.col("top") - F.col("before")) > F.col("height") * LINE_TOLERANCE)).cast("int")
    d = d.withColumn("starts", starts).withColumn("line", F.sum("starts").over(w.rowsBetween(Window.unboundedPreceding, 0)))
    return d.groupBy(*PAGE, "line").agg(F.sum("n").alias("n_words"), F.min("top").alias("top"))


def placed(words: DataFrame, pages: DataFrame) -> DataFrame:
    """Words of pages that have a width, each with its line, the space to the word before it and whether
    it begins the line. Written once, since every rule of a layout reads it."""
    w = Window.partitionBy(*PAGE, "line").orderBy("x0", "idx")
    d = lines(words).withColumns({"space": F.col("x0") - F.lag("x1").over(w), "begins": F.row_number().over(w) == 1})
    d = d.join(pages.select(*PAGE, "width").filter("width > 0"), PAGE)
    return Stages(words.sparkSession, "layout").write(d.select(*PAGE, "width", "x0", "x1", "space", "begins"), "placed")


def corridors(words: DataFrame, pages: DataFrame) -> DataFrame:
    """doc, page, centre, left_share, right_share: the empty strip between two columns of words that
    leaves the largest smaller side; pages without one are left out."""
    return _corridors(placed(words, pages))


def _corridors(placed: DataFrame) -> DataFrame:
    bin_of = lambda c: F.greatest(F.lit(0), F.least(F.lit(COVERAGE_BINS - 1), F.floor(F.col(c) / F.col("width") * COVERAGE_BINS))).cast("int")
    gaps = placed.groupBy(*PAGE, "width").agg(F.collect_list(F.when(F.col("space") > 0, F.col("space"))).alias("s"), F.count("*").alias("n"))
    spacing = gaps.select(*PAGE, "width", "n", F.when(F.size("s") > 0, upper_median(F.col("s"), 2.0)).otherwise(2.0).alias("spacing"))
    covered = placed.select(*PAGE, F.explode(F.sequence(bin_of("x0"), bin_of("x1"))).alias("bin")).groupBy(*PAGE, "bin").agg(F.count("*").alias("c"))
    grid = spacing.withColumn("bin", F.explode(F.sequence(F.lit(0), F.lit(COVERAGE_BINS - 1)))).join(covered, [*PAGE, "bin"], "left")
    empty = grid.filter(F.coalesce("c", F.lit(0)) <= F.greatest(F.lit(1), F.floor(F.col("n") * GAP_COVERAGE)))
    runs = empty.withColumn("run", F.col("bin") - F.row_number().over(Window.partitionBy(*PAGE).orderBy("bin"))).groupBy(*PAGE, "width", "n", "spacing", "run").agg(F.min("bin").alias("a"), (F.max("bin") + 1).alias("b"))
    wide = (F.col("b") - F.col("a") >= max(1, int(GAP_WIDTH * COVERAGE_BINS))) & ((F.col("b") - F.col("a")) / COVERAGE_BINS * F.col("width") >= GAP_SPACING * F.col("spacing"))
    runs = runs.filter((F.col("a") > 0) & (F.col("b") < COVERAGE_BINS) & wide).withColumn("centre", (F.col("a") + F.col("b")) / 2.0 / COVERAGE_BINS)
    split = F.col("centre") * F.col("width")
    sided = runs.join(placed.select(*PAGE, "x0", "x1"), PAGE).groupBy(*PAGE, "a", "n", "centre").agg(F.sum((F.col("x1") <= split).cast("int")).alias("l"), F.sum((F.col("x0") >= split).cast("int")).alias("r"))
    sided = sided.select(*PAGE, "a", "centre", (F.col("l") / F.col("n")).alias("left_share"), (F.col("r") / F.col("n")).alias("right_share")).withColumn("least", F.least("left_share", "right_share")).filter(F.col("least") >= SIDE)
    first = Window.partitionBy(*PAGE).orderBy(F.desc("least"), "a")
    return sided.withColumn("k", F.row_number().over(first)).filter("k = 1").select(*PAGE, "centre", "left_share", "right_share")


def layout(words: DataFrame, pages: DataFrame, parallel: bool = True) -> DataFrame:
    """doc, page, layout_type, column_boundary, right_column_start, column_role of every page of
    ``pages`` (doc, page, width, char_count, ruling_line_count): blank, ruled_table, two_column
    (parallel, or labels in a gutter), form, single_column."""
    words = placed(words, pages)
    starts = words.filter("begins").select(*PAGE, F.least(F.col("x0") / F.col("width"), F.lit(1.0)).alias("f")).withColumn("bin", F.least(F.lit(BINS - 1), F.floor(F.col("f") * BINS)).cast("int"))
    bins = starts.groupBy(*PAGE, "bin").agg(F.count("*").alias("c"))
    modes = bins.withColumn("run", F.col("bin") - F.row_number().over(Window.partitionBy(*PAGE).orderBy("bin"))).groupBy(*PAGE, "run").agg((F.min("bin") / BINS).alias("a"), ((F.max("bin") + 1) / BINS).alias("b"), F.sum("c").alias("c"))
    page = Window.partitionBy(*PAGE)
    modes = modes.withColumns({"n": F.sum("c").over(page), "modes": F.count("*").over(page), "top": F.first(F.struct("a", "c")).over(page.orderBy(F.desc("c"), "a"))})
    left = modes.filter((F.col("b") <= F.col("top.a")) & (F.col("a") < LEFT_START) & (F.col("top.a") - F.col("b") >= COLUMN_GAP)).groupBy(*PAGE).agg(F.max("b").alias("left_end"))
    per = modes.groupBy(*PAGE).agg(F.first("modes").alias("modes"), F.first("top.a").alias("top_a"), F.first(F.col("top.c") / F.col("n")).alias("share")).join(left, PAGE, "left")
    right = starts.join(left, PAGE).filter(F.col("f") > F.col("left_end")).groupBy(*PAGE).agg(F.min("f").alias("right_start"))
    d = pages.select(*PAGE, "char_count", "ruling_line_count").join(per, PAGE, "left").join(right, PAGE, "left")
    d = d.join(_corridors(words).select(*PAGE, "centre"), PAGE, "left") if parallel else d.withColumn("centre", F.lit(None).cast("double"))
    plain = (F.col("char_count") >= BLANK) & (F.col("ruling_line_count") < RULED) & F.col("modes").isNotNull()
    both = plain & F.col("centre").isNotNull()
    gutter = plain & ~both & (F.col("modes") > 1) & (F.col("share") >= DOMINANT) & F.col("left_end").isNotNull()
    kind = F.when(F.col("char_count") < BLANK, "blank").when(F.col("ruling_line_count") >= RULED, "ruled_table").when(F.col("modes").isNull(), "blank").when(both | gutter, "two_column").when((F.col("modes") > 1) & (F.col("share") < DOMINANT), "form").otherwise("single_column")
    return d.select(*PAGE, kind.alias("layout_type"), F.when(both, F.col("centre")).when(gutter, (F.col("left_end") + F.col("top_a")) / 2).alias("column_boundary"), F.when(both, F.col("centre")).when(gutter, F.coalesce("right_start", "top_a")).alias("right_column_start"), F.when(both, "parallel").when(gutter, "gutter_label").alias("column_role"))


def blocks(words: DataFrame, pages: DataFrame, found: DataFrame) -> DataFrame:
    """doc, page, block_idx, column_index, text, x0, top, x1, bottom, size, bold: lines of text in reading
    order. Parallel columns are read one after the other, words across the strip belonging to
    neither; a line with a label in the gutter is cut at the right column."""
    d = words.join(pages.select(*PAGE, "width"), PAGE).join(found.select(*PAGE, "column_role", "column_boundary", "right_column_start"), PAGE)
    split = F.col("column_boundary") * F.col("width")
    side = F.when(F.col("column_role") == "parallel", F.when(F.col("x1") <= split, 0).when(F.col("x0") > split, 1)).otherwise(0)
    d = d.withColumn("side", side).filter("side is not null")
    heights = d.groupBy(*PAGE, "side").agg(upper_median(F.collect_list(F.col("bottom") - F.col("top"))).alias("height"))
    w = Window.partitionBy(*PAGE, "side").orderBy("top", "x0", "idx")
    d = d.join(heights, [*PAGE, "side"]).withColumn("before", F.lag("top").over(w))
    d = d.withColumn("line", F.sum((F.col("before").isNull() | (F.abs(F.col("top") - F.col("before")) > F.col("height") * LINE_TOLERANCE)).cast("int")).over(w.rowsBetween(Window.unboundedPreceding, 0)))
    cut = F.col("right_column_start") * F.col("width") - MARGIN
    in_line = Window.partitionBy(*PAGE, "side", "line")
    label = (F.col("column_role") == "gutter_label") & (F.min("x0").over(in_line) < cut) & (F.col("x0") >= cut)
    d = d.withColumn("column_index", F.when(F.col("column_role") == "parallel", F.col("side")).when(label, 1).when((F.col("column_role") == "gutter_label") & (F.min("x0").over(in_line) >= cut), 1).otherwise(0))
    g = d.groupBy(*PAGE, "side", "line", "column_index").agg(
        F.array_join(F.transform(F.array_sort(F.collect_list(F.struct("x0", "idx", "text"))), lambda x: x["text"]), " ").alias("text"),
        F.min("x0").alias("x0"), F.min("top").alias("top"), F.max("x1").alias("x1"), F.max("bottom").alias("bottom"), F.min_by("size", F.struct("x0", "idx")).alias("size"), F.bool_or("bold").alias("bold"))
    order = Window.partitionBy(*PAGE).orderBy("side", F.bround(F.col("top") / BUCKET), "column_index", "x0", "line")
    return g.withColumn("block_idx", F.row_number().over(order) - 1).drop("side", "line")


def clusters(segments: DataFrame, keys: list[str], tolerance: float, join_gap: float = 12.0) -> DataFrame:
    """Rules (keys, position, start, end) at chained positions within ``tolerance`` as one, their spans joined
    where no more than ``join_gap`` apart: keys, position (the mean), start, end."""
    w = Window.partitionBy(*keys).orderBy("position", "start")
    d = segments.withColumn("new", F.coalesce((F.col("position") - F.lag("position").over(w) > tolerance).cast("int"), F.lit(1)))
    d = d.withColumn("c", F.sum("new").over(w.rowsBetween(Window.unboundedPreceding, 0)))
    v = Window.partitionBy(*keys, "c").orderBy("start", "end")
    reach = F.max("end").over(v.rowsBetween(Window.unboundedPreceding, -1))
    d = d.withColumns({"at": F.avg("position").over(Window.partitionBy(*keys, "c")), "gap": F.coalesce((F.col("start") - reach > join_gap).cast("int"), F.lit(1))})
    d = d.withColumn("s", F.sum("gap").over(v.rowsBetween(Window.unboundedPreceding, 0)))
    return d.groupBy(*keys, "c", "s").agg(F.first("at").alias("position"), F.min("start").alias("start"), F.max("end").alias("end")).drop("c", "s")


def cells(words: DataFrame, rows: DataFrame, columns: DataFrame) -> DataFrame:
    """Text of table cells: words whose centre lies in a row band (doc, page, row, y0, y1) and a column band
    (doc, page, col, x0, x1), in lines from the top, then from the left."""
    cx, cy = (F.col("w.x0") + F.col("w.x1")) / 2, (F.col("w.top") + F.col("w.bottom")) / 2
    d = words.alias("w").join(rows.alias("r"), PAGE).filter((cy >= F.col("r.y0")) & (cy < F.col("r.y1"))).join(columns.alias("c"), PAGE).filter((cx >= F.col("c.x0")) & (cx < F.col("c.x1")))
    placed = F.struct(F.bround(F.col("w.top") / BUCKET).alias("b"), F.col("w.x0").alias("x"), F.col("w.idx").alias("i"), F.col("w.text").alias("t"))
    return d.groupBy(*PAGE, "row", "col").agg(F.array_join(F.transform(F.array_sort(F.collect_list(placed)), lambda x: x["t"]), " ").alias("text"))
