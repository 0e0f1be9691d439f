"""Contents runs, parts of a document and headings among its lines."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from lontar.functions.text import caps_ratio, is_toc_line

LEAST, LEAST_ANNOUNCED = 3, 2  # lines of a contents run, without and with a title among them
TITLE = r"(?i)^(?:daftar\s+isi|table\s+of\s+contents)\b"
# Weights of heading signals, and bounds.
WEIGHTS = {"all_caps": 0.30, "short": 0.20, "isolated_above": 0.20, "starts_fresh": 0.15, "centred": 0.15, "no_sentence_end": 0.15, "larger_font": 0.15, "bold": 0.10}
EMPHASIS = ["all_caps", "bold", "larger_font", "centred"]
HEADING, DIVISION = 0.60, 0.75
WORDS, SENTENCE_WORDS, LEAD_IN_WORDS, DIVISION_WORDS = 12, 6, 4, 2
CAPS, CAPS_LETTERS, ISOLATED, CENTRE, NARROW, LARGER = 0.9, 4, 1.2, 0.06, 0.7, 1.15
LABELLED = r"^[^\W\d_][\w\s./-]{0,30}:\s*\S"


def contents_runs(lines: DataFrame) -> DataFrame:
    """doc, first_line, last_line, n of runs of contents lines (doc, line_no, text) of a page or document.
    A title begins a run anew and counts as a line of it; what stands right before it is no run."""
    w = Window.partitionBy("doc").orderBy("line_no")
    title = F.trim("text").rlike(TITLE)
    d = lines.withColumns({"title": title, "toc": is_toc_line(F.col("text")) | title})
    d = d.withColumns({"starts": F.col("toc") & (F.col("title") | ~F.coalesce(F.lag("toc").over(w), F.lit(False))), "cut": F.coalesce(F.lead("title").over(w), F.lit(False))})
    d = d.withColumn("run", F.sum(F.col("starts").cast("int")).over(w.rowsBetween(Window.unboundedPreceding, 0))).filter("toc")
    g = d.groupBy("doc", "run").agg(F.min("line_no").alias("first_line"), F.max("line_no").alias("last_line"), F.count("*").alias("n"), F.bool_or("title").alias("announced"), F.bool_or("cut").alias("cut"))
    return g.filter(((F.col("n") >= LEAST) | (F.col("announced") & (F.col("n") >= LEAST_ANNOUNCED))) & ~F.col("cut")).select("doc", "first_line", "last_line", "n")


def parts(lines: DataFrame, markers: list[tuple[str, str]]) -> DataFrame:
    """Lines with ``part``: that of the last marker (part, pattern) met; each marker counts where it is first met,
    and not among contents lines."""
    met = F.coalesce(*[F.when(F.col("text").rlike(p), F.lit(name)) for name, p in markers])
    d = lines.withColumn("met", F.when(~is_toc_line(F.col("text")), met))
    first = Window.partitionBy("doc", "met").orderBy("line_no")
    d = d.withColumn("met", F.when(F.col("met").isNotNull() & (F.row_number().over(first) == 1), F.col("met")))
    w = Window.partitionBy("doc").orderBy("line_no").rowsBetween(Window.unboundedPreceding, 0)
    return d.withColumn("part", F.last("met", ignorenulls=True).over(w)).drop("met")


def page_parts(lines: DataFrame, page: Column) -> DataFrame:
    """doc, page, part: the last part of each page, carried over pages without one."""
    g = lines.withColumn("page", page).groupBy("doc", "page").agg(F.max_by("part", F.when(F.col("part").isNotNull(), F.col("line_no"))).alias("part"))
    w = Window.partitionBy("doc").orderBy("page").rowsBetween(Window.unboundedPreceding, 0)
    return g.withColumn("part", F.last("part", ignorenulls=True).over(w))


def headings(blocks: DataFrame, pages: DataFrame) -> DataFrame:
    """doc, page, block, score, signals, is_heading, is_division of blocks of text (doc, page, block, text,
    x0, x1, top, bottom, size, bold) on pages (doc, page, width, line_height).

    Signals add up their weights: capitals, shortness, space above, a sentence that has ended before,
    the middle of the page, a larger font, bold, no end of a sentence. A line that ends in ; or ,
    or leads in a list, a whole sentence, a labelled value and a long line without an end have none.
    A heading needs one signal of emphasis besides its score. Blank blocks are left out.
    """
    page = ["doc", "page"]
    w = Window.partitionBy(*page).orderBy("block")
    middle = lambda c: F.try_element_at(F.array_sort(F.collect_list(c)), (F.floor(F.count(c) / 2) + 1).cast("int"))
    text = F.trim("text")
    d = blocks.filter(text != "").withColumns({"text": text, "before": F.lag("text").over(w), "gap": F.col("top") - F.lag("bottom").over(w)})
    stats = d.groupBy(*page).agg(F.coalesce(middle(F.when(F.col("size") > 0, F.col("size"))), F.lit(0.0)).alias("font"), F.coalesce(middle(F.col("x0")), F.lit(0.0)).alias("body"))
    d = d.join(stats, page).join(pages.select(*page, "width", F.when(F.col("line_height") > 0, F.col("line_height")).otherwise(12.0).alias("line_height")), page)
    words = F.size(F.split("text", r"\s+"))
    ended = lambda marks: F.col("text").rlike(f"[{marks}]$")
    offset, wide = F.abs((F.col("x0") + F.col("x1")) / 2 - F.col("width") / 2), F.col("x1") - F.col("x0")
    given = {
        "all_caps": (caps_ratio(F.col("text")) >= CAPS) & (F.length(F.regexp_replace("text", r"[^\p{L}]", "")) >= CAPS_LETTERS),
        "short": words <= WORDS,
        "isolated_above": F.coalesce(F.col("gap") >= ISOLATED * F.col("line_height"), F.lit(False)),
        "starts_fresh": F.col("before").isNull() | F.col("before").rlike(r"[.!?;]\s*$"),
        "centred": (F.col("width") > 0) & (wide <= NARROW * F.col("width")) & (offset <= CENTRE * F.col("width")) & (F.col("x0") > F.col("body") + 1),
        "no_sentence_end": ~ended(".!?"),
        "larger_font": (F.col("size") > 0) & (F.col("font") > 0) & (F.col("size") >= LARGER * F.col("font")),
        "bold": F.coalesce(F.col("bold"), F.lit(False)),
    }
    veto = ended(";,") | ((words > WORDS) & ~ended(".!?;")) | F.col("text").rlike(LABELLED) | (ended(".!?") & (words >= SENTENCE_WORDS)) | (ended(":") & (words >= LEAD_IN_WORDS))
    signals = F.when(veto, F.array().cast("array<string>")).otherwise(F.array_compact(F.array(*[F.when(cond, F.lit(name)) for name, cond in given.items()])))
    weights = F.create_map(*[F.lit(x) for kv in WEIGHTS.items() for x in kv])
    score = F.round(F.aggregate("signals", F.lit(0.0), lambda a, s: a + F.element_at(weights, s)), 4)
    d = d.withColumns({"signals": signals, "n": words}).withColumn("score", score)
    emphasis = F.arrays_overlap("signals", F.array(*map(F.lit, EMPHASIS)))
    return d.select(*page, "block", "score", "signals", ((F.col("score") >= HEADING) & emphasis).alias("is_heading"), ((F.col("score") >= DIVISION) & (F.col("n") >= DIVISION_WORDS)).alias("is_division"))
