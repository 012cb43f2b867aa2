"""Line dedup by a log-template tree (DataFrame functions only).

A line's tokens are its words; a word with a digit is a variable field
``<*>``.  A tree of fixed depth files a line by its token count and its
``depth`` leading tokens.  In a leaf, the token that most lines have at a
place is part of the leaf's template, other places are variable; a line
follows the template when enough of its tokens do, else it is a template of
its own.  A template found in ``min_docs`` documents or more is recurring:
its lines go from every document but the first.

Lines move as hashes.  Only lines of leaves that hold several different
lines and enough documents move as text, once, to build the templates.
Counts are combined before each shuffle and joins have unique right sides,
so a line that a third of all documents share doesn't meet in one task.

``recurring_lines`` is the rule of OP3_SQL.  ``every_recurring_line`` is the
wider one of the pipeline: lines of any length, several templates in a leaf,
and lines of figures compared as they are.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from promo_engine.llm import common as C

DEPTH = 2
MIN_TOKENS = 4
MIN_DOCS = 10
MAJORITY = 0.5
SIMILARITY = 0.75
REPEATS = 2
_NO_ID = 2 ** 63 - 1


def _masked(line: Column) -> Column:
    """The line's tokens joined by one blank, variable fields as ``<*>``."""
    odd = line.rlike("[0-9\\x09-\\x0D]") | line.contains("  ")         # few lines need the slow way
    plain = F.trim(F.regexp_replace(line, f"{C.SPACE_CLASS}+", " "))
    return F.when(odd, F.regexp_replace(plain, "[^ ]*[0-9][^ ]*", "<*>")).otherwise(F.trim(line))


def _lines(rows: DataFrame, min_tokens: int, depth: int) -> DataFrame:
    """Every line of ``min_tokens`` tokens or more, with its leaf."""
    # masked inside the array, so that the filter below reads the result and not the expression again
    masked = F.transform(F.split("text", "\n", -1), _masked)
    tokens = F.octet_length("masked") - F.octet_length(F.replace("masked", F.lit(" "), F.lit(""))) + 1
    return (rows.select("doc", "row", F.posexplode(masked).alias("pos", "masked"))
            .where((tokens >= min_tokens) & (F.col("masked") != ""))
            .withColumn("leaf", F.xxhash64(tokens, F.substring_index("masked", " ", depth))))


def _with_key(lines: DataFrame) -> DataFrame:
    """128 bits that stand for the masked line."""
    return lines.withColumn("h", F.xxhash64("masked")).withColumn("g", F.xxhash64(F.lit(1), "masked"))


def _followers(variants: DataFrame, majority: float, similarity: float, least_words: float = 0.0) -> DataFrame:
    """Lines that follow the template of their leaf's majorities, ``least_words`` of it in words with letters."""
    tokens = (variants.groupBy("leaf", "total", "masked").agg(F.count(F.lit(1)).alias("c"))
              .select("leaf", "total", "c", F.posexplode(F.split("masked", " ")).alias("at", "token"))
              .groupBy("leaf", "total", "at", "token").agg(F.sum("c").alias("c"))
              .where(F.col("c") >= F.col("total") * majority)
              .groupBy("leaf", "at").agg(F.max(F.struct("c", "token")).alias("top")))
    templates = C.cut_lineage(
        tokens.groupBy("leaf").agg(F.map_from_entries(F.collect_list(F.struct("at", "top.token"))).alias("template")),
        "templates")
    words = F.split("masked", " ")
    same = F.size(F.filter(words, lambda t: t.isNotNull()))
    follow = F.size(F.filter(F.transform(words, lambda t, i: F.coalesce(F.col("template")[i] == t, F.lit(False))),
                             lambda x: x))
    worded = F.size(F.filter(F.transform(words, lambda t, i: F.coalesce(F.col("template")[i] == t, F.lit(False))
                                         & t.rlike("\\p{L}")), lambda x: x))
    enough = follow >= same * similarity
    return (variants.join(templates, "leaf").where(enough & (worded >= same * least_words) if least_words else enough)
            .select("leaf", "doc", "h", "g").distinct())


def _shared(members: DataFrame, template: list[str], min_docs: int) -> DataFrame:
    """The first document of each template found in ``min_docs`` documents or more."""
    return (members.select(*template, "doc").distinct().groupBy(template)
            .agg(F.count(F.lit(1)).alias("docs"), F.min("doc").alias("first"))
            .where(F.col("docs") >= min_docs).select(*template, "first"))


def recurring_lines(rows: DataFrame, min_docs: int = MIN_DOCS, min_tokens: int = MIN_TOKENS, depth: int = DEPTH,
                    majority: float = MAJORITY, similarity: float = SIMILARITY) -> tuple[DataFrame, DataFrame]:
    """(lines, dropped): the hashed lines of ``rows`` (doc, row, text), and
    for each masked line of a recurring template the first document."""
    lines = C.cut_lineage(_with_key(_lines(rows, min_tokens, depth)).drop("masked"), "lines")
    own = C.cut_lineage(
        lines.groupBy("h", "g", "leaf", "doc").agg(F.count(F.lit(1)).alias("c"))
        .groupBy("h", "g", "leaf").agg(F.count(F.lit(1)).alias("docs"), F.min("doc").alias("first"),
                                       F.sum("c").alias("lines")), "line-counts")
    leaves = C.cut_lineage(
        own.groupBy("leaf").agg(F.count(F.lit(1)).alias("forms"), F.sum("docs").alias("docs"),
                                F.sum("lines").alias("total"))
        .where((F.col("forms") > 1) & (F.col("docs") >= min_docs)).select("leaf", "total"), "leaves")
    variants = C.cut_lineage(
        _with_key(_lines(rows, min_tokens, depth)).select("doc", "h", "g", "leaf", "masked")
        .join(leaves, "leaf"), "variants")
    members = C.cut_lineage(_followers(variants, majority, similarity), "members")
    shared = C.cut_lineage(_shared(members, ["leaf"], min_docs), "recurring-templates")
    by_template = members.select("leaf", "h", "g").distinct().join(shared, "leaf").select("h", "g", "first")
    by_line = own.where(F.col("docs") >= min_docs).select("h", "g", "first")
    # a line that recurs by itself and by its template keeps the template's first document
    dropped = by_template.unionByName(by_line).groupBy("h", "g").agg(F.min("first").alias("first"))
    return lines, C.cut_lineage(dropped, "recurring-lines")


def _compared(line: Column, min_tokens: int) -> Column:
    """The line as it is compared: with ``<*>`` for words with a digit if at
    least half of its tokens are words of letters, else as it is."""
    odd = line.rlike("[\\x09-\\x0D]") | line.contains("  ")
    plain = F.when(odd, F.trim(F.regexp_replace(line, f"{C.SPACE_CLASS}+", " "))).otherwise(F.trim(line))
    masked = F.regexp_replace(plain, "[^ ]*[0-9][^ ]*", "<*>")
    return F.when(plain.rlike("[0-9]") & (_tokens(plain) >= min_tokens) & (_worded(masked) * 2 >= _tokens(plain)),
                  masked).otherwise(plain)


def _tokens(line: Column) -> Column:
    return F.octet_length(line) - F.octet_length(F.replace(line, F.lit(" "), F.lit(""))) + 1


def _worded(line: Column) -> Column:
    """How many tokens hold a letter."""
    return F.regexp_count(line, F.lit("\\p{L}[^ ]*"))


def _compared_lines(rows: DataFrame, min_tokens: int, depth: int) -> DataFrame:
    """Every line that isn't blank; those that can follow a template have a leaf."""
    line = F.col("masked")
    leafed = (_tokens(line) >= min_tokens) & ~line.rlike("[0-9]") & (_worded(line) * 2 >= _tokens(line))
    return (rows.select("doc", "row", F.posexplode(F.transform(F.split("text", "\n", -1),
                                                               lambda x: _compared(x, min_tokens))).alias("pos", "masked"))
            .where(line != "")
            .withColumn("leaf", F.when(leafed, F.xxhash64(_tokens(line), F.substring_index("masked", " ", depth)))))


def _patterns(variants: DataFrame, min_docs: int, depth: int, similarity: float) -> DataFrame:
    """``leaf, h, g, pattern``: the part of each line that makes its template,
    its ``similarity`` most frequent tokens by their counts at their places in
    the leaf.  Lines of one template share them, whatever else is in the leaf."""
    words = F.split("masked", " ")
    cells = C.cut_lineage(
        variants.groupBy("leaf", "h", "g", "masked").agg(F.count(F.lit(1)).alias("c"))
        .select("leaf", "h", "g", "c", F.size(words).alias("n"),
                F.size(F.filter(F.slice(words, 1, depth), lambda t: t.rlike("\\p{L}"))).alias("lead"),
                F.posexplode(words).alias("at", "token"))
        .where(F.col("at") >= depth)                        # the leading ones are those of the leaf
        .select("leaf", "h", "g", "c", "n", "lead", "at", F.xxhash64("token").alias("token"),
                F.col("token").rlike("\\p{L}").cast("int").alias("worded")), "cells")
    often = (cells.groupBy("leaf", "at", "token").agg(F.sum("c").alias("often"))
             .where(F.col("often") >= min_docs))
    need = F.greatest(F.ceil(F.col("n") * similarity).cast("int") - depth, F.lit(1))
    top = F.slice(F.array_sort("cells"), 1, need)
    return (cells.join(often, ["leaf", "at", "token"]).groupBy("leaf", "h", "g", "n", "lead")
            .agg(F.collect_list(F.struct((-F.col("often")).alias("o"), "at", "token", "worded")).alias("cells"))
            .where(F.size("cells") >= need).select("leaf", "h", "g", "n", "lead", top.alias("top"))
            .where((F.col("lead") + F.aggregate("top", F.lit(0), lambda a, x: a + x["worded"])) * 2 >= F.col("n"))
            .select("leaf", "h", "g", F.xxhash64(F.array_sort(F.transform(
                "top", lambda x: F.struct(x["at"], x["token"])))).alias("pattern")))


def every_recurring_line(rows: DataFrame, repeats: int = REPEATS, min_docs: int = MIN_DOCS,
                         min_tokens: int = MIN_TOKENS, depth: int = DEPTH, majority: float = MAJORITY,
                         similarity: float = SIMILARITY) -> tuple[DataFrame, DataFrame]:
    """As ``recurring_lines``, but a line of any length recurs in ``repeats``
    documents, a leaf holds a template for every pattern of frequent tokens
    beside the one of its majorities, and half of a template's places must be
    words of letters; other lines with figures are compared as they are."""
    lines = C.cut_lineage(_with_key(_compared_lines(rows, min_tokens, depth)).drop("masked"), "lines")
    own = C.cut_lineage(
        lines.groupBy("h", "g", "leaf", "doc").agg(F.count(F.lit(1)).alias("c"))
        .groupBy("h", "g", "leaf").agg(F.count(F.lit(1)).alias("docs"), F.min("doc").alias("first"),
                                       F.sum("c").alias("lines")), "line-counts")
    leaves = C.cut_lineage(
        own.where("leaf is not null").groupBy("leaf")
        .agg(F.count(F.lit(1)).alias("forms"), F.sum("docs").alias("docs"), F.sum("lines").alias("total"))
        .where((F.col("forms") > 1) & (F.col("docs") >= min_docs)).select("leaf", "total"), "leaves")
    variants = C.cut_lineage(
        _with_key(_compared_lines(rows, min_tokens, depth)).select("doc", "h", "g", "leaf", "masked")
        .join(leaves, "leaf"), "variants")
    members = C.cut_lineage(_followers(variants, majority, similarity, 0.5), "members")
    by_template = C.cut_lineage(
        members.select("leaf", "h", "g").distinct().join(_shared(members, ["leaf"], min_docs), "leaf")
        .select("h", "g", "first"), "majority-lines")
    # a line has one template, so that the first document of each template keeps its line
    patterns = C.cut_lineage(_patterns(variants, min_docs, depth, similarity)
                             .join(by_template.select("h", "g"), ["h", "g"], "left_anti"), "patterns")
    alike = variants.select("doc", "h", "g", "leaf").distinct().join(patterns, ["leaf", "h", "g"])
    by_pattern = (patterns.join(_shared(alike, ["leaf", "pattern"], min_docs), ["leaf", "pattern"])
                  .select("h", "g", "first"))
    by_line = own.where(F.col("docs") >= repeats).select("h", "g", "first")
    dropped = (by_template.unionByName(by_pattern).unionByName(by_line)
               .groupBy("h", "g").agg(F.min("first").alias("first")))
    return lines, C.cut_lineage(dropped, "recurring-lines")


def drop_recurring(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", min_docs: int = MIN_DOCS,
                   min_tokens: int = MIN_TOKENS, depth: int = DEPTH, majority: float = MAJORITY,
                   similarity: float = SIMILARITY) -> DataFrame:
    """One row per input row: ``doc_id, text, kept_text, n_lines, n_dropped``.

    Lines end at \\\\n; lines of fewer than ``min_tokens`` tokens are too short
    to tell and stay, as do blank lines.  The kept lines are joined by \\\\n.
    The first document is the one with the smallest id (rows without an id
    count as one document, the last), it keeps its lines; rows repeated under
    one id are one document.  A null text has no lines and stays null, an
    empty text has one empty line.  Other columns are not read; an empty
    table gives no rows.
    """
    rows = C.id_text(docs, id_col, text_col)
    rows = rows.select("doc_id", "text", F.coalesce("doc_id", F.lit(_NO_ID)).alias("doc"),
                       F.xxhash64("text").alias("row"))
    lines, dropped = recurring_lines(rows, min_docs, min_tokens, depth, majority, similarity)
    gone = (lines.join(dropped, ["h", "g"]).where(F.col("doc") != F.col("first"))
            .groupBy("doc", "row").agg(F.collect_set("pos").alias("gone")))
    gone = C.cut_lineage(gone, "dropped-lines")
    parts = F.split("text", "\n", -1)
    kept = F.filter(parts, lambda x, i: ~F.array_contains("gone", i))
    return (rows.join(gone, ["doc", "row"], "left")
            .select("doc_id", "text", F.when(F.col("gone").isNull(), F.col("text")).otherwise(
                        F.array_join(kept, "\n")).alias("kept_text"),
                    F.coalesce(F.size(parts), F.lit(0)).cast("bigint").alias("n_lines"),
                    F.coalesce(F.size("gone"), F.lit(0)).cast("bigint").alias("n_dropped"))
            .withColumn("n_lines", F.when(F.col("text").isNull(), F.lit(0).cast("bigint")).otherwise(F.col("n_lines")))
            .withColumn("n_dropped", F.greatest("n_dropped", F.lit(0).cast("bigint"))))


def strip_recurring(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", rule=recurring_lines,
                    **how) -> DataFrame:
    """``docs`` with the recurring lines of ``rule`` removed from the text, other columns
    unchanged.  A document that had words and loses all of them goes."""
    mine = ["__doc", "__row", "__gone"]
    doc, row, gone_col = C.fresh(docs, *mine)
    rows = C.id_text(docs, id_col, text_col).select(
        "text", F.coalesce("doc_id", F.lit(_NO_ID)).alias("doc"), F.xxhash64("text").alias("row"))
    lines, dropped = rule(rows, **how)
    gone = C.cut_lineage(
        lines.join(dropped, ["h", "g"]).where(F.col("doc") != F.col("first"))
        .groupBy(F.col("doc").alias(doc), F.col("row").alias(row)).agg(F.collect_set("pos").alias(gone_col)),
        "dropped-lines")
    text = F.col(text_col)
    kept = F.array_join(F.filter(F.split(text, "\n", -1), lambda x, i: ~F.array_contains(gone_col, i)), "\n")
    out = (docs.withColumn(doc, F.coalesce(F.col(id_col).cast("bigint"), F.lit(_NO_ID)))
           .withColumn(row, F.xxhash64(text.cast("string"))).join(gone, [doc, row], "left")
           .withColumn(text_col, F.when(F.col(gone_col).isNull(), text).otherwise(kept)))
    blank = F.length(F.regexp_replace(text, f"{C.SPACE_CLASS}+", "")) == 0
    return out.where(F.col(gone_col).isNull() | ~blank).select(docs.columns)


def digest(out: DataFrame) -> DataFrame:
    return out.select("doc_id", "n_lines", "n_dropped",
                      F.sha2(F.encode(F.coalesce("kept_text", F.lit("")), "UTF-8"), 256).alias("kept_sha256"))
