"""Line dedup by a log-template tree of fixed depth.

A line goes to the leaf named by its number of tokens and its first tokens (those
with a digit count as a variable there). Inside a leaf a token is a constant of its
place if enough documents' lines have it there, and a variable field otherwise; a
line's template has ``<*>`` for its variable fields. A template that is constant
enough and occurs in enough documents is boilerplate: its lines go, in all documents.

``drop_templates`` states exactly what the query's SQL states. ``drop_repeats`` loses no
line altogether: it counts distinct texts in place of ids and keeps a line, or a template,
in the first document that has it.

All counts combine before they are shuffled, so neither a line nor a leaf that a
third of the corpus shares meets in one task; the result does not depend on order.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, functions as F

from loadpanel.scale import is_small, materialize

TOKEN = r"([^\x20\x09-\x0D]+)"
DEPTH = 2
MIN_DOCS = 10
MIN_CONSTANT = 0.5
FIELD = "<*>"


def _text() -> Column:
    return F.coalesce(F.col("text").cast("string"), F.lit(""))


def _two(name: str, *parts: Column) -> list[Column]:
    """A 128-bit name of the parts, as two columns."""
    return [F.xxhash64(*parts).alias(f"{name}1"), F.xxhash64(F.lit(name), *reversed(parts)).alias(f"{name}2")]


ROW, LINE = ["row1", "row2"], ["line1", "line2"]


def _row_name() -> list[Column]:
    return _two("row", F.coalesce(F.col("doc_id").cast("string"), F.lit("null")), _text())


def _document() -> Column:
    """What counts as one document: the id, each null one by its text."""
    return F.coalesce(F.col("doc_id").cast("string"), F.concat(F.lit("null-"), F.sha2(_text(), 256)))


def _lines(docs: DataFrame, depth: int) -> DataFrame:
    """Every line that has tokens: the row it is in, doc, no, line, its name, tokens and leaf."""
    lines = docs.select(
        *_row_name(), _document().alias("doc"), F.posexplode(F.split(_text(), "\n", -1)).alias("no", "line")
    )
    lines = lines.withColumn("tokens", F.regexp_extract_all("line", F.lit(TOKEN), F.lit(1))).filter(F.size("tokens") > 0)
    lead = F.transform(
        F.slice("tokens", 1, depth), lambda t: F.when(t.rlike("[0-9]"), F.lit(FIELD)).otherwise(t)
    )
    return lines.select("*", *_two("line", F.col("line")), F.concat_ws(" ", F.size("tokens").cast("string"), lead).alias("leaf"))


def _small(keys: DataFrame) -> DataFrame:
    return F.broadcast(keys) if is_small(keys) else keys


def line_templates(
    docs: DataFrame, depth: int = DEPTH, min_docs: int = MIN_DOCS, min_constant: float = MIN_CONSTANT
) -> tuple[DataFrame, DataFrame]:
    """The recurring templates (leaf, template, n_docs), and the rows (row1, row2, no) of the lines that have one."""
    lines = _lines(docs, depth)
    leaves = lines.select("leaf", "doc").distinct().groupBy("leaf").agg(F.count(F.lit(1)).alias("n_docs"))
    leaves = materialize(leaves.filter(F.col("n_docs") >= min_docs).select("leaf"), "template-leaves")
    rows = materialize(
        lines.join(_small(leaves), "leaf", "left_semi").select(*ROW, *LINE, "doc", "no", "line", "leaf"), "template-lines"
    )
    # Each distinct line once, with the number of documents that have it; its text is shuffled once.
    held = rows.select(*LINE, "doc").distinct().groupBy(*LINE).agg(F.count(F.lit(1)).alias("n"))
    texts = rows.groupBy(*LINE).agg(F.first("line").alias("line"), F.first("leaf").alias("leaf"))
    tokens = F.regexp_extract_all("line", F.lit(TOKEN), F.lit(1))
    distinct = materialize(texts.join(held, LINE).select(*LINE, "leaf", "n", tokens.alias("tokens")), "template-distinct")
    places = distinct.select(*LINE, "leaf", "n", F.size("tokens").alias("size"), F.posexplode("tokens").alias("place", "token"))
    constants = places.groupBy("leaf", "place", "token").agg(F.sum("n").alias("support"))
    constants = materialize(constants.filter(F.col("support") >= min_docs).drop("support"), "template-constants")
    # Only constants go on: they and the number of tokens make the template.
    marked = places.join(_small(constants), ["leaf", "place", "token"])
    named = marked.groupBy(*LINE).agg(
        F.first("leaf").alias("leaf"),
        F.first("size").alias("size"),
        F.map_from_entries(F.collect_list(F.struct("place", "token"))).alias("constants"),
    )
    fields = F.transform(
        F.sequence(F.lit(0), F.col("size") - 1), lambda i: F.coalesce(F.col("constants")[i], F.lit(FIELD))
    )
    named = named.filter(F.size("constants") >= F.col("size") * min_constant)
    named = materialize(named.select(*LINE, "leaf", F.concat_ws(" ", fields).alias("template")), "template-named")
    found = rows.select(*ROW, *LINE, "doc", "no").join(_small(named), LINE)
    templates = (
        found.select("leaf", "template", "doc").distinct().groupBy("leaf", "template").agg(F.count(F.lit(1)).alias("n_docs"))
    )
    templates = materialize(templates.filter(F.col("n_docs") >= min_docs), "templates")
    key = ["leaf", "template"]
    return templates, found.join(_small(templates).select(*key), key, "left_semi").select(*ROW, "no")


def drop_templates(
    docs: DataFrame, depth: int = DEPTH, min_docs: int = MIN_DOCS, min_constant: float = MIN_CONSTANT
) -> DataFrame:
    """One row per row of ``docs``: doc_id, n_lines, n_dropped and the text that is left.

    Lines end at a line feed; what is left is joined by one. A line without tokens
    is kept. A null or empty text is one empty line. Rows that repeat an id count as
    one document; rows with a null id as one for each text. Other columns are not
    looked at. Without rows, no rows.
    """
    return _without(docs, line_templates(docs, depth, min_docs, min_constant)[1])


def _without(docs: DataFrame, dropped: DataFrame) -> DataFrame:
    """``docs`` without the lines of the rows (row1, row2, no)."""
    # The line numbers of one document, bounded by its text.
    gone = materialize(dropped.groupBy(*ROW).agg(F.collect_set("no").alias("gone")), "template-dropped")
    rows = docs.select(F.col("doc_id").cast("long").alias("doc_id"), _text().alias("text"), *_row_name())
    lines = F.split("text", "\n", -1)
    marked = rows.join(gone, ROW, "left").withColumn("gone", F.coalesce("gone", F.array().cast("array<int>")))
    kept = F.filter(lines, lambda line, i: ~F.array_contains("gone", i))
    return marked.select(
        "doc_id",
        F.size(lines).cast("long").alias("n_lines"),
        F.size("gone").cast("long").alias("n_dropped"),
        F.array_join(kept, "\n").alias("text"),
    )


def _first() -> Column:
    """The row with the smallest doc_id, null last, and of equal ids the one with the smallest name."""
    return F.min(F.struct(F.col("id").isNull().alias("null"), "id", *ROW)).alias("first")


def _later() -> Column:
    """Whether a row is another one than the first."""
    return (F.col("row1") != F.col("first.row1")) | (F.col("row2") != F.col("first.row2"))


def _repeated_templates(lines: DataFrame, depth: int, min_docs: int, min_constant: float) -> DataFrame:
    """The rows (row1, row2, no) of lines with a recurring template that has variable fields, but for its first document."""
    leaves = lines.select("leaf", "doc").distinct().groupBy("leaf").agg(F.count(F.lit(1)).alias("n_docs"))
    leaves = materialize(leaves.filter(F.col("n_docs") >= min_docs).select("leaf"), "repeat-leaves")
    rows = lines.join(_small(leaves), "leaf", "left_semi")
    rows = materialize(rows.select(*ROW, *LINE, "doc", "id", "no", "line", "leaf"), "repeat-lines")
    held = rows.select(*LINE, "doc").distinct().groupBy(*LINE).agg(F.count(F.lit(1)).alias("n"))
    texts = rows.groupBy(*LINE).agg(F.first("line").alias("line"), F.first("leaf").alias("leaf"))
    tokens = F.regexp_extract_all("line", F.lit(TOKEN), F.lit(1))
    distinct = materialize(texts.join(held, LINE).select(*LINE, "leaf", "n", tokens.alias("tokens")), "repeat-distinct")
    places = distinct.select(*LINE, "leaf", "n", F.size("tokens").alias("size"), F.posexplode("tokens").alias("place", "token"))
    constants = places.groupBy("leaf", "place", "token").agg(F.sum("n").alias("support"))
    constants = materialize(constants.filter(F.col("support") >= min_docs).drop("support"), "repeat-constants")
    named = places.join(_small(constants), ["leaf", "place", "token"]).groupBy(*LINE).agg(
        F.first("leaf").alias("leaf"),
        F.first("size").alias("size"),
        F.map_from_entries(F.collect_list(F.struct("place", "token"))).alias("constants"),
    )
    # The leading tokens name the leaf, so only those behind them say that lines are alike.
    behind = F.size(F.filter(F.map_keys("constants"), lambda i: i >= depth))
    alike = (behind > 0) & (behind >= (F.col("size") - depth) * min_constant)
    named = named.filter(alike & (F.size("constants") < F.col("size")))
    fields = F.transform(
        F.sequence(F.lit(0), F.col("size") - 1), lambda i: F.coalesce(F.col("constants")[i], F.lit(FIELD))
    )
    named = materialize(named.select(*LINE, "leaf", F.concat_ws(" ", fields).alias("template")), "repeat-named")
    found = rows.select(*ROW, *LINE, "doc", "id", "no").join(_small(named), LINE)
    key = ["leaf", "template"]
    counted = found.select(*key, "doc").distinct().groupBy(*key).agg(F.count(F.lit(1)).alias("n_docs"))
    often = materialize(counted.filter(F.col("n_docs") >= min_docs).select(*key), "repeat-often")
    firsts = materialize(
        found.join(_small(often), key, "left_semi").groupBy(*key).agg(_first()), "repeat-templates"
    )
    return found.join(_small(firsts), key).filter(_later()).select(*ROW, "no")


def drop_repeats(
    docs: DataFrame, depth: int = DEPTH, min_docs: int = MIN_DOCS, min_constant: float = MIN_CONSTANT
) -> DataFrame:
    """One row per row of ``docs``: doc_id, n_lines, n_dropped and the text that is left.

    Copies of one text are one document here. A line that two different texts have
    stays in the first document that has it and goes from all others. A template with
    variable fields goes the same way from ``min_docs`` different texts on, if
    ``min_constant`` of its tokens behind the leading ones, and one at least, are
    constants. First is the smallest doc_id, null last; rows that repeat an id are told
    apart by their texts. Copies of a text that shares no line with another stay whole.
    Other rules are those of ``drop_templates``.
    """
    text = F.struct(*_two("text", _text()))
    named = docs.select(F.col("doc_id").cast("long").alias("id"), text.alias("doc"), *_row_name(), F.posexplode(F.split(_text(), "\n", -1)).alias("no", "line"))
    named = named.filter(F.col("line").rlike(TOKEN)).select("*", *_two("line", F.col("line")))
    # Only names are shuffled, and combined before: two texts are known by their smallest and largest name.
    ends = named.groupBy(*LINE).agg(_first(), F.min("doc").alias("low"), F.max("doc").alias("high"))
    repeated = materialize(ends.filter("low != high").select(*LINE, "first"), "repeat-exact")
    exact = named.select(*ROW, *LINE, "no").join(_small(repeated), LINE).filter(_later()).select(*ROW, "no")
    tokens = F.regexp_extract_all("line", F.lit(TOKEN), F.lit(1))
    lead = F.transform(F.slice(tokens, 1, depth), lambda t: F.when(t.rlike("[0-9]"), F.lit(FIELD)).otherwise(t))
    lines = named.withColumn("leaf", F.concat_ws(" ", F.size(tokens).cast("string"), lead))
    both = exact.unionByName(_repeated_templates(lines, depth, min_docs, min_constant))
    return _without(docs, both)
