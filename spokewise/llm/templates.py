"""Recurring lines removed by a tree of line templates.

Lines are parsed at a fixed depth: by their number of tokens, then by their leading
tokens; tokens with a digit are fields from the start. In the leaf so reached, a token
that enough of the leaf's documents have in its place is constant and any other is a
field. What remains is the line's template. Templates that occur in many documents are
boilerplate, and all their lines are dropped.

Native: only DataFrame functions. Equal lines are counted together before anything is
joined or unfolded, so a line that a third of all documents share is one row with a
weight. A leaf keeps at most ``1 / CONSTANT_SHARE`` constants in a place.

Results for odd input: a NULL text stays NULL with 0 lines, an empty one stays empty
with one empty line; lines shorter than ``LEAST_TOKENS`` are never dropped; repeated
lines of one document count once towards recurrence but all go; repeated rows and
copies count as documents each; rows with NULL ids are treated like others; an empty
table gives an empty result; further columns do no harm.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, functions as F

from spokewise.llm.batches import by_place, place_of
from spokewise.session import stage

LEADING = 2
LEAST_TOKENS = 4
# Documents a template occurs in, at least, to be dropped.
LEAST_DOCUMENTS = 10
# Share of a leaf's lines that a constant token has in its place, and of constant tokens in a template.
CONSTANT_SHARE = 0.05
LEAST_CONSTANT = 0.5
FIELD = "<*>"


def token_count(masked: Column) -> Column:
    """Tokens are what stands between blanks."""
    return F.octet_length(masked) - F.octet_length(F.replace(masked, F.lit(" "), F.lit(""))) + 1


def masked_line(line: Column) -> Column:
    """The trimmed line with a field for each token that has a digit."""
    return F.when(line.rlike("[0-9]"), F.regexp_replace(line, "[^ ]*[0-9][^ ]*", FIELD)).otherwise(line)


def _unfolded(docs: DataFrame, text_column: str, *carried: Column) -> DataFrame:
    """One row per line that may be dropped: what is carried along, its ``place`` in the text, and ``masked``."""
    lines = docs.select(*carried, F.posexplode(F.split(F.col(f"`{text_column}`"), "\n")).alias("place", "line"))
    names = [c for c in lines.columns if c != "line"]
    lines = lines.select(*names, F.trim("line").alias("line"))
    # A field is one token like the token it stands for, so short lines go before any is masked.
    lines = lines.filter(token_count(F.col("line")) >= LEAST_TOKENS)
    return lines.select(*names, masked_line(F.col("line")).alias("masked"))


def text_key(text: Column) -> Column:
    """128 bits that stand for a text, so that it need not travel."""
    return F.struct(F.xxhash64(text).alias("a"), F.xxhash64(F.lit(1), text).alias("b"))


def leaf_of(masked: Column) -> Column:
    """Leaf of a masked line: number of tokens and the leading ones."""
    return F.xxhash64(token_count(masked), F.substring_index(masked, " ", LEADING))


def _lines_and_recurring(docs: DataFrame, text_column: str, least_documents: int) -> tuple[DataFrame, DataFrame]:
    """The lines of frequent leaves (row, text_key, leaf, masked, places), and those that recur (masked, template, documents)."""
    # Lines bound documents from above, which is enough to leave out rare leaves.
    leaves = _unfolded(docs, text_column).select(leaf_of(F.col("masked")).alias("o_leaf"))
    often = leaves.groupBy("o_leaf").agg(F.count(F.lit(1)).alias("n")).filter(F.col("n") >= least_documents)
    often = stage(often.select("o_leaf"), "leaves")
    # The key is taken before the text is unfolded, else it would be once per line.
    text = F.col(f"`{text_column}`")
    numbered = docs.select(text, F.monotonically_increasing_id().alias("row"), text_key(text).alias("text_key"))
    lines = _unfolded(numbered, text_column, F.col("row"), F.col("text_key")).withColumn("leaf", leaf_of(F.col("masked")))
    lines = lines.join(often, F.col("leaf") == F.col("o_leaf"), "left_semi")
    # The row number is fixed by being written; it only serves to count documents.
    lines = stage(lines.groupBy("row", "text_key", "leaf", "masked").agg(F.collect_list("place").alias("places")), "lines")
    weighed = stage(lines.groupBy("leaf", "masked").agg(F.count(F.lit(1)).alias("weight")), "weighed")
    sizes = weighed.groupBy("leaf").agg(F.sum("weight").alias("size"))
    places = weighed.select("leaf", "weight", F.posexplode(F.split("masked", " ")).alias("place", "token"))
    common = places.groupBy("leaf", "place", "token").agg(F.sum("weight").alias("weight"))
    common = common.join(sizes, "leaf").filter(
        (F.col("weight") >= least_documents) & (F.col("weight") >= CONSTANT_SHARE * F.col("size")) & (F.col("token") != FIELD)
    )
    constants = common.groupBy("leaf", "place").agg(F.collect_set("token").alias("tokens"))
    constants = constants.groupBy(F.col("leaf").alias("c_leaf")).agg(F.map_from_entries(F.collect_list(F.struct("place", "tokens"))).alias("constants"))
    parsed = weighed.join(constants, F.col("leaf") == F.col("c_leaf"))
    parts = F.split("masked", " ")
    is_constant = lambda t, k: F.coalesce(F.array_contains(F.col("constants")[k], t), F.lit(False))
    template = F.transform(parts, lambda t, k: F.when(is_constant(t, k), t).otherwise(FIELD))
    fixed = F.size(F.filter(template, lambda t: t != FIELD))
    parsed = parsed.filter(fixed >= LEAST_CONSTANT * F.size(parts)).select("leaf", "masked", F.array_join(template, " ").alias("template"))
    parsed = stage(parsed, "templates")
    # A document with several lines of one template counts once.
    named = lines.join(parsed.select(F.col("masked").alias("p_masked"), "template"), F.col("masked") == F.col("p_masked"))
    counts = named.select("template", "row").distinct().groupBy("template").agg(F.count(F.lit(1)).alias("documents"))
    counts = counts.filter(F.col("documents") >= least_documents).withColumnRenamed("template", "t_template")
    found = parsed.join(counts, F.col("template") == F.col("t_template"))
    return lines, found.select("masked", "template", "documents")


def recurring_lines(docs: DataFrame, text_column: str = "text", least_documents: int = LEAST_DOCUMENTS) -> DataFrame:
    """(masked, template, documents): the masked lines whose template recurs."""
    return _lines_and_recurring(docs, text_column, least_documents)[1]


def drop_recurring_lines(
    docs: DataFrame, text_column: str = "text", least_documents: int = LEAST_DOCUMENTS
) -> DataFrame:
    """All columns of ``docs``, the text without recurring lines, and ``n_lines`` and ``n_dropped``."""
    names, text_at = docs.columns, place_of(docs, text_column)
    docs = by_place(docs)
    lines, recurring = _lines_and_recurring(docs, text_at, least_documents)
    recurring = stage(recurring.select(F.col("masked").alias("r_masked")), "recurring")
    hits = lines.join(recurring, F.col("masked") == F.col("r_masked"), "left_semi")
    # What goes depends on the text alone, so equal texts share one row of hits.
    hits = hits.select(F.col("text_key").alias("__key"), F.explode("places").alias("place"))
    hits = hits.groupBy("__key").agg(F.collect_set("place").alias("__gone"))
    text = F.col(text_at)
    rows = docs.join(hits, text_key(text) == F.col("__key"), "left")
    count = F.when(text.isNull(), 0).otherwise(F.octet_length(text) - F.octet_length(F.replace(text, F.lit("\n"), F.lit(""))) + 1)
    rows = rows.withColumns({"__lines": count, "__parts": F.when(F.col("__gone").isNotNull(), F.split(text, "\n"))})
    # Line by line by its place: both steps take time in proportion to the lines.
    stays = F.array_except(F.sequence(F.lit(0), F.size("__parts") - 1), F.col("__gone"))
    rows = rows.withColumn("__kept", F.transform(stays, lambda k: F.get(F.col("__parts"), k)))
    new_text = F.when(F.col("__gone").isNull(), text).otherwise(F.array_join("__kept", "\n"))
    gone = F.when(F.col("__gone").isNull(), 0).otherwise(F.size("__gone")).cast("long")
    columns = [new_text if n == text_at else F.col(n) for n in docs.columns]
    return rows.select(*columns, F.col("__lines").cast("long"), gone).toDF(*names, "n_lines", "n_dropped")
