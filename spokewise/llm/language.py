"""Language of web pages by fusing evidence in Bayes' way.

Three kinds of evidence are multiplied for every candidate language: the likelihood of
the page's text under character trigram counts of that language (counted over all
labelled documents), the chance that pages of that language declare what this page's
markup declares, and a prior for the page's host. The last two come from grouped sums
of what the text alone says. Host priors are smoothed step by step towards the host's
domain, its address suffix and the whole collection, and leave out the page itself.

Results for odd input: a page without text is judged by markup and host alone; a page
that declares nothing gets no evidence from that; a NULL or malformed address falls
back on the whole collection; equal chances go to the language whose code comes first;
without labelled documents the language is NULL; repeated pages count each; an empty
table gives an empty result; further columns do no harm.
"""

from __future__ import annotations

import re
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, functions as F, types as T

from spokewise.llm.batches import batch_of, extended, map_batches
from spokewise.llm.html import host_of, main_text
from spokewise.session import stage

BUCKETS = 1 << 15
GRAM = 3
# Neighbouring trigrams overlap, so each counts as a part of an independent observation.
TEMPER = 0.3
# Languages a model may have; it goes to every task.
MOST_LANGUAGES = 500
# Pages of its parent's kind that a level's own counts are mixed with.
STRENGTH = 20.0
# A language's pages assumed at first: they declare that language nine times in ten.
DECLARED_PAGES = 10.0
DECLARED_RIGHT = 0.9

_LANG = re.compile(r"<html\b[^>]*?\blang\s*=\s*[\"']?\s*([A-Za-z]{2,8})", re.I)
_SPACE = re.compile(r"\s+")


def gram_buckets(text: str) -> np.ndarray:
    """Hashed trigrams of a text in lower case, white space as one blank, also at its ends."""
    text = _SPACE.sub(" ", f" {text.lower()} ")
    chars = np.frombuffer(text.encode("utf-32-le", "replace"), np.uint32)
    if len(chars) < GRAM:
        return np.zeros(0, np.int64)
    h = np.full(len(chars) - GRAM + 1, 2166136261, np.uint32)
    for k in range(GRAM):
        h = (h ^ chars[k : k + len(h)]) * np.uint32(16777619)
    h ^= h >> np.uint32(15)
    h *= np.uint32(0x2C1B3C6D)
    h ^= h >> np.uint32(12)
    return (h & np.uint32(BUCKETS - 1)).astype(np.int64)


@dataclass(frozen=True)
class TextModel:
    """Log chances of trigrams, and of each language."""

    languages: list[str]
    grams: np.ndarray  # bucket, language
    prior: np.ndarray

    def evidence(self, text: str) -> np.ndarray:
        buckets = gram_buckets(text)
        if len(buckets) == 0 or text.isspace():
            return np.zeros(len(self.languages))
        total = self.grams[buckets].sum(axis=0)
        return TEMPER * (total - total.max())


def fit(docs: DataFrame, text_column: str = "text", language_column: str = "lang") -> TextModel:
    """Count trigrams of all labelled documents; the result has a fixed size per language."""
    rows = docs.select(F.lower(F.trim(F.col(f"`{language_column}`"))).alias("lang"), F.col(f"`{text_column}`").alias("text"))
    rows = rows.filter("lang is not null and lang <> ''")

    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        sums: dict[str, np.ndarray] = {}
        for batch in batches:
            for lang, text in zip(batch.column(0).to_pylist(), batch.column(1)):
                own = sums.setdefault(lang, np.zeros(BUCKETS + 1, np.int64))
                own[BUCKETS] += 1
                own[:BUCKETS] += np.bincount(gram_buckets(text.as_py() or ""), minlength=BUCKETS)
            if len(sums) > MOST_LANGUAGES:
                raise ValueError(f"more than {MOST_LANGUAGES} languages")
        for lang, own in sums.items():
            at = np.flatnonzero(own)
            yield batch_of(pa.array([lang] * len(at), pa.string()), pa.array(at, pa.int32()), pa.array(own[at]))

    counted = map_batches(rows, count, "lang string, bucket int, n long").groupBy("lang", "bucket").agg(F.sum("n").alias("n"))
    table = counted.toPandas()  # at most BUCKETS rows for each language
    languages = sorted(table["lang"].unique())
    counts = np.zeros((BUCKETS + 1, len(languages)))
    counts[table["bucket"], np.searchsorted(languages, table["lang"])] = table["n"]
    pages, grams = counts[BUCKETS], counts[:BUCKETS] + 0.5
    prior = np.log((pages + 1) / (pages + 1).sum()) if languages else pages
    return TextModel(languages, np.log(grams / grams.sum(axis=0)), prior)


def _softmax(scores: Column) -> Column:
    top = F.array_max(scores)
    raised = F.transform(scores, lambda x: F.exp(x - top))
    total = F.aggregate(raised, F.lit(0.0), lambda a, x: a + x)
    return F.transform(raised, lambda x: x / total)


def _added(a: Column, b: Column) -> Column:
    return F.zip_with(a, b, lambda x, y: x + y)


def _sums(rows: DataFrame, key: str, name: str, count: int) -> DataFrame:
    """Per value of ``key`` the sum of the text's chances of each language."""
    sums = [F.sum(F.element_at("chance", k + 1)) for k in range(count)]
    return rows.groupBy(F.col(key).alias(f"{name}_key")).agg(F.array(*sums).alias(name))


def _smoothed(counts: Column, own: Column, parent: Column) -> Column:
    """Shares of a group without the page's own part, mixed with the parent's."""
    rest = F.zip_with(counts, own, lambda c, p: F.greatest(c - p, F.lit(0.0)))
    total = F.aggregate(rest, F.lit(0.0), lambda a, x: a + x)
    return F.zip_with(rest, parent, lambda c, p: (c + STRENGTH * p) / (total + STRENGTH))


def identify(
    pages: DataFrame,
    model: TextModel,
    id_column: str = "page_id",
    url_column: str = "url",
    html_column: str = "html",
) -> DataFrame:
    """One row per page: id, url, host, declared, text_lang, lang and its probability."""
    count = len(model.languages)
    host = host_of(F.col(f"`{url_column}`"))
    rows = pages.select(F.col(f"`{id_column}`").alias("id"), F.col(f"`{url_column}`").alias("url"), host.alias("host"), F.col(f"`{html_column}`").alias("html"))
    if count == 0:
        none = F.lit(None).cast("string")
        return rows.select(
            F.col("id").alias(id_column), F.col("url").alias(url_column), "host", none.alias("declared"),
            none.alias("text_lang"), none.alias("lang"), F.lit(None).cast("double").alias("probability"),
        )
    shared = pages.sparkSession.sparkContext.broadcast(model)

    def read(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            declared, evidence = [], []
            for page in batch.column(3):
                page = page.as_py() or ""
                found = _LANG.search(page)
                declared.append(found.group(1).lower() if found else None)
                evidence.append(shared.value.evidence(main_text(page)))
            yield batch_of(*batch.columns[:3], pa.array(declared, pa.string()), pa.array(evidence, pa.list_(pa.float64())))

    schema = extended(rows.schema.fields[:3], declared=T.StringType(), evidence=T.ArrayType(T.DoubleType()))
    found = map_batches(rows, read, schema)
    labels = F.split("host", "\\.")
    found = found.withColumns(
        {
            "domain": F.when(F.size(labels) > 1, F.array_join(F.slice(labels, -2, 2), ".")).otherwise(F.col("host")),
            "suffix": F.element_at(labels, -1),
            "chance": _softmax(_added(F.col("evidence"), F.array(*[F.lit(float(x)) for x in model.prior]))),
        }
    )
    found = stage(found, "evidence")
    everything = found.agg(*[F.coalesce(F.sum(F.element_at("chance", k + 1)), F.lit(0.0)).alias(f"s{k}") for k in range(count)]).first()
    total = sum(everything) + count
    base = F.array(*[F.lit((s + 1) / total) for s in everything])
    # Sums of all levels on one row per host, and of what is declared on one row per declaration.
    places = found.select("host", "domain", "suffix").distinct()
    for level in ("host", "domain", "suffix"):
        sums = _sums(found, level, f"{level}_sum", count)
        places = places.join(sums, F.col(level) == F.col(f"{level}_sum_key")).drop(f"{level}_sum_key")
    places = stage(places.select(F.col("host").alias("at_host"), "host_sum", "domain_sum", "suffix_sum"), "places")
    told = stage(_sums(found.filter("declared is not null"), "declared", "told", count), "declared")
    told_all = told.agg(*[F.coalesce(F.sum(F.element_at("told", k + 1)), F.lit(0.0)) for k in range(count)]).first()
    rows = found.join(places, F.col("host") == F.col("at_host")).join(told, F.col("declared") == F.col("told_key"), "left")
    chance = F.col("chance")
    prior = _smoothed(F.col("suffix_sum"), chance, base)
    prior = _smoothed(F.col("domain_sum"), chance, prior)
    prior = _smoothed(F.col("host_sum"), chance, prior)
    languages = F.array(*[F.lit(x) for x in model.languages])
    codes = F.transform(languages, lambda x: F.split(x, "[-_]")[0])
    assumed = F.transform(codes, lambda x: F.when(x == F.col("declared"), DECLARED_RIGHT).otherwise((1 - DECLARED_RIGHT) / count))
    all_told = F.array(*[F.lit(float(s)) for s in told_all])
    own_told = F.zip_with("told", chance, lambda c, p: F.greatest(c - p, F.lit(0.0)))
    parts = F.zip_with(own_told, assumed, lambda c, a: c + DECLARED_PAGES * a)
    weighed = F.zip_with(parts, all_told, lambda c, n: F.log(c / (n + DECLARED_PAGES)))
    scores = _added(F.col("evidence"), F.transform(prior, lambda p: F.log(p)))
    scores = F.when(F.col("declared").isNull(), scores).otherwise(_added(scores, weighed))
    rows = rows.withColumn("posterior", _softmax(scores))
    best = F.array_max("posterior")
    text_best = F.array_position("evidence", F.array_max("evidence"))
    return rows.select(
        F.col("id").alias(id_column),
        F.col("url").alias(url_column),
        "host",
        "declared",
        F.when(F.array_min("evidence") < 0, F.element_at(languages, text_best.cast("int"))).alias("text_lang"),
        F.element_at(languages, F.array_position("posterior", best).cast("int")).alias("lang"),
        best.alias("probability"),
    )
