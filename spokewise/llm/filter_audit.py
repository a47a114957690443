"""How filters of a corpus overlap, in every order they could be applied.

Each document fails or passes each filter, so a part of the corpus (here: a source) is
one tensor of counts with an axis of length two per filter. Whatever a report asks of a
step is a contraction of that tensor: along each axis the vector (1, 0) selects those
that pass, (0, 1) those that fail, and (1, 1) all. One ``einsum`` contracts the tensors
of a batch of parts with the vectors of all orders and steps at once, so the documents
are read once, whatever the number of orders.

Spark reads the texts, finds copies and counts; at most 2**filters rows a part are left,
and the contractions run on batches of parts in the tasks.

Results for odd input: NULL text counts as empty, an empty text has no words, and 0 of 0
is no failure; a NULL part is the empty string; of equal texts those above the smallest
id fail, so that rows which share that id all pass; a NULL id is below no other and above
none, so its row passes that filter; a document without a label, or with NULL labels, is
neither good nor toxic, and repeated labels count if any of them says so; repeated rows
count each; an empty table gives an empty result; further columns do no harm. Whole texts
are read, however long.
"""

from __future__ import annotations

from collections.abc import Iterator, Sequence
from dataclasses import dataclass
from itertools import permutations

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame, functions as F, types as T

from spokewise.llm.batches import by_place, place_of
from spokewise.session import stage

LEAST_WORDS = 200
MOST_UPPER_PERCENT = 2
LEAST_DISTINCT_PERCENT = 50
FILTERS = "ABCDE"
# What is counted of each combination of failures.
MEASURES = ("documents", "good", "toxic")
# Parts whose steps are worked out at once.
_PARTS_AT_ONCE = 256

PASS, FAIL, ALL = (1, 0), (0, 1), (1, 1)


def text_failures(text: Column) -> dict[str, Column]:
    """Failure conditions A to D of one text, which must not be NULL."""
    words = F.regexp_extract_all(text, F.lit("([^\\x20\\x09-\\x0D]+)"), 1)
    # Handed on as one value, so that the words are cut once.
    counts = F.transform(F.array(words), lambda w: F.struct(F.size(w).alias("all"), F.size(F.array_distinct(w)).alias("distinct")))[0]
    return {
        "A": counts["all"] < LEAST_WORDS,
        "B": 100 * counts["distinct"] < LEAST_DISTINCT_PERCENT * counts["all"],
        "C": 100 * F.regexp_count(text, F.lit("[A-Z]")) > MOST_UPPER_PERCENT * F.length(text),
        "D": text.rlike("[#$%&*|]"),
    }


def failures(docs: DataFrame, id_column: str = "doc_id", text_column: str = "text", part_column: str = "source") -> DataFrame:
    """One row per document: id, part and ``mask``, bit k of which is set if filter k of A to E fails."""
    plain = by_place(docs)
    text = F.coalesce(F.col(place_of(docs, text_column)), F.lit(""))
    bits = [F.when(failed, 1 << k).otherwise(0) for k, failed in enumerate(text_failures(text).values())]
    rows = plain.select(
        F.col(place_of(docs, id_column)).alias("id"),
        F.coalesce(F.col(place_of(docs, part_column)), F.lit("")).alias("part"),
        sum(bits[1:], bits[0]).cast("int").alias("text_mask"),
        F.unhex(F.sha2(text, 256)).alias("digest"),
    )
    rows = stage(rows, "failures")
    first = rows.groupBy("digest").agg(F.min("id").alias("first_id"), F.count(F.lit(1)).alias("copies"))
    # Written, so that the join below shuffles both sides alike and a large group can be split.
    first = stage(first.filter("copies > 1").select("digest", "first_id"), "firsts")
    rows = rows.join(first, "digest", "left")
    copy = F.when(F.col("id") > F.col("first_id"), 1 << 4).otherwise(0)
    return rows.select("id", "part", (F.col("text_mask") + copy).cast("int").alias("mask"))


def tallies(failed: DataFrame, labels: DataFrame) -> DataFrame:
    """One row per part: entry ``mask`` of the arrays ``documents``, ``good`` and ``toxic`` counts that combination."""
    told = by_place(labels)
    told = told.groupBy(F.col(place_of(labels, "doc_id")).alias("id")).agg(
        *[
            F.coalesce(F.max((F.col(place_of(labels, n)) == 1).cast("int")), F.lit(0)).alias(m)
            for m, n in (("good", "quality"), ("toxic", "toxic"))
        ]
    )
    rows = failed.join(told.filter("id IS NOT NULL AND good + toxic > 0"), "id", "left")
    counted = rows.groupBy("part", "mask").agg(
        F.count(F.lit(1)).alias("documents"),
        *[F.sum(F.coalesce(F.col(m), F.lit(0))).cast("long").alias(m) for m in ("good", "toxic")],
    )
    # At most 2**filters rows a part.
    found = counted.groupBy("part").agg(
        F.map_from_entries(F.collect_list(F.struct("mask", F.struct(*MEASURES)))).alias("of")
    )
    combinations = range(1 << len(FILTERS))
    none = F.lit(0).cast("long")
    filled = [
        F.array(*[F.coalesce(F.try_element_at("of", F.lit(k))[m], none) for k in combinations]).alias(m) for m in MEASURES
    ]
    return found.select("part", *filled)


@dataclass(frozen=True)
class Steps:
    """All orders of the filters and all their steps, as vectors along the axes of the tensor."""

    orders: list[str]  # per row: the order
    numbers: np.ndarray  # per row: the step, from 1
    own: np.ndarray  # per row: axis of the step's filter
    kept: np.ndarray  # (rows, axes, 2): what has passed this step
    removed: np.ndarray  # (rows, axes, 2): what this step removes

    @staticmethod
    def of(filters: str = FILTERS) -> Steps:
        orders, numbers, own, kept, removed = [], [], [], [], []
        for order in permutations(range(len(filters))):
            for k, axis in enumerate(order):
                passed = [PASS if a in order[:k] else ALL for a in range(len(filters))]
                orders.append("".join(filters[a] for a in order))
                numbers.append(k + 1)
                own.append(axis)
                kept.append([PASS if a == axis else v for a, v in enumerate(passed)])
                removed.append([FAIL if a == axis else v for a, v in enumerate(passed)])
        return Steps(orders, np.array(numbers), np.array(own), np.array(kept), np.array(removed))


def contract(tensors: np.ndarray, vectors: np.ndarray) -> np.ndarray:
    """Contract each tensor (first axis) with each row of vectors (first axis) along all axes."""
    axes = tensors.ndim - 1
    operands: list = [tensors, [0, *range(2, axes + 2)]]
    for a in range(axes):
        operands += [vectors[:, a], [1, a + 2]]
    return np.einsum(*operands, [0, 1], optimize=True)


def _tensors(column: pd.Series, axes: int) -> np.ndarray:
    """Counts by mask as tensors; bit k of the mask is axis k."""
    flat = np.array(column.tolist(), dtype=np.int64).reshape(len(column), *[2] * axes)
    return flat.transpose(0, *range(axes, 0, -1))


def audit(counted: DataFrame, filters: Sequence[str] = FILTERS) -> DataFrame:
    """One row per part, order of all filters and step, from the table of ``tallies``.

    ``kept``, ``removed``, ``redundant``, ``unique_fails``, ``good_lost``, ``toxic_lost``
    and ``shapley`` (what the step's filter removes, summed over all orders).
    """
    axes = len(filters)
    whole = ("kept", "removed", "redundant", "unique_fails", "good_lost", "toxic_lost", "shapley")
    schema = T.StructType(
        [T.StructField("part", T.StringType()), T.StructField("filter_order", T.StringType()), T.StructField("step", T.IntegerType())]
        + [T.StructField(n, T.LongType()) for n in whole]
    )

    def run(frames: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        steps = Steps.of("".join(filters))
        alone = np.array([[FAIL if a == axis else PASS for a in range(axes)] for axis in range(axes)])
        failing = np.array([[FAIL if a == axis else ALL for a in range(axes)] for axis in range(axes)])
        for frame in frames:
            for first in range(0, len(frame), _PARTS_AT_ONCE):
                parts = frame.iloc[first : first + _PARTS_AT_ONCE]
                documents, good, toxic = (_tensors(parts[m], axes) for m in MEASURES)
                removed = contract(documents, steps.removed)
                shapley = np.stack([removed[:, steps.own == a].sum(axis=1) for a in range(axes)], axis=1)
                values = {
                    "kept": contract(documents, steps.kept),
                    "removed": removed,
                    "redundant": contract(documents, failing)[:, steps.own] - removed,
                    "unique_fails": contract(documents, alone)[:, steps.own],
                    "good_lost": contract(good, steps.removed),
                    "toxic_lost": contract(toxic, steps.removed),
                    "shapley": shapley[:, steps.own],
                }
                yield pd.DataFrame(
                    {
                        "part": np.repeat(parts["part"].to_numpy(), len(steps.orders)),
                        "filter_order": steps.orders * len(parts),
                        "step": np.tile(steps.numbers, len(parts)).astype(np.int32),
                    }
                    | {n: values[n].reshape(-1) for n in whole}
                )

    return counted.mapInPandas(run, schema)


def audit_documents(docs: DataFrame, labels: DataFrame) -> DataFrame:
    """The five filters of this module over documents, audited per source."""
    return audit(tallies(failures(docs), labels))
