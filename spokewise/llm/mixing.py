"""Mixing sources to target weights as a curriculum over training time.

Sources share all words of the corpus by weight, each up to ``most_epochs`` times its
own size; what a full source cannot take goes to the others by weight. Inside a source
documents come in hash order, as often as the target needs, the last one in part.

Each source also has a weight schedule over training time 0..1, as straight pieces. The
integral of its schedule is its cumulative demand for words. Inverting it at the middle
of a document's words gives the document's training position, and a range sort by
position gives the training order. Schedules move words in time, not between sources.

Native: only DataFrame functions. Running sums are split over hash slices of a source,
so a source with a third of all rows is no single task.

Results for odd input: NULL text has size 0; NULL is a source of its own, after all
others; a source without words has target 0; repeated rows count each; NULL ids are
ordinary values; an empty table gives an empty result; further columns do no harm.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window, functions as F

WEIGHTS = (5, 2, 1)
MOST_EPOCHS = 3
# Hash slices a source's running sum is split into: 16**SLICE_DIGITS.
SLICE_DIGITS = 3
# Knots (time, relative weight) of the schedules, given to the sources in turn.
SCHEDULES = (
    ((0.0, 1.5), (1.0, 0.5)),
    ((0.0, 0.5), (1.0, 1.5)),
    ((0.0, 0.5), (0.5, 1.5), (1.0, 0.5)),
)


def word_count(text: Column) -> Column:
    """Runs of anything but ASCII white space."""
    return F.coalesce(F.regexp_count(text, F.lit("[^\\x20\\x09-\\x0D]+")), F.lit(0)).cast("long")


def targets(sizes: DataFrame, weights: Sequence[int] = WEIGHTS, most_epochs: int = MOST_EPOCHS) -> DataFrame:
    """Add ``rank``, ``target`` and ``epochs`` to a table (source, source_size).

    In order of size per weight the first sources fill up; the others share the rest.
    The windows run over one row per source.
    """
    ranked = sizes.withColumn("rank", F.row_number().over(Window.orderBy(F.col("source").asc_nulls_last())) - 1)
    weight = F.element_at(F.array(*[F.lit(w).cast("long") for w in weights]), (F.col("rank") % len(weights) + 1).cast("int"))
    ranked = ranked.withColumn("weight", weight).withColumn("most", F.col("source_size") * most_epochs)
    everything = Window.partitionBy()
    by_room = Window.orderBy(F.col("most") / F.col("weight"), "rank")
    before = by_room.rowsBetween(Window.unboundedPreceding, -1)
    ranked = (
        ranked.withColumn("all_words", F.sum("source_size").over(everything))
        .withColumn("all_weight", F.sum("weight").over(everything))
        .withColumn("full_before", F.coalesce(F.sum("most").over(before), F.lit(0)))
        .withColumn("weight_before", F.coalesce(F.sum("weight").over(before), F.lit(0)))
    )
    # Words per weight if this and all later sources shared what the earlier ones leave.
    level = (F.col("all_words") - F.col("full_before")) / (F.col("all_weight") - F.col("weight_before"))
    ranked = ranked.withColumn("level", level)
    # The first source that the level does not fill sets it for all after it; all before it are full.
    place = F.struct((F.col("most") / F.col("weight")).alias("room"), "rank")
    open_place = F.when(F.col("level") * F.col("weight") <= F.col("most"), F.struct(place.alias("place"), "level"))
    first = F.min(open_place).over(everything)
    ranked = ranked.withColumns({"fits": place >= first["place"], "share_level": first["level"]})
    target = F.when(F.col("fits"), F.col("share_level") * F.col("weight")).otherwise(F.col("most").cast("double"))
    return ranked.select("source", "source_size", "rank", target.alias("target"))


def _position(at: Column, schedule: Column) -> Column:
    """Time at which a share ``at`` (0..1) of a source's words is reached.

    ``schedule`` is an array of pieces (t0, t1, w0, w1, c0, c1), c being the cumulative
    share at the piece's ends.
    """
    piece = F.element_at(F.filter(schedule, lambda p: (p["c1"] >= at) | (p["t1"] >= 1)), 1)
    # Inside a piece demand is w0 x + (w1 - w0) x^2 / 2 over x = 0..1, scaled to c0..c1.
    area = (piece["w0"] + piece["w1"]) / 2
    wanted = (at - piece["c0"]) / (piece["c1"] - piece["c0"]) * area
    slope = piece["w1"] - piece["w0"]
    root = F.sqrt(F.greatest(F.lit(0.0), piece["w0"] * piece["w0"] + 2 * slope * wanted))
    # The form with the root below the line holds for a slope of 0, too.
    inside = F.when(wanted <= 0, F.lit(0.0)).otherwise(2 * wanted / (piece["w0"] + root))
    return piece["t0"] + (piece["t1"] - piece["t0"]) * inside


def _pieces(knots: Sequence[tuple[float, float]]) -> Column:
    areas = [(b[0] - a[0]) * (a[1] + b[1]) / 2 for a, b in zip(knots, knots[1:])]
    if knots[0][0] != 0 or knots[-1][0] != 1 or min(areas) <= 0 or min(w for _, w in knots) < 0:
        raise ValueError("a schedule runs from 0 to 1 with weights above 0")
    total, done, rows = sum(areas), 0.0, []
    for (t0, w0), (t1, w1), area in zip(knots, knots[1:], areas):
        c0, done = done, done + area / total
        rows.append(
            F.struct(*[F.lit(float(v)).alias(n) for n, v in zip(("t0", "t1", "w0", "w1", "c0", "c1"), (t0, t1, w0, w1, c0, done))])
        )
    return F.array(*rows)


def mix(
    docs: DataFrame,
    id_column: str = "doc_id",
    text_column: str = "text",
    source_column: str = "source",
    weights: Sequence[int] = WEIGHTS,
    most_epochs: int = MOST_EPOCHS,
    schedules: Sequence[Sequence[tuple[float, float]]] = SCHEDULES,
    slice_digits: int = SLICE_DIGITS,
) -> DataFrame:
    """One row per document: id, source, size, source_size, target, taken and the positions of its copies.

    ``taken`` words are ``taken / size`` copies; ``positions`` has one entry per copy
    begun, in the order of training time.
    """
    order = F.md5(F.coalesce(F.col(f"`{id_column}`").cast("string"), F.lit("")))
    rows = docs.select(
        F.col(f"`{id_column}`").alias("id"),
        F.col(f"`{source_column}`").alias("source"),
        word_count(F.col(f"`{text_column}`")).alias("size"),
        order.alias("mark"),
    ).withColumn("slice", F.substring("mark", 1, slice_digits))
    slices = rows.groupBy("source", "slice").agg(F.sum("size").alias("slice_size"))
    sources = slices.groupBy("source").agg(F.sum("slice_size").alias("source_size"))
    plan = targets(sources, weights, most_epochs)
    # Running sums over slices: at most 16**slice_digits rows for each source.
    ahead = Window.partitionBy("source").orderBy("slice").rowsBetween(Window.unboundedPreceding, -1)
    slices = slices.withColumn("slice_start", F.coalesce(F.sum("slice_size").over(ahead), F.lit(0)))
    plan = slices.join(plan, slices["source"].eqNullSafe(plan["source"])).select(
        slices["source"].alias("p_source"), slices["slice"].alias("p_slice"), "slice_start", "source_size", "rank", "target"
    )
    inner = Window.partitionBy("source", "slice").orderBy("mark", F.col("id").asc_nulls_first(), "size")
    inner = inner.rowsBetween(Window.unboundedPreceding, -1)
    rows = rows.withColumn("inner_start", F.coalesce(F.sum("size").over(inner), F.lit(0)))
    rows = rows.join(plan, F.col("source").eqNullSafe(F.col("p_source")) & (F.col("slice") == F.col("p_slice")))
    start = F.col("slice_start") + F.col("inner_start")
    wanted = F.floor(F.col("target") + 0.5).cast("long")
    epochs = F.when(F.col("source_size") > 0, F.floor(wanted / F.col("source_size"))).otherwise(0).cast("long")
    rest = F.greatest(F.lit(0).cast("long"), F.least(F.col("size"), wanted - epochs * F.col("source_size") - start))
    rows = rows.withColumns({"start": start, "epochs": epochs, "rest": rest})
    curve = F.element_at(F.array(*[_pieces(s) for s in schedules]), (F.col("rank") % len(schedules) + 1).cast("int"))
    # Words of the source before copy k, plus half the copy: the middle of its words.
    copies = (F.col("epochs") + F.when(F.col("rest") > 0, 1).otherwise(0)).cast("int")
    middle = lambda k: k * F.col("source_size") + F.col("start") + F.when(k < F.col("epochs"), F.col("size")).otherwise(F.col("rest")) / 2
    positions = F.transform(
        F.sequence(F.lit(0), F.greatest(copies, F.lit(1)) - 1),
        lambda k: _position(F.least(F.lit(1.0), middle(k) / F.greatest(wanted, F.lit(1))), curve),
    )
    return rows.select(
        F.col("id").alias(id_column),
        "source",
        "size",
        "source_size",
        "target",
        (F.col("epochs") * F.col("size") + F.col("rest")).alias("taken"),
        F.when(F.col("size") * copies > 0, positions).otherwise(F.array().cast("array<double>")).alias("positions"),
    )


def training_order(mixed: DataFrame, id_column: str = "doc_id") -> DataFrame:
    """One row per copy, range-sorted by training position."""
    copies = mixed.select(
        id_column, "source", "size", "taken", F.posexplode("positions").alias("copy", "position")
    )
    words = F.least(F.col("size"), F.col("taken") - F.col("copy") * F.col("size"))
    return copies.select(id_column, "source", "copy", words.alias("words"), "position").orderBy("position", id_column, "copy")


def digest(docs: DataFrame, id_column: str = "doc_id", **options) -> DataFrame:
    """One row per document, range-sorted by the position of its first copy; what the mix leaves out comes last.

    ``positions`` has the place of every copy in training time.
    """
    mixed = mix(docs, id_column, **options)
    first = F.get("positions", F.lit(0))
    ordered = mixed.orderBy(first.asc_nulls_last(), id_column)
    return ordered.select(id_column, "source", "size", "source_size", "target", "taken", "positions")
