import pytest

from spokewise.llm import mixing as M


def rows_of(spark, rows):
    return spark.createDataFrame(rows, "doc_id long, text string, source string, target int")


def fill(sizes, weights=(5, 2, 1), most=3):
    """Targets by resharing again and again."""
    weight = {s: weights[k % len(weights)] for k, s in enumerate(sizes)}
    target, open_, left = {}, set(sizes), float(sum(sizes.values()))
    while True:
        total = sum(weight[s] for s in open_)
        over = [s for s in open_ if left * weight[s] / total > most * sizes[s]]
        if not over:
            return target | {s: left * weight[s] / total for s in open_}
        for s in over:
            target[s] = most * sizes[s]
            open_.remove(s)
        left = sum(sizes.values()) - sum(target.values())


def test_targets_by_resharing(spark):
    for sizes in ({"a": 10, "b": 100, "c": 1000, "d": 5}, {"a": 7}, {"a": 0, "b": 3}, {"b": 1, "é": 900, "z": 2, "zz": 40, "zzz": 40}):
        table = spark.createDataFrame(list(sizes.items()), "source string, source_size long")
        found = {r.source: r.target for r in M.targets(table).collect()}
        assert found == pytest.approx(fill(sizes))


def sample(spark):
    rows = []
    for k in range(400):
        source = ["big", "big", "mid", None, "tiny"][k % 5] if k < 390 else ""
        rows.append((k, " ".join(["w"] * (k % 37)), source, k))
    return rows + [(5000, None, "mid", 1), (5001, " \t", "mid", 1), (None, "a b", "mid", 1), (7, rows[7][1], "big", 1)]


def test_mix_takes_what_is_asked(spark):
    rows = sample(spark)
    mixed = M.mix(rows_of(spark, rows)).collect()
    assert len(mixed) == len(rows)
    sizes = {}
    for _, text, source, _ in sorted(rows, key=lambda r: (r[2] is None, r[2] or "")):
        sizes[source] = sizes.get(source, 0) + len((text or "").split())
    wanted = fill(sizes)
    for source, size in sizes.items():
        own = [r for r in mixed if r.source == source]
        assert all(r.source_size == size and r.target == pytest.approx(wanted[source]) for r in own)
        assert abs(sum(r.taken for r in own) - wanted[source]) <= 0.5 + 1e-6
    assert all(0 <= r.taken <= 3 * r.size for r in mixed)
    again = M.mix(rows_of(spark, rows).repartition(5)).collect()
    assert sorted(map(str, again)) == sorted(map(str, mixed))


def test_positions_follow_the_schedules(spark):
    rows = rows_of(spark, sample(spark))
    mixed = M.mix(rows)
    order = M.training_order(mixed).collect()
    assert [r.position for r in order] == sorted(r.position for r in order)
    assert all(0 <= r.position <= 1 for r in order)
    total = {}
    for r in order:
        total[r.doc_id, r.source] = total.get((r.doc_id, r.source), 0) + r.words
    taken = {}
    for r in mixed.collect():
        if r.taken:
            taken[r.doc_id, r.source] = taken.get((r.doc_id, r.source), 0) + r.taken
    assert total == taken
    # Source ranks: "", big, mid, tiny, NULL. "big" has schedule 1, which asks for more and more.
    early = sum(r.words for r in order if r.source == "big" and r.position < 0.5)
    late = sum(r.words for r in order if r.source == "big" and r.position >= 0.5)
    assert early / (early + late) == pytest.approx(0.375, abs=0.02)


def test_steady_schedule_is_linear(spark):
    rows = rows_of(spark, [(k, "w " * 10, "a", 0) for k in range(50)])
    mixed = M.mix(rows, schedules=(((0.0, 1.0), (1.0, 1.0)),))
    places = sorted(p for r in mixed.collect() for p in r.positions)
    assert places == pytest.approx([(k + 0.5) / 50 for k in range(50)])
    with pytest.raises(ValueError):
        M.mix(rows, schedules=(((0.0, 1.0), (0.5, 1.0)),))


def test_digest_places_every_copy(spark):
    rows = sample(spark)
    found = M.digest(rows_of(spark, rows)).collect()
    assert all(len(r.positions) == (-(-r.taken // r.size) if r.size else 0) for r in found)
    assert max(len(r.positions) for r in found) > 1
    assert all(list(r.positions) == sorted(r.positions) for r in found)
    first = [r.positions[0] for r in found if r.positions]
    assert first == sorted(first) and all(not r.positions for r in found[len(first) :])


def test_nothing_to_mix(spark):
    assert M.digest(rows_of(spark, []).limit(0)).count() == 0
    empty = M.digest(rows_of(spark, [(1, None, "a", 1), (2, "", None, 1)])).collect()
    assert [(r.size, r.target, r.taken) for r in empty] == [(0, 0.0, 0)] * 2
