import random

import numpy as np
import pyarrow as pa
from pyspark.sql import functions as F

from spokewise.llm import quality as Q
from spokewise.llm.batches import slices


def table(spark, rows):
    return spark.createDataFrame(rows, "doc_id long, text string, score int, predicted string")


def sample(spark, count=240):
    rng, rows, labels = random.Random(1), [], []
    for k in range(count):
        good = k % 3 != 0
        words = [rng.choice(["the", "house", "stands", "near", "water", "été"]) + ("" if good else "$$$") for _ in range(rng.randrange(5, 60))]
        rows.append((k, " ".join(words), k, "x"))
        labels.append((k, int(good)))
    return table(spark, rows), spark.createDataFrame(labels, "doc_id long, quality int")


def test_learns_and_passes_held_out_rows(spark):
    docs, labels = sample(spark)
    model = Q.fit(docs, labels, use=~Q.held_out())
    rows = Q.score(docs, model, keep=["doc_id"]).withColumn("held", Q.held_out()).join(labels, "doc_id").collect()
    held = [r for r in rows if r.held]
    assert 0.1 < len(held) / len(rows) < 0.4
    assert np.mean([r.predicted == r.quality for r in held]) > 0.95
    assert all(0 <= r.score <= 1 and r.predicted == (r.score >= 0.7) for r in rows)
    again = Q.fit(docs.repartition(7), labels, use=~Q.held_out())
    assert np.array_equal(model.weights, again.weights)


def test_labels_held_out_are_not_used(spark):
    docs, labels = sample(spark)
    wrong = labels.withColumn("quality", F.when(Q.held_out(), 1 - F.col("quality")).otherwise(F.col("quality")))
    a, b = (Q.fit(docs, some, use=~Q.held_out()).weights for some in (labels, wrong))
    assert np.array_equal(a, b)


def test_one_id_in_many_rows_is_one_text_of_the_sample(spark):
    docs, labels = sample(spark)
    many = docs.unionByName(docs.filter("doc_id = 1").crossJoin(spark.range(5000)).drop("id"))
    once, again = (Q.fit(d, labels, per_class=10) for d in (docs, many))
    assert np.array_equal(once.weights, again.weights)


def test_training_matches_a_plain_loop(spark):
    """The same features and steps, word by word and vector by vector."""
    texts = ["the house stands", "the the $$$ x", "été à l'eau", "$$$ $$$ near"]
    rows = []
    for label, text in enumerate(texts):
        ids, counts = next(Q.sparse_features(next(slices(pa.array([text.encode()], pa.binary())))))
        assert list(ids).count(Q.BIAS) == 1 and len(set(ids)) == len(ids)
        rows.append((ids, counts, label % 2, np.float32(1)))
    random_ = np.random.default_rng(7)
    vectors = random_.uniform(-1 / Q.DIMENSIONS, 1 / Q.DIMENSIONS, (Q.BUCKETS + 2, Q.DIMENSIONS)).astype(np.float32)
    output = [[0.0] * Q.DIMENSIONS for _ in range(2)]
    step, steps = 0, Q.EPOCHS * len(rows)
    for _ in range(Q.EPOCHS):
        for k in random_.permutation(len(rows)):
            ids, counts, label, _ = rows[k]
            total = sum(map(float, counts))
            mean = [sum(float(c) / total * float(vectors[i][d]) for i, c in zip(ids, counts)) for d in range(Q.DIMENSIONS)]
            raw = [sum(o * m for o, m in zip(output[y], mean)) for y in range(2)]
            parts = [np.exp(v - max(raw)) for v in raw]
            pull = [Q.RATE * (1 - step / steps) * (p / sum(parts) - (y == label)) for y, p in enumerate(parts)]
            back = [sum(pull[y] * output[y][d] for y in range(2)) for d in range(Q.DIMENSIONS)]
            output = [[output[y][d] - pull[y] * mean[d] for d in range(Q.DIMENSIONS)] for y in range(2)]
            for i, c in zip(ids, counts):
                vectors[i] -= np.array([float(c) / total * v * len(ids) ** 0.5 for v in back], np.float32)
            step += 1
    wanted = vectors @ (np.array(output[1], np.float32) - np.array(output[0], np.float32))
    assert np.allclose(Q.train(rows).weights, wanted, atol=1e-4)


def test_odd_texts_and_labels(spark):
    docs, labels = sample(spark)
    model = Q.fit(docs, labels)
    odd = table(spark, [(1, None, 1, "a"), (2, "", 1, "a"), (3, " ", 1, None), (None, "the house " * 50_000, 1, "a"), (5, "the house", 1, "a"), (5, "the house", 1, "a")])
    rows = Q.score(odd, model, keep=["doc_id"]).collect()
    assert len(rows) == 6 and all(0 <= r.score <= 1 for r in rows)
    assert len({r.score for r in rows if r.doc_id == 5}) == 1
    kept = Q.score(odd, model, only_good=True)
    assert kept.columns == odd.columns and kept.count() >= 3
    assert Q.score(odd.limit(0), model).count() == 0
    one_class = Q.fit(docs, labels.filter("quality = 1"))
    assert {r.score for r in Q.score(odd, one_class, keep=["doc_id"]).collect()} == {1.0}
    assert Q.fit(docs, labels.limit(0)).share == 0.5
    several = labels.unionByName(labels).unionByName(labels.selectExpr("doc_id", "cast(null as int) as quality"))
    assert np.array_equal(Q.fit(docs, several).weights, model.weights)


def test_scores_do_not_depend_on_slices_and_rows_do_not_mix():
    texts = ["ab cd ab", "", "é ab ab", "x" * 50, " ab", "cd"]
    model = Q.QualityModel(np.random.default_rng(2).normal(size=Q.BUCKETS + 2).astype(np.float32))
    together = model.scores(pa.array([t.encode() for t in texts], pa.binary()))
    alone = [model.scores(pa.array([t.encode()], pa.binary()))[0] for t in texts]
    assert np.allclose(together, alone)
    piece = next(slices(pa.array([b"ab ab"], pa.binary())))
    ids, counts = next(Q.sparse_features(piece))
    assert counts[list(ids).index(Q.REPEAT)] == 1 and counts[list(ids).index(Q.BIAS)] == 1
