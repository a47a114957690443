import random
import re

from pyspark.sql import functions as F

from spokewise.llm import decontaminate as D

WORD = re.compile(r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+")


def words(text):
    return WORD.findall("".join(c.lower() if "A" <= c <= "Z" else c for c in text or ""))


def by_hand(text, bench):
    own, hit, items = words(text), set(), set()
    for item, t in bench:
        target = words(t)
        size = min(13, len(target))
        windows = {tuple(target[k : k + size]) for k in range(len(target) - size + 1)} if target else set()
        for k in range(len(own) - size + 1):
            if tuple(own[k : k + size]) in windows:
                hit |= set(range(k, k + size))
                items.add(item)
    return len(own), len(hit), sorted(str(i) for i in items if i is not None)


def run(spark, docs, bench, **options):
    table = spark.createDataFrame(bench, "item_id long, text string")
    found = D.matched(docs, table, **options)
    rows = found.select("doc_id", "__n_words", D.hit_words(F.col("__matches")).alias("hit"), "__matches").collect()
    return rows


def test_hits_equal_brute_force(spark, documents):
    rng = random.Random(3)
    text = lambda n: " ".join(rng.choice(["ab", "cd", "Éf", "g", "h1"]) for _ in range(n))
    bench = [(k, text(rng.choice([4, 9, 13, 14, 30]))) for k in range(12)] + [(50, ""), (51, None), (52, "!?"), (3, text(20)), (None, text(20))]
    docs = []
    for k in range(60):
        parts = [text(rng.randrange(30)), (rng.choice(bench)[1] or "").upper().replace(" ", ", "), text(rng.randrange(30))]
        docs.append((k, " ".join(parts)))
    docs += [(100, None), (101, ""), (102, docs[0][1]), (102, docs[0][1])]
    wanted = sorted((i, *by_hand(t, bench)) for i, t in docs)
    for options in ({}, {"block_bytes": 200}):
        rows = run(spark, documents(docs), bench, **options)
        found = sorted((r.doc_id, r["__n_words"], r.hit, sorted({m.item for m in r["__matches"] if m.item})) for r in rows)
        assert found == wanted


def test_longest_matches_and_places(spark, documents):
    target = " ".join(f"w{k}" for k in range(40))
    docs = documents([(1, "x y " + " ".join(f"W{k}" for k in range(5, 35)) + " z"), (2, target), (3, "w1 w2 w3")])
    rows = {r.doc_id: r["__matches"] for r in run(spark, docs, [(7, target)])}
    assert [tuple(m) for m in rows[1]] == [("7", 2, 30)]
    assert [tuple(m) for m in rows[2]] == [("7", 0, 40)]
    assert rows[3] == []


def test_clean_documents_stay(spark, documents):
    target = " ".join(f"w{k}" for k in range(13))
    diluted = " ".join(f"d{k}" for k in range(13 * 19)) + " " + target
    docs = documents([(1, target), (2, diluted), (3, diluted + " more"), (4, None), (5, "w0 w1")]).withColumnRenamed("lang", "__n_words")
    bench = spark.createDataFrame([(1, target)], "item_id long, text string")
    kept = D.clean_documents(docs.withColumnRenamed("__n_words", "n_words"), bench)
    assert sorted(r.doc_id for r in kept.collect()) == [3, 4, 5]
    none = bench.limit(0)
    assert D.clean_documents(docs.withColumnRenamed("__n_words", "n_words"), none).count() == 5
    assert D.clean_documents(docs.withColumnRenamed("__n_words", "n_words").limit(0), bench).count() == 0
