import hashlib

import numpy as np
import pytest

from spokewise.llm import exact_dedup as E

ROWS = [(1, "Same"), (2, "sAME"), (3, "other"), (4, None), (5, ""), (6, "É"), (7, "é"), (8, "same"), (None, "same"), (3, "other")]


def by_hand(rows):
    groups = {}
    for i, t in rows:
        low = "".join(c.lower() if "A" <= c <= "Z" else c for c in t or "")
        groups.setdefault(hashlib.sha256(low.encode()).hexdigest(), []).append(i)
    return {
        h: (max((i for i in g if i is not None), default=None), len(g)) for h, g in groups.items()
    }


@pytest.mark.parametrize("bits", [1 << 16, 16])
def test_copies_match_grouping_by_hand(documents, bits):
    found = E.exact_copies(documents(ROWS), max_bits=bits, bits_per_row=1).collect()
    wanted = by_hand(ROWS)
    assert len(found) == len(ROWS)
    assert all(wanted[r.text_sha256] == (r.keep_id, r.group_size) for r in found)
    kept = [r.text_sha256 for r in found if r.kept]
    assert sorted(kept) == sorted(wanted)
    assert all(r.doc_id == r.keep_id for r in found if r.kept)


def test_filter_misses_no_repeated_hash(spark, documents):
    digests = E.with_digest(documents([str(k % 50) for k in range(80)]), "text", [])
    packed = E.repeated_bits(digests)
    column = digests.toPandas()["__digest"]
    import pyarrow as pa

    flags = E._maybe(packed, pa.array([bytes(d) for d in column], pa.binary()))
    repeated = column.map(bytes).duplicated(keep=False).to_numpy()
    assert (flags >= repeated).all() and flags.sum() < 70


def test_whole_rows_are_kept_and_empty_tables_work(documents):
    docs = documents(ROWS).withColumnRenamed("lang", "__maybe")
    rows = E.drop_exact_copies(docs)
    assert rows.columns == docs.columns
    assert sorted(r.doc_id for r in rows.collect()) == [3, 5, 6, 7, 8]
    assert E.exact_copies(documents([]).limit(0)).count() == 0
    assert E.drop_exact_copies(documents([]).limit(0)).count() == 0


def test_very_long_text(documents):
    long = "word " * 400_000
    kept = E.drop_exact_copies(documents([(1, long), (2, long.upper()), (3, long + ".")])).collect()
    assert sorted(r.doc_id for r in kept) == [2, 3]
