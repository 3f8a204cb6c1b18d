import os
from collections import Counter

import pytest
from hypothesis import given, settings
from hypothesis import strategies as st
from pyspark.sql import functions as F

from debtloom.llm.packing import DEFAULT_TOKENIZER, pack, plan_packing, token_counts


def fills(histogram, capacity):
    rows, used = plan_packing(histogram, capacity)
    by = {}
    for r in rows:
        by.setdefault(r[0], []).append(r)
    fill = Counter()
    for size, n in histogram.items():
        at = -1
        for rank in range(n):
            while at + 1 < len(by[size]) and by[size][at + 1][1] <= rank:
                at += 1
            _, first_rank, first, offset, modulo, per = by[size][at]
            fill[first + (rank - first_rank + offset) % modulo // per] += size
    return fill, used


@settings(max_examples=150, deadline=None)
@given(st.integers(1, 60), st.dictionaries(st.integers(1, 60), st.integers(0, 30), max_size=15))
def test_every_item_has_a_place_and_nothing_overflows(capacity, histogram):
    histogram = {s: n for s, n in histogram.items() if s <= capacity}
    fill, used = fills(histogram, capacity)
    assert all(v <= capacity for v in fill.values()) and len(fill) == used
    assert sum(fill.values()) == sum(s * n for s, n in histogram.items())


def test_little_room_is_left():
    import random

    random.seed(4)
    histogram = Counter(min(512, int(random.lognormvariate(5, 0.8)) + 1) for _ in range(20000))
    fill, used = fills(histogram, 512)
    assert sum(fill.values()) / used / 512 > 0.98


def test_pieces_and_repeats(spark):
    counts = spark.createDataFrame([("a", 25), ("b", 0), ("c", None), (None, 3), ("d", 10), ("a", 25)] + [(f"x{i}", 3) for i in range(50)], "doc_id string, n bigint")
    packs = spark.createDataFrame([(1, 10), (2, 7), (None, 5), (1, 10)], "pack_id int, c int")
    rows = pack(counts, "doc_id", "n", packs, "pack_id", "c").collect()
    for p, c in ((1, 10), (2, 7)):
        mine = [r for r in rows if r.pack_id == p]
        assert sum(r.token_end - r.token_start for r in mine) == 25 * 2 + 10 + 150
        full = Counter()
        for r in mine:
            full[r.container_id] += r.token_end - r.token_start
        assert max(full.values()) <= c
    assert sorted((r.token_start, r.token_end) for r in rows if r.pack_id == 1 and r.doc_id == "a")[::2] == [(0, 10), (10, 20), (20, 25)]
    assert pack(counts.limit(0), "doc_id", "n", packs, "pack_id", "c").count() == 0
    assert pack(counts, "doc_id", "n", packs.limit(0), "pack_id", "c").count() == 0
    with pytest.raises(ValueError):
        pack(counts, "doc_id", "n", spark.createDataFrame([(1, 0)], "pack_id int, c int"), "pack_id", "c")


@pytest.mark.skipif(not os.path.exists(DEFAULT_TOKENIZER), reason="no vocabulary")
def test_token_counts(spark):
    df = spark.createDataFrame([(1, "Hello world"), (2, ""), (3, None), (4, "a " * 50000)], "doc_id bigint, text string")
    got = {r.doc_id: r.n_tokens for r in token_counts(df, "doc_id", "text").orderBy(F.col("doc_id")).collect()}
    assert got[1] == 2 and got[2] == 0 and 3 not in got and got[4] >= 50000
