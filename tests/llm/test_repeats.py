"""Suffix arrays and removal of repeats against sorting and sets of windows."""

import hashlib
import random
from collections import Counter

import numpy as np
import pytest

from glossarion.llm import suffix_dedup
from glossarion.llm.induced_sorting import permuted_common_prefixes, suffix_array
from glossarion.llm.queries import op1_suffix_array_dedup

SF = "/root/testdata/sf0.001"


def test_suffix_array():
    rng = random.Random(1)
    for trial in range(200):
        letters = rng.choice([1, 2, 3, 26, 256])
        b = bytes(rng.randrange(letters) for _ in range(rng.randint(0, 60))) * rng.choice([1, 1, 3])
        sa = suffix_array(np.frombuffer(b, np.uint8))
        assert sa.tolist() == sorted(range(len(b)), key=lambda i: b[i:])
        p = permuted_common_prefixes(np.frombuffer(b, np.uint8), sa, 1 << 30)
        for x, y in zip(sa[:-1].tolist(), sa[1:].tolist()):
            k = 0
            while y + k < len(b) and x + k < len(b) and b[x + k] == b[y + k]:
                k += 1
            assert p[y] == k


def brute(rows, length):
    raw = [(i, (t or "").encode()) for i, t in rows]
    count = Counter(b[k : k + length] for _, b in raw for k in range(len(b) - length + 1))
    out = []
    for i, b in raw:
        gone = np.zeros(len(b) + 1, bool)
        for k in range(len(b) - length + 1):
            if count[b[k : k + length]] > 1:
                gone[k : k + length] = True
        gone[-1] = False
        spans = int((gone[:-1] & ~np.concatenate([[False], gone[:-2]])).sum()) if len(b) else 0
        out.append((i, len(b), int(gone.sum()), spans, hashlib.sha256(bytes(x for x, g in zip(b, gone) if not g)).hexdigest()))
    return sorted(out, key=str)


def digest(df):
    return sorted(((r.doc_id, r.n_bytes, r.n_removed, r.n_spans, hashlib.sha256(r.kept).hexdigest()) for r in df.collect()), key=str)


@pytest.mark.parametrize("max_group", [20_000, 1])
def test_small_alphabet(spark, max_group):
    rng = random.Random(2)
    letters = "abé "
    passage = "".join(rng.choice(letters) for _ in range(90))
    rows = [(None, None), (0, ""), (1, "a" * 500), (2, "ab" * 300), (3, passage), (3, passage), (4, "x" + passage[:60])]
    for i in range(5, 60):
        x = "".join(rng.choice(letters) for _ in range(rng.randint(0, 200)))
        if i % 2:
            a = rng.randint(0, 40)
            x += passage[a : a + rng.randint(20, 60)] + rng.choice(letters) + x[: rng.randint(0, 50)]
        rows.append((i, x))
    rows += [(100, rows[-1][1]), (None, rows[-1][1])]
    df = spark.createDataFrame([(i, t, 3, "k") for i, t in rows], "doc_id long, text string, s int, kept string").repartition(3)
    got = suffix_dedup.remove_repeats(df, length=20, gram=7, max_group=max_group)
    assert digest(got) == brute(rows, 20)
    assert {r.s for r in got.collect()} == {3}


def test_query(spark):
    rows = [(r.doc_id, r.text) for r in spark.read.parquet(f"{SF}/documents.parquet").collect()]
    assert sorted((tuple(r) for r in op1_suffix_array_dedup(spark, SF).collect()), key=str) == brute(rows, 200)


def test_empty(spark):
    assert suffix_dedup.remove_repeats(spark.createDataFrame([], "doc_id long, text string")).count() == 0


def test_parts_of_a_very_long_text(monkeypatch):
    """A text cut into overlapping parts has the same windows as pieces of the whole."""
    data = np.frombuffer(bytes(random.Random(3).choices(range(256), k=300_000)), np.uint8)
    monkeypatch.setattr(suffix_dedup, "BLOCK", 1000)
    parts = list(suffix_dedup._blocks(data, np.array([0, len(data)]), 200))
    assert len(parts) == 1
    row, s, e, a, h, p = suffix_dedup.pieces(data, np.array([0, len(data)]), 200, 64)
    assert s[0] == 0 and e[-1] == len(data) - 200 and (s[1:] == e[:-1] + 1).all() and (a >= e).all() and (a <= s + 136).all()
