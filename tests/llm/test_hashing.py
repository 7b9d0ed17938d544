"""Hashes that stand for words and lines: texts built to collide in polynomial hashes modulo a power of two."""

import numpy as np
import pyarrow as pa
import pytest

from glossarion.llm import _bytes, circulant_minhash, line_runs


def thue_morse(n):
    x = "".join("ab"[bin(i).count("1") % 2] for i in range(n))
    return x, x.translate(str.maketrans("ab", "ba"))


@pytest.mark.parametrize("n", [256, 1024, 4096, 8192])
def test_thue_morse_words_differ(n):
    x, y = thue_morse(n)
    for width in (1, 3):
        a, b = circulant_minhash.shingles(pa.array([f"one {x} two three", f"one {y} two three"]), width)
        assert set(a.tolist()) != set(b.tolist())
    data = np.frombuffer((x + y).encode(), np.uint8)
    at = np.array([0, n])
    for seed in (0, 1):
        for h in (_bytes.segment_hash(data, at, at + n, seed), _bytes.PrefixHash(data, seed).of(at, at + n)):
            assert h[0] != h[1]


def test_thue_morse_lines_and_documents(spark):
    pairs = [thue_morse(1 << k) for k in range(8, 14)]
    rows = [(2 * k + i, f"first line of many\n{t}") for k, p in enumerate(pairs) for i, t in enumerate(p)]
    df = spark.createDataFrame(rows, "doc_id long, text string")
    got = {r.doc_id: r for r in line_runs.dedup_lines(df).collect()}
    assert all(got[i].n_dropped == (i > 0) and got[i].text.endswith(t.split("\n")[1]) for i, t in rows)
    near = circulant_minhash.near_duplicates(spark.createDataFrame([(i, t.split("\n")[1]) for i, t in rows], "doc_id long, text string"))
    assert all(r.kept for r in near.collect())


def test_hashes_depend_on_content_alone():
    rng = np.random.default_rng(1)
    data = rng.integers(0, 256, 200_000).astype(np.uint8)
    moved = np.concatenate([rng.integers(0, 256, 777).astype(np.uint8), data])
    start = rng.integers(0, 100_000, 500)
    end = start + rng.integers(0, 90_000, 500)
    for seed in (0, 1):
        assert (_bytes.segment_hash(data, start, end, seed) == _bytes.segment_hash(moved, start + 777, end + 777, seed)).all()
        assert (_bytes.PrefixHash(data, seed).of(start, end) == _bytes.PrefixHash(moved, seed).of(start + 777, end + 777)).all()
    # the sum of bytes times powers, modulo the prime
    x = sum((int(data[j]) + 1) * pow(_bytes.BASES[0], j - 50, _bytes.PRIME) for j in range(50, 80)) % _bytes.PRIME
    want = _bytes.mix(np.array([x], np.uint64) + np.array([30], np.uint64) * np.uint64(0x2545F4914F6CDD1D))
    assert want[0] == _bytes.PrefixHash(data).of(np.array([50]), np.array([80]))[0]
