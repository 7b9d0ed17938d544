"""Near duplicates against all pairs, components against union-find."""

import random
import re

import pytest

from glossarion.llm import circulant_minhash
from glossarion.llm._shared import Workspace
from glossarion.llm.components import components
from glossarion.llm.queries import op2_circulant_minhash

SF = "/root/testdata/sf0.001"
WORD = re.compile(r"[^\x20\x09-\x0D]+")


def shingle_set(text, width):
    w = WORD.findall(re.sub("[A-Z]", lambda m: m[0].lower(), text or ""))
    return {tuple(w[i : i + width]) for i in range(len(w) - width + 1)} if len(w) >= width else {tuple(w)} if w else set()


def union(pairs, nodes):
    up = {n: n for n in nodes}

    def root(x):
        while up[x] != x:
            x = up[x]
        return x

    for a, b in pairs:
        a, b = sorted((root(a), root(b)))
        up[b] = a
    return {n: root(n) for n in nodes}


def truth(rows, width, num, den):
    first = lambda i: -1 if i is None else i
    sets = [(first(i), shingle_set(t, width)) for i, t in rows]
    pairs = [(a, b) for k, (a, x) in enumerate(sets) for b, y in sets[:k] if x and y and den * len(x & y) >= num * len(x | y)]
    comp = union(pairs, {i for i, _ in sets})
    none = lambda i: None if i == -1 else i
    return sorted(((none(i), len(s), none(comp[i]), comp[i] == i) for i, s in sets), key=str)


def family(rng, words, size, edits):
    base = [rng.choice(words) for _ in range(60)]
    out = [" ".join(base)]
    for _ in range(size):
        w = list(base)
        for _ in range(rng.randint(0, edits)):
            w[rng.randrange(len(w))] = rng.choice(words)
        out.append(" ".join(w))
    return out


@pytest.mark.parametrize("width,num", [(3, 85), (5, 80)])
def test_against_all_pairs(spark, width, num):
    rng = random.Random(5)
    words = [f"w{i}" for i in range(3000)]
    texts = family(rng, words, 60, 5) + family(rng, words, 25, 3) + [None, "", " ", "a", "A", "a b", "a  B", "a b c d", "x y z"] + ["q r s t u v w"] * 5 + ["h " * 20000]
    rng.shuffle(texts)
    rows = [(i * 3 + 1, t) for i, t in enumerate(texts)] + [(None, texts[0]), (None, "something else with words"), (4, texts[9]), (4, "unlike words for row four")]
    df = spark.createDataFrame([(i, t, 1, "e") for i, t in rows], "doc_id long, text string, n int, doc string").repartition(3)
    got = circulant_minhash.near_duplicates(df, width, (num, 100)).collect()
    assert sorted((tuple(r) for r in got), key=str) == truth(rows, width, num, 100)


def test_query(spark):
    rows = [(r.doc_id, r.text) for r in spark.read.parquet(f"{SF}/documents.parquet").collect()]
    got = op2_circulant_minhash(spark, SF).collect()
    assert sorted((tuple(r) for r in got), key=str) == truth(rows, 3, 85, 100)


def test_open_pairs_without_rounds(spark):
    rng = random.Random(6)
    rows = list(enumerate(family(rng, [f"w{i}" for i in range(500)], 30, 4)))
    df = spark.createDataFrame(rows, "doc_id long, text string")
    got = circulant_minhash.near_duplicates(df, 3, (85, 100), rounds=1).collect()
    assert sorted((tuple(r) for r in got), key=str) == truth(rows, 3, 85, 100)


def test_empty(spark):
    assert circulant_minhash.near_duplicates(spark.createDataFrame([], "doc_id long, text string")).count() == 0


def test_components(spark):
    rng = random.Random(7)
    edges = [(i, i + 1) for i in range(40)] + [(100, 100 + i) for i in range(50)] + [(rng.randrange(200, 300), rng.randrange(200, 300)) for _ in range(60)] + [(500, 500)]
    got = {r.v: r.comp for r in components(Workspace(spark, "t"), spark.createDataFrame(edges, "a long, b long")).collect()}
    want = union([e for e in edges if e[0] != e[1]], {x for a, b in edges if a != b for x in (a, b)})
    assert got == want
