"""The pipeline against a plain version of every stage."""

import random

import pytest
from test_near import truth as near_truth
from test_rules_and_lines import brute as base_statistics
from test_tokens import check_packing
from test_tokens import truth as token_truth

corpus_pipeline = pytest.importorskip("corpus_pipeline")

SF = "/root/testdata/sf0.001"


def without_repeats(texts, length=200):
    from collections import Counter

    raw = [t.encode() for t in texts]
    count = Counter(b[k : k + length] for b in raw for k in range(len(b) - length + 1))
    out = []
    for b in raw:
        gone = [False] * len(b)
        k = 0
        while k <= len(b) - length:
            if count[b[k : k + length]] > 1:
                for j in range(k, k + length):
                    gone[j] = True
            k += 1
        kept, at = "", 0
        for c in b.decode():
            n = len(c.encode())
            if not all(gone[at : at + n]):
                kept += c
            at += n
        out.append(kept)
    return out


def line_dedup(rows):
    import re

    key = lambda x: re.sub("[A-Z]", lambda m: m[0].lower(), x.strip(" \t\n\x0b\x0c\r"))
    owner = {}
    for i, t in sorted(rows):
        for x in t.split("\n"):
            owner.setdefault(key(x), i)
    return [(i, "\n".join(x for x in t.split("\n") if len(key(x)) < 10 or owner[key(x)] == i)) for i, t in rows]


def test_pipeline(spark):
    docs = spark.read.parquet(f"{SF}/documents.parquet")
    rows = [(r.doc_id, r.text) for r in docs.collect()]
    from glossarion.llm import decision_list

    rules = decision_list.fit(docs, spark.read.parquet(f"{SF}/labels.parquet"))
    kept = {r.doc_id for r in decision_list.judge(docs, rules).where("kept").collect()}
    assert kept <= {i for i, t in rows if not base_statistics(t)[-1]}
    rows = line_dedup([r for r in rows if r[0] in kept])
    one = {i for i, _, _, k in near_truth(rows, 5, 80, 100) if k}
    rows = [r for r in rows if r[0] in one]
    rows = list(zip([i for i, _ in rows], without_repeats([t for _, t in rows]), strict=True))
    check_packing(corpus_pipeline.run(spark, SF).collect(), dict(token_truth(rows, 2)))


def test_stages_keep_columns_and_odd_rows(spark):
    rng = random.Random(1)
    texts = [None, "", "x"] + [" ".join(f"w{rng.randrange(500)}" for _ in range(80)) for _ in range(20)]
    rows = [(i, t, "en", "s", 1, 2.5) for i, t in enumerate(texts)] + [(None, texts[-1] + " end", None, None, None, None), (5, texts[5], "en", "s", 1, 2.5)]
    docs = spark.createDataFrame(rows, "doc_id long, text string, lang string, source string, n_chars long, kept double")
    for some in (docs, docs.limit(0)):
        for name, stage in corpus_pipeline.STAGES[:-1]:
            out = stage(spark, some, SF)
            assert out.columns == docs.columns, name
            out.count()


def test_columns_with_the_operators_names_keep_their_values(spark):
    rng = random.Random(2)
    names = ["doc", "th", "items", "found", "kept", "removed", "n_lines", "n_dropped", "lost", "n_words", "rule", "comp", "sn", "k1"]
    rows = [(i, " ".join(f"w{rng.randrange(900)}" for _ in range(90)) + f"\nline number {i % 3} of a few words", 1, *(f"{n}-{i}" for n in names)) for i in range(25)]
    docs = spark.createDataFrame(rows, "doc_id long, text string, n_chars long, " + ", ".join(f"{n} string" for n in names))
    for name, stage in corpus_pipeline.STAGES[:-1]:
        out = stage(spark, docs, SF)
        assert out.columns == docs.columns, name
        got = out.collect()
        assert len(got) > 5 and all(r[n] == f"{n}-{r.doc_id}" for r in got for n in names), name
