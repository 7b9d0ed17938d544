"""Fingerprints: local consistency, and every digest against plain Python."""

import hashlib
import random

import numpy as np

from glossarion.llm import phrase_fingerprint as pf
from glossarion.llm.queries import op6_phrase_fingerprint

SF = "/root/testdata/sf0.001"


def check(rows, got):
    rows = sorted(rows, key=lambda r: (r[0] is not None, r[0] or 0, r[1] or ""))
    texts = [t or "" for _, t in rows]
    want = []
    for k, (i, _) in enumerate(rows):
        t, f = texts[k], texts[(k + 1) % len(rows)]
        half = len(t) // 2
        e = t[: len(t) - half] + f[:half]
        a, b, c = pf.sketches([t, e, f])
        want.append((i, len(t), hashlib.sha256(e.encode()).hexdigest(), pf.encoded(a), pf.encoded(b), pf.likeness(a, b), pf.likeness(a, c)))
    assert sorted(map(tuple, got), key=str) == sorted(want, key=str)


def test_query(spark):
    rows = [(r.doc_id, r.text) for r in spark.read.parquet(f"{SF}/documents.parquet").collect()]
    check(rows, op6_phrase_fingerprint(spark, SF).collect())


def test_odd_rows(spark):
    rows = [(1, None), (2, ""), (3, "a"), (4, "ab"), (5, "é" * 1001), (6, "😀x" * 300), (6, "tie"), (6, "tie"), (None, "null id"), (9, " ".join(map(str, range(30000))))]
    df = spark.createDataFrame([(i, t, 1, 2.0) for i, t in rows], "doc_id long, text string, n_chars int, near_next double").repartition(3)
    check(rows, pf.fingerprints(df).collect())
    assert pf.fingerprints(df.limit(0)).count() == 0
    one = pf.fingerprints(df.where("doc_id = 4")).collect()
    assert len(one) == 1 and one[0].near_next == 1.0


def test_equal_passages_share_inner_phrases():
    rng = random.Random(1)
    word = lambda: "".join(rng.choice("abcdefghij") for _ in range(rng.randint(2, 8)))
    passage = " ".join(word() for _ in range(400))
    for shift in range(7):
        a = "x" * shift + " ".join(word() for _ in range(50)) + passage
        b = " ".join(word() for _ in range(20 + shift)) + passage + word()
        x, y = pf.phrases([a, b])
        for level in range(3):
            both = set(x[level].tolist()) & set(y[level].tolist())
            assert len(both) > 0.85 * len(set(pf.phrases([passage])[0][level].tolist()))


def test_likeness_follows_common_share():
    rng = random.Random(2)
    words = ["".join(rng.choice("abcdefghijklmnop") for _ in range(rng.randint(2, 9))) for _ in range(4000)]
    near, far = [], []
    for _ in range(40):
        a, b = (" ".join(rng.choice(words) for _ in range(500)) for _ in range(2))
        s = pf.sketches([a, pf.edited(a, b), b])
        near.append(pf.likeness(s[0], s[1]))
        far.append(pf.likeness(s[0], s[2]))
    assert 0.25 < np.mean(near) < 0.42 and min(near) > 0.1 and max(far) < 0.08


def test_likeness_does_not_depend_on_length_classes():
    """A text and its first part, near the lengths at which levels were once switched and elsewhere."""
    rng = random.Random(7)
    means = []
    for n in (140, 150, 160, 300, 990, 1000, 1010, 3000):
        got = []
        for _ in range(40):
            t = "".join(rng.choice("abcdefghij ") for _ in range(n + n // 20))
            a, b = pf.sketches([t, t[:n]])
            got.append(pf.likeness(a, b))
        means.append(np.mean(got))
    # short texts have few phrases, of which an end breaks some; there is no jump between neighbouring lengths
    assert min(means) > 0.7 and np.ptp(means[:3]) < 0.1 and np.ptp(means[4:7]) < 0.05


def test_near_copies_on_both_sides_of_a_level_switch():
    rng = random.Random(3)
    for n in (150, 1000):
        got = []
        for _ in range(30):
            t = "".join(rng.choice("abcdefghij ") for _ in range(n + 5))
            a, b = pf.sketches([t, t[:-10]])
            got.append(pf.likeness(a, b))
        assert np.mean(got) > 0.6


def test_sets_keep_64_hashes():
    (s,) = pf.sketches([" ".join(map(str, range(5000)))])
    assert len(s) == 64


def plain_phrases(text):
    """Locally consistent parsing of one text, place by place: [(name, code points covered)] of every level."""
    u64 = (1 << 64) - 1

    def mix(x):
        return int(pf.mix(np.array([x & u64], np.uint64))[0])

    level, out = [(mix(ord(c) + 1), c) for c in text], []
    while level:
        runs = []
        for name, part in level:
            if runs and runs[-1][0] == name:
                runs[-1][1].append(part)
            else:
                runs.append((name, [part]))
        x = [(mix(n + len(p) * 0x9E3779B97F4A7C15) if len(p) > 1 else n, "".join(p)) for n, p in runs]
        label = [n for n, _ in x]
        for _ in range(4):
            new = []
            for i, v in enumerate(label):
                differ = 1 if i == 0 else v ^ label[i - 1]
                low = (differ & -differ).bit_length() - 1
                new.append(2 * low + (v >> low & 1))
            label = new
        cut = [i for i in range(len(x)) if i == 0 or label[i] > label[i - 1] and label[i] >= (label[i + 1] if i + 1 < len(x) else 127)]
        level = []
        for a, b in zip(cut, [*cut[1:], len(x)]):
            total = sum(mix(n + k * 0x9E3779B97F4A7C15) for k, (n, _) in enumerate(x[a:b]))
            level.append((mix(total + b - a), "".join(p for _, p in x[a:b])))
        out.append(level)
        if len(level) == 1:
            return out
    return out


def test_phrases_by_plain_parsing():
    rng = random.Random(11)
    texts = ["a", "aaaa", "abab" * 30, "".join(rng.choice("ab") for _ in range(300)), " ".join(rng.choice(["lorem", "ipsum", "dolor", "sit"]) for _ in range(120)), "été Σίσυφος 日本語 " * 9]
    for t, levels in zip(texts, pf.phrases(texts)):
        want = plain_phrases(t)
        assert [x.tolist() for x in levels] == [[n for n, _ in level] for level in want]
        assert all("".join(p for _, p in level) == t for level in want)
        # equal names stand for equal substrings
        of = {}
        assert all(of.setdefault((k, n), p) == p for k, level in enumerate(want) for n, p in level)


def test_query_by_plain_parsing(spark):
    """Fingerprints and likeness of whole documents from plain parsing."""
    def sketch(text):
        levels = plain_phrases(text)
        names = {n for level in levels[min(1, len(levels) - 1) :] for n, _ in level} if levels else set()
        return sorted({int(pf.mix(np.array([n], np.uint64))[0]) >> 32 for n in names})[:64]

    def like(a, b):
        if not a or not b:
            return float(len(a) == len(b))
        least = sorted({*a, *b})
        if max(len(a), len(b)) == 64:
            least = least[:64]
        return len([x for x in least if x in a and x in b]) / len(least)

    rows = [(r.doc_id, r.text or "") for r in spark.read.parquet(f"{SF}/documents.parquet").orderBy("doc_id").limit(40).collect()]
    rows = [(i, t[:400]) for i, t in rows] + [(10**6, ""), (10**6 + 1, "x")]
    got = {r.doc_id: r for r in pf.fingerprints(spark.createDataFrame(rows, "doc_id long, text string")).collect()}
    for k, (i, t) in enumerate(rows):
        after = rows[(k + 1) % len(rows)][1]
        changed = pf.edited(t, after)
        a, b, c = sketch(t), sketch(changed), sketch(after)
        assert pf.decoded(got[i].fingerprint).tolist() == a and pf.decoded(got[i].edited_fingerprint).tolist() == b
        assert abs(got[i].near_edited - like(a, b)) < 1e-12 and abs(got[i].near_next - like(a, c)) < 1e-12
