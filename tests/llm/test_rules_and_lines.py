"""Quality rules, URL filter and line dedup against plain Python."""

import hashlib
import re

import pytest

from glossarion.llm import decision_list, host_reputation, line_runs
from glossarion.llm.queries import op8_decision_list

SF = "/root/testdata/sf0.001"
WORD = re.compile(r"[^\x20\x09-\x0D]+")
TEXTS = [None, "", " \n\t", "a b c", "x " * 30, "One two three four five six seven eight nine ten " * 3, "Same line here\nother\nSame line here\n same line HERE \n\n", "été # $ | <a> & * %\r\nÉté été",
         "the quick brown fox jumps over the lazy dog and the quick brown fox jumps over the lazy cat", "z" * 50000, "w " * 30000]


def brute(text):
    text = text or ""
    w = WORD.findall(text)
    seen, dup = set(), 0
    for line in text.split("\n"):
        if WORD.search(line):
            dup += line in seen
            seen.add(line)
    windows, covered = {}, set()
    for i in range(len(w) - 7):
        windows.setdefault(tuple(w[i : i + 8]), []).append(i)
    for at in windows.values():
        if len(at) > 1:
            covered.update(i + k for i in at for k in range(8))
    rep = len(covered)
    return len(w), sum(map(len, w)), len(re.findall(r"[#*$%&|<>]", text)), dup, rep, len(w) < 20 or 100 * rep > 30 * len(w)


@pytest.fixture(scope="module")
def odd(spark):
    return spark.createDataFrame([(i, t, "a", 7) for i, t in enumerate(TEXTS)] + [(None, "no id at all", "b", 8), (3, "a b c", "c", 9)], "doc_id long, text string, lost string, n_words int")


def test_statistics(spark, odd):
    got = decision_list.judge(odd.select("doc_id", "text"), decision_list.DecisionList(()))
    for r in got.where("doc_id is not null").collect():
        assert (r.n_words, r.word_chars, r.n_symbols, r.n_dup_lines, r.n_repeat_words, r.base_failed) == brute(TEXTS[r.doc_id]), r.doc_id
        assert r.kept != r.base_failed
    assert decision_list.judge(odd.limit(0), decision_list.DecisionList(()), "q_").count() == 0
    assert set(odd.columns) < set(decision_list.judge(odd, decision_list.DecisionList(()), "q_").columns)


def test_quality_query(spark):
    rows = {r.doc_id: r for r in op8_decision_list(spark, SF).collect()}
    labels = {r.doc_id: r.quality for r in spark.read.parquet(f"{SF}/labels.parquet").collect()}
    for d in spark.read.parquet(f"{SF}/documents.parquet").collect():
        r = rows[d.doc_id]
        assert (r.n_words, r.word_chars, r.n_symbols, r.n_dup_lines, r.n_repeat_words, r.base_failed) == brute(d.text)
        assert r.kept == (not r.base_failed and r.rule is None)
    assert sum(rows[i].kept for i, q in labels.items() if q) > 0.9 * sum(labels.values())


def test_learned_list_generalises(spark):
    docs, labels = (spark.read.parquet(f"/root/testdata/sf0.1/{t}.parquet") for t in ("documents", "labels"))
    rules = decision_list.fit(docs, labels.where("doc_id % 2 = 0"))
    held = decision_list.judge(docs.join(labels.where("doc_id % 2 = 1"), "doc_id"), rules).select("quality", "kept").collect()
    bad, good = [r.kept for r in held if not r.quality], [r.kept for r in held if r.quality]
    assert sum(bad) < 0.2 * len(bad) and sum(good) > 0.97 * len(good), str(rules)


def test_no_labels(spark, odd):
    none = spark.createDataFrame([(1, None), (None, 0)], "doc_id long, quality int")
    assert decision_list.fit(odd, none).rules == ()


URLS = [None, "", "nothing", "http://A.Example.ORG/es/1?x#y", "https://example.org/en/12", "https://badexample.org/es/", "http://x.com/fr/a", "http://x.com/de/#/fr/", "http://x.com?/de/", "http://com/de/", "x://org", "x://org/", "http://h.co.uk/a://b"]


def test_urls(spark):
    pages = spark.createDataFrame([(i, u, "p") for i, u in enumerate(URLS)] + [(None, "http://x.net/", "q")], "page_id long, url string, host string")
    labels = spark.createDataFrame([(None, 1, 1), (3, None, None), (1, 0, 0), (1, 1, 0)], "doc_id long, quality int, toxic int")
    got = {r.page_id: r for r in host_reputation.judge(pages, labels).collect()}
    assert len(got) == len(URLS) + 1
    for i, u in enumerate(URLS):
        host, path = (m[1], m[2]) if u and "://" in u and (m := re.match(r"([^/?#]*)([^?#]*)", u.split("://", 1)[1])) else ("", "")
        host = re.sub("[A-Z]", lambda m: m[0].lower(), host)
        fits = [(len(h + p), h + p, v) for v, h, p in host_reputation.RULES if (host == h or host.endswith("." + h)) and path.startswith(p)]
        assert (got[i].host, got[i].path, got[i].rule) == (host, path, max(fits)[1] if fits else None)
        if fits:
            assert got[i].verdict == max(fits)[2]
    assert host_reputation.judge(pages.limit(0), labels).count() == 0
    assert {r.verdict for r in host_reputation.judge(pages, labels.limit(0)).where("rule is null").collect()} == {"allow"}


def test_bad_host_is_blocked_and_rare_one_shrinks(spark):
    outcomes = spark.createDataFrame([("spam.bad.com", 200, 190), ("new.bad.com", 1, 1), ("a.good.com", 300, 3), ("b.good.com", 1, 1), ("c.fine.net", 500, 5), ("d.else.net", 0, 0)], "host string, n long, bad long")
    got = {r.host: r for r in host_reputation.reputations(outcomes).collect()}
    assert got["spam.bad.com"].verdict == "block" and got["b.good.com"].verdict == "allow" and got["d.else.net"].verdict == "allow"
    assert got["new.bad.com"].mean > got["b.good.com"].mean


def brute_lines(rows):
    key = lambda x: re.sub("[A-Z]", lambda m: m[0].lower(), x.strip(" \t\n\x0b\x0c\r"))
    first = lambda i: -1 if i is None else i
    holders = {}
    for i, t in rows:
        for x in (t or "").split("\n"):
            holders.setdefault(key(x), set()).add(first(i))
    out = []
    for i, t in rows:
        lines = (t or "").split("\n")
        kept = [x for x in lines if len(key(x)) < 10 or len(holders[key(x)]) < 2 or min(holders[key(x)]) == first(i)]
        out.append((i, len(lines), len(lines) - len(kept), hashlib.sha256("\n".join(kept).encode()).hexdigest()))
    return sorted(out, key=str)


@pytest.mark.parametrize("batches", [1, 3, 7])
def test_lines(spark, batches):
    rows = [(r.doc_id, r.text) for r in spark.read.parquet(f"{SF}/documents.parquet").collect()]
    rows += [(1000 + i, t) for i, t in enumerate(TEXTS * 2)] + [(None, "A shared LINE of text\nrest"), (5000, " a shared line of TEXT\t\nx"), (5000, "a shared line of text"), (5001, "\n\n")]
    df = spark.createDataFrame([(i, t, 1, "e") for i, t in rows], "doc_id long, text string, n_lines int, doc string")
    got = [(r.doc_id, r.n_lines, r.n_dropped, hashlib.sha256(r.text.encode()).hexdigest()) for r in line_runs.dedup_lines(df, batches=batches, fanout=2).collect()]
    assert sorted(got, key=str) == brute_lines(rows)
    if batches == 1:
        assert line_runs.dedup_lines(df.limit(0)).count() == 0


def test_runs_outlive_a_call_and_are_not_shuffled(spark):
    from glossarion.llm._shared import Workspace

    store = Workspace(spark, "t").path
    frame = lambda rows: spark.createDataFrame(rows, "doc_id long, text string")
    line = lambda k: f"a line of some length {k}"
    first = [(i, "\n".join(line(k) for k in range(i, i + 3))) for i in range(0, 20, 2)]
    got = {r.doc_id: r.n_dropped for r in line_runs.dedup_lines(frame(first), batches=3, fanout=2, store=store).collect()}
    assert got == {i: int(i > 0) for i, _ in first}
    second = [(1, f"{line(4)}\nnew words in this line\n{line(900)}"), (100, f"{line(900)}\n{line(20)}\nshort")]
    got = {r.doc_id: r.n_dropped for r in line_runs.dedup_lines(frame(second), batches=1, store=store).collect()}
    assert got == {1: 1, 100: 2}
    runs = line_runs.Runs.open(spark, store, 4)
    assert sum(map(len, runs.levels)) >= 2
    owners = spark.createDataFrame([(1, 2, 3, 3)], "k1 long, k2 long, owner long, last long")
    plan = runs.merge(owners)._jdf.queryExecution().executedPlan().toString()
    assert plan.count("Exchange hashpartitioning") == 1, plan


def test_verdicts_by_plain_rules(spark):
    """The learned conditions, applied one after another in plain Python to counts by brute force."""
    docs, labels = (spark.read.parquet(f"{SF}/{t}.parquet") for t in ("documents", "labels"))
    rules = decision_list.fit(docs, labels).rules
    assert rules
    got = {r.doc_id: (r.rule, r.kept) for r in op8_decision_list(spark, SF).collect()}
    for d in docs.collect():
        text = d.text or ""
        w = WORD.findall(text)
        n_words, chars, symbols, dup, rep, failed = brute(text)
        ratio = lambda x: x / n_words if n_words else None
        value = {"n_words": float(n_words), "word_length": ratio(chars), "symbols": ratio(symbols), "dup_lines": ratio(dup), "repeats": ratio(rep), "distinct": ratio(len(set(w))), "shouts": ratio(text.count("!")), "capitals": ratio(len(re.findall("[A-Z]", text)))}
        first = None
        for k, rule in enumerate(rules, 1):
            if all(value[c.feature] is not None and (value[c.feature] > c.threshold if c.above else value[c.feature] <= c.threshold) for c in rule):
                first = k
                break
        assert got[d.doc_id] == (first, not failed and first is None), d.doc_id


def test_texts_are_read_once_and_no_run_is_written_that_no_batch_meets(spark, monkeypatch):
    written, write = [], line_runs.Runs._write
    tables, put = [], line_runs.Workspace.write
    monkeypatch.setattr(line_runs.Workspace, "write", lambda self, df, name: tables.append(name) or put(self, df, name))
    monkeypatch.setattr(line_runs.Runs, "_write", lambda self, rows: written.append(write(self, rows)) or written[-1])
    df = spark.createDataFrame([(i, f"one line of document {i}\na line they all have") for i in range(9)], "doc_id long, text string")
    got = sorted((r.doc_id, r.n_dropped) for r in line_runs.dedup_lines(df, batches=3, fanout=3).collect())
    assert got == [(i, int(i > 0)) for i in range(9)]
    assert len(written) == 2
    assert tables == ["pairs", "merged0", "merged1", "merged2", "lost"]
