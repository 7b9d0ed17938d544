"""Texts are read once, however many branches of a plan need their words, and words are normalised once, not at each place."""

import duckdb
import pytest

import __spark_entry__ as entry
from glossarion.operators import lexicon as lx

SF = "/root/testdata/sf0.001"
NAMES = [
    "label_exclude",
    "label_exclude_primary",
    "label_include_primary",
    "label_include",
    "format_text_fields",
    "sense_match_counts",
    "pos_exclude_any",
    "temporal_include",
    "syllable_range",
    "policy_family_friendly",
    "normalize_sense_offsets",
    "pos_include_primary",
    "combo_cumulative",
    "order_case_insensitive",
    "syllable_exact",
    "source_include",
    "order_frequency",
    "format_tsv",
    "normalize_lexemes",
    "format_text",
]


@pytest.fixture(scope="module")
def con():
    c = duckdb.connect()
    for t in "part documents benchmark labels conversations".split():
        c.execute(f"CREATE VIEW {t} AS SELECT * FROM read_parquet('{SF}/{t}.parquet')")
    return c


@pytest.mark.parametrize("name", NAMES)
def test_reads_once(spark, con, name):
    df = entry.queries()[name](spark, SF)
    plan = df._jdf.queryExecution().executedPlan().toString()
    assert plan.count("documents.parquet") <= 1 and plan.count("conversations.parquet") <= 1 and plan.count("ArrowEvalPython") <= 2
    cols = sorted(df.columns)
    got = sorted((tuple(r[c] for c in cols) for r in df.collect()), key=repr)
    sql = con.execute(entry.oracle_sql()[name])
    names = [c[0] for c in sql.description]
    assert got == sorted((tuple(r[names.index(c)] for c in cols) for r in sql.fetchall()), key=repr)


def test_merge_of_odd_words(spark):
    base = spark.createDataFrame([("Ab", ["wikt"]), (" ", ["wikt"]), (None, ["wikt"]), ("ﬁn", None)], "id string, sources array<string>")
    words = lambda *v: spark.createDataFrame([(x,) for x in v], "id string")
    got = {(r.id, ",".join(r.sources or ["-"]), r.wc) for r in lx.merge_sources(base, {"eowl": words("AB", "ab ", "", None, " New  one "), "wordnet": words("fin", "AB", "new  one")}).collect()}
    assert got == {("Ab", "eowl,wikt,wordnet", None), (" ", "wikt", None), (None, "wikt", None), ("ﬁn", "-", None), ("new  one", "eowl,wordnet", 2)}
