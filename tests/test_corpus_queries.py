"""Queries over raw words against their SQL in DuckDB, on the smallest tables."""

import decimal

import duckdb
import pytest

import __spark_entry__ as entry

SF = "/root/testdata/sf0.001"
NAMES = [
    "preset_standard", "preset_common_punct", "phrase_word_bounds", "phrase_type", "pos_include_primary", "label_exclude_primary", "proper_noun_exclude_pure", "valid_contractions", "word_form", "has_lemma_of", "concreteness_factory",
    "order_score", "order_length", "format_jsonl", "csv_quotes", "default_omission", "read_entries_lenient", "last_wins", "grouped_rows", "read_word_list", "read_concreteness", "read_aoa", "read_frequency_list",
    "unique_sense_rows", "sense_summary", "missing_expected_codes", "selection_coverage", "entry_differences", "tier_ranges", "plural_candidates", "spec_kids_nouns", "trie_word_ids", "trie_words_of_ids", "trie_longest_prefix",
    "page_status", "scan_entries", "section_headers", "block_containment", "label_to_code", "category_substring", "syllable_priority", "clean_lemma", "normalize_word", "englishlike", "add_source", "synsets_of_words", "synset_members",
    "deplural_match", "sample_by_combo", "output_checksum", "qid_missing",
]


@pytest.fixture(scope="module")
def con():
    c = duckdb.connect()
    for t in "customer part orders documents pages benchmark labels conversations".split():
        c.execute(f"CREATE VIEW {t} AS SELECT * FROM read_parquet('{SF}/{t}.parquet')")
    return c


def plain(v):
    return round(float(v), 9) if isinstance(v, float | decimal.Decimal) else v


@pytest.mark.parametrize("name", NAMES)
def test_against_sql(spark, con, name):
    df = entry.queries()[name](spark, SF)
    cols = sorted(df.columns)
    got = sorted((tuple(plain(r[c]) for c in cols) for r in df.collect()), key=repr)
    sql = con.execute(entry.oracle_sql()[name])
    names = [c[0] for c in sql.description]
    want = sorted((tuple(plain(r[names.index(c)]) for c in cols) for r in sql.fetchall()), key=repr)
    assert sorted(names) == cols and got == want
