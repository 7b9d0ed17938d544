"""Lookups, selections, fallbacks and exports."""

from datetime import datetime

import pytest

from glossarion import vocab
from glossarion.operators import lookups as lk


def test_synsets_and_members(spark):
    edges = spark.createDataFrame([("Bank", "s1", "NOU"), ("bank", "s2", "NOU"), ("shore", "s2", "NOU")], "lemma string, synset string, pos string")
    names = spark.createDataFrame([("s1", "noun.artifact"), ("s2", "noun.object")], "synset string, lexname string")
    asked = spark.createDataFrame([("BANK",), ("none",)], "id string")
    assert {(r.id, r.synset) for r in lk.synsets_of(edges, asked).collect()} == {("BANK", "s1"), ("BANK", "s2")}
    got = lk.members_of(edges, names, spark.createDataFrame([("s2",), ("s9",)], "synset string")).collect()
    assert [(r.synset, r.lexname, r.lemmas) for r in got] == [("s2", "noun.object", ["bank", "shore"])]


def test_formats_licenses_and_filters():
    assert lk.entry_format(["id", "sense_length"]) == "lexeme" and lk.entry_format(["id", "sources"]) == "single_file"
    assert lk.license_without_counts(["eowl", "wordnet"]) == {"license": "CC BY 4.0", "description": "Attribution required", "sources": ["EOWL (UKACD License)", "WordNet (WordNet License)"]}
    assert lk.license_without_counts(["frequency"])["license"] == "CC BY-SA 4.0"
    assert lk.quick_filter() is None and lk.quick_filter("single")["config"] == {"singleWord": True}
    both = lk.quick_filter("phrases", "required")
    assert both["type"] == "composite" and both["summary"] == "Phrases only + Syllable data required"


def test_sources_and_ages():
    known = {"a": {"group": "x"}, "b": {"skip_in_default": True}, "c": {"group": "x"}}
    assert lk.select_sources(known) == ["a", "c"] and lk.select_sources(known, everything=True) == ["a", "b", "c"]
    assert lk.select_sources(known, ["b"]) == ["b"] and lk.select_sources(known, group="x") == ["a", "c"]
    for bad in ({"ids": ["z"]}, {"group": "y"}):
        with pytest.raises(KeyError):
            lk.select_sources(known, **bad)
    then, now = datetime(2024, 1, 1), datetime(2024, 1, 8, 12)
    assert lk.age_in_days(then, now) == 7 and lk.age_in_days(now, then) == 0
    assert lk.is_fresh(then, now) and lk.is_fresh(then, now, 8) and not lk.is_fresh(then, now, 7) and not lk.is_fresh(None, now) and not lk.is_fresh(then, now, force=True)


def test_sections_and_codes():
    text = "a\n<!-- AUTO:x -->\nold\n<!-- /AUTO:x -->\nb"
    assert lk.rewrite_section(text, "x", "new\n") == ("a\n<!-- AUTO:x -->\nnew\n<!-- /AUTO:x -->\nb", True)
    assert lk.rewrite_section(text, "y", "new") == (text, False)
    codes = lk.codes_for_interfaces()
    assert codes["flags"]["INFL"] == {"name": "inflected_form", "short": "inflected form"} and set(codes["pos"]) == set(vocab.POS)
    assert lk.configuration_summary()["register"] == len(vocab.REGISTER)
