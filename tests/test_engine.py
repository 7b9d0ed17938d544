"""Lexicon engine: functions, specs, predicates, tables, trie, scan, files and streams on small rows."""

import json

import pytest
from pyspark.sql import functions as F

from glossarion import vocab
from glossarion.functions import lexical
from glossarion.operators import lexicon as lx
from glossarion.operators import predicates as pr
from glossarion.operators import scan, trie
from glossarion.plans import spec
from glossarion.sources import readers, sinks


def values(spark, column, rows, schema="x string"):
    return [r[0] for r in spark.createDataFrame([(r,) for r in rows], schema).select(column(F.col("x"))).collect()]


def test_codes_are_sound():
    assert vocab.check_codes() == []
    assert vocab.tier_range("A") == (1, 20) and vocab.tier_range("Y") == (400001, None) and vocab.tier_range("Z") == (None, None)
    assert vocab.pos_code("Noun") == "NOU" and vocab.pos_code("xyz") == "XYZ" and vocab.TIER_SCORE["A"] == 100 and vocab.TIER_SCORE["Z"] == 0


def test_scalar_functions(spark):
    assert values(spark, lexical.normalize_word, [" HeLLo ", "ﬁn", None]) == ["hello", "fin", None]
    assert values(spark, lexical.strip_accents, ["café", "plain", "Å"]) == ["cafe", "plain", "A"]
    assert values(spark, lexical.is_lower_word, ["abc", "aBc", "123", "é"]) == [True, False, False, True]
    assert values(spark, lexical.word_count, ["a", " a  b ", ""]) == [1, 2, 0]
    assert values(spark, lexical.rank_to_tier, [1, 20, 21, 400001, None, 0], "x int") == ["A", "A", "B", "Y", "Z", "Z"]
    assert values(spark, lexical.tier_score, ["A", "B", "Z", None]) == [100, 96, 0, 0]
    assert values(spark, lexical.concreteness_category, [3.5, 2.5, 1.0, None], "x double") == ["concrete", "mixed", "abstract", None]
    assert values(spark, lexical.aoa_grade, [4.9, 5.0, 10.9, 13.0, 17.0, 30.0, None], "x double") == ["pre-k", "k-2", "3-5", "6-8", "9-12", "adult", None]
    assert values(spark, lexical.case_class, ["abc", "ABC", "Abc", "aBc"]) == ["lower", "upper", "title", "mixed"]
    assert values(spark, lexical.plural_bases, ["flies", "boxes", "cat"]) == [["flie", "fli", "fly"], ["boxe", "box"], []]
    assert values(spark, lexical.clean_lemma, ["[[run|Running]]", "{{x|y}}Walk#Etym", "w:Place"]) == ["running", "walk", "place"]
    assert values(spark, lexical.ipa_syllables, ["/ˈhæpinəs/", "/ˈbʌtn̩/", "/taɪm/", "none"]) == [3, 2, 1, None]
    assert values(spark, lexical.is_englishlike, ["naïve", "R&amp;B", "слово", "don't", "123", "éx"]) == [True, False, False, True, False, True]
    assert values(spark, lexical.is_qid, ["Q42", "q42", "Q4a"]) == [True, False, False]
    r = spark.range(1).select(lexical.tier_to_range(F.lit("B")).alias("r")).first().r
    assert (r.low, r.high) == (21, 100)
    with pytest.raises(Exception):
        spark.range(1).select(lexical.tier_to_range(F.lit("?"))).collect()


WORDS = "id string, wc int, frequency_tier string, sources array<string>, spelling_region string, nsyll int, concreteness string, is_inflected boolean, phrase_type string"
ROWS = [
    ("castle", 1, "H", ["wikt", "eowl"], None, 2, "concrete", False, None),
    ("colour", 1, "I", ["wikt"], "en-GB", 2, "mixed", False, None),
    ("color", 1, "G", ["wikt", "wordnet"], "en-US", 2, None, False, None),
    ("kick the bucket", 3, "Z", ["wikt"], None, 4, None, False, "idiom"),
    ("running", 1, None, ["wordnet"], None, None, "abstract", True, None),
    ("Zürich", None, "P", ["wikt"], None, 2, None, None, None),
]
SENSES = [("castle", 1, "NOU", [], None), ("castle", 2, "VRB", ["DGAMB"], None), ("colour", 1, "NOU", ["ENGB"], None), ("color", 1, "NOU", ["ENUS", "RVLG"], None), ("color", 2, "VRB", ["TARC"], None), ("running", 1, "VRB", ["INFL"], "run")]


@pytest.fixture(scope="module")
def words(spark):
    return spark.createDataFrame(ROWS, WORDS).coalesce(1)


@pytest.fixture(scope="module")
def senses(spark):
    return spark.createDataFrame(SENSES, "id string, sense_ord int, pos string, codes array<string>, lemma string").coalesce(1)


@pytest.mark.parametrize(
    "filters,want",
    [
        ({}, {r[0] for r in ROWS}),
        ({"character": {"exact_length": 6}}, {"castle", "colour", "Zürich"}),
        ({"character": {"char_preset": "standard"}}, {"castle", "colour", "color", "running"}),
        ({"character": {"pattern": "col"}}, {"colour", "color"}),
        ({"character": {"exclude_pattern": "c"}}, {"kick the bucket", "running", "Zürich"}),
        ({"character": {"contains": ["o", "l"], "exclude_contains": "u"}}, {"color"}),
        ({"phrase": {"is_phrase": True}}, {"kick the bucket"}),
        ({"phrase": {"max_words": 1}}, {"castle", "colour", "color", "running", "Zürich"}),
        ({"phrase": {"phrase_type": "idiom"}}, {"kick the bucket"}),
        ({"frequency": {"max_tier": "H"}}, {"castle", "color"}),
        ({"frequency": {"tiers": ["Z"]}}, {"kick the bucket", "running"}),
        ({"sources": {"include": ["wordnet"], "exclude": ["wikt"]}}, {"running"}),
        ({"sources": ["eowl"]}, {"castle"}),
        ({"spelling_region": {"region": "en-GB", "include_universal": False}}, {"colour"}),
        ({"region": {"region": "en-US"}}, {"castle", "color", "kick the bucket", "running", "Zürich"}),
        ({"syllables": {"exact": 2, "min": 4}}, {"castle", "colour", "color", "Zürich"}),
        ({"syllables": {"require_syllables": True, "min": 3}}, {"kick the bucket"}),
        ({"concreteness": {"values": ["concrete", "mixed"]}}, {"castle", "colour"}),
        ({"lemma": {"base_forms_only": True}}, {"castle", "colour", "color", "kick the bucket", "Zürich"}),
        ({"pos": {"include": ["verb"]}}, {"castle", "color", "running"}),
        ({"pos": {"include-if-primary": ["verb"]}}, {"running"}),
        ({"pos": {"exclude-if-primary": ["noun"]}}, {"kick the bucket", "running", "Zürich"}),
        ({"labels": {"register": {"include": ["vulgar"]}}}, {"color"}),
        ({"labels": {"domain": {"include": ["DGAMB"]}}}, {"castle"}),
        ({"policy": {"family_friendly": True, "modern_only": True}}, {"castle", "colour", "kick the bucket", "running", "Zürich"}),
        ({"temporal": {"include-if-primary": ["TARC"]}}, set()),
    ],
)
def test_filters(words, senses, filters, want):
    assert {r.id for r in spec.run(words, {"filters": filters}, senses).collect()} == want


def test_dialects_and_output(words, senses):
    operation = {"include": {"pos": ["noun"], "register": ["vulgar"]}, "character": {"max_length": 6}}
    assert [r.id for r in spec.run(words, operation, senses).collect()] == ["color"]
    web = {"filters": [{"type": "character", "mode": "include", "config": {"max_length": 5}}, {"type": "pos", "config": {}}]}
    assert spec.normalize(web).warnings and [r.id for r in spec.run(words, web).collect()] == ["color"]
    text = "character:\n  min_length: 6\noutput:\n  sort_by: length\n  limit: 2\n"
    assert [r.id for r in spec.run(words, text).collect()] == ["Zürich", "castle"]
    assert spec.run(words, {"passthrough": True}).count() == len(ROWS) and spec.run(words, {"output": {"limit": 0}}).count() == len(ROWS)
    with pytest.raises(spec.SpecError):
        spec.run(words, {"filters": {"proper_noun": {"require_common_usage": True}}})
    with pytest.raises(spec.SpecError):
        spec.parse("[1, 2]")
    s = spec.normalize({"character": {"min_length": 5, "max_length": 5}})
    assert "exact_length: 5" in spec.to_yaml(s) and json.loads(spec.to_json(s))["filters"] == s.filters and spec.explain(s)
    assert spec.lint([{"type": "phrase", "config": {"max_words": 1}}, {"type": "phrase", "config": {"min_words": 2}}])
    for body in spec.PRESET_SPECS.values():
        assert not spec.validate(spec.normalize(body), words.columns)


def test_plan_joins_only_when_needed(words, senses):
    import contextlib
    import io

    def plan(df):
        out = io.StringIO()
        with contextlib.redirect_stdout(out):
            df.explain()
        return out.getvalue()

    assert "Join" not in plan(spec.run(words, {"character": {"max_length": 5}}, senses))
    assert "Join" in plan(spec.run(words, {"pos": {"include": ["noun"]}}, senses))


def test_two_table_filter(words, senses):
    names = lambda df: {r.id for r in df.collect()}
    assert names(pr.filter_two_tables(words, senses, sense=pr.matches_pos("VRB"))) == {"castle", "color", "running"}
    assert names(pr.filter_two_tables(words, senses, sense=pr.matches_pos("VRB"), need_all=True)) == {"running", "kick the bucket", "Zürich"}
    assert names(pr.filter_two_tables(words, senses, lexeme=pr.word_form()())) == {"castle", "colour", "color", "running", "Zürich"}


def test_lexemes(senses):
    got = {r.id: (r.sense_count, r.sense_length, r.sense_offset) for r in lx.lexemes_of(senses).collect()}
    assert got == {"castle": (2, 2, 0), "color": (2, 2, 2), "colour": (1, 1, 4), "running": (1, 1, 5)}
    assert {r.id: r.primary for r in lx.lemma_map(senses).collect()} == {"running": "run"}
    assert [r.forms for r in lx.lemma_groups(senses).collect()] == [["run", "running"]]


def test_merge_and_enrich(spark):
    base = spark.createDataFrame([("March", ["wikt"], 1), ("march", ["wikt"], 1), ("Polish", ["wikt"], 1)], "id string, sources array<string>, wc int")
    merged = lx.merge_sources(base, {"eowl": spark.createDataFrame([("MARCH",), ("new",)], "id string")})
    got = {r.id: (r.sources, r.license_sources) for r in merged.collect()}
    assert got["March"][0] == got["march"][0] == ["eowl", "wikt"] and got["new"] == (["eowl"], {"UKACD": ["eowl"]})
    ranks = spark.createDataFrame([("march", 5), ("polish", 700)], "word string, rank int")
    tiers = {r.id: r.frequency_tier for r in lx.add_frequency(base, ranks).collect()}
    assert tiers == {"March": "Z", "march": "A", "Polish": "G"}
    rated = spark.createDataFrame([("march", 4.256, 0.5)], "word string, mean double, sd double")
    old = base.withColumns({"concreteness": F.lit("mixed"), "concreteness_rating": F.lit(3.0), "concreteness_sd": F.lit(0.1)})
    assert {r.id: r.concreteness for r in lx.add_concreteness(old, rated).collect()}["march"] == "concrete"
    assert {r.id: r.concreteness for r in lx.add_concreteness(old, rated, prefer=False).collect()}["march"] == "mixed"


def test_trie(spark):
    listed = ["a", "an", "and", "ant", "be", "bee", "been", "über", "zoo"]
    t = trie.Trie.build(listed)
    assert sorted(t.word(t.word_id(w)) for w in listed) == sorted(listed) and "ann" not in t and t.word_id("x") == -1
    assert t.with_prefix("an") == ["an", "and", "ant"] and [w for w, _ in t.common_prefixes("beenish")] == ["be", "bee", "been"]
    again = trie.Trie.from_bytes(t.to_bytes())
    assert [again.word_id(w) for w in listed] == [t.word_id(w) for w in listed] and t.stats()["words"] == len(listed)
    words = spark.createDataFrame([(w,) for w in listed], "id string")
    assert {r.id: r.node_id for r in trie.with_ids(words).collect()} == {w: t.word_id(w) for w in listed}
    assert [r.id for r in trie.keys_with_prefix(words, "be").collect()] == ["be", "bee", "been"]
    assert trie.longest_prefix(words, spark.createDataFrame([("ander",), ("q",)], "text string")).first().prefix == "and"
    for n in (0, 127, 128, 300, 1 << 20):
        assert trie.read_varint(trie.varint(n)) == (n, len(trie.varint(n)))
    v = trie.BitVector([1, 0, 1, 1, 0])
    assert (v.rank1(3), v.rank0(5), v.select1(3), v.select0(2), v.select1(9)) == (2, 2, 3, 4, -1)


PAGE = """<page><title>happiness</title><ns>0</ns><text>==English==
===Etymology===
{{suffix|en|happy|ness}}
===Pronunciation===
* {{IPA|en|/ˈhæpinəs/}}
===Noun===
{{en-noun}}
# {{lb|en|chiefly|informal}} The {{m|en|state}} of [[being]] {{unclosed
# {{plural of|en|happy#Noun}}
====Synonyms====
* joy
==French==
===Noun===
# rien
</text></page>"""


def test_scan(spark, tmp_path):
    other = ["<page><title>Talk:x</title><ns>1</ns><text>==English==\n</text></page>", '<page><title>y</title><ns>0</ns><redirect title="z"/></page>', "<page><title>mot</title><ns>0</ns><text>==French==\n</text></page>", "<page><title>no</title><ns>0</ns></page>", "<page><title>cut"]
    (tmp_path / "d.xml").write_text("<mediawiki>\n" + "\n".join([PAGE, *other]))
    pages = scan.parse_pages(scan.read_pages(spark, str(tmp_path / "d.xml")))
    assert {r.title: r.status for r in pages.collect()} == {"happiness": "ok", "Talk:x": "special", "y": "redirect", "mot": "non_english", "no": "no_content"}
    got = scan.scan_entries(pages).orderBy("definition_level").collect()
    assert [(r.id, r.pos, r.nsyll, r.codes, r.lemma) for r in got] == [("happiness", "NOU", 3, ["RINF"], None), ("happiness", "NOU", 3, ["INFL"], "happy")]
    assert got[0].morphology.type == "SUFF" and got[0].morphology.components == ["happy", "-ness"]
    assert "synonyms" in {r.header for r in scan.headers(pages).collect()}
    assert [r.header for r in scan.unknown_headers(pages).collect()] == ["french"]


def test_markup():
    assert scan.templates("a {{x|{{y|1}}|k=2}} {{open {{z}}") == [("x", ["{{y|1}}", "k=2"]), ("z", [])]
    assert scan.strip_markup("''The'' {{m|en|word}} [[a|b]] {{lb|en|x}}{{gloss|g}}") == "The word b g"
    assert scan.morphology([("affix", ["en", "un-", "break", "-able"])])["type"] == "AFFX"
    assert scan.syllable_count("{{hyphenation|en|hap|pi|ness}}", []) == 3 and scan.syllable_count("{{rhymes|en|x|s=2}}", []) == 2
    assert scan.entries("R&amp;B", "===Noun===\n# x") == []


def test_files(spark, tmp_path):
    p = lambda name, text: (tmp_path / name).write_text(text) and str(tmp_path / name)
    bad = p("e.jsonl", '{"id":"a","wc":1}\n\n{oops\n{"id":"b"}\n')
    assert sorted(r.id for r in readers.entries(spark, bad).collect()) == ["a", "b"]
    with pytest.raises(Exception):
        readers.entries(spark, bad, strict=True).collect()
    assert {r.word: r["rank"] for r in readers.frequency_list(spark, p("f.txt", "the 9\n\n'em 5\nof 4\nthe 1\n")).collect()} == {"the": 5, "of": 4}
    assert [(r.word, r.mean, r.sd) for r in readers.concreteness(spark, p("c.tsv", "Word\tB\tM\tSD\nCat\t0\t4.8\t0.3\nbad\t0\tx\t1\n")).collect()] == [("cat", 4.8, 0.3)]
    assert [(r.word, r.known) for r in readers.aoa(spark, p("a.tsv", "W\tM\tS\tK\ndog\t3.1\tNA\t0.9\nno\tNA\t1\t1\n")).collect()] == [("dog", 0.9)]
    assert {r.id: r.severity for r in readers.severity_list(spark, p("s.json", '[{"match":"a|b","severity":1},{"match":"b","severity":4}]')).collect()} == {"a": "mild", "b": "mild"}
    assert [(r.section, r.line) for r in readers.sections(spark, p("x.txt", "=== A ===\n1\n\n=== B ===\n2\n")).collect()] == [("A", "1"), ("B", "2")]
    assert readers.first_existing(spark, str(tmp_path / "none"), bad) == bad
    words = spark.createDataFrame([("b", 'q"x', 2), ("a", None, 1)], "id string, v string, nsyll int")
    assert [r.value for r in sinks.lines(words.orderBy("id"), "csv", ["v"]).collect()] == ['"a",""', '"b","q""x"']
    sinks.write_list(words, str(tmp_path / "out"), "text")
    assert [r.value for r in spark.read.text(str(tmp_path / "out")).collect()] == ["a", "b"]
    assert json.loads(sinks.json_array(words.orderBy("id"), 10)) == ["a", "b"] and sinks.project(words, "{id, n: .nsyll}").columns == ["id", "n"]
    m = sinks.manifest(spark, bad).first()
    assert m.bytes == 36 and m.entries is None and len(m.sha256) == 64
    assert sorted((r.word, r.value) for r in sinks.module_values(words, "syllables").collect()) == [("a", 1), ("b", 2)]


def test_stream(spark, tmp_path):
    from glossarion.streaming import incremental as inc

    (tmp_path / "in").mkdir()
    (tmp_path / "in" / "1.json").write_text('{"id":"The"}\n{"id":"zyx"}\n')
    ranks = spark.createDataFrame([("the", 1)], "word string, rank int")
    stream = inc.enrich_stream(inc.entry_stream(spark, str(tmp_path / "in")), ranks)
    inc.append(stream, str(tmp_path / "out"), str(tmp_path / "c1")).awaitTermination()
    assert {r.id: r.frequency_tier for r in spark.read.parquet(str(tmp_path / "out")).collect()} == {"The": "A", "zyx": "Z"}
    inc.tier_histogram(stream, "hist", str(tmp_path / "c2")).awaitTermination()
    assert {r.frequency_tier: r.n for r in spark.table("hist").collect()} == {"A": 1, "Z": 1}


def test_every_oracle_has_a_query():
    import __spark_entry__ as e

    assert set(e.oracle_sql()) <= set(e.queries())


def test_reports(spark):
    from glossarion.operators import reports

    for w in ("word", "NaSA", "Ünï", "a b", "don't"):
        assert reports.word_of(reports.file_name(w)) == w and reports.file_name(w).islower() or w == "word"
    assert reports.interpolate("{lang}/{x}", lang="en") == "en/{x}"
    left = spark.createDataFrame([("a", ["x", "y"], 1), ("b", ["x"], 2)], "id string, codes array<string>, n int")
    right = spark.createDataFrame([("a", ["y", "x"], 1), ("b", ["x"], None)], "id string, codes array<string>, n int")
    assert [(r.id, r.column) for r in reports.entry_diff(left, right).collect()] == [("b", "n")]
    assert {(r.path, r.value) for r in reports.paths(left).where("value = 'y' or path = 'n'").collect()} == {("codes[]", "y"), ("n", "1"), ("n", "2")}
    got = spark.createDataFrame([("slang",), ("US",), ("Algebra",), ("dated",), ("none",)], "x string").select(reports.route_label(F.col("x")).alias("k")).collect()
    assert [r.k for r in got] == ["register", "region", "domain", "temporal", None]
    assert reports.available_filters({"a": [], "b": ["wikt"], "c": ["x"]}, ["wikt"]) == ["a", "b"]
