"""Queries of the lexicon engine over the raw words of the tables: presets, predicates, orders, formats, readers, audits."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from glossarion import vocab
from glossarion.functions import lexical
from glossarion.operators import lexicon as lx
from glossarion.operators import predicates as pr
from glossarion.operators import lookups, reports, trie
from glossarion.plans import derived as d
from glossarion.plans import spec
from glossarion.plans.queries import _FIRST, _SENSES, ORACLES, QUERIES, WITH, register, wordlist  # noqa: F401  the two tables are filled here too
from glossarion.sources import readers, sinks
from glossarion.sources.sinks import scratch

_BLANK = r"[^\x20\x09-\x0D]+"
#: raw(id, n): words as they stand in documents, with signs and capitals.
RAW = f"WITH raw AS (SELECT id, count(*) AS n FROM (SELECT unnest(regexp_extract_all(text, '{_BLANK}')) AS id FROM documents) GROUP BY id)"


def raw_words(spark: SparkSession, sf_dir: str) -> DataFrame:
    words = d.table(spark, sf_dir, "documents").select(F.explode(F.regexp_extract_all("text", F.lit(f"({_BLANK})"), 1)).alias("id"))
    return words.groupBy("id").agg(F.count("*").alias("n"))


# --- character presets, phrases, primary senses, proper nouns ---------------------

_PRESETS = {
    "standard": r"regexp_matches(id, '^\p{Ll}*$')", "contractions": r"regexp_matches(id, '^[\p{L}'']*$')", "alphanumeric": r"regexp_matches(id, '^[\p{L}\p{Nd}]*$')",
    "hyphenated": r"regexp_matches(id, '^[\p{L}\-]*$')", "common-punct": r"regexp_matches(id, '^[\p{L}''\-]*$')", "any": "true",
}


def _preset(name: str, where: str) -> None:
    @register(f"preset_{name.replace('-', '_')}", f"SELECT id, n FROM raw WHERE {where}", base=RAW)
    def run(spark, sf_dir):
        return spec.run(raw_words(spark, sf_dir), {"filters": {"character": {"char_preset": name}}})


for _name, _where in _PRESETS.items():
    _preset(_name, _where)

#: Names and types of parts, alone or together, are phrases of one word and more; the brand stands for a phrase type.
PHRASES = "WITH ph AS (SELECT DISTINCT id, len(regexp_extract_all(id, '\\S+')) AS wc, phrase_type FROM (SELECT CASE p_size % 3 WHEN 0 THEN p_type WHEN 1 THEN p_name ELSE p_name || ' ' || p_type END AS id, p_brand AS phrase_type FROM part))"


def phrases(spark: SparkSession, sf_dir: str) -> DataFrame:
    name = F.when(F.col("p_size") % 3 == 0, F.col("p_type")).when(F.col("p_size") % 3 == 1, F.col("p_name")).otherwise(F.concat_ws(" ", "p_name", "p_type"))
    rows = d.table(spark, sf_dir, "part").select(name.alias("id"), F.col("p_brand").alias("phrase_type")).distinct()
    return rows.withColumn("wc", lexical.word_count(F.col("id")))


def _phrase(name: str, options: dict, where: str) -> None:
    @register(name, f"SELECT id, phrase_type FROM ph WHERE {where}", base=PHRASES)
    def run(spark, sf_dir):
        return spec.run(phrases(spark, sf_dir), {"filters": {"phrase": options}}).select("id", "phrase_type")


_phrase("phrase_word_bounds", {"min_words": 2, "max_words": 3}, "wc BETWEEN 2 AND 3")
_phrase("phrase_is_phrase", {"is_phrase": True}, "wc <> 1")
_phrase("phrase_single_word", {"is_phrase": False}, "wc <= 1")
_phrase("phrase_type", {"phrase_type": "Brand#5"}, "phrase_type = 'Brand#5'")

_PRIMARY = "id {}IN (SELECT id FROM prim WHERE k = 1 AND {})"
wordlist("pos_include_primary", {"pos": {"include-if-primary": ["noun"]}}, _PRIMARY.format("", "pos = 'NOU'"), senses=True, ctes=_FIRST)
wordlist("pos_exclude_primary", {"pos": {"exclude-if-primary": ["verb"]}}, _PRIMARY.format("NOT ", "pos = 'VRB'"), senses=True, ctes=_FIRST)
wordlist("label_include_primary", {"labels": {"temporal": {"include-if-primary": ["archaic"]}}}, _PRIMARY.format("", "quality = 0"), senses=True, ctes=_FIRST)
wordlist("label_exclude_primary", {"labels": {"register": {"exclude-if-primary": ["vulgar"]}}}, _PRIMARY.format("NOT ", "toxic = 1"), senses=True, ctes=_FIRST)

USAGE = f"{RAW}, lw AS (SELECT lower(id) AS id, bool_or(id = lower(id)) AS common, bool_or(id <> lower(id)) AS proper FROM raw WHERE regexp_matches(id, '^[A-Za-z]+$') GROUP BY 1)"


def usage(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Words seen in lower case (common) or with a capital (proper)."""
    w = raw_words(spark, sf_dir).where(F.col("id").rlike("^[A-Za-z]+$"))
    return w.groupBy(F.lower("id").alias("id")).agg(F.bool_or(F.col("id") == F.lower("id")).alias("has_common_usage"), F.bool_or(F.col("id") != F.lower("id")).alias("has_proper_usage"))


def _proper(name: str, options: dict, where: str) -> None:
    @register(name, f"SELECT id FROM lw WHERE {where}", base=USAGE)
    def run(spark, sf_dir):
        return spec.run(usage(spark, sf_dir), {"filters": {"proper_noun": options}}).select("id")


_proper("proper_noun_exclude_pure", {"exclude_pure_proper_nouns": True}, "NOT (proper AND NOT common)")
_proper("proper_noun_common", {"require_common_usage": True}, "common")
_proper("proper_noun_none", {"allow_proper_usage": False}, "NOT proper")

# --- predicates --------------------------------------------------------------------


def _test(name: str, column, where: str, table=raw_words, base: str = RAW, source: str = "raw", columns=("id",)) -> None:
    @register(name, f"SELECT {', '.join(columns)} FROM {source} WHERE {where}", base=base)
    def run(spark, sf_dir):
        return table(spark, sf_dir).where(column()).select(*columns)


_test("contraction_fragments", lambda: pr.is_contraction_fragment(), "id LIKE '''%' OR id LIKE '%'''")
_test("valid_contractions", lambda: pr.is_valid_contraction(), "id LIKE '%''%' AND NOT (id LIKE '''%' OR id LIKE '%''')")
_test("word_form", lambda: pr.word_form()(), r"NOT (id LIKE '''%' OR id LIKE '%''') AND regexp_matches(id, '^\p{L}+$')")
_test("qid_like", lambda: lexical.is_qid(F.concat(F.lit("Q"), "id")), "regexp_matches('Q' || id, '^Q\\d+$')")
_SEN = WITH + _SENSES
_test("has_lemma", lambda: pr.has_lemma(), "lemma IS NOT NULL", d.senses, _SEN, "sen", ("id", "pos", "source"))
_test("has_lemma_of", lambda: pr.has_lemma("us"), "lemma = 'us'", d.senses, _SEN, "sen", ("id", "pos", "source"))
_test("pos_factory", lambda: pr.pos_is("NOU", "ADV")(), "pos IN ('NOU', 'ADV')", d.senses, _SEN, "sen", ("id", "pos", "source"))
_test("tier_factory", lambda: pr.tier_between("C", "J")(), "tier BETWEEN 'C' AND 'J'", d.words, WITH, "words")
_test("concreteness_factory", lambda: pr.concreteness_is(None, 2.0, 4.0)(), "conc IS NULL OR conc BETWEEN 2 AND 4", d.words, WITH, "words")
_test("concreteness_categories", lambda: pr.concreteness_is(["mixed", "abstract"])(), "conc < 3.5", d.words, WITH, "words")


@register("proper_noun_pos", "SELECT id FROM lw WHERE proper AND NOT common", base=USAGE)
def proper_noun_pos(spark, sf_dir):
    named = F.when(F.col("has_proper_usage") & ~F.col("has_common_usage"), "NAM").otherwise("NOU")
    return usage(spark, sf_dir).withColumn("pos", named).where(pr.is_proper_noun()).select("id")


@register("abbreviations", r"SELECT id FROM raw WHERE regexp_matches(id, '^[A-Z]{2,}$')", base=RAW)
def abbreviations(spark, sf_dir):
    codes = F.array_compact(F.array(F.when(F.col("id").rlike("^[A-Z]{2,}$"), "ABRV")))
    return raw_words(spark, sf_dir).withColumn("codes", codes).where(pr.is_abbreviation()).select("id")


# --- orders, formats ---------------------------------------------------------------


def _order(name: str, sort_by: str, order: str, limit: int = 200) -> None:
    @register(name, f"SELECT id FROM words ORDER BY {order} LIMIT {limit}")
    def run(spark, sf_dir):
        return spec.run(d.words(spark, sf_dir), {"filters": {}, "output": {"sort_by": sort_by, "limit": limit}}).select("id")


_SCORE = "CASE WHEN tier = 'Z' THEN 0 ELSE 100 - 4 * (ascii(tier) - 65) END"
_order("order_alphabetical", "alphabetical", "id")
_order("order_score", "score", f"{_SCORE} + CASE WHEN conc >= 3.5 THEN 20 ELSE 0 END - CASE WHEN length(id) > 12 THEN 10 ELSE 0 END - CASE WHEN length(id) > 15 THEN 10 ELSE 0 END DESC, id")
_order("order_frequency", "frequency", f"{_SCORE} DESC, id")
_order("order_length", "length", "length(id), id")
_order("order_case_insensitive", "case_insensitive", "lower(id), id")


def _format(name: str, fmt: str, fields, value: str) -> None:
    @register(name, f"SELECT {value} AS value FROM words")
    def run(spark, sf_dir):
        return sinks.lines(d.words(spark, sf_dir).select("id", "frequency_tier", "nsyll"), fmt, fields)


_N = "coalesce(CAST(nsyll AS VARCHAR), '')"
_format("format_text", "text", None, "id")
_format("format_text_fields", "text", ["frequency_tier", "nsyll"], f"id || chr(9) || tier || chr(9) || {_N}")
_format("format_tsv", "tsv", ["nsyll"], f"id || chr(9) || {_N}")
_format("format_csv", "csv", ["frequency_tier", "nsyll"], f"'\"' || id || '\",\"' || tier || '\",\"' || {_N} || '\"'")
_format("format_jsonl_ids", "jsonl", None, "'{\"id\":\"' || id || '\"}'")
_format("format_jsonl", "jsonl", [], "'{\"frequency_tier\":\"' || tier || '\",\"id\":\"' || id || '\"' || CASE WHEN nsyll IS NULL THEN '' ELSE ',\"nsyll\":' || nsyll END || '}'")
_format("format_unknown", "xml", ["nsyll"], "id")


@register("object_projection", "SELECT id AS word, tier FROM words")
def object_projection(spark, sf_dir):
    return sinks.project(d.words(spark, sf_dir), "{word: .id, tier: .frequency_tier}")


@register("default_omission", "SELECT id, nullif(tier, 'Z') AS frequency_tier, CASE WHEN inflected THEN true END AS is_inflected FROM words")
def default_omission(spark, sf_dir):
    return sinks.without_defaults(d.words(spark, sf_dir).select("frequency_tier", "is_inflected", "id"))


@register("csv_quotes", "SELECT '\"' || replace(id, '\"', '\"\"') || '\",\"' || n || '\"' AS value FROM raw", base=RAW)
def csv_quotes(spark, sf_dir):
    return sinks.lines(raw_words(spark, sf_dir), "csv", ["n"])


# --- readers: a table is written as the reader's format and read back ------------------


@register("read_entries", "SELECT id, CAST(length(id) AS INTEGER) AS wc, tier AS frequency_tier FROM words")
def read_entries(spark, sf_dir):
    path = scratch(spark)
    sinks.write_jsonl(d.words(spark, sf_dir).select("id", F.length("id").alias("wc"), "frequency_tier"), path)
    return readers.entries(spark, path, strict=True).select("id", "wc", "frequency_tier")


@register("read_entries_lenient", "SELECT id, pos FROM (SELECT DISTINCT id, pos FROM sen) WHERE length(id) > 3", senses=True)
def read_entries_lenient(spark, sf_dir):
    """Bad and blank lines between good ones are dropped."""
    path = scratch(spark)
    rows = d.senses(spark, sf_dir).select("id", "pos").distinct()
    line = F.when(F.length("id") > 3, F.to_json(F.struct("id", "pos"))).when(F.length("id") > 1, F.concat(F.lit('{"id": "'), "id")).otherwise("")
    rows.select(line.alias("value")).write.text(path)
    return readers.entries(spark, path).select("id", "pos")


@register("last_wins", "SELECT o_custkey AS id, arg_max(o_totalprice, o_orderkey) AS price FROM orders GROUP BY 1", base="")
def last_wins(spark, sf_dir):
    o = d.table(spark, sf_dir, "orders").select(F.col("o_custkey").alias("id"), F.col("o_orderkey").alias("ord"), F.col("o_totalprice").alias("price"))
    return readers.last_wins(o)


@register("grouped_rows", "SELECT o_custkey AS id, string_agg(o_orderstatus, ',' ORDER BY o_orderkey) AS statuses FROM orders GROUP BY 1", base="")
def grouped_rows(spark, sf_dir):
    o = d.table(spark, sf_dir, "orders").select(F.col("o_custkey").alias("id"), F.col("o_orderkey").alias("ord"), "o_orderstatus")
    return readers.grouped(o).select("id", F.array_join(F.transform("rows", lambda x: x["o_orderstatus"]), ",").alias("statuses"))


@register("read_word_list", "SELECT DISTINCT lower(id) AS id FROM raw WHERE regexp_matches(id, '^[A-Za-z]+$')", base=RAW)
def read_word_list(spark, sf_dir):
    path = scratch(spark)
    raw_words(spark, sf_dir).where(F.col("id").rlike("^[A-Za-z]+$")).select(F.concat(F.lit(" "), "id", F.lit(" ")).alias("value")).write.text(path)
    return readers.word_list(spark, path)


@register("read_commented_list", "SELECT DISTINCT lower(id) AS id FROM raw WHERE regexp_matches(id, '^[#A-Za-z]+$') AND id NOT LIKE '#%'", base=RAW)
def read_commented_list(spark, sf_dir):
    path = scratch(spark)
    raw_words(spark, sf_dir).where(F.col("id").rlike("^[#A-Za-z]+$")).select(F.col("id").alias("value")).write.text(path)
    return readers.commented_list(spark, path)


def _ratings_file(spark, sf_dir: str, columns: str) -> str:
    """One tab-separated file: a rating table is the reader's unit."""
    path = scratch(spark)
    rows = d.part_ratings(spark, sf_dir).selectExpr("1 AS k", f"concat_ws('\t', {columns}) AS value")
    head = spark.createDataFrame([(0, "word\tx\ty\tz")], "k int, value string")
    head.unionByName(rows).repartition(1).sortWithinPartitions("k", "value").select("value").write.text(path)
    return path


_RATES = "WITH rated AS (SELECT id AS word, CAST(sum(p_size) AS DOUBLE) AS s, CAST(max(p_size) AS DOUBLE) AS m, CAST(min(p_size) AS DOUBLE) AS k FROM (SELECT p_size, unnest(regexp_extract_all(lower(p_name), '[a-z]+')) AS id FROM part) GROUP BY id)"


@register("read_concreteness", "SELECT word, m / 50.0e0 AS mean, 0.0e0 AS sd FROM rated WHERE word NOT LIKE 'b%'", base=_RATES)
def read_concreteness(spark, sf_dir):
    """An unreadable mean drops the row, a missing deviation is 0."""
    path = _ratings_file(spark, sf_dir, "upper(word), '1', if(word like 'b%', 'NA', cast(sd as string)), ''")
    return readers.concreteness(spark, path)


@register("read_aoa", "SELECT word, m / 50.0e0 AS mean, 0.0e0 AS sd, k / 2.0e0 AS known FROM rated WHERE word NOT LIKE 'b%'", base=_RATES)
def read_aoa(spark, sf_dir):
    path = _ratings_file(spark, sf_dir, "word, if(word like 'b%', '#N/A', cast(sd as string)), 'n', cast(known as string)")
    return readers.aoa(spark, path)


@register("read_frequency_list", "SELECT id AS word, r AS rank FROM rk")
def read_frequency_list(spark, sf_dir):
    """One file in order of rank: its line numbers are the ranks."""
    path = scratch(spark)
    d.ranks(spark, sf_dir).repartitionByRange(1, "rank").sortWithinPartitions("rank").select(F.concat_ws(" ", "word", "count").alias("value")).write.text(path)
    return readers.frequency_list(spark, path)


# --- audits and statistics -------------------------------------------------------------


@register("unique_sense_rows", "SELECT id, pos, min(ord) AS sense_ord FROM sen GROUP BY id, pos, lemma, coalesce(toxic, 0) = 1, coalesce(quality, 1) = 0, region", senses=True)
def unique_sense_rows(spark, sf_dir):
    return lx.unique_senses(d.senses(spark, sf_dir)).select("id", "pos", "sense_ord")


@register("sense_summary", "SELECT count(DISTINCT words.id) AS n_words, count(DISTINCT CASE WHEN sen.id IS NULL THEN words.id END) AS senseless, count(sen.id) AS n_senses, round(count(sen.id) / count(DISTINCT words.id), 4) AS average FROM words LEFT JOIN sen ON words.id = sen.id", senses=True)
def sense_summary(spark, sf_dir):
    return reports.sense_summary(*d.words_and_senses(spark, sf_dir))


@register("multi_pos_words", "SELECT id, count(DISTINCT pos) AS n_pos FROM sen GROUP BY id HAVING count(DISTINCT pos) > 1", senses=True)
def multi_pos_words(spark, sf_dir):
    return reports.multi_pos(d.senses(spark, sf_dir))


@register("regional_words", "SELECT region AS code, count(DISTINCT id) AS n FROM sen WHERE region IS NOT NULL GROUP BY region", senses=True)
def regional_words(spark, sf_dir):
    return reports.regional(d.senses(spark, sf_dir))


@register("missing_expected_codes", "SELECT c AS code FROM (SELECT unnest(['NOU', 'VRB', 'ADJ', 'ADV', 'PRN', 'NAM']) AS c) WHERE c NOT IN (SELECT pos FROM sen)", senses=True)
def missing_expected_codes(spark, sf_dir):
    return reports.missing_codes(d.senses(spark, sf_dir), "pos", ["NOU", "VRB", "ADJ", "ADV", "PRN", "NAM"])


@register("selection_coverage", "SELECT count(*) AS n_words, round(100.0 * count(nsyll) / count(*), 2) AS syllables, round(100.0 * count(conc) / count(*), 2) AS concreteness, round(100.0 * count(r) / count(*), 2) AS frequency, round(100.0 * count(region) / count(*), 2) AS region FROM words WHERE list_contains(sources, 'eowl') OR list_contains(sources, 'brysbaert')")
def selection_coverage(spark, sf_dir):
    return reports.selection_coverage(d.words(spark, sf_dir), ["eowl", "brysbaert"])


@register("register_words", "SELECT DISTINCT id FROM sen WHERE toxic = 1 OR quality = 0", senses=True)
def register_words(spark, sf_dir):
    return reports.labelled(d.senses(spark, sf_dir), ["RVLG", "TARC"])


@register("single_word_set", "SELECT DISTINCT lower(id) AS id FROM ph WHERE wc <= 1", base=PHRASES)
def single_word_set(spark, sf_dir):
    return reports.single_words(phrases(spark, sf_dir))


@register("distinct_qids", "SELECT count(DISTINCT o_custkey) AS n FROM orders", base="")
def distinct_qids(spark, sf_dir):
    o = d.table(spark, sf_dir, "orders").select(F.concat(F.lit("Q"), "o_custkey").alias("qid"))
    return o.where(lexical.is_qid(F.col("qid"))).agg(F.count_distinct("qid").alias("n"))


@register("entry_differences", "SELECT id, 'a' AS \"column\" FROM (SELECT p_brand AS id, min(p_size) AS x, max(p_size) AS y FROM part GROUP BY 1) WHERE x <> y", base="")
def entry_differences(spark, sf_dir):
    p = d.table(spark, sf_dir, "part").groupBy(F.col("p_brand").alias("id")).agg(F.min("p_size").alias("x"), F.max("p_size").alias("y"))
    return reports.entry_diff(p.select("id", F.col("x").alias("a")), p.select("id", F.col("y").alias("a")))


@register("tier_ranges", "SELECT id, tier, CASE tier " + " ".join(f"WHEN '{t}' THEN {vocab.tier_range(t)[0] if vocab.tier_range(t)[0] is not None else 'NULL'}" for t in vocab.TIERS) + " END AS low, CASE tier " + " ".join(f"WHEN '{t}' THEN {vocab.tier_range(t)[1] if vocab.tier_range(t)[1] is not None else 'NULL'}" for t in vocab.TIERS) + " END AS high FROM words")
def tier_ranges(spark, sf_dir):
    w = d.words(spark, sf_dir).select("id", F.col("frequency_tier").alias("tier"))
    return w.withColumn("x", lexical.tier_to_range(F.col("tier"))).select("id", "tier", "x.low", "x.high")


@register("plural_candidates", "SELECT id, left(id, length(id) - 1) || CASE WHEN id LIKE '%es' THEN ',' || left(id, length(id) - 2) ELSE '' END || CASE WHEN id LIKE '%ies' THEN ',' || left(id, length(id) - 3) || 'y' ELSE '' END AS bases FROM cnt WHERE id LIKE '%s'")
def plural_candidates(spark, sf_dir):
    c = d.counts(spark, sf_dir).where(F.col("id").endswith("s"))
    return c.select("id", F.array_join(lexical.plural_bases(F.col("id")), ",").alias("bases"))


def _named_spec(name: str, where: str, senses: bool = False) -> None:
    wordlist(f"spec_{name}", spec.PRESET_SPECS[name], where, senses=senses)


_SAFE = "NOT id IN (SELECT id FROM sen WHERE toxic = 1)"
_named_spec("wordle", "length(id) = 5 AND regexp_matches(id, '^[a-z]+$')")
_named_spec("kids_nouns", f"id IN (SELECT id FROM sen WHERE pos = 'NOU') AND conc >= 3.5 AND tier <= 'I' AND {_SAFE} AND NOT id IN (SELECT id FROM sen WHERE quality = 0)", True)
_named_spec("blocklist", "id IN (SELECT id FROM sen WHERE toxic = 1)", True)
_named_spec("british", "region IS NULL OR region = 'en-GB'")
_named_spec("children", f"tier <= 'H' AND nsyll <= 2 AND {_SAFE}", True)
_named_spec("prefix_game", "id LIKE 'un%' AND length(id) >= 5")
_named_spec("no_special", "regexp_matches(id, '^[a-zA-Z]+$')")

# --- dictionary lookups ----------------------------------------------------------------


@register("trie_has", "SELECT DISTINCT id FROM (SELECT unnest(regexp_extract_all(lower(text), '[a-z]+')) AS id FROM conversations) WHERE id IN (SELECT id FROM cnt)")
def trie_has(spark, sf_dir):
    return trie.has(d.counts(spark, sf_dir), d.other_sources(spark, sf_dir)["wordnet"])


@register("trie_word_ids", "SELECT id, row_number() OVER (ORDER BY length(id), id) - 1 AS node_id FROM cnt")
def trie_word_ids(spark, sf_dir):
    return trie.with_ids(d.counts(spark, sf_dir))


@register("trie_words_of_ids", ", x AS (SELECT id, row_number() OVER (ORDER BY length(id), id) - 1 AS node_id FROM cnt) SELECT node_id, id FROM x WHERE node_id IN (SELECT o_orderkey FROM orders)")
def trie_words_of_ids(spark, sf_dir):
    asked = d.table(spark, sf_dir, "orders").select(F.col("o_orderkey").alias("node_id"))
    return trie.words_of_ids(d.counts(spark, sf_dir), asked).select("node_id", "id")


@register("trie_children", "SELECT left(id, 3) AS prefix, bool_or(length(id) = 3) AS terminal FROM cnt WHERE id LIKE 'th_%' GROUP BY 1")
def trie_children(spark, sf_dir):
    return trie.children(d.counts(spark, sf_dir), "th")


@register("trie_longest_prefix", ", a AS (SELECT DISTINCT unnest(regexp_extract_all(lower(text), '[a-z]+')) AS text FROM benchmark), p AS (SELECT DISTINCT left(id, k) AS prefix FROM (SELECT id, unnest(range(1, length(id) + 1)) AS k FROM cnt)), c AS (SELECT text, left(text, k) AS prefix FROM (SELECT text, unnest(range(1, length(text) + 1)) AS k FROM a)) SELECT text, arg_max(prefix, length(prefix)) AS prefix FROM c WHERE prefix IN (SELECT prefix FROM p) GROUP BY text")
def trie_longest_prefix(spark, sf_dir):
    asked = d.other_sources(spark, sf_dir)["eowl"].select(F.col("id").alias("text"))
    return trie.longest_prefix(d.counts(spark, sf_dir), asked)


# --- synsets: the words of a part's name stand for lemmas, the part for their synset --------------

_EDGES = "WITH edges AS (SELECT DISTINCT unnest(regexp_extract_all(p_name, '[A-Za-z]+')) AS lemma, p_partkey AS synset, p_brand AS pos FROM part)"


def _edges(spark: SparkSession, sf_dir: str) -> DataFrame:
    p = d.table(spark, sf_dir, "part")
    return p.select(F.explode(F.regexp_extract_all("p_name", F.lit("([A-Za-z]+)"), 1)).alias("lemma"), F.col("p_partkey").alias("synset"), F.col("p_brand").alias("pos"))


@register("synsets_of_words", f", asked AS (SELECT DISTINCT unnest(regexp_extract_all(text, '[A-Za-z]+')) AS id FROM conversations UNION SELECT DISTINCT upper(lemma) FROM edges) SELECT DISTINCT id, synset, pos FROM asked JOIN edges ON lower(id) = lower(lemma)", base=_EDGES)
def synsets_of_words(spark, sf_dir):
    text = d.table(spark, sf_dir, "conversations").select(F.explode(F.regexp_extract_all("text", F.lit("([A-Za-z]+)"), 1)).alias("id"))
    e = _edges(spark, sf_dir)
    return lookups.synsets_of(e, text.unionByName(e.select(F.upper("lemma").alias("id"))))


@register("synset_members", "SELECT synset, p_type AS lexname, string_agg(DISTINCT lemma, ',' ORDER BY lemma) AS lemmas FROM edges JOIN part ON p_partkey = synset WHERE synset IN (SELECT o_custkey FROM orders) GROUP BY 1, 2", base=_EDGES)
def synset_members(spark, sf_dir):
    names = d.table(spark, sf_dir, "part").select(F.col("p_partkey").alias("synset"), F.col("p_type").alias("lexname"))
    asked = d.table(spark, sf_dir, "orders").select(F.col("o_custkey").alias("synset"))
    return lookups.members_of(_edges(spark, sf_dir), names, asked).select("synset", "lexname", F.array_join("lemmas", ",").alias("lemmas"))
