"""Registered queries of the lexicon engine and their SQL."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from glossarion import vocab
from glossarion.functions import lexical
from glossarion.operators import lexicon as lx
from glossarion.operators import predicates as pr
from glossarion.operators import reports, trie
from glossarion.plans import derived as d
from glossarion.plans import spec

QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {}
ORACLES: dict[str, str] = {}

_TIER = "CASE WHEN r IS NULL THEN 'Z' " + " ".join(f"WHEN r >= {least} THEN '{t}'" for t, least in reversed(vocab.TIER_FROM.items())) + " END"
_SETS = " UNION ALL ".join(f"SELECT DISTINCT unnest(regexp_extract_all(lower({c}), '[a-z]+')) AS id, '{s}' AS s FROM {t}" for s, t, c in (("eowl", "benchmark", "text"), ("wordnet", "conversations", "text"), ("brysbaert", "part", "p_name")))
#: Common tables of the SQL: cnt, rk(id, n, r), words.
WITH = f"""WITH cnt AS (SELECT id, count(*) AS n FROM (SELECT unnest(regexp_extract_all(lower(text), '[a-z]+')) AS id FROM documents) GROUP BY id),
rk AS (SELECT id, n, CAST(row_number() OVER (ORDER BY n DESC, id) AS INTEGER) AS r FROM cnt),
srcs AS (SELECT id, list_sort(list(s)) AS sources FROM (SELECT id, 'wikt' AS s FROM cnt UNION ALL {_SETS}) GROUP BY id),
words AS (SELECT srcs.id, sources, r, {_TIER} AS tier, nullif(len(regexp_extract_all(srcs.id, '[aeiouy]+')), 0) AS nsyll,
  CASE WHEN srcs.id LIKE '%our' THEN 'en-GB' WHEN srcs.id LIKE '%or' THEN 'en-US' END AS region,
  CASE WHEN length(srcs.id) % 3 <> 0 THEN CAST(ascii(srcs.id) % 5 + 1 AS DOUBLE) END AS conc,
  regexp_matches(srcs.id, '(ing|ed)$') AS inflected FROM srcs LEFT JOIN rk ON srcs.id = rk.id)"""
_SENSES = """, lab AS (SELECT doc_id, max(toxic) AS toxic, min(quality) AS quality FROM labels GROUP BY doc_id),
tok AS (SELECT DISTINCT doc_id, lang, source, unnest(regexp_extract_all(lower(text), '[a-z]+')) AS id FROM documents),
sen AS (SELECT id, lang, source, min(tok.doc_id) AS ord, max(toxic) AS toxic, min(quality) AS quality, regexp_matches(id, '(ing|ed)$') AS inflected,
  CASE lang WHEN 'en' THEN 'NOU' WHEN 'fr' THEN 'VRB' WHEN 'de' THEN 'ADJ' WHEN 'es' THEN 'ADV' END AS pos,
  CASE lang WHEN 'en' THEN 'ENUS' WHEN 'de' THEN 'ENGB' END AS region,
  CASE WHEN regexp_matches(id, '(ing|ed)$') AND length(regexp_extract(id, '^(.*?)(ing|ed)$', 1)) > 1 THEN regexp_extract(id, '^(.*?)(ing|ed)$', 1) END AS lemma
  FROM tok LEFT JOIN lab ON tok.doc_id = lab.doc_id GROUP BY id, lang, source)"""


def register(name: str, sql: str | None = None, senses: bool = False, base: str | None = None):
    """``base``: the common tables before ``sql``; none for SQL that stands alone."""

    def put(f):
        QUERIES[name] = f
        if sql is not None:
            ORACLES[name] = f"{WITH if base is None else base}{_SENSES if senses else ''}\n{sql}"
        return f

    return put


def wordlist(name: str, filters: dict, where: str, columns=("id", "frequency_tier"), senses: bool = False, ctes: str = "") -> None:
    """A spec and the condition on ``words`` that says the same."""
    names = {"id": "id", "frequency_tier": "tier AS frequency_tier", "nsyll": "nsyll", "spelling_region": "region AS spelling_region"}
    sql = f"{WITH}{_SENSES if senses else ''}{ctes}\nSELECT {', '.join(names[c] for c in columns)} FROM words WHERE {where}"

    def run(spark: SparkSession, sf_dir: str) -> DataFrame:
        tables = d.words_and_senses(spark, sf_dir) if senses else (d.words(spark, sf_dir), None)
        return spec.run(tables[0], {"filters": filters}, tables[1]).select(*columns)

    QUERIES[name], ORACLES[name] = run, sql


wordlist("wordlist_exact_len", {"character": {"exact_length": 5, "pattern": "[a-z]+$"}, "frequency": {"max_tier": "N"}, "phrase": {"max_words": 1}}, "length(id) = 5 AND tier <= 'N'")
wordlist("wordlist_len_range", {"character": {"min_length": 3, "max_length": 4}}, "length(id) BETWEEN 3 AND 4")
wordlist("wordlist_char_presets", {"character": {"char_preset": "standard", "min_length": 12}}, "length(id) >= 12")
wordlist("wordlist_affixes", {"character": {"starts_with": ["th", "an"], "ends_with": "er", "exclude_starts_with": "than", "exclude_ends_with": ["eer"]}}, "(id LIKE 'th%' OR id LIKE 'an%') AND id LIKE '%er' AND id NOT LIKE 'than%' AND id NOT LIKE '%eer'")
wordlist("wordlist_contains", {"character": {"contains": ["in", "es"], "exclude_contains": "tk"}}, "id LIKE '%in%' AND id LIKE '%es%' AND id NOT LIKE '%t%' AND id NOT LIKE '%k%'")
wordlist("wordlist_regex", {"character": {"pattern": "[aeiou]..n", "exclude_pattern": ".*st"}}, "regexp_matches(id, '^[aeiou]..n') AND NOT regexp_matches(id, '^.*st')")
wordlist("wordlist_phrase", {"phrase": {"is_phrase": False, "min_words": 1}, "character": {"max_length": 3}}, "length(id) <= 3")
wordlist("freq_tier_set", {"frequency": {"tiers": ["A", "C", "H"]}}, "tier IN ('A', 'C', 'H')")
wordlist("freq_tier_range", {"frequency": {"min_tier": "E", "max_tier": "K"}}, "tier BETWEEN 'E' AND 'K'")
wordlist("freq_min_score", {"frequency": {"min_score": 72}}, "100 - 4 * (ascii(tier) - 65) >= 72")
wordlist("source_include", {"sources": {"include": ["wordnet", "brysbaert"], "exclude": ["eowl"]}}, "(list_contains(sources, 'wordnet') OR list_contains(sources, 'brysbaert')) AND NOT list_contains(sources, 'eowl')")
wordlist("region_universal", {"spelling_region": {"region": "en-GB"}, "character": {"min_length": 9}}, "(region IS NULL OR region = 'en-GB') AND length(id) >= 9", ("id", "spelling_region"))
wordlist("region_exclude", {"region": {"exclude": ["en-US"]}, "character": {"ends_with": "r"}}, "coalesce(region, '') <> 'en-US' AND id LIKE '%r'", ("id", "spelling_region"))
wordlist("syllable_range", {"syllables": {"min": 3, "max": 4}}, "nsyll BETWEEN 3 AND 4", ("id", "nsyll"))
wordlist("syllable_exact", {"syllables": {"exact": 2, "require_syllables": True}}, "nsyll = 2", ("id", "nsyll"))
wordlist("concreteness_values", {"concreteness": {"values": ["concrete"]}}, "conc >= 3.5")
wordlist("lemma_base_only", {"lemma": {"base_forms_only": True}, "character": {"max_length": 6}}, "NOT inflected AND length(id) <= 6")
wordlist("passthrough", {}, "true")
_ANY = "id IN (SELECT id FROM sen WHERE {})"
_FIRST = ", prim AS (SELECT id, pos, toxic, quality, region, row_number() OVER (PARTITION BY id ORDER BY ord) AS k FROM sen)"
wordlist("pos_include_any", {"pos": {"include": ["noun", "adverb"]}}, _ANY.format("pos IN ('NOU', 'ADV')"), senses=True)
wordlist("pos_exclude_any", {"pos": {"exclude": ["noun"], "require_pos": True}}, _ANY.format("true") + " AND NOT " + _ANY.format("pos = 'NOU'"), senses=True)
wordlist("label_exclude", {"labels": {"register": {"exclude": ["vulgar"]}, "temporal": {"exclude": ["archaic"]}}}, "NOT " + _ANY.format("toxic = 1 OR quality = 0"), senses=True)
wordlist("label_include", {"labels": {"region": {"include": ["ENGB"]}}}, _ANY.format("region = 'ENGB'"), senses=True)
wordlist("temporal_include", {"temporal": {"include": ["TARC"]}}, _ANY.format("quality = 0"), senses=True)
wordlist("policy_family_friendly", {"policy": {"family_friendly": True, "modern_only": True, "no_jargon": True}}, "NOT " + _ANY.format("toxic = 1 OR quality = 0"), senses=True)


@register("freq_rank_tier", "SELECT id, n, r AS rank, CASE WHEN false THEN '' " + _TIER[5:].replace("WHEN r IS NULL THEN 'Z'", "") + " AS tier FROM rk")
def freq_rank_tier(spark, sf_dir):
    return d.rank_by_count(d.counts(spark, sf_dir)).withColumn("tier", lexical.rank_to_tier(F.col("rank")))


@register("tier_histogram", "SELECT tier, count(*) AS n FROM words GROUP BY tier")
def tier_histogram(spark, sf_dir):
    return d.words(spark, sf_dir).groupBy(F.col("frequency_tier").alias("tier")).agg(F.count("*").alias("n"))


@register("tier_pct_ranked", "SELECT tier, count(*) AS n, round(100.0 * count(*) / (SELECT count(*) FROM words WHERE tier <> 'Z'), 2) AS pct FROM words WHERE tier <> 'Z' GROUP BY tier")
def tier_pct_ranked(spark, sf_dir):
    n = d.words(spark, sf_dir).where("frequency_tier <> 'Z'").groupBy(F.col("frequency_tier").alias("tier")).agg(F.count("*").alias("n"))
    return n.withColumn("pct", F.round(100.0 * F.col("n") / F.sum("n").over(W.partitionBy()), 2))


@register("score_topk", "SELECT id, score FROM (SELECT id, CASE WHEN tier = 'Z' THEN 0 ELSE 100 - 4 * (ascii(tier) - 65) END + CASE WHEN conc >= 3.5 THEN 20 ELSE 0 END - CASE WHEN length(id) > 12 THEN 10 ELSE 0 END - CASE WHEN length(id) > 15 THEN 10 ELSE 0 END AS score FROM words) ORDER BY score DESC, id LIMIT 100")
def score_topk(spark, sf_dir):
    score = lexical.score(F.col("id"), F.col("frequency_tier"), F.col("concreteness"), F.lit(None).cast("array<string>"))
    return d.words(spark, sf_dir).select("id", score.cast("long").alias("score")).orderBy(F.desc("score"), "id").limit(100)


@register("sense_any_match", "SELECT id FROM words WHERE id IN (SELECT id FROM sen WHERE pos = 'VRB' AND NOT coalesce(toxic = 1, false))", senses=True)
def sense_any_match(spark, sf_dir):
    return pr.filter_two_tables(*d.words_and_senses(spark, sf_dir), sense=pr.matches_pos("VRB") & ~pr.has_code("RVLG")).select("id")


@register("sense_all_match", "SELECT id FROM words WHERE id NOT IN (SELECT id FROM sen WHERE NOT (pos IN ('NOU', 'ADJ')))", senses=True)
def sense_all_match(spark, sf_dir):
    return pr.filter_two_tables(*d.words_and_senses(spark, sf_dir), sense=pr.matches_pos("NOU", "ADJ"), need_all=True).select("id")


@register("sense_match_counts", "SELECT id, count(ord) AS n_senses, count(CASE WHEN lemma IS NULL AND NOT inflected THEN 1 END) AS n_matching FROM (SELECT words.id, ord, lemma, sen.inflected FROM words LEFT JOIN sen ON words.id = sen.id) GROUP BY id", senses=True)
def sense_match_counts(spark, sf_dir):
    return pr.filter_two_tables(*d.words_and_senses(spark, sf_dir), sense=pr.is_base_form(), counts=True).select("id", "n_senses", "n_matching")


@register("sense_predicates", "SELECT pos, count(*) AS n, count(CASE WHEN toxic = 1 THEN 1 END) AS profane, count(CASE WHEN quality = 0 THEN 1 END) AS dated, count(CASE WHEN inflected THEN 1 END) AS inflected, count(CASE WHEN region IS NULL OR region = 'ENGB' THEN 1 END) AS british, count(CASE WHEN NOT coalesce(toxic = 1, false) AND NOT coalesce(quality = 0, false) THEN 1 END) AS child_safe FROM sen GROUP BY pos", senses=True)
def sense_predicates(spark, sf_dir):
    s = d.senses(spark, sf_dir).withColumns({c: F.array().cast("array<string>") for c in ("register_tags", "temporal_tags")})
    tests = {"profane": pr.is_profane(), "dated": ~pr.is_modern(), "inflected": pr.is_inflected(), "british": pr.matches_region("ENGB"), "child_safe": pr.is_child_safe()}
    return s.groupBy("pos").agg(F.count("*").alias("n"), *(F.count_if(t).alias(k) for k, t in tests.items()))


@register("normalize_lexemes", "SELECT id, count(*) AS sense_count, count(DISTINCT pos || coalesce(lemma, '-') || CASE WHEN toxic = 1 THEN 'v' ELSE '' END || CASE WHEN quality = 0 THEN 'a' ELSE '' END || coalesce(region, '')) AS sense_length FROM sen GROUP BY id", senses=True)
def normalize_lexemes(spark, sf_dir):
    return lx.lexemes_of(d.senses(spark, sf_dir)).select("id", "sense_count", "sense_length")


@register("normalize_sense_offsets", "SELECT id, CAST(sum(k) OVER (ORDER BY id ROWS UNBOUNDED PRECEDING) - k AS BIGINT) AS sense_offset, k AS sense_length FROM (SELECT id, count(DISTINCT pos || coalesce(lemma, '-') || CASE WHEN toxic = 1 THEN 'v' ELSE '' END || CASE WHEN quality = 0 THEN 'a' ELSE '' END || coalesce(region, '')) AS k FROM sen GROUP BY id)", senses=True)
def normalize_sense_offsets(spark, sf_dir):
    return lx.lexemes_of(d.senses(spark, sf_dir)).select("id", "sense_offset", "sense_length")


@register("merge_sources", "SELECT id, array_to_string(sources, ',') AS sources FROM words")
def merge_sources(spark, sf_dir):
    return d.words(spark, sf_dir).select("id", F.array_join("sources", ",").alias("sources"))


@register("merge_partition_stats", "SELECT count(*) AS total, " + ", ".join(f"count(CASE WHEN {e} THEN 1 END) AS {k}" for k, e in {"wikt_only": "a AND NOT b AND NOT c", "wordnet_only": "NOT a AND b AND NOT c", "eowl_only": "NOT a AND NOT b AND c", "wikt_wordnet": "a AND b AND NOT c", "wikt_eowl": "a AND NOT b AND c", "wordnet_eowl": "NOT a AND b AND c", "all_three": "a AND b AND c"}.items()) + " FROM (SELECT list_contains(sources, 'wikt') AS a, list_contains(sources, 'wordnet') AS b, list_contains(sources, 'eowl') AS c FROM words)")
def merge_partition_stats(spark, sf_dir):
    return lx.merge_partition(d.words(spark, sf_dir))


@register("license_map", "SELECT id, CASE WHEN list_contains(sources, 'wordnet') THEN 'wordnet' END AS attribution, CASE WHEN list_contains(sources, 'wikt') THEN 'wikt' END AS share_alike FROM words")
def license_map(spark, sf_dir):
    m = lambda k: F.array_join(F.col("license_sources")[k], ",")
    return d.words(spark, sf_dir).select("id", m("CC-BY-4.0").alias("attribution"), m("CC-BY-SA-4.0").alias("share_alike"))


_RATED = ", rated AS (SELECT id AS word, avg(p_size) / 10 AS mean, max(p_size) / 50.0 AS sd, min(p_size) / 2.0 AS known FROM (SELECT p_size, unnest(regexp_extract_all(lower(p_name), '[a-z]+')) AS id FROM part) GROUP BY id)"


@register("enrich_concreteness", "SELECT words.id, round(mean, 2) AS concreteness_rating, CASE WHEN round(mean, 2) >= 3.5 THEN 'concrete' WHEN round(mean, 2) >= 2.5 THEN 'mixed' ELSE 'abstract' END AS concreteness FROM words JOIN rated ON words.id = word", base=WITH + _RATED)
def enrich_concreteness(spark, sf_dir):
    out = lx.add_concreteness(d.words(spark, sf_dir).drop("concreteness", "concreteness_rating"), d.part_ratings(spark, sf_dir))
    return out.where("concreteness_rating is not null").select("id", "concreteness_rating", "concreteness")


@register("enrich_aoa_grade", "SELECT words.id, round(mean, 2) AS aoa, CASE WHEN mean IS NULL THEN NULL WHEN round(mean, 2) < 5 THEN 'pre-k' WHEN round(mean, 2) < 8 THEN 'k-2' ELSE 'more' END AS aoa_grade FROM words LEFT JOIN (SELECT * FROM rated WHERE known >= 0.5) ON words.id = word", base=WITH + _RATED)
def enrich_aoa_grade(spark, sf_dir):
    return lx.add_aoa(d.words(spark, sf_dir), d.part_ratings(spark, sf_dir)).select("id", "aoa", "aoa_grade")


_CASED = "SELECT DISTINCT unnest(regexp_extract_all(text, '[A-Za-z]+')) AS id FROM benchmark"


@register("case_credit", f", cased AS ({_CASED}) SELECT cased.id, CASE WHEN cased.id = lower(cased.id) OR lower(cased.id) NOT IN (SELECT id FROM cased) THEN r END AS frequency_rank FROM cased LEFT JOIN rk ON lower(cased.id) = rk.id")
def case_credit(spark, sf_dir):
    cased = d.table(spark, sf_dir, "benchmark").select(F.explode(F.regexp_extract_all("text", F.lit("([A-Za-z]+)"), 1)).alias("id")).distinct()
    return lx.add_frequency(cased, d.ranks(spark, sf_dir)).select("id", "frequency_rank")


@register("source_counts", "SELECT s AS source, count(*) AS n FROM (SELECT unnest(sources) AS s FROM words) GROUP BY s")
def source_counts(spark, sf_dir):
    return d.words(spark, sf_dir).select(F.explode("sources").alias("source")).groupBy("source").agg(F.count("*").alias("n"))


@register("source_combinations", "SELECT array_to_string(sources, ',') AS combination, count(*) AS n FROM words GROUP BY 1")
def source_combinations(spark, sf_dir):
    return d.words(spark, sf_dir).groupBy(F.array_join("sources", ",").alias("combination")).agg(F.count("*").alias("n"))


_MEAS = "count(*) AS n_words, count(nsyll) AS n_syllables, count(conc) AS n_concreteness, count(r) AS n_ranked"


@register("coverage_grouping_sets", f"SELECT 'all' AS grain, '' AS key, {_MEAS} FROM words UNION ALL SELECT 'combination', array_to_string(sources, ','), {_MEAS} FROM words GROUP BY 2 UNION ALL SELECT 'source', s, {_MEAS} FROM (SELECT *, unnest(sources) AS s FROM words) GROUP BY s")
def coverage_grouping_sets(spark, sf_dir):
    measures = {k: lx.MEASURES[k] for k in ("n_syllables", "n_concreteness", "n_ranked")}
    return lx.coverage(d.words(spark, sf_dir), measures)


@register("label_topk", ", c AS (SELECT pos, source, count(*) AS n FROM sen GROUP BY pos, source) SELECT pos, source, n, place FROM (SELECT *, row_number() OVER (PARTITION BY pos ORDER BY n DESC, source) AS place FROM c) WHERE place <= 3", senses=True)
def label_topk(spark, sf_dir):
    return lx.top_per_group(d.senses(spark, sf_dir).groupBy("pos", "source").agg(F.count("*").alias("n")), "pos", "source", 3)


@register("union_estimate", "SELECT count(*) AS n_words FROM words WHERE list_contains(sources, 'eowl') OR list_contains(sources, 'wordnet')")
def union_estimate(spark, sf_dir):
    combos = d.words(spark, sf_dir).groupBy(F.array_join("sources", ",").alias("combination")).agg(F.count("*").alias("n_words"))
    return lx.union_estimate(combos, ["eowl", "wordnet"])


@register("license_resolution", f"SELECT CASE WHEN bool_or(list_contains(sources, 'wikt')) THEN '{vocab.LICENSES['wikt']}' WHEN bool_or(list_contains(sources, 'wordnet')) THEN '{vocab.LICENSES['wordnet']}' WHEN bool_or(list_contains(sources, 'eowl')) THEN '{vocab.LICENSES['eowl']}' ELSE 'none' END AS license FROM words WHERE list_contains(sources, 'brysbaert')")
def license_resolution(spark, sf_dir):
    combos = d.words(spark, sf_dir).groupBy(F.array_join("sources", ",").alias("combination")).agg(F.count("*").alias("n_words"))
    return lx.resulting_license(combos, ["brysbaert"])


@register("lemma_primary", "SELECT id, min(lemma) AS lemma FROM sen WHERE lemma IS NOT NULL AND lemma <> id GROUP BY id", senses=True)
def lemma_primary(spark, sf_dir):
    return lx.lemma_map(d.senses(spark, sf_dir)).select("id", F.col("primary").alias("lemma"))


@register("lemma_groups", "SELECT lemma, lemma || ',' || string_agg(id, ',' ORDER BY id) AS forms FROM (SELECT DISTINCT lemma, id FROM sen WHERE lemma IS NOT NULL AND lemma <> id) GROUP BY lemma", senses=True)
def lemma_groups(spark, sf_dir):
    return lx.lemma_groups(d.senses(spark, sf_dir)).select("lemma", F.array_join("forms", ",").alias("forms"))


@register("lexname_sets", "SELECT id, string_agg(t, ',' ORDER BY t) AS lexnames FROM (SELECT DISTINCT unnest(regexp_extract_all(lower(p_name), '[a-z]+')) AS id, p_type AS t FROM part) GROUP BY id", base="")
def lexname_sets(spark, sf_dir):
    p = d.table(spark, sf_dir, "part")
    edges = d.tokens(p.select("p_name", "p_partkey"), "p_name").select(F.col("id").alias("lemma"), F.col("p_partkey").alias("synset"))
    return lx.lexnames(edges, p.select(F.col("p_partkey").alias("synset"), F.col("p_type").alias("lexname"))).select("id", F.array_join("lexnames", ",").alias("lexnames"))


@register("coverage_semi", "SELECT DISTINCT id FROM (SELECT unnest(regexp_extract_all(lower(text), '[a-z]+')) AS id FROM conversations) WHERE id IN (SELECT id FROM cnt)")
def coverage_semi(spark, sf_dir):
    return lx.coverage_of(d.counts(spark, sf_dir), d.other_sources(spark, sf_dir)["wordnet"]).where("found").select("id")


@register("coverage_anti", "SELECT DISTINCT id FROM (SELECT unnest(regexp_extract_all(lower(p_name), '[a-z]+')) AS id FROM part) WHERE id NOT IN (SELECT id FROM cnt)")
def coverage_anti(spark, sf_dir):
    return lx.coverage_of(d.counts(spark, sf_dir), d.other_sources(spark, sf_dir)["brysbaert"]).where("NOT found").select("id")


@register("deplural_match", ", m AS (SELECT id FROM cnt WHERE id LIKE '%s'), c AS (SELECT id, 0 AS k, left(id, length(id) - 1) AS base FROM m UNION ALL SELECT id, 1, left(id, length(id) - 2) FROM m WHERE id LIKE '%es' UNION ALL SELECT id, 2, left(id, length(id) - 3) || 'y' FROM m WHERE id LIKE '%ies') SELECT c.id, arg_min(base, k) AS base FROM c JOIN cnt ON base = cnt.id WHERE base <> '' GROUP BY c.id")
def deplural_match(spark, sf_dir):
    c = d.counts(spark, sf_dir)
    return lx.missing_plurals(c, c.where(F.col("id").endswith("s")))


@register("profanity_gap", ", e AS (SELECT DISTINCT unnest(regexp_extract_all(lower(text), '[a-z]+')) AS id FROM benchmark), o AS (SELECT id, bool_or(coalesce(toxic = 1, false)) AS l FROM sen GROUP BY id) SELECT coalesce(e.id, o.id) AS id, CASE WHEN e.id IS NOT NULL AND l THEN 'agreed' WHEN e.id IS NOT NULL AND l IS NULL THEN 'absent' WHEN e.id IS NOT NULL THEN 'unlabelled' ELSE 'only_ours' END AS state FROM e FULL JOIN o ON e.id = o.id WHERE e.id IS NOT NULL OR l", senses=True)
def profanity_gap(spark, sf_dir):
    return lx.gaps(d.other_sources(spark, sf_dir)["eowl"], d.senses(spark, sf_dir), F.array_contains("codes", "RVLG"))


@register("syllable_histogram", "SELECT nsyll, count(*) AS n FROM words GROUP BY nsyll")
def syllable_histogram(spark, sf_dir):
    return d.words(spark, sf_dir).groupBy("nsyll").agg(F.count("*").alias("n"))


@register("freq_unmatched", "SELECT id AS word, r AS rank, 'not a word' AS reason FROM rk WHERE id NOT IN (SELECT id FROM words WHERE list_contains(sources, 'eowl')) ORDER BY r LIMIT 20")
def freq_unmatched(spark, sf_dir):
    return lx.unmatched_ranks(d.ranks(spark, sf_dir), d.other_sources(spark, sf_dir)["eowl"]).select("word", "rank", "reason")


@register("combo_cumulative", ", c AS (SELECT array_to_string(sources, ',') AS combination, count(*) AS n FROM words GROUP BY 1) SELECT combination, n, CAST(sum(n) OVER w AS BIGINT) AS running, sum(n) OVER w - n < 0.8 * (SELECT sum(n) FROM c) AS needed FROM c WINDOW w AS (ORDER BY n DESC, combination ROWS UNBOUNDED PRECEDING)")
def combo_cumulative(spark, sf_dir):
    c = d.words(spark, sf_dir).groupBy(F.array_join("sources", ",").alias("combination")).agg(F.count("*").alias("n"))
    return lx.cumulative(c, "combination")


@register("int_ranges", "SELECT source, string_agg(CASE WHEN a = b THEN CAST(a AS VARCHAR) ELSE a || '-' || b END, ',' ORDER BY a) AS ranges FROM (SELECT source, min(n) AS a, max(n) AS b FROM (SELECT source, n, n - row_number() OVER (PARTITION BY source ORDER BY n) AS g FROM (SELECT DISTINCT source, length(text) AS n FROM documents)) GROUP BY source, g) GROUP BY source", base="")
def int_ranges(spark, sf_dir):
    return lx.int_ranges(d.table(spark, sf_dir, "documents").select("source", F.length("text").cast("long").alias("n")), "n", "source")


@register("case_class_dist", f"SELECT CASE WHEN id = lower(id) THEN 'lower' WHEN id = upper(id) THEN 'upper' WHEN left(id, 1) = upper(left(id, 1)) AND substr(id, 2) = lower(substr(id, 2)) THEN 'title' ELSE 'mixed' END AS kind, count(*) AS n FROM ({_CASED.replace('benchmark', 'documents')}) GROUP BY 1", base="")
def case_class_dist(spark, sf_dir):
    cased = d.table(spark, sf_dir, "documents").select(F.explode(F.regexp_extract_all("text", F.lit("([A-Za-z]+)"), 1)).alias("id")).distinct()
    return cased.groupBy(lexical.case_class(F.col("id")).alias("kind")).agg(F.count("*").alias("n"))


@register("prefix_search", "SELECT id FROM cnt WHERE id LIKE 'the%' ORDER BY id LIMIT 100")
def prefix_search(spark, sf_dir):
    return trie.keys_with_prefix(d.counts(spark, sf_dir), "the", 100)


@register("common_prefixes", ", t AS (SELECT id AS text FROM cnt WHERE length(id) >= 14) SELECT DISTINCT text, cnt.id AS id FROM t JOIN cnt ON starts_with(text, cnt.id)")
def common_prefixes(spark, sf_dir):
    c = d.counts(spark, sf_dir)
    return trie.common_prefixes(c, c.where(F.length("id") >= 14).select(F.col("id").alias("text"))).select("text", "id")


@register("next_letters", "SELECT substr(id, 3, 1) AS letter, count(*) AS n FROM cnt WHERE id LIKE 'th_%' GROUP BY 1")
def next_letters(spark, sf_dir):
    return trie.next_letters(d.counts(spark, sf_dir), "th")


@register("neighbors", "SELECT id, lag(id) OVER (ORDER BY id) AS before, lead(id) OVER (ORDER BY id) AS after FROM cnt")
def neighbors(spark, sf_dir):
    return trie.neighbors(d.counts(spark, sf_dir).select("id"))


@register("trie_node_count", "SELECT length(p) AS depth, count(*) AS nodes FROM (SELECT DISTINCT left(id, k) AS p FROM (SELECT id, unnest(range(1, length(id) + 1)) AS k FROM cnt)) GROUP BY 1")
def trie_node_count(spark, sf_dir):
    return trie.nodes(d.counts(spark, sf_dir)).groupBy("depth").agg(F.count("*").alias("nodes"))


@register("parity_diff", ", a AS (SELECT DISTINCT unnest(regexp_extract_all(lower(text), '[a-z]+')) AS id FROM benchmark), b AS (SELECT DISTINCT unnest(regexp_extract_all(lower(text), '[a-z]+')) AS id FROM conversations) SELECT id, 'left' AS side FROM a WHERE id NOT IN (SELECT id FROM b) UNION ALL SELECT id, 'right' FROM b WHERE id NOT IN (SELECT id FROM a)")
def parity_diff(spark, sf_dir):
    o = d.other_sources(spark, sf_dir)
    return lx.parity(o["eowl"], o["wordnet"])


@register("qid_missing", "SELECT word, CAST(floor((row_number() OVER (ORDER BY n, word) - 1) / 500) AS BIGINT) AS batch FROM (SELECT DISTINCT 'Q' || c_custkey AS word, c_custkey AS n FROM customer WHERE c_custkey NOT IN (SELECT o_custkey FROM orders))", base="")
def qid_missing(spark, sf_dir):
    wanted = d.table(spark, sf_dir, "customer").select(F.concat(F.lit("Q"), "c_custkey").alias("word"))
    return lx.missing_keys(wanted, d.table(spark, sf_dir, "orders").select(F.concat(F.lit("Q"), "o_custkey").alias("word")), "word")


@register("module_export", "SELECT id AS word, nsyll AS value FROM words WHERE nsyll IS NOT NULL")
def module_export(spark, sf_dir):
    from glossarion.sources.sinks import module_values

    return module_values(d.words(spark, sf_dir), "syllables")


@register("sample_by_combo", ", k AS (SELECT id, array_to_string(sources, ',') AS combination FROM words), t AS (SELECT combination FROM k GROUP BY 1 ORDER BY count(*) DESC, combination LIMIT 8) SELECT combination, CAST(place AS INTEGER) AS place, id FROM (SELECT *, row_number() OVER (PARTITION BY combination ORDER BY md5('0:' || id), id) AS place FROM k WHERE combination IN (SELECT combination FROM t)) WHERE place <= 3")
def sample_by_combo(spark, sf_dir):
    return lx.sample_by_combination(d.words(spark, sf_dir))


@register("output_checksum", "SELECT count(*) AS n, CAST(sum(CAST('0x' || left(md5(id), 8) AS BIGINT)) AS BIGINT) AS checksum FROM words")
def output_checksum(spark, sf_dir):
    return lx.checksum(d.words(spark, sf_dir).select("id")).select("n", F.col("checksum").cast("long").alias("checksum"))


@register("page_title_extract", "SELECT page_id, regexp_extract(html, '<title>([^<]*)</title>', 1) AS title FROM pages", base="")
def page_title_extract(spark, sf_dir):
    return d.table(spark, sf_dir, "pages").select("page_id", F.regexp_extract("html", "<title>([^<]*)</title>", 1).alias("title"))


@register("ordinal_map", "SELECT id, CAST(row_number() OVER (ORDER BY f) - 1 AS BIGINT) AS ordinal, k AS n_lines FROM (SELECT p_brand AS id, min(p_partkey) AS f, count(*) AS k FROM part GROUP BY p_brand)", base="")
def ordinal_map(spark, sf_dir):
    rows = d.table(spark, sf_dir, "part").select(F.col("p_brand").alias("id"), F.col("p_partkey").alias("ord"))
    return reports.ordinals(rows).select("id", "ordinal", F.size("lines").cast("long").alias("n_lines"))


@register("duplicate_histogram", "SELECT e AS entries_per_word, n, round(100.0 * n / sum(n) OVER (), 2) AS pct, round(100.0 * sum(n) OVER (ORDER BY e ROWS UNBOUNDED PRECEDING) / sum(n) OVER (), 2) AS cumulative_pct FROM (SELECT e, count(*) AS n FROM (SELECT p_brand, count(*) AS e FROM part GROUP BY p_brand) GROUP BY e)", base="")
def duplicate_histogram(spark, sf_dir):
    return reports.duplicate_histogram(d.table(spark, sf_dir, "part").select(F.col("p_brand").alias("id")))


@register("richness_topk", "SELECT id, richness FROM (SELECT id, len(sources) + CASE WHEN nsyll IS NULL THEN 0 ELSE 1 END + CASE WHEN conc IS NULL THEN 0 ELSE 1 END + CASE WHEN r IS NULL THEN 0 ELSE 1 END + CASE WHEN region IS NULL THEN 0 ELSE 1 END AS richness FROM words) WHERE richness >= 5 ORDER BY richness DESC, id LIMIT 10")
def richness_topk(spark, sf_dir):
    return reports.richness(d.words(spark, sf_dir))


@register("label_cooccurrence", "SELECT code, count(*) AS n FROM (SELECT unnest([CASE WHEN quality = 0 THEN 'TARC' END, region, CASE WHEN inflected THEN 'INFL' END]) AS code FROM sen WHERE toxic = 1) WHERE code IS NOT NULL GROUP BY code", senses=True)
def label_cooccurrence(spark, sf_dir):
    return reports.co_labels(d.senses(spark, sf_dir), "RVLG")


@register("enrichment_impact", "SELECT array_to_string(list_filter(sources, lambda s: s <> 'brysbaert'), ',') AS combination, 'brysbaert' AS enrichment, count(*) AS n FROM words WHERE list_contains(sources, 'brysbaert') GROUP BY 1")
def enrichment_impact(spark, sf_dir):
    return reports.enrichment_impact(d.words(spark, sf_dir))


@register("array_combinations", "SELECT combination, count(*) AS n FROM (SELECT array_to_string(sources, ',') AS combination FROM words) GROUP BY 1")
def array_combinations(spark, sf_dir):
    return reports.array_combinations(d.words(spark, sf_dir), "sources")


@register("distinct_values", "SELECT 'p_brand' AS path, count(DISTINCT p_brand) AS n, CAST(ceil(log2(count(DISTINCT p_brand))) AS INTEGER) AS bits FROM part UNION ALL SELECT 'p_type', count(DISTINCT p_type), CAST(ceil(log2(count(DISTINCT p_type))) AS INTEGER) FROM part", base="")
def distinct_values(spark, sf_dir):
    return reports.distinct_values(d.table(spark, sf_dir, "part").select("p_brand", "p_type"))


@register("enriched_entries", "SELECT words.id, tier AS frequency_tier, string_agg(DISTINCT pos, ',' ORDER BY pos) AS pos, count(ord) AS n_senses FROM words LEFT JOIN sen ON words.id = sen.id GROUP BY words.id, tier", senses=True)
def enriched_entries(spark, sf_dir):
    out = reports.enriched(*d.words_and_senses(spark, sf_dir))
    return out.select("id", "frequency_tier", F.array_join("pos", ",").alias("pos"), F.coalesce(F.size("senses"), F.lit(0)).cast("long").alias("n_senses"))
