"""Queries of the dump scan over a dump made of whole tables: a page for each document, whose parts follow from the
document's id and language, so that SQL can state the result."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from glossarion.functions import lexical
from glossarion.operators import lexicon as lx
from glossarion.operators import scan
from glossarion.plans import derived as d

QUERIES, ORACLES = {}, {}

#: Section header, head template and code of a part of speech, by id modulo 4; label and code by id modulo 3.
KINDS = (("Noun", "en-noun", "NOU"), ("Verb", "en-verb", "VRB"), ("Adjective", "en-adj", "ADJ"), ("Adverb", "en-adv", "ADV"))
LABELS = (("chiefly|informal", "RINF"), ("slang", "RSLG"), ("archaic", "TARC"))
TITLE = "'t' || translate(CAST(doc_id AS VARCHAR), '0123456789', 'abcdefghij')"


def register(name: str, sql: str):
    def put(f):
        QUERIES[name], ORACLES[name] = f, sql
        return f

    return put


def _by(column: str, values, n: int):
    out = F.when(F.col(column) % n == 0, values[0])
    for k, v in enumerate(values[1:], 1):
        out = out.when(F.col(column) % n == k, v)
    return out


def _case(column: str, values, n: int) -> str:
    return f"CASE {column} % {n} " + " ".join(f"WHEN {k} THEN '{v}'" for k, v in enumerate(values)) + " END"


def dump(spark: SparkSession, sf_dir: str) -> DataFrame:
    """xml: of five documents one is a talk page, one a redirect, one has no English, two are entries."""
    docs = d.table(spark, sf_dir, "documents").select("doc_id")
    title = F.concat(F.lit("t"), F.translate(F.col("doc_id").cast("string"), "0123456789", "abcdefghij"))
    header, template = (_by("doc_id", [k[i] for k in KINDS], 4) for i in (0, 1))
    entry = F.concat(
        F.lit("==English==\n===Etymology===\n{{suffix|en|"), title, F.lit("|ness}}\n===Pronunciation===\n* {{IPA|en|/ˈhæpinəs/}}\n==="), header, F.lit("===\n{{"), template,
        F.lit("}}\n# {{lb|en|"), _by("doc_id", [x for x, _ in LABELS], 3), F.lit("}} The state of being [[happy]].\n# {{plural of|en|happy}}\n====Synonyms====\n* joy\n"),
    )
    text = F.when(F.col("doc_id") % 5 == 2, F.lit("==French==\n")).otherwise(entry)
    page = lambda ns, body: F.concat(F.lit("<title>"), title, F.lit(f"</title><ns>{ns}</ns>"), body)
    full = F.concat(F.lit("<text>"), text, F.lit("</text>"))
    xml = F.when(F.col("doc_id") % 5 == 0, page(1, full)).when(F.col("doc_id") % 5 == 1, page(0, F.lit('<redirect title="z"/>'))).otherwise(page(0, full))
    return docs.select(xml.alias("xml"))


def _pages(spark: SparkSession, sf_dir: str) -> DataFrame:
    return scan.parse_pages(dump(spark, sf_dir))


@register("page_status", "SELECT CASE doc_id % 5 WHEN 0 THEN 'special' WHEN 1 THEN 'redirect' WHEN 2 THEN 'non_english' ELSE 'ok' END AS status, count(*) AS n FROM documents GROUP BY 1")
def page_status(spark, sf_dir):
    return scan.status_counts(_pages(spark, sf_dir))


@register("scan_entries", f"""WITH e AS (SELECT doc_id, {TITLE} AS id, {_case('doc_id', [k[2] for k in KINDS], 4)} AS pos FROM documents WHERE doc_id % 5 >= 3)
SELECT id, pos, 3 AS nsyll, {_case('doc_id', [c for _, c in LABELS], 3)} AS code, NULL AS lemma, id || ',-ness' AS morph FROM e UNION ALL SELECT id, pos, 3, 'INFL', 'happy', id || ',-ness' FROM e""")
def scan_entries(spark, sf_dir):
    return scan.scan_entries(_pages(spark, sf_dir)).select("id", "pos", "nsyll", F.array_join("codes", ",").alias("code"), "lemma", F.array_join("morphology.components", ",").alias("morph"))


@register("section_headers", f"""WITH e AS (SELECT lower({_case('doc_id', [k[0] for k in KINDS], 4)}) AS header FROM documents WHERE doc_id % 5 >= 3)
SELECT level, header, count(*) AS n FROM (SELECT 2 AS level, 'english' AS header FROM e UNION ALL SELECT 3, 'etymology' FROM e UNION ALL SELECT 3, 'pronunciation' FROM e UNION ALL SELECT 3, header FROM e UNION ALL SELECT 4, 'synonyms' FROM e) GROUP BY 1, 2""")
def section_headers(spark, sf_dir):
    return scan.headers(_pages(spark, sf_dir).where("status = 'ok'")).groupBy("level", "header").agg(F.count("*").alias("n"))


@register("ignored_headers", "SELECT CASE doc_id % 4 WHEN 0 THEN 'etymology ' || doc_id WHEN 1 THEN 'noun' WHEN 2 THEN 'synonyms' ELSE 'etymology x' END AS header, doc_id % 2 = 0 AS ignored, count(*) AS n FROM documents GROUP BY 1, 2")
def ignored_headers(spark, sf_dir):
    header = F.when(F.col("doc_id") % 4 == 0, F.concat(F.lit("etymology "), "doc_id")).when(F.col("doc_id") % 4 == 1, "noun").when(F.col("doc_id") % 4 == 2, "synonyms").otherwise("etymology x")
    rows = d.table(spark, sf_dir, "documents").select(header.alias("header"))
    return rows.groupBy("header", scan.is_ignored_header(F.col("header")).alias("ignored")).agg(F.count("*").alias("n"))


@register("block_containment", "SELECT page, start, coalesce(max(CASE WHEN start % 3 = 0 THEN start END) OVER (PARTITION BY page ORDER BY start), min(CASE WHEN start % 3 = 0 THEN start END) OVER (PARTITION BY page)) AS block FROM (SELECT o_custkey AS page, o_orderkey AS start FROM orders)")
def block_containment(spark, sf_dir):
    o = d.table(spark, sf_dir, "orders").select(F.col("o_custkey").alias("page"), F.col("o_orderkey").alias("start"))
    return scan.block_of_section(o.withColumn("header", F.when(F.col("start") % 3 == 0, "etymology 1").otherwise("noun"))).select("page", "start", "block")


@register("label_to_code", "SELECT doc_id AS id, CASE lang WHEN 'en' THEN 'ENUS,RINF' WHEN 'fr' THEN 'DMATH,RINF' ELSE 'RINF' END AS codes FROM documents")
def label_to_code(spark, sf_dir):
    label = F.when(F.col("lang") == "en", "U.S.").when(F.col("lang") == "fr", "Algebra").when(F.col("lang") == "de", "nothing").otherwise("often")
    rows = d.table(spark, sf_dir, "documents").select(F.col("doc_id").alias("id"), F.array(F.lit("chiefly"), label, F.lit("colloquial")).alias("labels"))
    return rows.select("id", F.array_join(F.array_sort(scan.label_codes(F.col("labels"))), ",").alias("codes"))


@register("category_substring", "SELECT doc_id AS id, CASE lang WHEN 'en' THEN 'RSLG' WHEN 'fr' THEN 'DCHEM,DORGC' ELSE '' END AS codes FROM documents")
def category_substring(spark, sf_dir):
    category = F.when(F.col("lang") == "en", "English slang").when(F.col("lang") == "fr", "en:Organic chemistry").otherwise("English lemmas")
    rows = d.table(spark, sf_dir, "documents").select(F.col("doc_id").alias("id"), F.array(category).alias("c"))
    return rows.select("id", F.array_join(F.array_sort(scan.category_codes(F.col("c"))), ",").alias("codes"))


@register("syllable_sources_disagree", "SELECT doc_id AS id, doc_id % 3 + 1 <> doc_id % 2 + 1 AND doc_id % 7 > 0 AS differs FROM documents")
def syllable_sources_disagree(spark, sf_dir):
    n = lambda k: (F.col("doc_id") % k + 1).cast("int")
    rows = d.table(spark, sf_dir, "documents").select(F.col("doc_id").alias("id"), n(3).alias("ipa"), F.when(F.col("doc_id") % 7 > 0, n(2)).alias("hyph"), F.lit(None).cast("int").alias("rhymes"))
    return scan.syllable_disagreement(rows, ["ipa", "hyph", "rhymes"]).select("id", "differs")


@register("syllable_priority", "SELECT doc_id AS id, CASE doc_id % 5 WHEN 0 THEN 3 WHEN 1 THEN 2 WHEN 2 THEN 4 WHEN 3 THEN 5 END AS n FROM documents")
def syllable_priority(spark, sf_dir):
    """By id: a transcription, two parts, one long part beside a category, rhymes alone, one long part alone."""
    k = F.col("doc_id") % 5
    strings = lambda *x: F.array(*map(F.lit, x))
    ipa, hyph = F.when(k == 0, "/ˈhæpinəs/"), F.when(k == 0, strings("a", "b")).when(k == 1, strings("ta", "ble")).when(k == 2, strings("strength")).when(k == 4, strings("window"))
    category, rhymes = F.when(k == 0, 9).when(k == 1, 4).when(k == 2, 4), F.when(k < 3, 9).when(k == 3, 5)
    return d.table(spark, sf_dir, "documents").select(F.col("doc_id").alias("id"), lexical.syllables(ipa, hyph, category, rhymes).alias("n"))


@register("clean_lemma", "SELECT DISTINCT id AS lemma FROM (SELECT unnest(regexp_extract_all(lower(text), '[a-z]+')) AS id FROM documents)")
def clean_lemma(spark, sf_dir):
    w = d.counts(spark, sf_dir).select(F.concat(F.lit("{{x|y}}[["), "id", F.lit("|"), F.upper("id"), F.lit("]]#Etym")).alias("raw"))
    return w.select(lexical.clean_lemma(F.col("raw")).alias("lemma"))


@register("normalize_word", "SELECT id, nfc_normalize(lower(id)) AS norm, strip_accents(id) AS plain FROM (SELECT DISTINCT unnest(regexp_extract_all(text, '[A-Za-zÀ-ÿ]+')) AS id FROM documents)")
def normalize_word(spark, sf_dir):
    words = d.table(spark, sf_dir, "documents").select(F.explode(F.regexp_extract_all("text", F.lit("([A-Za-zÀ-ÿ]+)"), 1)).alias("id")).distinct()
    return words.select("id", lexical.normalize_word(F.concat(F.lit("  "), "id", F.lit(" "))).alias("norm"), lexical.strip_accents(F.col("id")).alias("plain"))


@register("englishlike", r"SELECT id, NOT regexp_matches(id, '[&;<>]') AND regexp_matches(id, '[A-Za-zÀ-ɏ]') AS ok FROM (SELECT DISTINCT unnest(regexp_extract_all(text, '[!-~À-ÿ]+')) AS id FROM documents) WHERE NOT regexp_matches(id, '[×÷]')")
def englishlike(spark, sf_dir):
    words = d.table(spark, sf_dir, "documents").select(F.explode(F.regexp_extract_all("text", F.lit("([!-~À-ÿ]+)"), 1)).alias("id")).distinct()
    return words.where(~F.col("id").rlike("[×÷]")).select("id", lexical.is_englishlike(F.col("id")).alias("ok"))


@register("add_source", "SELECT doc_id AS id, 'eowl,wikt' || CASE WHEN doc_id % 2 = 0 THEN ',wordnet' ELSE '' END AS sources, CASE WHEN doc_id % 2 = 0 THEN 'CC-BY-4.0,' ELSE '' END || 'CC-BY-SA-4.0,UKACD' AS licenses FROM documents")
def add_source(spark, sf_dir):
    docs = d.table(spark, sf_dir, "documents")
    even = F.col("doc_id") % 2 == 0
    one = lambda *x: F.array(*map(F.lit, x))
    s0 = F.when(even, one("wikt", "wordnet")).otherwise(one("wikt"))
    l0 = F.when(even, F.create_map(F.lit("CC-BY-SA-4.0"), one("wikt"), F.lit("CC-BY-4.0"), one("wordnet"))).otherwise(F.create_map(F.lit("CC-BY-SA-4.0"), one("wikt")))
    s, licenses = lexical.add_source(s0, l0, "eowl")
    return docs.select(F.col("doc_id").alias("id"), F.array_join(s, ",").alias("sources"), F.array_join(F.array_sort(F.map_keys(licenses)), ",").alias("licenses"))


@register("synset_stats", "SELECT count(DISTINCT lemma) AS words, count(DISTINCT synset) AS synsets, count(*) AS senses FROM (SELECT unnest(regexp_extract_all(p_name, '[a-z]+')) AS lemma, p_partkey AS synset FROM part)")
def synset_stats(spark, sf_dir):
    edges = d.table(spark, sf_dir, "part").select(F.explode(F.regexp_extract_all("p_name", F.lit("([a-z]+)"), 1)).alias("lemma"), F.col("p_partkey").alias("synset"))
    return lx.synset_stats(edges)
