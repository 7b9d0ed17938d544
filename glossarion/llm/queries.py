"""The operators' registered queries: each reads whole tables and derives its digest columns."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from glossarion.llm import circulant_minhash, compact_windows, decision_list, grammar_store, host_reputation, line_runs, packing, phrase_fingerprint, sentencepiece_codec, suffix_dedup
from glossarion.llm._shared import Workspace, table


def tokenizer_file(name: str) -> str:
    """Where the installed vocabulary files are; a parameter of every operator that needs one."""
    import public_tokenizers

    return public_tokenizers.path(name)


def op1_suffix_array_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    out = suffix_dedup.remove_repeats(table(spark, sf_dir, "documents").select("doc_id", "text"))
    return out.select("doc_id", "n_bytes", "n_removed", "n_spans", F.sha2("kept", 256).alias("kept_sha256"))


def op2_circulant_minhash(spark: SparkSession, sf_dir: str) -> DataFrame:
    return circulant_minhash.near_duplicates(table(spark, sf_dir, "documents"), width=3, share=(85, 100), bands=24, rows=5)


def op3_grammar_token_store(spark: SparkSession, sf_dir: str) -> DataFrame:
    store = f"{Workspace(spark, 'op3').path}/tokens"
    grammar_store.write_token_store(table(spark, sf_dir, "documents"), store, tokenizer_file("word_bpe_49k.json"))
    return grammar_store.read_token_store(spark, store).select("doc_id", "start", "n_tokens", F.crc32("ids").alias("ids_crc32"))


def op4_host_reputation(spark: SparkSession, sf_dir: str) -> DataFrame:
    return host_reputation.judge(table(spark, sf_dir, "pages"), table(spark, sf_dir, "labels")).drop("mean", "low")


def op5_compact_windows(spark: SparkSession, sf_dir: str) -> DataFrame:
    return compact_windows.duplicate_passages(table(spark, sf_dir, "documents"))


def op6_phrase_fingerprint(spark: SparkSession, sf_dir: str) -> DataFrame:
    return phrase_fingerprint.fingerprints(table(spark, sf_dir, "documents"))


def op7_vector_bin_packing(spark: SparkSession, sf_dir: str) -> DataFrame:
    pieces = packing.pack(table(spark, sf_dir, "documents"), tokenizer_file("word_bpe_49k.json"))
    return pieces.select("doc_id", "start", "length", F.crc32("ids").alias("ids_crc32"), "doc_tokens", "sequence_id", "offset")


def op8_decision_list(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents").select("doc_id", "text")
    rules = decision_list.fit(docs, table(spark, sf_dir, "labels"))
    return decision_list.judge(docs, rules).select("doc_id", *decision_list.COUNTS, "base_failed", "rule", "kept")


def op9_line_runs(spark: SparkSession, sf_dir: str) -> DataFrame:
    out = line_runs.dedup_lines(table(spark, sf_dir, "documents").select("doc_id", "text"))
    return out.select("doc_id", "n_lines", "n_dropped", F.sha2(F.col("text").cast("binary"), 256).alias("kept_sha256"))


def op10_sentencepiece_codec(spark: SparkSession, sf_dir: str) -> DataFrame:
    path = tokenizer_file("piece_bpe_32k.model")
    both = sentencepiece_codec.decode(sentencepiece_codec.encode(table(spark, sf_dir, "documents"), path), path)
    same = F.coalesce(F.col("text").cast("binary") == F.col("decoded"), F.length("decoded") == 0)
    return both.select("doc_id", "n_tokens", F.crc32("ids").alias("ids_crc32"), "parity", same.alias("round_trip"))


QUERIES = {
    "op1_suffix_array_dedup": op1_suffix_array_dedup,
    "op2_circulant_minhash": op2_circulant_minhash,
    "op3_grammar_token_store": op3_grammar_token_store,
    "op4_host_reputation": op4_host_reputation,
    "op5_compact_windows": op5_compact_windows,
    "op6_phrase_fingerprint": op6_phrase_fingerprint,
    "op7_vector_bin_packing": op7_vector_bin_packing,
    "op8_decision_list": op8_decision_list,
    "op9_line_runs": op9_line_runs,
    "op10_sentencepiece_codec": op10_sentencepiece_codec,
}

_BLANKS = "chr(32) || chr(9) || chr(10) || chr(11) || chr(12) || chr(13)"

ORACLES: dict[str, str] = {
    "op2_circulant_minhash": r"""
WITH RECURSIVE w AS (
  SELECT doc_id, regexp_extract_all(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '[^\x20\x09-\x0D]+') AS ws FROM documents),
sh AS (
  SELECT DISTINCT doc_id, s FROM (
    SELECT doc_id, unnest(CASE WHEN len(ws) >= 3 THEN list_transform(range(1, len(ws) - 1), lambda i: ws[i] || ' ' || ws[i + 1] || ' ' || ws[i + 2])
                               WHEN len(ws) > 0 THEN [array_to_string(ws, ' ')] ELSE [] END) AS s FROM w)),
n AS (SELECT doc_id, count(*) AS n FROM sh GROUP BY doc_id),
common AS (SELECT x.doc_id AS a, y.doc_id AS b, count(*) AS c FROM sh x JOIN sh y ON x.s = y.s AND x.doc_id < y.doc_id GROUP BY 1, 2),
links AS (SELECT a, b FROM common JOIN n na ON na.doc_id = a JOIN n nb ON nb.doc_id = b WHERE 100 * c >= 85 * (na.n + nb.n - c)),
ways AS (SELECT a, b FROM links UNION ALL SELECT b, a FROM links),
reach(v, r) AS (SELECT doc_id, doc_id FROM documents UNION SELECT reach.v, ways.b FROM reach JOIN ways ON reach.r = ways.a),
comp AS (SELECT v, min(r) AS component_id FROM reach GROUP BY v)
SELECT d.doc_id, coalesce(n.n, 0) AS n_shingles, component_id, d.doc_id = component_id AS kept
FROM documents d JOIN comp ON comp.v = d.doc_id LEFT JOIN n ON n.doc_id = d.doc_id
""",
    "op9_line_runs": f"""
WITH lines AS (
  SELECT doc_id, l, i FROM (
    SELECT doc_id, unnest(string_split(coalesce(text, ''), chr(10))) AS l,
           unnest(range(1, len(string_split(coalesce(text, ''), chr(10))) + 1)) AS i FROM documents)),
keyed AS (
  SELECT doc_id, l, i, translate(trim(l, {_BLANKS}), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz') AS k FROM lines),
owners AS (
  SELECT k, min(doc_id) AS owner FROM keyed WHERE length(k) >= 10 GROUP BY k HAVING count(DISTINCT doc_id) > 1),
judged AS (
  SELECT d.doc_id, d.l, d.i, o.owner IS NOT NULL AND o.owner <> d.doc_id AS lost FROM keyed d LEFT JOIN owners o ON d.k = o.k)
SELECT doc_id, count(*) AS n_lines, count(*) FILTER (WHERE lost) AS n_dropped,
       sha256(coalesce(string_agg(l, chr(10) ORDER BY i) FILTER (WHERE NOT lost), '')) AS kept_sha256
FROM judged GROUP BY doc_id
""",
    "op4_host_reputation": """
WITH cut AS (
  SELECT page_id, CASE WHEN instr(url, '://') > 0 THEN substr(url, instr(url, '://') + 3) ELSE '' END AS rest FROM pages),
places AS (
  SELECT page_id, translate(regexp_extract(rest, '^([^/?#]*)', 1), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz') AS host,
         regexp_extract(rest, '^[^/?#]*([^?#]*)', 1) AS path FROM cut),
seen AS (
  SELECT doc_id, max(CASE WHEN coalesce(quality, 1) = 0 OR coalesce(toxic, 0) = 1 THEN 1 ELSE 0 END) AS bad FROM labels WHERE doc_id IS NOT NULL GROUP BY doc_id),
outcomes AS (
  SELECT host, count(bad) AS n, coalesce(sum(bad), 0) AS bad FROM places LEFT JOIN seen ON page_id = doc_id GROUP BY host),
parts AS (SELECT *, string_split(host, '.') AS p FROM outcomes),
two AS (SELECT host, n, bad, p, CASE WHEN len(p) <= 2 THEN host ELSE p[-2] || '.' || p[-1] END AS t FROM parts),
hosts AS (
  SELECT host, n, bad,
         CASE WHEN t IN ('co.uk', 'org.uk', 'ac.uk', 'com.au', 'co.jp', 'com.br') AND len(p) > 2 THEN p[-3] || '.' || t ELSE t END AS domain,
         CASE WHEN t IN ('co.uk', 'org.uk', 'ac.uk', 'com.au', 'co.jp', 'com.br') THEN t ELSE p[-1] END AS suffix FROM two),
d0 AS (SELECT suffix, domain, sum(n) AS n, sum(bad) AS bad FROM hosts GROUP BY suffix, domain),
s0 AS (SELECT suffix, sum(n) AS n, sum(bad) AS bad, (SELECT CASE WHEN sum(n) > 0 THEN (sum(bad) + 0.5e0) / (sum(n) + 1) ELSE 0.5e0 END FROM hosts) AS prior FROM d0 GROUP BY suffix),
ks AS (
  SELECT least(greatest(1e0, least(1000e0, coalesce(n, 0e0))), CASE WHEN n IS NULL OR v <= 0 OR s - (g - 1) * (v / n) <= 0 THEN 1000e0
              ELSE greatest(1e0, (v / n) / ((s - (g - 1) * (v / n)) / greatest(n - nn / n, 1e-9)) - 1) END) AS k
  FROM (SELECT sum(n)::DOUBLE AS n, sum(n * n)::DOUBLE AS nn, count(*) AS g, sum(n * pow(bad::DOUBLE / n - prior, 2)) AS s, sum(n * prior * (1 - prior)) AS v FROM s0 WHERE n > 0)),
s1 AS (SELECT suffix, (bad + (SELECT k FROM ks) * prior) / (n + (SELECT k FROM ks)) AS mean FROM s0),
d1 AS (SELECT d0.*, s1.mean AS prior FROM d0 JOIN s1 USING (suffix)),
kd AS (
  SELECT least(greatest(1e0, least(1000e0, coalesce(n, 0e0))), CASE WHEN n IS NULL OR v <= 0 OR s - (g - 1) * (v / n) <= 0 THEN 1000e0
              ELSE greatest(1e0, (v / n) / ((s - (g - 1) * (v / n)) / greatest(n - nn / n, 1e-9)) - 1) END) AS k
  FROM (SELECT sum(n)::DOUBLE AS n, sum(n * n)::DOUBLE AS nn, count(*) AS g, sum(n * pow(bad::DOUBLE / n - prior, 2)) AS s, sum(n * prior * (1 - prior)) AS v FROM d1 WHERE n > 0)),
d2 AS (SELECT domain, (bad + (SELECT k FROM kd) * prior) / (n + (SELECT k FROM kd)) AS mean FROM d1),
h1 AS (SELECT hosts.*, d2.mean AS prior FROM hosts JOIN d2 USING (domain)),
kh AS (
  SELECT least(greatest(1e0, least(1000e0, coalesce(n, 0e0))), CASE WHEN n IS NULL OR v <= 0 OR s - (g - 1) * (v / n) <= 0 THEN 1000e0
              ELSE greatest(1e0, (v / n) / ((s - (g - 1) * (v / n)) / greatest(n - nn / n, 1e-9)) - 1) END) AS k
  FROM (SELECT sum(n)::DOUBLE AS n, sum(n * n)::DOUBLE AS nn, count(*) AS g, sum(n * pow(bad::DOUBLE / n - prior, 2)) AS s, sum(n * prior * (1 - prior)) AS v FROM h1 WHERE n > 0)),
h2 AS (SELECT host, n, (SELECT k FROM kh) AS k, (bad + (SELECT k FROM kh) * prior) / (n + (SELECT k FROM kh)) AS mean FROM h1),
h3 AS (SELECT host, CASE WHEN mean - 1.645e0 * sqrt(mean * (1 - mean) / (n + k + 1)) > 0.4e0 THEN 'block' ELSE 'allow' END AS own FROM h2),
ruled AS (
  SELECT page_id, places.host, path, own, CASE
    WHEN (places.host = 'example.org' OR places.host LIKE '%.example.org') AND starts_with(path, '/en/1') THEN 'example.org/en/1'
    WHEN (places.host = 'example.org' OR places.host LIKE '%.example.org') AND starts_with(path, '/es/') THEN 'example.org/es/'
    WHEN (places.host = 'com' OR places.host LIKE '%.com') AND starts_with(path, '/fr/') THEN 'com/fr/'
    WHEN (places.host = 'com' OR places.host LIKE '%.com') AND starts_with(path, '/de/') THEN 'com/de/'
    WHEN (places.host = 'org' OR places.host LIKE '%.org') AND starts_with(path, '/') THEN 'org/' END AS rule
  FROM places JOIN h3 ON places.host = h3.host)
SELECT page_id, host, path, rule, CASE WHEN rule IN ('org/', 'com/fr/') THEN 'allow' WHEN rule IS NOT NULL THEN 'block' ELSE own END AS verdict FROM ruled
""",
}
