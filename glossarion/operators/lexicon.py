"""Normalising, merging, enriching and summarising lexicon tables."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from glossarion import vocab
from glossarion.functions import lexical
from glossarion.sources.sinks import kept

PROJECTION = ("pos", "register_tags", "temporal_tags", "domain_tags", "region_tags", "is_abbreviation", "is_inflected", "lemma", "codes")


# --- senses and lexemes ------------------------------------------------------


def projection(df: DataFrame, codes_aware: bool = True) -> Column:
    """What makes two senses of a word equal."""
    names = [c for c in PROJECTION if c in df.columns and (codes_aware or c != "codes")]
    return F.struct(*(F.array_sort(F.coalesce(F.col(c), F.array().cast("array<string>"))).alias(c) if dict(df.dtypes)[c].startswith("array") else F.col(c) for c in names))


def unique_senses(senses: DataFrame, codes_aware: bool = True) -> DataFrame:
    """First of equal senses of a word, in document order."""
    w = W.partitionBy("id", "__p").orderBy("sense_ord")
    return senses.withColumn("__p", projection(senses, codes_aware)).withColumn("__n", F.row_number().over(w)).where("__n = 1").drop("__p", "__n")


def lexemes_of(senses: DataFrame, codes_aware: bool = True) -> DataFrame:
    """One row a word: first values in order, counts of senses, offset and length in the table of unique senses sorted by word."""
    first = lambda c: F.min_by(c, F.when(F.col(c).isNotNull(), F.col("sense_ord"))).alias(c)
    have = [c for c in ("nsyll", "morphology", "phrase_type", "spelling_region") if c in senses.columns]
    agg = senses.withColumn("__p", projection(senses, codes_aware)).groupBy("id").agg(
        F.min_by("wc", "sense_ord").alias("wc") if "wc" in senses.columns else F.first(lexical.word_count(F.col("id"))).alias("wc"),
        *(first(c) for c in have), F.count("*").alias("sense_count"), F.count_distinct("__p").alias("sense_length"),
    )
    return with_offsets(agg)


def with_offsets(words: DataFrame) -> DataFrame:
    """sense_offset: senses of all words before, by word.

    A running sum over all words, without one task for all: words are cut into ranges
    by their first characters, each range sums for itself, and the ranges' totals, one
    row each, are summed and joined back. ``words`` is read twice, so it is written first.
    """
    ranged = kept(words).withColumn("__range", F.substring("id", 1, 2))
    totals = ranged.groupBy("__range").agg(F.sum("sense_length").alias("__t"))
    before = totals.withColumn("__before", F.sum("__t").over(W.orderBy("__range").rowsBetween(W.unboundedPreceding, W.currentRow)) - F.col("__t")).drop("__t")
    inner = F.sum("sense_length").over(W.partitionBy("__range").orderBy("id").rowsBetween(W.unboundedPreceding, W.currentRow)) - F.col("sense_length")
    return ranged.withColumn("__inner", inner).join(before, "__range").withColumn("sense_offset", F.col("__before") + F.col("__inner")).drop("__range", "__inner", "__before")


# --- merging -----------------------------------------------------------------


def license_map(sources: Column) -> Column:
    """License -> sorted sources; a source of unknown license is in none."""
    def under(name: str) -> Column:
        members = [k for k, v in vocab.LICENSES.items() if v == name]
        return F.array_sort(F.filter(sources, lambda s: s.isin(*members)))

    names = sorted(set(vocab.LICENSES.values()))
    entries = [F.struct(F.lit(n).alias("key"), under(n).alias("value")) for n in names]
    return F.map_from_entries(F.filter(F.array(*entries), lambda e: F.size(e["value"]) > 0))


def merge_sources(base: DataFrame, others: dict[str, DataFrame]) -> DataFrame:
    """``base`` (id, sources, …) with further word lists by normalised key.

    A key of the base reaches all its case variants; keys that the base lacks become new
    words. The license map follows the sources.
    """
    lists = None
    for name, df in others.items():
        one = df.select("id", F.lit(name).alias("__s"))
        lists = one if lists is None else lists.unionByName(one)
    # each word is normalised once, after it is grouped; a condition on the key before the join would be tested on every place of the texts
    once = lists.groupBy("id").agg(F.collect_set("__s").alias("__s")).select(lexical.normalize_word(F.col("id")).alias("__k"), F.explode("__s").alias("__s"))
    per = once.groupBy("__k").agg(F.array_sort(F.collect_set("__s")).alias("__more"))
    none = F.array().cast("array<string>")
    both = base.withColumn("__k", lexical.normalize_word(F.col("id"))).withColumn("__base", F.lit(True)).join(per, "__k", "full")
    old, more = F.col("__base").isNotNull(), F.when(F.col("__k") != "", F.col("__more"))
    both = both.where(old | (F.coalesce("__k", F.lit("")) != ""))
    merged = {
        "id": F.when(old, F.col("id")).otherwise(F.col("__k")),
        "sources": F.when(old, F.array_sort(F.array_union("sources", F.coalesce(more, none)))).otherwise(more),
        "wc": F.when(~old, lexical.word_count(F.col("__k"))) if "wc" not in base.columns else F.when(old, F.col("wc")).otherwise(lexical.word_count(F.col("__k"))),
    }
    return both.withColumns(merged).drop("__k", "__more", "__base").withColumn("license_sources", license_map(F.col("sources")))


def merge_partition(words: DataFrame, names=("wikt", "wordnet", "eowl")) -> DataFrame:
    """One row: words in each of the seven cells of membership in three sources."""
    a, b, c = (F.array_contains("sources", n) for n in names)
    cells = {f"{names[0]}_only": a & ~b & ~c, f"{names[1]}_only": ~a & b & ~c, f"{names[2]}_only": ~a & ~b & c, f"{names[0]}_{names[1]}": a & b & ~c, f"{names[0]}_{names[2]}": a & ~b & c, f"{names[1]}_{names[2]}": ~a & b & c, "all_three": a & b & c}
    return words.agg(F.count("*").alias("total"), *(F.count_if(v).alias(k) for k, v in cells.items()))


# --- enrichment --------------------------------------------------------------


def add_frequency(words: DataFrame, ranks: DataFrame) -> DataFrame:
    """frequency_rank and frequency_tier by lower-case word. A word in other case gets the rank only if its lower-case form is no word."""
    keyed = words.withColumn("__k", F.lower("id"))
    lows = words.where(lexical.is_lower_word(F.col("id"))).select(F.col("id").alias("__k")).distinct().withColumn("__low", F.lit(True))
    r = ranks.select(F.col("word").alias("__k"), F.col("rank").alias("frequency_rank"))
    out = keyed.join(r, "__k", "left").join(lows, "__k", "left")
    own = F.when((F.col("id") == F.col("__k")) | F.col("__low").isNull(), F.col("frequency_rank"))
    return out.withColumn("frequency_rank", own).withColumn("frequency_tier", lexical.rank_to_tier(F.col("frequency_rank"))).drop("__k", "__low")


def add_concreteness(words: DataFrame, ratings: DataFrame, prefer: bool = True) -> DataFrame:
    """concreteness, its rating and deviation by lower-case word; ``prefer``: over values already there, else only where none is."""
    r = ratings.select(F.col("word").alias("__k"), F.round("mean", 2).alias("__m"), F.round("sd", 2).alias("__s"))
    out = words.withColumn("__k", F.lower("id")).join(r, "__k", "left")
    for name, new in (("concreteness_rating", F.col("__m")), ("concreteness_sd", F.col("__s")), ("concreteness", lexical.concreteness_category(F.col("__m")))):
        old = F.col(name) if name in words.columns else F.lit(None)
        out = out.withColumn(name, F.coalesce(new, old) if prefer else F.coalesce(old, new))
    return out.drop("__k", "__m", "__s")


def add_aoa(words: DataFrame, ratings: DataFrame, least_known: float = 0.5) -> DataFrame:
    """aoa and aoa_grade; ratings known to fewer than ``least_known`` are left out before the join."""
    r = ratings.where(F.coalesce("known", F.lit(0.0)) >= least_known).select(F.col("word").alias("__k"), F.round("mean", 2).alias("aoa"))
    return words.withColumn("__k", F.lower("id")).join(r, "__k", "left").withColumn("aoa_grade", lexical.aoa_grade(F.col("aoa"))).drop("__k")


# --- statistics --------------------------------------------------------------

MEASURES = {
    "n_syllables": "nsyll is not null",
    "n_concreteness": "concreteness_rating is not null",
    "n_ranked": "frequency_rank is not null",
    "n_multiword": "wc > 1",
    "n_any": "nsyll is not null or concreteness_rating is not null or frequency_rank is not null",
}


def coverage(words: DataFrame, measures=MEASURES) -> DataFrame:
    """The same measures for all words, each source and each combination, in one pass over the words.

    A word counts once in its combination and in the total, and once for each source.
    """
    rows = words.withColumn("combination", F.array_join(F.array_sort("sources"), ",")).withColumn("source", F.explode(F.array_union(F.array(F.lit(None).cast("string")), F.col("sources"))))
    flags = rows.select("combination", "source", *(F.expr(f"case when {e} then 1 else 0 end").alias(k) for k, e in measures.items()))
    own = flags.groupBy("combination", "source").agg(F.count("*").alias("n_words"), *(F.sum(k).alias(k) for k in measures))
    by_source, total = own.where("source is not null").groupBy("source"), own.where("source is null")
    sums = [F.sum("n_words").alias("n_words"), *(F.sum(k).alias(k) for k in measures)]
    parts = [
        total.groupBy(F.lit("all").alias("grain"), F.lit("").alias("key")).agg(*sums),
        total.groupBy(F.lit("combination").alias("grain"), F.col("combination").alias("key")).agg(*sums),
        by_source.agg(*sums).select(F.lit("source").alias("grain"), F.col("source").alias("key"), "n_words", *measures),
    ]
    return parts[0].unionByName(parts[1]).unionByName(parts[2])


def top_per_group(counts: DataFrame, group: str, value: str, n: int) -> DataFrame:
    """The ``n`` largest of each group; of equal counts the less value first."""
    w = W.partitionBy(group).orderBy(F.desc("n"), value)
    return counts.withColumn("place", F.row_number().over(w)).where(F.col("place") <= n)


def cumulative(counts: DataFrame, key: str, share: float = 0.8) -> DataFrame:
    """Running share of ``n`` by descending count and the keys needed to reach ``share``."""
    w = W.orderBy(F.desc("n"), key).rowsBetween(W.unboundedPreceding, W.currentRow)
    total = F.sum("n").over(W.partitionBy())
    return counts.withColumn("running", F.sum("n").over(w)).withColumn("needed", F.col("running") - F.col("n") < share * total)


def union_estimate(combinations: DataFrame, selected: list[str]) -> DataFrame:
    """Words in any selected source from disjoint combination counts."""
    hit = F.arrays_overlap(F.split("combination", ","), F.array(*map(F.lit, selected)))
    return combinations.where(hit).agg(F.coalesce(F.sum("n_words"), F.lit(0)).alias("n_words"))


def resulting_license(combinations: DataFrame, selected: list[str]) -> DataFrame:
    """The strictest license of all combinations that meet the selection: share-alike, then wordnet, then the word list."""
    parts = F.split("combination", ",")
    hit = combinations.where(F.arrays_overlap(parts, F.array(*map(F.lit, selected))))
    has = hit.agg(*(F.coalesce(F.bool_or(F.array_contains(parts, s)), F.lit(False)).alias(s) for s in ("wikt", "wordnet", "eowl")))
    return has.select(F.when(F.col("wikt"), vocab.LICENSES["wikt"]).when(F.col("wordnet"), vocab.LICENSES["wordnet"]).when(F.col("eowl"), vocab.LICENSES["eowl"]).otherwise("none").alias("license"))


def int_ranges(df: DataFrame, value: str, group: str) -> DataFrame:
    """Consecutive integers of each group as ``a-b`` ranges, joined."""
    w = W.partitionBy(group).orderBy(value)
    islands = df.select(group, value).distinct().withColumn("__i", F.col(value) - F.row_number().over(w))
    runs = islands.groupBy(group, "__i").agg(F.min(value).alias("a"), F.max(value).alias("b"))
    text = F.when(F.col("a") == F.col("b"), F.col("a").cast("string")).otherwise(F.concat_ws("-", "a", "b"))
    return runs.groupBy(group).agg(F.array_join(F.transform(F.array_sort(F.collect_list(F.struct("a", text.alias("t")))), lambda x: x["t"]), ",").alias("ranges"))


# --- lemmas, synsets ---------------------------------------------------------


def lemma_map(senses: DataFrame) -> DataFrame:
    """id, lemmas (other than the word, sorted), primary (the least)."""
    out = senses.where((F.col("lemma").isNotNull()) & (F.col("lemma") != F.col("id"))).groupBy("id").agg(F.array_sort(F.collect_set("lemma")).alias("lemmas"))
    return out.withColumn("primary", F.array_min("lemmas"))


def lemma_groups(senses: DataFrame) -> DataFrame:
    """lemma, forms: the base first, then its forms sorted."""
    forms = senses.where((F.col("lemma").isNotNull()) & (F.col("lemma") != F.col("id"))).groupBy("lemma").agg(F.collect_set("id").alias("f"))
    return forms.select("lemma", F.concat(F.array("lemma"), F.array_sort(F.array_remove("f", F.col("lemma")))).alias("forms"))


def lexnames(edges: DataFrame, names: DataFrame) -> DataFrame:
    """Word -> sorted set of its synsets' categories; edges(lemma, pos, synset), names(synset, lexname)."""
    return edges.join(names, "synset").groupBy(lexical.nfkc_lower(F.col("lemma")).alias("id")).agg(F.array_sort(F.collect_set("lexname")).alias("lexnames"))


def synset_stats(edges: DataFrame) -> DataFrame:
    return edges.agg(F.count_distinct("lemma").alias("words"), F.count_distinct("synset").alias("synsets"), F.count("*").alias("senses"))


# --- audits ------------------------------------------------------------------


def coverage_of(lexicon: DataFrame, external: DataFrame) -> DataFrame:
    """Each external word and whether the lexicon has it."""
    have = lexicon.select(F.col("id")).distinct().withColumn("found", F.lit(True))
    return external.select("id").distinct().join(have, "id", "left").withColumn("found", F.coalesce("found", F.lit(False)))


def missing_plurals(lexicon: DataFrame, missing: DataFrame) -> DataFrame:
    """Missing words whose singular the lexicon has, with the first candidate found."""
    cand = missing.select("id", F.posexplode(lexical.plural_bases(F.col("id"))).alias("k", "base")).where("base <> ''")
    return cand.join(lexicon.select(F.col("id").alias("base")).distinct(), "base", "left_semi").groupBy("id").agg(F.min_by("base", "k").alias("base"))


def gaps(external: DataFrame, lexicon: DataFrame, labelled: Column) -> DataFrame:
    """Full outer comparison of an external list with labelled words: unlabelled, absent, only_ours or agreed."""
    ours = lexicon.select("id", F.coalesce(labelled, F.lit(False)).alias("l")).groupBy("id").agg(F.bool_or("l").alias("l"))
    both = external.select("id").distinct().withColumn("e", F.lit(True)).join(ours, "id", "full")
    state = F.when(F.col("e") & F.col("l"), "agreed").when(F.col("e") & F.col("l").isNull(), "absent").when(F.col("e"), "unlabelled").when(F.col("l"), "only_ours")
    return both.select("id", state.alias("state")).where("state is not null")


def unmatched_ranks(ranks: DataFrame, words: DataFrame, n: int = 20) -> DataFrame:
    """Most frequent listed words that no lexeme matches, with the reason."""
    keys = words.select(F.lower("id").alias("word")).distinct()
    out = ranks.join(keys, "word", "left_anti")
    fragment = F.col("word").startswith("'") | F.col("word").endswith("'")
    return out.withColumn("reason", F.when(fragment, "fragment").otherwise("not a word")).orderBy("rank").limit(n)


def parity(left: DataFrame, right: DataFrame) -> DataFrame:
    """Rows of one side only, as a multiset: side and the row's columns."""
    cols = left.columns
    return left.exceptAll(right.select(cols)).withColumn("side", F.lit("left")).unionByName(right.select(cols).exceptAll(left).withColumn("side", F.lit("right")))


def checksum(df: DataFrame) -> DataFrame:
    """Row count and an order-independent sum of row hashes."""
    return df.agg(F.count("*").alias("n"), F.sum(F.conv(F.substring(F.md5(F.concat_ws("\t", *df.columns)), 1, 8), 16, 10).cast("decimal(38,0)")).alias("checksum"))


def sample_by_combination(words: DataFrame, combos: int = 8, each: int = 3, seed: int = 0) -> DataFrame:
    """A few words, by seeded hash, of the largest source combinations."""
    keyed = words.withColumn("combination", F.array_join(F.array_sort("sources"), ","))
    top = keyed.groupBy("combination").count().orderBy(F.desc("count"), "combination").limit(combos).select("combination")
    w = W.partitionBy("combination").orderBy(F.md5(F.concat(F.lit(f"{seed}:"), "id")), "id")
    return keyed.join(F.broadcast(top), "combination").withColumn("place", F.row_number().over(w)).where(F.col("place") <= each).select("combination", "place", "id")


def missing_keys(wanted: DataFrame, cache: DataFrame, key: str, batch: int = 500) -> DataFrame:
    """Keys the cache lacks, numbered into batches in the order of their digits."""
    miss = wanted.select(key).distinct().join(cache.select(key).distinct(), key, "left_anti").withColumn("__n", F.regexp_extract(key, r"(\d+)", 1).cast("long"))
    # numbered within ranges of numbers, whose totals are summed and joined back
    miss = miss.withColumn("__r", F.floor(F.col("__n") / 100_000))
    totals = miss.groupBy("__r").agg(F.count("*").alias("__c"))
    before = totals.withColumn("__b", F.sum("__c").over(W.orderBy("__r").rowsBetween(W.unboundedPreceding, W.currentRow)) - F.col("__c")).drop("__c")
    place = F.col("__b") + F.row_number().over(W.partitionBy("__r").orderBy("__n", key)) - 1
    return miss.join(before, "__r").withColumn("batch", F.floor(place / batch)).drop("__n", "__r", "__b")
