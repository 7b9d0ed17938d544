"""Report operators: ordinals, duplicates, path and combination statistics, co-labels, differences, enriched entries, file names."""

from __future__ import annotations

import re

from pyspark.sql import Column, DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from glossarion import vocab
from glossarion.functions import lexical


def ordinals(entries: DataFrame, order: str = "ord") -> DataFrame:
    """id, ordinal by first appearance (from 0), first, lines: all places of the word.

    Numbered within ranges of first places; the ranges' totals are summed and joined back.
    """
    per = entries.groupBy("id").agg(F.min(order).alias("first"), F.array_sort(F.collect_list(order)).alias("lines")).withColumn("__r", F.floor(F.col("first") / 10_000))
    totals = per.groupBy("__r").agg(F.count("*").alias("__n"))
    before = totals.withColumn("__b", F.sum("__n").over(W.orderBy("__r").rowsBetween(W.unboundedPreceding, W.currentRow)) - F.col("__n")).drop("__n")
    inner = F.row_number().over(W.partitionBy("__r").orderBy("first")) - 1
    return per.withColumn("__k", inner).join(before, "__r").select("id", (F.col("__b") + F.col("__k")).alias("ordinal"), "first", "lines")


def duplicate_histogram(entries: DataFrame) -> DataFrame:
    """entries_per_word, n words, percentage and cumulative percentage."""
    per = entries.groupBy("id").agg(F.count("*").alias("entries_per_word")).groupBy("entries_per_word").agg(F.count("*").alias("n"))
    total = F.sum("n").over(W.partitionBy())
    running = F.sum("n").over(W.orderBy("entries_per_word").rowsBetween(W.unboundedPreceding, W.currentRow))
    return per.select("entries_per_word", "n", F.round(100.0 * F.col("n") / total, 2).alias("pct"), F.round(100.0 * running / total, 2).alias("cumulative_pct"))


def paths(entries: DataFrame) -> DataFrame:
    """path, value (as text) of every leaf of every row; arrays give a row for each element."""
    def leaves(fields, prefix: str, c: str) -> list[tuple[str, Column]]:
        out = []
        for f in fields:
            name, kind = f"{c}.`{f.name}`" if c else f"`{f.name}`", f.dataType.typeName()
            if kind == "struct":
                out += leaves(f.dataType.fields, f"{prefix}{f.name}.", name)
            elif kind == "array":
                out.append((f"{prefix}{f.name}[]", F.transform(F.col(name), lambda x: x.cast("string"))))
            elif kind != "map":
                out.append((prefix + f.name, F.array(F.col(name).cast("string"))))
        return out

    rows = F.array(*(F.struct(F.lit(p).alias("path"), v.alias("values")) for p, v in leaves(entries.schema.fields, "", "")))
    return entries.select(F.explode(rows).alias("x")).select("x.path", F.explode("x.values").alias("value")).where("value is not null")


def distinct_values(entries: DataFrame) -> DataFrame:
    """path, distinct values and the bits that number them."""
    n = paths(entries).groupBy("path").agg(F.count_distinct("value").alias("n"))
    return n.withColumn("bits", F.when(F.col("n") > 1, F.ceil(F.log2("n"))).otherwise(0).cast("int"))


def array_combinations(entries: DataFrame, column: str) -> DataFrame:
    """Sorted, joined values of an array column and how often each combination occurs."""
    key = F.concat_ws(",", F.array_sort(column)).alias("combination")
    return entries.where(F.size(column) > 0).groupBy(key).agg(F.count("*").alias("n"))


def co_labels(senses: DataFrame, code: str) -> DataFrame:
    """Codes that occur beside ``code``, with their counts."""
    rows = senses.where(F.array_contains("codes", code)).select(F.explode("codes").alias("code"))
    return rows.where(F.col("code") != code).groupBy("code").agg(F.count("*").alias("n"))


def richness(words: DataFrame, n: int = 10, least: int = 5) -> DataFrame:
    """Words with the most kinds of metadata: a point for each source and each known value."""
    points = F.size("sources")
    for c in ("nsyll", "concreteness_rating", "frequency_rank", "spelling_region"):
        if c in words.columns:
            points = points + F.col(c).isNotNull().cast("int")
    return words.select("id", points.alias("richness")).where(F.col("richness") >= least).orderBy(F.desc("richness"), "id").limit(n)


def enrichment_impact(words: DataFrame, base=("wikt", "wordnet", "eowl"), extra=("brysbaert", "frequency")) -> DataFrame:
    """Words by combination of primary sources and enriching source."""
    own = F.array_join(F.filter("sources", lambda s: s.isin(*base)), ",")
    more = F.filter("sources", lambda s: s.isin(*extra))
    return words.select(own.alias("combination"), F.explode(more).alias("enrichment")).groupBy("combination", "enrichment").agg(F.count("*").alias("n"))


def enriched(words: DataFrame, senses: DataFrame) -> DataFrame:
    """Words with their senses, lemmas other than the word, and defaults for tier and sources."""
    own = F.when(F.col("lemma") != F.col("id"), F.col("lemma"))
    per = senses.groupBy("id").agg(
        F.array_sort(F.collect_set("pos")).alias("pos"), F.array_sort(F.collect_set(own)).alias("lemmas"),
        F.transform(F.array_sort(F.collect_list(F.struct("sense_ord", "pos", own.alias("lemma")))), lambda x: F.struct(x["pos"].alias("pos"), x["lemma"].alias("lemma"))).alias("senses"),
    )
    return words.select("id", F.coalesce("frequency_tier", F.lit("Z")).alias("frequency_tier"), F.coalesce("sources", F.array().cast("array<string>")).alias("sources")).join(per, "id", "left")


def entry_diff(left: DataFrame, right: DataFrame, key: str = "id") -> DataFrame:
    """key, column for each value that differs between two tables, arrays compared as sets of elements in order."""
    kinds = dict(left.dtypes)
    norm = lambda t, c: F.array_sort(F.col(f"{t}.{c}")) if kinds[c].startswith("array") else F.col(f"{t}.{c}")
    cols = [c for c in left.columns if c != key and c in right.columns]
    both = left.alias("l").join(right.alias("r"), key)
    differ = F.array_compact(F.array(*(F.when(~norm("l", c).eqNullSafe(norm("r", c)), F.lit(c)) for c in cols)))
    return both.select(key, F.explode(differ).alias("column"))


def route_label(label: Column) -> Column:
    """register, temporal, domain or region: the first of them that knows the label."""
    names = lambda t: [n.lower() for n in t.values()]
    low = F.lower(label)
    return (
        F.when(low.isin(*names(vocab.REGISTER)), "register").when(low.isin(*names(vocab.TEMPORAL)), "temporal")
        .when(low.isin(*names(vocab.DOMAINS), *vocab.DOMAIN_OF_LABEL), "domain").when(low.isin(*names(vocab.REGION), *[k for k, v in vocab.LABEL_CODES.items() if v.startswith("EN")]), "region")
    )


def recommendations(counts: dict[str, int]) -> list[str]:
    """Advice from report totals."""
    out = []
    if counts.get("labelled", 0) > 100:
        out.append("labels suffice for filtering")
    if counts.get("unclassified_nouns", 0) > 1000:
        out.append("many nouns have no concreteness")
    return out


def available_filters(requires: dict[str, list[str]], selected: list[str]) -> list[str]:
    """Filters of which any required source is selected, and those that need none."""
    return [f for f, need in requires.items() if not need or set(need) & set(selected)]


def template_census(pages: DataFrame, text: str = "text") -> DataFrame:
    """How often each template name occurs, and its kind."""
    name = F.lower(F.trim(F.explode(F.regexp_extract_all(text, F.lit(r"\{\{([^{}|]+)"), 1))))
    kind = F.lit("other")
    for code, names in vocab.FLAG_TEMPLATES.items():
        kind = F.when(F.col("name").isin(*names), vocab.FLAGS[code]).otherwise(kind)
    kind = F.when(F.col("name").isin(*vocab.MORPH_TEMPLATES), "morphology").otherwise(kind)
    return pages.select(name.alias("name")).groupBy("name").agg(F.count("*").alias("n")).withColumn("kind", kind)


def cache_coverage(cache: DataFrame) -> DataFrame:
    """Cached keys with a label, with a description, with neither."""
    return cache.agg(F.count("*").alias("n"), F.count("label").alias("labelled"), F.count("description").alias("described"), F.count_if(F.col("label").isNull() & F.col("description").isNull()).alias("empty"))


def file_name(word: str) -> str:
    """A reversible file name, safe where case does not count: IDNA for other letters, upper-case places in octal."""
    bits = "".join("1" if c.isupper() else "0" for c in word)
    low = word.lower()
    safe = "".join(c if c.isascii() and (c.isalnum() or c == "-") else f"_{ord(c):x}." for c in low)
    return safe + (f"+{int(bits[::-1], 2):o}" if "1" in bits else "")


def word_of(name: str) -> str:
    """Inverse of ``file_name`` for words whose lower case has as many characters."""
    safe, _, octal = name.partition("+")
    low = re.sub(r"_([0-9a-f]+)\.", lambda m: chr(int(m[1], 16)), safe)
    mask = int(octal, 8) if octal else 0
    return "".join(c.upper() if mask >> i & 1 else c for i, c in enumerate(low))


def interpolate(template: str, **values: str) -> str:
    """``{name}`` replaced where known; other braces stay."""
    return re.sub(r"\{(\w+)\}", lambda m: str(values.get(m[1], m[0])), template)


def sense_summary(words: DataFrame, senses: DataFrame) -> DataFrame:
    """Words, words without a sense, senses, and senses a word on average."""
    per = senses.groupBy("id").agg(F.count("*").alias("k"))
    both = words.select("id").join(per, "id", "left")
    total = both.agg(F.count("*").alias("n_words"), F.count_if(F.col("k").isNull()).alias("senseless"), F.coalesce(F.sum("k"), F.lit(0)).alias("n_senses"))
    return total.withColumn("average", F.round(F.try_divide("n_senses", "n_words"), 4))


def multi_pos(senses: DataFrame) -> DataFrame:
    """Words of several parts of speech, and of how many."""
    return senses.groupBy("id").agg(F.count_distinct("pos").alias("n_pos")).where("n_pos > 1")


def regional(senses: DataFrame) -> DataFrame:
    """Region codes and the words that have them."""
    codes = senses.select("id", F.explode(lexical.categorize_codes(F.col("codes"))["region"]).alias("code"))
    return codes.groupBy("code").agg(F.count_distinct("id").alias("n"))


def missing_codes(senses: DataFrame, column: str, expected: list[str]) -> DataFrame:
    """Expected codes that no row has."""
    want = senses.sparkSession.createDataFrame([(c,) for c in expected], "code string")
    return want.join(senses.select(F.col(column).alias("code")).distinct(), "code", "left_anti")


def selection_coverage(words: DataFrame, selected: list[str]) -> DataFrame:
    """Of words from any selected source: how many, and the percentage with each kind of metadata."""
    some = words.where(F.arrays_overlap("sources", F.array(*map(F.lit, selected))))
    share = lambda c, name: F.round(100.0 * F.count(c) / F.count("*"), 2).alias(name)
    return some.agg(F.count("*").alias("n_words"), share("nsyll", "syllables"), share("concreteness_rating", "concreteness"), share("frequency_rank", "frequency"), share("spelling_region", "region"))


def labelled(senses: DataFrame, codes: list[str]) -> DataFrame:
    """Words that carry any of the codes."""
    return senses.where(F.arrays_overlap("codes", F.array(*map(F.lit, codes)))).select("id").distinct()


def single_words(words: DataFrame) -> DataFrame:
    """Normalised words of one word; longer phrases are left out."""
    return words.where("wc <= 1").select(lexical.normalize_word(F.col("id")).alias("id")).distinct()
