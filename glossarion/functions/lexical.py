"""Scalar functions on words, as Columns; Python only where Spark has no builtin."""

from __future__ import annotations

import unicodedata

import pandas as pd
from pyspark.sql import Column
from pyspark.sql import functions as F
from pyspark.sql.types import StringType

from glossarion import vocab

ASCII = r"^[\x00-\x7F]*$"


@F.pandas_udf(StringType())
def _nfkc(s: pd.Series) -> pd.Series:
    return s.map(lambda x: None if x is None else unicodedata.normalize("NFKC", x))


@F.pandas_udf(StringType())
def _plain(s: pd.Series) -> pd.Series:
    def one(x):
        return None if x is None else unicodedata.normalize("NFC", "".join(c for c in unicodedata.normalize("NFD", x) if not unicodedata.combining(c)))

    return s.map(one)


def normalize_word(c: Column) -> Column:
    """Lower case, stripped, NFKC."""
    low = F.trim(F.lower(c))
    return F.when(low.rlike(ASCII), low).otherwise(_nfkc(low))


def nfkc_lower(c: Column) -> Column:
    """NFKC, then lower case."""
    return F.when(c.rlike(ASCII), F.lower(c)).otherwise(F.lower(_nfkc(c)))


def strip_accents(c: Column) -> Column:
    return F.when(c.rlike(ASCII), c).otherwise(_plain(c))


def is_lower_word(c: Column) -> Column:
    """A cased character and none in upper or title case."""
    return c.rlike(r"\p{IsLowercase}") & ~c.rlike(r"[\p{IsUppercase}\p{Lt}]")


def word_count(c: Column) -> Column:
    return F.when(F.trim(c) == "", 0).otherwise(F.size(F.split(F.trim(c), r"\s+")))


def rank_to_tier(rank: Column) -> Column:
    out = F.when(rank.isNull(), "Z")
    for tier, least in reversed(vocab.TIER_FROM.items()):
        out = out.when(rank >= least, tier)
    return out.otherwise("Z")


def tier_to_range(tier: Column) -> Column:
    """struct(low, high); Z has nulls, Y no high; another value raises."""
    bad = F.raise_error(F.concat(F.lit("no such tier: "), tier)).cast("struct<low:int,high:int>")
    out = None
    for t in vocab.TIERS:
        low, high = vocab.tier_range(t)
        value = F.struct(F.lit(low).cast("int").alias("low"), F.lit(high).cast("int").alias("high"))
        out = F.when(tier == t, value) if out is None else out.when(tier == t, value)
    return out.otherwise(bad)


def tier_score(tier: Column) -> Column:
    """100 for A, four less for each further tier, 0 for Z or none."""
    return F.when(F.coalesce(tier, F.lit("Z")).rlike("^[A-Z]$"), 100 - 4 * (F.ascii(F.coalesce(tier, F.lit("Z"))) - 65)).otherwise(0)


def concreteness_category(rating: Column) -> Column:
    return F.when(rating.isNull(), None).when(rating >= 3.5, "concrete").when(rating >= 2.5, "mixed").otherwise("abstract")


def aoa_grade(age: Column) -> Column:
    return F.when(age.isNull(), None).when(age < 5, "pre-k").when(age < 8, "k-2").when(age < 11, "3-5").when(age < 14, "6-8").when(age < 18, "9-12").otherwise("adult")


def case_class(c: Column) -> Column:
    return (
        F.when(c == F.lower(c), "lower")
        .when(c == F.upper(c), "upper")
        .when((F.substring(c, 1, 1) == F.upper(F.substring(c, 1, 1))) & (F.substring(c, 2, 1 << 20) == F.lower(F.substring(c, 2, 1 << 20))), "title")
        .otherwise("mixed")
    )


def plural_bases(c: Column) -> Column:
    """Singular candidates in order: -s, -es, -ies to -y."""
    n = F.length(c)
    return F.array_compact(
        F.array(
            F.when(c.endswith("s"), F.substr(c, F.lit(1), n - 1)),
            F.when(c.endswith("es"), F.substr(c, F.lit(1), n - 2)),
            F.when(c.endswith("ies"), F.concat(F.substr(c, F.lit(1), n - 3), F.lit("y"))),
        )
    )


def categorize_codes(codes: Column) -> Column:
    """struct of register, temporal, domain and region codes."""
    kind = {"register": "^R...$", "temporal": "^T...$", "domain": "^D....$", "region": "^EN..$"}

    def matching(pattern: str) -> Column:
        return F.filter(codes, lambda x: x.rlike(pattern))

    return F.struct(*(matching(p).alias(k) for k, p in kind.items()))


def score(word: Column, tier: Column, concreteness: Column, domains: Column) -> Column:
    n = F.length(word)
    base = F.when(tier.isNull(), 0).otherwise(tier_score(tier))
    jargon = F.arrays_overlap(F.coalesce(domains, F.array().cast("array<string>")), F.array(*map(F.lit, vocab.JARGON)))
    return (
        base
        + F.when(concreteness == "concrete", 20).otherwise(0)
        - F.when(n > 12, 10).otherwise(0)
        - F.when(n > 15, 10).otherwise(0)
        - F.when(jargon, 30).otherwise(0)
    )


def add_source(sources: Column, licenses: Column, source: str) -> tuple[Column, Column]:
    """Sorted sources with one more, and the license map with it; an unknown license changes no map."""
    more = F.array_sort(F.array_union(sources, F.array(F.lit(source))))
    name = vocab.LICENSES.get(source)
    if name is None:
        return more, licenses
    both = F.map_zip_with(licenses, F.create_map(F.lit(name), F.array(F.lit(source))), lambda _, a, b: F.array_sort(F.array_union(F.coalesce(a, F.array().cast("array<string>")), F.coalesce(b, F.array().cast("array<string>")))))
    return more, both


def clean_lemma(c: Column) -> Column:
    """Links and templates removed, cut at #, namespace stripped, trimmed, lower case."""
    c = F.regexp_replace(c, r"\[\[(?:[^\]|]*\|)?([^\]]*)\]\]", "$1")
    c = F.regexp_replace(c, r"\{\{[^{}]*\}\}", "")
    c = F.regexp_replace(c, r"#.*$", "")
    c = F.regexp_replace(c, r"^:?[A-Za-z]+:", "")
    return F.lower(F.trim(c))


IPA = r"/([^/]+)/|\[([^\]]+)\]"
_VOWEL, _GLIDE, _MARK = "aeiouyæɑɒɔəɚɛɜɝɪʊʌøœɐɨʉɵɤɯʏɞɘɶ", "ɪʊəiujw", "ːˑ̯̃"


def ipa_syllables(c: Column) -> Column:
    """Vowel nuclei of the first transcription; a glide after a vowel joins it, a syllabic mark counts; null if 0 or over 15."""
    body = F.coalesce(F.nullif(F.regexp_extract(c, IPA, 1), F.lit("")), F.nullif(F.regexp_extract(c, IPA, 2), F.lit("")))
    n = F.regexp_count(body, F.lit(f".̩|[{_VOWEL}][{_MARK}]*(?:[{_GLIDE}][{_MARK}]*)?"))
    return F.when((n > 0) & (n <= 15), n)


def syllables(ipa: Column, hyphenation: Column, category: Column, rhymes: Column) -> Column:
    """By priority: transcription, hyphenation parts (one part of over three characters does not count), category, rhymes."""
    parts = F.filter(hyphenation, lambda x: (x != "") & ~x.contains("="))
    n = F.size(parts)
    hyph = F.when((n > 1) | ((n == 1) & (F.length(F.get(parts, F.lit(0))) <= 3)), n)
    return F.coalesce(ipa_syllables(ipa), hyph, category, rhymes)


def is_englishlike(c: Column) -> Column:
    """Latin letters up to U+024F, no markup signs, combining marks or unusual spaces, at least one letter."""
    c = F.when(c.rlike(ASCII), c).otherwise(_nfc(c))
    return ~c.rlike(r"[&;<>̀-ͯ\t\n  -‏ 　]") & c.rlike(r"[A-Za-zÀ-ɏ]") & ~c.rlike(r"[\p{L}&&[^A-Za-zÀ-ɏ]]") & ~c.rlike(r"[^\x{0}-\x{FFFF}]")


@F.pandas_udf(StringType())
def _nfc(s: pd.Series) -> pd.Series:
    return s.map(lambda x: None if x is None else unicodedata.normalize("NFC", x))


def is_qid(c: Column) -> Column:
    return c.rlike(r"^Q\d+$")
