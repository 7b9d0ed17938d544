"""Predicates on senses and words as Columns, and the two-table filter with its quantifiers."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from glossarion import vocab

Predicate = Callable[[], Column]


def strings(values) -> Column:
    return F.array(*map(F.lit, values)).cast("array<string>") if values else F.array().cast("array<string>")


def overlaps(c: Column, values) -> Column:
    """Any element in values; a null array or element is in none."""
    return F.coalesce(F.arrays_overlap(c, strings(values)), F.lit(False)) if values else F.lit(False)


def _codes_or_names(codes, names) -> Column:
    """v2 codes decide where a sense has any, else v1 names."""
    c = F.coalesce(F.col("codes"), F.array().cast("array<string>"))
    v1 = F.concat(*(F.coalesce(F.col(x), F.array().cast("array<string>")) for x in ("register_tags", "temporal_tags")))
    return F.when(F.size(c) > 0, overlaps(c, codes)).otherwise(overlaps(v1, names))


def is_profane() -> Column:
    return _codes_or_names(vocab.PROFANE_CODES, vocab.PROFANE_NAMES)


def is_modern() -> Column:
    return ~_codes_or_names((*vocab.DATED_CODES, "THIS"), (*vocab.DATED_NAMES, "historical"))


def is_child_safe() -> Column:
    return ~is_profane() & is_modern()


def matches_pos(*codes: str) -> Column:
    return F.col("pos").isin(*codes)


def matches_region(*codes: str) -> Column:
    """A sense without a region passes, and an empty preference passes all."""
    own = F.filter(F.coalesce(F.col("codes"), F.array().cast("array<string>")), lambda x: x.rlike("^EN..$"))
    return (F.size(own) == 0) | overlaps(own, codes) if codes else F.lit(True)


def has_code(code: str) -> Column:
    return F.coalesce(F.array_contains("codes", code), F.lit(False))


def is_inflected() -> Column:
    return has_code("INFL")


def is_abbreviation() -> Column:
    return has_code("ABRV")


def is_base_form() -> Column:
    return ~is_inflected() & F.col("lemma").isNull()


def has_lemma(target: str | None = None) -> Column:
    return F.col("lemma").isNotNull() if target is None else F.coalesce(F.col("lemma") == target, F.lit(False))


def is_proper_noun() -> Column:
    return F.coalesce(F.col("pos").isin("NAM", "proper"), F.lit(False))


def is_contraction_fragment(word: str = "id") -> Column:
    return F.col(word).startswith("'") | F.col(word).endswith("'")


def is_valid_contraction(word: str = "id") -> Column:
    return F.col(word).contains("'") & ~is_contraction_fragment(word)


def pos_is(*codes: str) -> Predicate:
    return lambda: matches_pos(*codes)


def tier_between(common: str = "A", rare: str = "Z") -> Predicate:
    return lambda: F.coalesce(F.col("frequency_tier"), F.lit("Z")).between(common, rare)


def word_form(word: str = "id") -> Predicate:
    return lambda: ~is_contraction_fragment(word) & F.col(word).rlike(r"^\p{L}+$")


def concreteness_is(categories=None, low: float | None = None, high: float | None = None) -> Predicate:
    """Bounds count only where there is a rating."""

    def build() -> Column:
        rating, out = F.col("concreteness_rating"), F.lit(True)
        if categories:
            out = out & F.coalesce(F.col("concreteness").isin(*categories), F.lit(False))
        if low is not None:
            out = out & (rating.isNull() | (rating >= low))
        if high is not None:
            out = out & (rating.isNull() | (rating <= high))
        return out

    return build


def filter_two_tables(lexemes: DataFrame, senses: DataFrame, lexeme: Column | None = None, sense: Column | None = None, need_all: bool = False, counts: bool = False) -> DataFrame:
    """Lexemes of which a sense (or every sense) satisfies ``sense``.

    Without a sense a lexeme stays only if all senses must match or nothing is asked of
    senses. One aggregation of the sense table and one join; no predicate, no join.
    ``counts`` adds n_senses and n_matching and keeps all lexemes that pass ``lexeme``.
    """
    base = lexemes if lexeme is None else lexemes.where(lexeme)
    if sense is None and not counts:
        return base
    ok = F.coalesce(sense if sense is not None else F.lit(True), F.lit(False))
    per = senses.select("id", ok.alias("ok")).groupBy("id").agg(F.count("*").alias("n_senses"), F.count_if("ok").alias("n_matching"))
    joined = base.join(per, "id", "left").fillna(0, ["n_senses", "n_matching"])
    if counts:
        return joined
    test = F.col("n_matching") == F.col("n_senses") if need_all else F.col("n_matching") > 0
    return joined.where(test).drop("n_senses", "n_matching")
