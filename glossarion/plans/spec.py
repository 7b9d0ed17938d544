"""Word-list specs: five dialects into one form, validation, and one Column for all filters."""

from __future__ import annotations

import json
import re
from dataclasses import dataclass, field

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from glossarion import vocab
from glossarion.functions import lexical
from glossarion.operators.predicates import overlaps

SECTIONS = ("character", "phrase", "frequency", "pos", "concreteness", "labels", "policy", "temporal", "sources", "spelling_region", "region", "proper_noun", "syllables", "lemma")
OPERATIONS = ("include", "exclude", "include-if-primary", "exclude-if-primary")
#: Field that a section's options read; validation fails where a table lacks it.
NEEDS = {"frequency": "frequency_tier", "concreteness": "concreteness", "syllables": "nsyll", "sources": "sources", "spelling_region": "spelling_region", "region": "spelling_region"}
LETTERS = r"\p{L}"
PRESETS = {"standard": r"^[\p{L}&&\p{IsLowercase}]*$", "contractions": f"^[{LETTERS}']*$", "alphanumeric": rf"^[{LETTERS}\p{{Nd}}]*$", "hyphenated": f"^[{LETTERS}-]*$", "common-punct": f"^[{LETTERS}'-]*$"}


class SpecError(ValueError):
    """A spec that cannot be read or names fields the table lacks."""


@dataclass
class Spec:
    filters: dict = field(default_factory=dict)
    output: dict = field(default_factory=dict)
    warnings: list[str] = field(default_factory=list)


def parse(text: str) -> dict:
    try:
        body = json.loads(text)
    except ValueError:
        import yaml

        try:
            body = yaml.safe_load(text)
        except yaml.YAMLError as e:
            raise SpecError(str(e)) from e
    if not isinstance(body, dict):
        raise SpecError("a spec is a mapping")
    return body


def _listed(x) -> list:
    return [] if x is None else list(x) if isinstance(x, list | tuple) else [x]


def normalize(body: dict) -> Spec:
    """Versioned, web-builder, operation-first, simplified and unknown bodies in one form."""
    spec = Spec(output=dict(body.get("output") or {}))
    if isinstance(body.get("filters"), list):  # web builder: [{type, mode, config}]
        for f in body["filters"]:
            kind, config = f.get("type"), dict(f.get("config") or {})
            if kind in ("character", "phrase", "frequency"):
                spec.filters.setdefault(kind, {}).update(config)
            else:
                spec.warnings.append(f"web-builder filter {kind} has no effect")
    elif "filters" in body:
        spec.filters = dict(body["filters"] or {})
    elif any(op in body for op in OPERATIONS):  # {include: {pos: [...], register: [...]}}
        for op in OPERATIONS:
            for prop, values in (body.get(op) or {}).items():
                if prop == "pos":
                    spec.filters.setdefault("pos", {})[op] = _listed(values)
                elif prop in vocab.CATEGORIES:
                    spec.filters.setdefault("labels", {}).setdefault(prop, {})[op] = _listed(values)
                elif prop == "sources":
                    spec.filters.setdefault("sources", {})[op] = _listed(values)
                else:
                    spec.warnings.append(f"unknown property {prop}")
        for k in SECTIONS:
            if k in body:
                spec.filters[k] = body[k]
    else:
        spec.filters = {k: body[k] for k in SECTIONS if k in body}
        spec.warnings += [f"unknown key {k}" for k in body if k not in (*SECTIONS, "output", "version", "name", "description", "distribution")]
    if isinstance(spec.filters.get("sources"), list):
        spec.filters["sources"] = {"include": spec.filters["sources"]}
    return spec


def validate(spec: Spec, columns) -> list[str]:
    out = [f"{s} needs the field {NEEDS[s]}" for s in spec.filters if s in NEEDS and NEEDS[s] not in columns]
    out += [f"unknown section {s}" for s in spec.filters if s not in SECTIONS]
    if "proper_noun" in spec.filters and not {"has_common_usage", "has_proper_usage"} <= set(columns):
        out.append("proper_noun needs the fields has_common_usage and has_proper_usage")
    return out


def needs_senses(spec: Spec) -> bool:
    """Whether the plan joins senses: pos, labels, temporal, or an active policy."""
    f = spec.filters
    return bool(f.get("pos") or f.get("labels") or f.get("temporal") or any((f.get("policy") or {}).values()))


def _any(tests: list[Column]) -> Column:
    out = F.lit(False)
    for t in tests:
        out = out | t
    return out


def _character(o: dict) -> list[Column]:
    c, out = F.col("id"), []
    n = F.length(c)
    if o.get("exact_length") is not None:
        out.append(n == o["exact_length"])
    if o.get("min_length") is not None:
        out.append(n >= o["min_length"])
    if o.get("max_length") is not None:
        out.append(n <= o["max_length"])
    if o.get("char_preset") in PRESETS:
        out.append(c.rlike(PRESETS[o["char_preset"]]))
    if o.get("pattern"):
        out.append(c.rlike(f"^(?:{o['pattern']})"))
    if o.get("exclude_pattern"):
        out.append(~c.rlike(f"^(?:{o['exclude_pattern']})"))
    for key, test in (("starts_with", c.startswith), ("ends_with", c.endswith)):
        if _listed(o.get(key)):
            out.append(_any([test(x) for x in _listed(o[key])]))
        if _listed(o.get(f"exclude_{key}")):
            out.append(~_any([test(x) for x in _listed(o[f"exclude_{key}"])]))
    out += [c.contains(x) for x in _listed(o.get("contains"))]
    banned = o.get("exclude_contains") or []
    if banned:
        out.append(~_any([c.contains(x) for x in banned]))  # a string bans each of its characters
    return out


def _phrase(o: dict) -> list[Column]:
    wc, out = F.coalesce(F.col("wc"), lexical.word_count(F.col("id"))), []
    if o.get("min_words") is not None:
        out.append(wc >= o["min_words"])
    if o.get("max_words") is not None:
        out.append(wc <= o["max_words"])
    if o.get("is_phrase") is not None:
        out.append(wc != 1 if o["is_phrase"] else wc <= 1)
    if "phrase_type" in o:
        out.append(F.col("phrase_type").eqNullSafe(F.lit(o["phrase_type"])))
    return out


def _frequency(o: dict) -> list[Column]:
    tier, out = F.coalesce(F.col("frequency_tier"), F.lit("Z")), []
    if o.get("tiers"):
        out.append(tier.isin(*o["tiers"]))
    if o.get("min_tier"):
        out.append(tier >= o["min_tier"])
    if o.get("max_tier"):
        out.append(tier <= o["max_tier"])
    if o.get("min_score") is not None:
        out.append(lexical.tier_score(tier) >= o["min_score"])
    return out


def _set_tests(o: dict, own: Column, primary: Column, code) -> list[Column]:
    out = []
    for op, where, keep in (("include", own, True), ("exclude", own, False), ("include-if-primary", primary, True), ("exclude-if-primary", primary, False)):
        values = [code(x) for x in _listed(o.get(op))]
        if values:
            test = overlaps(where, values)
            out.append(test if keep else ~test)
    return out


def _sensed(f: dict) -> list[Column]:
    out = []
    pos = f.get("pos") or {}
    if pos.get("require_pos"):
        out.append(F.size(F.coalesce("pos", F.array().cast("array<string>"))) > 0)
    out += _set_tests(pos, F.col("pos"), F.array(F.col("primary_sense.pos")), vocab.pos_code)
    for cat, o in (f.get("labels") or {}).items():
        out += _set_tests(o or {}, F.col(f"labels.{cat}"), F.col(f"primary_sense.labels.{cat}"), vocab.label_code)
    if f.get("temporal"):
        out += _set_tests(f["temporal"], F.col("labels.temporal"), F.col("primary_sense.labels.temporal"), str)
    policy = f.get("policy") or {}
    if policy.get("family_friendly"):
        out.append(~overlaps(F.col("labels.register"), [*vocab.PROFANE_CODES, *vocab.PROFANE_NAMES]))
    if policy.get("modern_only"):
        out.append(~overlaps(F.col("labels.temporal"), [*vocab.DATED_CODES, *vocab.DATED_NAMES]))
    if policy.get("no_jargon"):
        out.append(~overlaps(F.col("labels.domain"), vocab.JARGON))
    return out


def _region(o) -> list[Column]:
    o = {"region": o} if isinstance(o, str) else o
    c, out = F.col("spelling_region"), F.lit(True)
    if o.get("region"):
        return [F.when(c.isNull(), F.lit(bool(o.get("include_universal", True)))).otherwise(c == o["region"])]
    if _listed(o.get("exclude")):
        out = ~F.coalesce(c.isin(*_listed(o["exclude"])), F.lit(False))
    return [out]


def _rest(f: dict) -> list[Column]:
    out = []
    o = f.get("concreteness") or {}
    if o.get("require_concreteness"):
        out.append(F.col("concreteness").isNotNull())
    values = _listed(o.get("values") or o.get("categories"))
    if values:
        out.append(F.coalesce(F.col("concreteness").isin(*values), F.lit(False)))
    o = f.get("sources") or {}
    if _listed(o.get("include")):
        out.append(overlaps(F.col("sources"), o["include"]))
    if _listed(o.get("exclude")):
        out.append(~overlaps(F.col("sources"), o["exclude"]))
    for k in ("spelling_region", "region"):
        if f.get(k):
            out += _region(f[k])
    o = f.get("proper_noun") or {}
    if o.get("require_common_usage"):
        out.append(F.coalesce("has_common_usage", F.lit(False)))
    if o.get("exclude_pure_proper_nouns"):
        out.append(~(F.coalesce("has_proper_usage", F.lit(False)) & ~F.coalesce("has_common_usage", F.lit(False))))
    if o.get("allow_proper_usage") is False:
        out.append(~F.coalesce("has_proper_usage", F.lit(False)))
    o = f.get("syllables") or {}
    n = F.col("nsyll")
    if o.get("exact") is not None:
        out.append(F.coalesce(n == o["exact"], F.lit(False)))
    else:
        if o.get("min") is not None:
            out.append(F.coalesce(n >= o["min"], F.lit(False)))
        if o.get("max") is not None:
            out.append(F.coalesce(n <= o["max"], F.lit(False)))
    if o.get("require_syllables"):
        out.append(n.isNotNull())
    o = f.get("lemma") or {}
    if o.get("base_forms_only") or o.get("exclude_inflected") or o.get("exclude_inflections"):
        out.append(~F.coalesce("is_inflected", F.lit(False)))
    return out


def compile_spec(spec: Spec) -> Column:
    """All filters as one conjunction; an empty spec matches all."""
    f, tests = spec.filters, []
    for name, build in (("character", _character), ("phrase", _phrase), ("frequency", _frequency)):
        if f.get(name):
            tests += build(f[name])
    out = F.lit(True)
    for t in [*tests, *_rest(f), *_sensed(f)]:
        out = out & t
    return out


def aggregate_senses(senses: DataFrame) -> DataFrame:
    """id, pos set, labels and primary_sense (the first sense's pos and labels): one row a word."""
    rows = senses.select("id", "sense_ord", "pos", F.coalesce(F.col("codes"), F.array().cast("array<string>")).alias("codes"))
    # codes are gathered once and sorted into categories a word at a time, of which a filter reads few
    words = rows.groupBy("id").agg(
        F.array_sort(F.collect_set("pos")).alias("pos"), F.array_sort(F.array_distinct(F.flatten(F.collect_set("codes")))).alias("codes"),
        F.min_by(F.struct("pos", "codes"), "sense_ord").alias("first"),
    )
    first = F.struct(F.col("first.pos").alias("pos"), lexical.categorize_codes(F.col("first.codes")).alias("labels"))
    return words.select("id", "pos", lexical.categorize_codes(F.col("codes")).alias("labels"), F.when(F.col("first").isNotNull(), first).alias("primary_sense"))


def run(lexemes: DataFrame, spec: Spec | dict | str, senses: DataFrame | None = None) -> DataFrame:
    """The words of a spec: filtered, sorted and limited rows of ``lexemes``.

    Word filters run before the join; senses are joined only if a filter reads them.
    """
    spec = normalize(parse(spec)) if isinstance(spec, str) else normalize(spec) if isinstance(spec, dict) else spec
    if problems := validate(spec, lexemes.columns):
        raise SpecError("; ".join(problems))
    columns = lexemes.columns
    if needs_senses(spec):
        if senses is None:
            raise SpecError("this spec needs senses")
        early = Spec({k: v for k, v in spec.filters.items() if k not in ("pos", "labels", "temporal", "policy")})
        late = Spec({k: v for k, v in spec.filters.items() if k in ("pos", "labels", "temporal", "policy")})
        kept = lexemes.where(compile_spec(early)).drop("pos", "labels", "primary_sense")
        out = kept.join(aggregate_senses(senses), "id", "left").where(compile_spec(late))
        out = out.select(*(c for c in columns if c in out.columns))
    else:
        out = lexemes.where(compile_spec(spec))
    return ordered(out, spec.output.get("sort_by"), spec.output.get("limit"))


def ordered(words: DataFrame, sort_by: str | None = None, limit: int | None = None) -> DataFrame:
    """alphabetical (code points), score, frequency (tier score) or length; ties keep the input's ``ord`` if it has one, else by word."""
    tie = F.col("ord") if "ord" in words.columns else F.col("id")
    keys = {
        "alphabetical": [F.col("id")],
        "score": [lexical.score(F.col("id"), F.col("frequency_tier"), F.col("concreteness") if "concreteness" in words.columns else F.lit(None), F.col("labels.domain") if "labels" in words.columns else F.lit(None).cast("array<string>")).desc(), tie],
        "frequency": [lexical.tier_score(F.col("frequency_tier")).desc(), tie],
        "length": [F.length("id"), tie],
        "case_insensitive": [F.lower("id"), tie],
    } if sort_by else {}
    out = words.orderBy(*keys[sort_by]) if sort_by in keys else words
    return out.limit(limit) if limit else out


def lint(filters: list[dict]) -> list[str]:
    """Equal filters and a single-word beside a multi-word demand, in a web-builder list."""
    seen, out = {}, []
    for i, f in enumerate(filters):
        key = (f.get("type"), f.get("mode"), json.dumps(f.get("config"), sort_keys=True))
        if key in seen:
            out.append(f"filters {seen[key]} and {i} are equal")
        seen.setdefault(key, i)
    words = [f.get("config", {}) for f in filters if f.get("type") == "phrase"]
    if any(w.get("max_words") == 1 or w.get("is_phrase") is False for w in words) and any((w.get("min_words") or 0) > 1 or w.get("is_phrase") for w in words):
        out.append("single-word and multi-word filters exclude each other")
    return out


def to_yaml(spec: Spec) -> str:
    """A versioned spec; equal bounds of length become an exact length."""
    import yaml

    f = json.loads(json.dumps(spec.filters))
    c = f.get("character") or {}
    if c.get("min_length") is not None and c.get("min_length") == c.get("max_length"):
        c["exact_length"] = c.pop("min_length")
        del c["max_length"]
    return yaml.safe_dump({"version": "1.0", "filters": f, **({"output": spec.output} if spec.output else {})}, sort_keys=False)


def to_json(spec: Spec) -> str:
    return json.dumps({"version": "1.0", "filters": spec.filters, **({"output": spec.output} if spec.output else {})}, indent=2)


def explain(spec: Spec) -> list[str]:
    """A line for each option, in words."""
    def lines(path: str, value) -> list[str]:
        if isinstance(value, dict):
            return [x for k, v in value.items() for x in lines(f"{path} {k}".strip().replace("_", " "), v)]
        return [f"{path}: {', '.join(map(str, value)) if isinstance(value, list) else value}"]

    return lines("", spec.filters)


PRESET_SPECS = {
    "wordle": {"character": {"exact_length": 5, "pattern": "[a-z]+$"}, "phrase": {"max_words": 1}},
    "kids_nouns": {"pos": {"include": ["noun"]}, "concreteness": {"values": ["concrete"]}, "policy": {"family_friendly": True, "modern_only": True}, "frequency": {"max_tier": "I"}},
    "scrabble": {"character": {"char_preset": "standard", "min_length": 2, "max_length": 15}, "phrase": {"max_words": 1}, "pos": {"exclude": ["proper noun", "affix", "symbol"]}},
    "blocklist": {"labels": {"register": {"include": ["vulgar", "offensive"]}}},
    "british": {"spelling_region": {"region": "en-GB"}},
    "children": {"frequency": {"max_tier": "H"}, "syllables": {"max": 2}, "policy": {"family_friendly": True}},
    "prefix_game": {"character": {"starts_with": ["un"], "min_length": 5}},
    "no_special": {"character": {"pattern": "[a-zA-Z]+$"}},
}
