"""Lookups in synset tables, source selection and freshness, fallbacks and exports for user interfaces."""

from __future__ import annotations

import re
from datetime import datetime, timedelta

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from glossarion import vocab


def synsets_of(edges: DataFrame, asked: DataFrame) -> DataFrame:
    """id, synset, pos: the synsets of each asked word, whatever the case of its letters."""
    keyed = edges.select(F.lower("lemma").alias("__w"), "synset", "pos").distinct()
    return asked.select("id", F.lower("id").alias("__w")).distinct().join(keyed, "__w").drop("__w")


def members_of(edges: DataFrame, names: DataFrame, asked: DataFrame) -> DataFrame:
    """synset, lexname, lemmas: what each asked synset is called and which words it has; unknown ones give no row."""
    some = asked.select("synset").distinct()
    words = edges.join(some, "synset").groupBy("synset").agg(F.array_sort(F.collect_set("lemma")).alias("lemmas"))
    return words.join(names.select("synset", "lexname").distinct(), "synset", "left").select("synset", "lexname", "lemmas")


def entry_format(columns) -> str:
    """Tables with offsets into a table of senses are lexemes; all others hold their senses themselves."""
    return "lexeme" if {"sense_offset", "sense_length"} & set(columns) else "single_file"


#: Source, its name, its license, and whether it makes the whole share-alike.
SOURCE_LICENSES = (
    ("wiktionary", "Wiktionary", "CC BY-SA 4.0", True),
    ("eowl", "EOWL", "UKACD License", False),
    ("wordnet", "WordNet", "WordNet License", False),
    ("brysbaert", "Brysbaert", "Research Use", False),
    ("frequency", "Frequency Data", "CC BY-SA 4.0", True),
)


def license_without_counts(selected: list[str]) -> dict:
    """The license of a selection when no statistics tell which words it holds."""
    chosen = [s for s in SOURCE_LICENSES if s[0] in selected]
    alike = any(s[3] for s in chosen)
    return {
        "license": "CC BY-SA 4.0" if alike else "CC BY 4.0",
        "description": "Attribution + ShareAlike required" if alike else "Attribution required",
        "sources": [f"{name} ({text})" for _, name, text, _ in chosen],
    }


def quick_filter(word_type: str = "any", syllables: str = "any") -> dict | None:
    """Filters for two choices of a form; none for ``any``, one alone as it is, both as a composite."""
    made = []
    if word_type in ("single", "phrases"):
        single = word_type == "single"
        made.append({"type": "phrase", "mode": "include", "config": {"singleWord" if single else "multiWord": True}, "summary": "Single words only" if single else "Phrases only"})
    if syllables == "required":
        made.append({"type": "syllable", "mode": "include", "config": {"requireSyllables": True}, "summary": "Syllable data required"})
    if len(made) < 2:
        return made[0] if made else None
    return {"type": "composite", "filters": made, "summary": " + ".join(f["summary"] for f in made)}


def select_sources(known: dict[str, dict], ids: list[str] | None = None, group: str | None = None, everything: bool = False) -> list[str]:
    """Sources named, of a group, all, or those of the default; an unknown name or an empty group is refused."""
    if ids:
        if unknown := [i for i in ids if i not in known]:
            raise KeyError(f"unknown sources: {', '.join(unknown)}")
        return list(ids)
    if group:
        found = [i for i, c in known.items() if c.get("group") == group]
        if not found:
            raise KeyError(f"no source in the group {group}")
        return found
    return [i for i, c in known.items() if everything or not c.get("skip_in_default")]


def age_in_days(modified: datetime, now: datetime) -> int:
    return max(timedelta(0), now - modified).days


def is_fresh(modified: datetime | None, now: datetime, max_age_days: int | None = None, force: bool = False) -> bool:
    """Whether a file that is there need not be fetched: always without an age limit, below it with one."""
    if modified is None or force:
        return False
    return not max_age_days or age_in_days(modified, now) < max_age_days


def rewrite_section(text: str, section: str, body: str) -> tuple[str, bool]:
    """``text`` with what stands between a section's AUTO markers replaced, and whether both markers were found."""
    marked = re.compile(rf"(<!-- AUTO:{re.escape(section)} -->[^\n]*\n)(.*?)(<!-- /AUTO:{re.escape(section)} -->)", re.S)
    out, n = marked.subn(lambda m: m[1] + body + m[3], text, count=1)
    return out, n > 0


def codes_for_interfaces() -> dict[str, dict]:
    """Every code table with names and short names, as one document."""
    tables = {"pos": vocab.POS, "flags": vocab.FLAGS, "register": vocab.REGISTER, "temporal": vocab.TEMPORAL, "region": vocab.REGION, "spelling": vocab.SPELLING, "phrase_types": vocab.PHRASES, "morphology_types": vocab.MORPHOLOGY, "domain_types": vocab.DOMAINS}
    first = lambda name: name if isinstance(name, str) else name[0]
    return {kind: {code: {"name": first(name), "short": first(name).lower().replace("_", " ")} for code, name in table.items()} for kind, table in tables.items()}


def configuration_summary() -> dict[str, int]:
    """How many codes and bindings each table has."""
    return {kind: len(codes) for kind, codes in codes_for_interfaces().items()} | {"labels": len(vocab.LABEL_CODES), "label_domains": len(vocab.DOMAIN_OF_LABEL), "morphology_templates": len(vocab.MORPH_TEMPLATES)}
