"""Dictionary-dump scan: pages, status, sections, definitions and entries.

Page splitting, routing and headers are Spark expressions; only nested markup goes
through a Python parser, in Arrow batches and after pages without a target-language
section have been dropped.
"""

from __future__ import annotations

import re
from collections.abc import Iterator

import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from glossarion import vocab

ENTRY = "id string, pos string, wc int, codes array<string>, lemma string, nsyll int, phrase_type string, morphology struct<type:string,components:array<string>,base:string,prefixes:array<string>,suffixes:array<string>>, definition_level int, definition_type string, senseid string"
TARGET = "English"


# --- pages -------------------------------------------------------------------


def read_pages(spark: SparkSession, path: str) -> DataFrame:
    """xml of each <page>: split at its end tag by the text reader, so entities stay raw and compressed files may split."""
    raw = spark.read.text(path, lineSep="</page>")
    xml = raw.where(F.col("value").contains("<page>")).select(F.element_at(F.split("value", "<page>"), -1).alias("xml"))
    x = F.col("xml")  # what the file's end cut off has an open element
    return xml.where((~x.contains("<title>") | x.contains("</title>")) & (~x.rlike("<text[^>/]*>") | x.contains("</text>")))


def parse_pages(pages: DataFrame) -> DataFrame:
    """title, ns, text and status: the first of no_content, special, redirect, no_content, non_english, dict_only, ok."""
    x = F.col("xml")
    some = lambda pattern: F.nullif(F.regexp_extract(x, pattern, 1), F.lit(""))
    text = some(r"(?s)<text[^>]*>(.*?)</text>")
    df = pages.withColumns({"title": some("<title>([^<]*)</title>"), "ns": F.coalesce(F.expr("try_cast(regexp_extract(xml, '<ns>(-?[0-9]+)</ns>', 1) as int)"), F.lit(0)), "text": text})
    special = (F.col("ns") != 0) | F.col("title").rlike("^(?:" + "|".join(map(re.escape, vocab.SPECIAL_PREFIXES)) + ")") | F.col("title").contains("/translations")
    has = F.col("text").rlike(rf"(?m)^==\s*{TARGET}\s*==\s*$")
    status = (
        F.when(F.col("title").isNull(), "no_content").when(special, "special").when(x.rlike("<redirect "), "redirect").when(F.col("text").isNull(), "no_content")
        .when(~has, "non_english").when(F.col("text").rlike(r"\{\{no entry\|en"), "dict_only").otherwise("ok")
    )
    return df.withColumn("status", status)


def status_counts(pages: DataFrame) -> DataFrame:
    return pages.groupBy("status").agg(F.count("*").alias("n"))


def extract_pages(pages: DataFrame, words: DataFrame) -> DataFrame:
    """First page of each wanted title, case-sensitive; ``pages`` has an ``ord``."""
    w = W.partitionBy("title").orderBy("ord")
    return pages.join(words.select(F.col("id").alias("title")).distinct(), "title", "left_semi").withColumn("__n", F.row_number().over(w)).where("__n = 1").drop("__n")


def target_section(text: Column) -> Column:
    """From the target language's header to the next level-2 header of another language."""
    return F.regexp_extract(text, rf"(?ms)^==\s*{TARGET}\s*==\s*$(.*?)(?=^==[^=].*?==\s*$|\z)", 1)


def headers(pages: DataFrame, text: str = "text") -> DataFrame:
    """page columns with start, level, header and end: a section ends where the next begins."""
    found = F.regexp_extract_all(text, F.lit(r"(?m)^(={2,6})\s*([^=\n]+?)\s*\1\s*$"), F.lit(0))
    rows = pages.select("*", F.posexplode(found).alias("k", "raw"))
    rows = rows.withColumns({"level": F.length(F.regexp_extract("raw", "^(=+)", 1)), "header": F.lower(F.regexp_extract("raw", r"^=+\s*(.*?)\s*=+\s*$", 1))})
    return rows.drop("raw")


def is_ignored_header(c: Column) -> Column:
    literal = [h for h in vocab.IGNORED_HEADERS if "%d" not in h]
    patterns = [re.escape(h).replace("%d", r"\d+") for h in vocab.IGNORED_HEADERS if "%d" in h]
    return c.isin(*literal) | c.rlike("^(?:" + "|".join(patterns) + ")$")


def unknown_headers(pages: DataFrame, n: int = 20) -> DataFrame:
    """Most frequent headers that are neither parts of speech nor ignored."""
    h = headers(pages).where(~is_ignored_header(F.col("header")) & ~F.col("header").isin(*vocab.POS_OF_NAME, TARGET.lower()))
    return h.groupBy("header").agg(F.count("*").alias("n")).orderBy(F.desc("n"), "header").limit(n)


def block_of_section(sections: DataFrame) -> DataFrame:
    """Each section's etymology block within its page: the last block that began before it, the first block if none did."""
    w = W.partitionBy("page").orderBy("start")
    block = F.when(F.col("header").rlike(r"^etymology"), F.col("start"))
    running = F.last(block, ignorenulls=True).over(w.rowsBetween(W.unboundedPreceding, W.currentRow))
    return sections.withColumn("block", F.coalesce(running, F.min(block).over(W.partitionBy("page"))))


def label_codes(labels: Column) -> Column:
    """Codes of exploded labels: qualifiers stripped, aliases resolved, one lookup."""
    table = F.create_map(*(F.lit(x) for kv in (vocab.LABEL_CODES | vocab.DOMAIN_OF_LABEL).items() for x in kv))
    alias = F.create_map(*(F.lit(x) for kv in vocab.NORMAL_LABELS.items() for x in kv))
    low = F.filter(F.transform(labels, lambda x: F.lower(F.trim(x))), lambda x: ~x.isin(*vocab.QUALIFIERS))
    return F.array_sort(F.array_distinct(F.array_compact(F.transform(low, lambda x: F.element_at(table, F.coalesce(F.element_at(alias, x), x))))))


def category_codes(categories: Column) -> Column:
    """Codes whose name a category contains: one pattern for each code, no join on containment."""
    low = F.transform(categories, F.lower)
    any_of = lambda name: F.exists(low, lambda c: c.contains(name))
    tests = [F.when(any_of(name), code) for code, name in (vocab.REGISTER | vocab.TEMPORAL | vocab.DOMAINS).items()]
    return F.array_sort(F.array_compact(F.array(*tests)))


# --- markup ------------------------------------------------------------------


def templates(text: str) -> list[tuple[str, list[str]]]:
    """Outermost templates in order: name and parameters. Nested ones stay inside parameters; unclosed ones are skipped."""
    out, at = [], 0
    while (begin := text.find("{{", at)) >= 0:
        depth, k = 0, begin
        while k < len(text):
            two = text[k : k + 2]
            if two == "{{":
                depth, k = depth + 1, k + 2
            elif two == "}}":
                depth, k = depth - 1, k + 2
                if not depth:
                    break
            else:
                k += 1
        if depth:
            at = begin + 2
            continue
        parts, level, last = [], 0, 0
        body = text[begin + 2 : k - 2]
        for i, c in enumerate(body):
            if body[i : i + 2] in ("{{", "[["):
                level += 1
            elif body[i : i + 2] in ("}}", "]]"):
                level -= 1
            elif c == "|" and level <= 0:
                parts.append(body[last:i])
                last = i + 1
        parts.append(body[last:])
        out.append((parts[0].strip(), [p.strip() for p in parts[1:]]))
        at = k
    return out


def positional(params: list[str]) -> list[str]:
    return [p for p in params if not re.match(r"[a-z]+\d*=", p)]


def named(params: list[str], key: str) -> str | None:
    return next((p.split("=", 1)[1].strip() for p in params if p.split("=", 1)[0].strip() == key and "=" in p), None)


def strip_markup(text: str) -> str:
    """Plain text: links show their words, mention and gloss templates their argument, other templates nothing."""
    def shown(name: str, params: list[str]) -> str:
        p = positional(params)
        if name in ("m", "l", "mention", "link"):
            return p[1] if len(p) > 1 else ""
        return p[0] if name in ("w", "gloss", "q", "qualifier", "i", "qual") and p else ""

    while (m := re.search(r"\{\{([^{}]*)\}\}", text)):
        name, *params = m[1].split("|")
        text = text[: m.start()] + shown(name.strip(), params) + text[m.end() :]
    text = re.sub(r"\[\[(?:[^\]|]*\|)?([^\]]*)\]\]", r"\1", text)
    return re.sub(r"'{2,}|<[^>]*>", "", text).strip()


def lemma_text(text: str) -> str:
    text = re.sub(r"\[\[(?:[^\]|]*\|)?([^\]]*)\]\]", r"\1", text)
    text = re.sub(r"\{\{[^{}]*\}\}", "", text).split("#")[0]
    return re.sub(r"^:?[A-Za-z]+:", "", text).strip().lower()


def englishlike(title: str) -> bool:
    return bool(re.search("[A-Za-zÀ-ɏ]", title)) and not any(c in "&;<>" or "̀" <= c <= "ͯ" or ord(c) > 0xFFFF or (c.isalpha() and c > "ɏ") or (c.isspace() and c != " ") for c in title)


def form_of(found: list[tuple[str, list[str]]], kind: str) -> str | None:
    """Target of an inflection or alternative-form template."""
    for name, params in found:
        if name.removeprefix("en-") in vocab.FLAG_TEMPLATES[kind] or name in vocab.FLAG_TEMPLATES[kind]:
            p = positional(params)
            if p and p[0] == "en":
                p = p[1:]
            if name == "form of":
                p = p[1:]
            if p and p[0]:
                return lemma_text(p[0])
    return None


def morphology(found: list[tuple[str, list[str]]]) -> dict | None:
    """The first morphology template of the language with two components at least."""
    for name, params in found:
        kind, p = vocab.MORPH_TEMPLATES.get(name), positional(params)
        if not kind or not p or p[0] != "en":
            continue
        parts = [lemma_text(x) for x in p[1:] if x]
        if len(parts) < 2:
            continue
        if kind == "suffix":
            parts = [parts[0], *("-" + x.lstrip("-") for x in parts[1:])]
        elif kind == "prefix":
            parts = [*(x.rstrip("-") + "-" for x in parts[:-1]), parts[-1]]
        elif kind == "confix":
            parts = [parts[0].rstrip("-") + "-", *parts[1:-1], "-" + parts[-1].lstrip("-")]
        pre, suf = [x for x in parts if x.endswith("-")], [x for x in parts if x.startswith("-") and not x.endswith("-")]
        rest = [x for x in parts if x not in pre and x not in suf]
        code = "CIRC" if kind == "confix" else "AFFX" if pre and suf else "PREF" if pre else "SUFF" if suf else "COMP" if len(rest) > 1 else "SIMP"
        return {"type": code, "components": parts, "base": rest[0] if len(rest) == 1 else None, "prefixes": pre, "suffixes": suf}
    return None


VOWELS, GLIDES, MARKS = "aeiouyæɑɒɔəɚɛɜɝɪʊʌøœɐɨʉɵɤɯ", "ɪʊəiujw", "ːˑ̯̃"


def syllable_count(section: str, categories: list[str]) -> int | None:
    """Transcription, then hyphenation, then category, then rhymes."""
    found = templates(section)
    for name, params in found:
        if name == "IPA" and (m := re.search(r"/([^/]+)/|\[([^\]]+)\]", "|".join(params))):
            n = len(re.findall(f".̩|[{VOWELS}][{MARKS}]*(?:[{GLIDES}][{MARKS}]*)?", m[1] or m[2]))
            if 0 < n <= 15:
                return n
    for name, params in found:
        if name in ("hyphenation", "hyph"):
            parts = [x for x in "|".join(params).split("||")[0].split("|") if x and "=" not in x and x != "en"]
            if len(parts) > 1 or (parts and len(parts[0]) <= 3):
                return len(parts)
    for c in categories:
        if m := re.search(r"English (\d+)-syllable words", c):
            return int(m[1])
    for name, params in found:
        if name == "rhymes" and (s := named(params, "s")) and s.isdigit():
            return int(s)
    return None


DEFINITION = re.compile(r"^(###|##|#\*|#:|#)\s*(.*)$", re.M)
HEADER = re.compile(r"^(={3,6})\s*([^=\n]+?)\s*\1\s*$", re.M)


def part_of_speech(header: str, found: list[tuple[str, list[str]]], categories: list[str]) -> str:
    if header in vocab.POS_OF_NAME:
        return vocab.POS_OF_NAME[header]
    for name, params in found:
        p = positional(params)
        if name in ("head", "en-head", "head-lite") and len(p) > 1 and p[1] in vocab.POS_OF_NAME:
            return vocab.POS_OF_NAME[p[1]]
        if name in vocab.HEAD_TEMPLATES:
            return vocab.HEAD_TEMPLATES[name]
    for c in categories:
        if c.lower().removeprefix("english ") in vocab.POS_OF_NAME:
            return vocab.POS_OF_NAME[c.lower().removeprefix("english ")]
    return "UNK"


def _codes(labels: list[str], found: list[tuple[str, list[str]]], categories: list[str]) -> set[str]:
    out = set()
    for raw in labels:
        x = raw.strip().lower()
        for q in vocab.QUALIFIERS:
            if x.startswith(q + " "):
                x = x[len(q) + 1 :]
        x = vocab.NORMAL_LABELS.get(x, x)
        out |= {c for c in (vocab.LABEL_CODES.get(x), vocab.DOMAIN_OF_LABEL.get(x)) if c}
    for code, names in vocab.FLAG_TEMPLATES.items():
        for name, params in found:
            if name in names or name.removeprefix("en-") in names:
                out.add(code)
                for key in ("from", "from2"):
                    spelling = vocab.FROM_SPELLING.get((named(params, key) or "").lower())
                    if spelling:
                        out.add(vocab.LABEL_CODES[spelling])
    for c in categories:
        low = c.lower()
        out |= {code for code, name in (vocab.REGISTER | vocab.TEMPORAL | vocab.DOMAINS).items() if name.lower() in low}
        out |= {"ABRV"} if re.search("abbreviations|initialisms|acronyms", low) else set()
    return out


def entries(title: str, section: str) -> list[dict]:
    """One entry for each primary definition of a page's target-language section; equal entries once."""
    if not englishlike(title):
        return []
    categories = re.findall(r"\[\[Category:([^\]|]+)", section)
    heads = list(HEADER.finditer(section))
    preamble = section[: heads[0].start()] if heads else section
    nsyll, out, etymology, pron = syllable_count(preamble, categories), [], "", None
    for k, m in enumerate(heads):
        body = section[m.end() : heads[k + 1].start() if k + 1 < len(heads) else len(section)]
        header = m[2].lower()
        if header.startswith("etymology"):
            etymology, pron = body, None
        if header.startswith(("etymology", "pronunciation")):
            pron = syllable_count(body, categories) or pron
            continue
        phrase = next((c for c, n in vocab.PHRASES.items() if n.replace("_", " ") == header.rstrip("s")), None)
        if header not in vocab.POS_OF_NAME and not phrase:
            continue
        before = body.split("\n#")[0]
        head = templates(before)
        pos = part_of_speech(header, head, categories)
        lines = [(mark, text) for mark, text in DEFINITION.findall(body) if mark == "#"] or [("#", "")]
        for level, (_, text) in enumerate(lines, 1):
            found = templates(text)
            labels = [x for name, params in (*found, *head) if name in ("lb", "label", "context", "tlb") for x in positional(params)[1:]]
            codes = _codes(labels, [*found, *head], categories)
            lemma = form_of(found, "INFL") or form_of(found, "ALTH")
            sense = next((positional(p)[-1] for name, p in found if name == "senseid" and positional(p)), None)
            wc = len(title.split())
            one = {
                "id": title, "pos": pos, "wc": wc, "codes": sorted(codes), "lemma": lemma if lemma and englishlike(lemma) else None, "nsyll": pron or nsyll,
                "phrase_type": phrase if wc > 1 else None, "morphology": morphology(templates(etymology)), "definition_level": level, "definition_type": "primary", "senseid": sense,
            }
            if one not in out:
                out.append(one)
    return out


def _entries(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    part = pa.list_(pa.string())
    types = {
        "id": pa.string(), "pos": pa.string(), "wc": pa.int32(), "codes": part, "lemma": pa.string(), "nsyll": pa.int32(), "phrase_type": pa.string(),
        "morphology": pa.struct([("type", pa.string()), ("components", part), ("base", pa.string()), ("prefixes", part), ("suffixes", part)]), "definition_level": pa.int32(), "definition_type": pa.string(), "senseid": pa.string(),
    }
    for batch in batches:
        rows = [e for t, s in zip(batch.column(0).to_pylist(), batch.column(1).to_pylist(), strict=True) for e in entries(t, s)]
        yield pa.RecordBatch.from_pydict({k: pa.array([r[k] for r in rows], v) for k, v in types.items()})


def scan_entries(pages: DataFrame) -> DataFrame:
    """Entries of parsed pages; pages of another status never reach Python."""
    return pages.where("status = 'ok'").select("title", target_section(F.col("text")).alias("section")).mapInArrow(_entries, ENTRY)


def code_counts(found: DataFrame) -> DataFrame:
    """Statistics of entries: how often each value of pos and codes occurs."""
    long = found.select(F.explode(F.concat(F.array(F.struct(F.lit("pos").alias("kind"), F.col("pos").alias("value"))), F.transform("codes", lambda c: F.struct(F.lit("code").alias("kind"), c.alias("value"))))).alias("x"))
    return long.groupBy("x.kind", "x.value").agg(F.count("*").alias("n"))


def syllable_disagreement(df: DataFrame, columns: list[str]) -> DataFrame:
    """Rows whose sources of a syllable count differ."""
    got = F.array_distinct(F.array_compact(F.array(*columns)))
    return df.withColumn("differs", F.size(got) > 1)

