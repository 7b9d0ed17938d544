"""Code tables of the lexicon: parts of speech, flags, tags, domains, tiers and source bindings.

Fixed values: the codes, names and bounds that specs and data files use.
"""

from __future__ import annotations

import string

# --- fixed values -----------------------------------------------------------
#: Code -> names by which specs and section headers call it.
POS = {
    "NOU": ["noun", "nouns", "noun form", "noun forms", "plural noun", "countable noun", "uncountable noun", "n", "nf"],
    "NAM": ["proper noun", "proper nouns", "proper name", "propernoun", "proper noun form", "prop", "pn"],
    "VRB": ["verb", "verbs", "verb form", "transitive verb", "intransitive verb", "ambitransitive verb", "auxiliary verb", "linking verb", "phrasal verb", "v"],
    "ADJ": ["adjective", "adjectives", "adjective form", "determiner and adjective", "predicative adjective", "attributive adjective", "adj", "a"],
    "ADV": ["adverb", "adverbs", "adverb form", "comparative adverb", "superlative adverb", "adv", "r"],
    "PRN": ["pronoun", "pronouns", "pronoun form", "pron"],
    "DET": ["determiner", "determiners", "article", "articles", "det"],
    "ADP": ["preposition", "prepositions", "postposition", "postpositions", "adposition", "adpositions", "prep"],
    "CNJ": ["conjunction", "conjunctions", "coordinating conjunction", "subordinating conjunction", "conj"],
    "PRT": ["particle", "particles"],
    "ITJ": ["interjection", "interjections", "exclamation", "exclamations", "intj"],
    "PHR": ["phrase", "phrases", "verb phrase", "verb phrases", "verb phrase form", "adverbial phrase", "noun phrase", "noun phrases"],
    "PRV": ["proverb", "proverbs", "saying", "adage"],
    "PPP": ["prepositional phrase", "prepositional phrases"],
    "IDM": ["idiom", "idioms"],
    "AFX": ["affix", "prefix", "suffix", "infix", "circumfix", "prefixes", "suffixes", "affixes"],
    "NUM": ["numeral", "numerals", "number", "cardinal number", "ordinal number"],
    "SYM": ["symbol", "symbols", "letter", "letters", "punctuation mark", "character"],
    "MLT": ["multiple parts of speech"],
    "CTN": ["contraction", "contractions"],
}
FLAGS = {"ABRV": "abbreviation_or_initialism", "INFL": "inflected_form", "ALTH": "alternative_form"}
REGISTER = {"RINF": "informal", "RSLG": "slang", "RVLG": "vulgar", "ROFF": "offensive", "RFRM": "formal", "REUP": "euphemistic", "RHUM": "humorous", "RLIT": "literary", "RCHD": "childish", "RNST": "nonstandard", "RAAV": "AAVE"}
TEMPORAL = {"TARC": "archaic", "TOBS": "obsolete", "TDAT": "dated", "THIS": "historical", "TRAR": "rare"}
REGION = {"ENGB": "United Kingdom", "ENSC": "Scotland", "ENUS": "United States", "ENCA": "Canada", "ENAU": "Australia", "ENNZ": "New Zealand", "ENIE": "Ireland", "ENZA": "South Africa", "ENIN": "India"}
SPELLING = {"SPGB": "UK spelling", "SPUS": "US spelling", "SPCA": "Canadian spelling", "SPAU": "Australian spelling", "SPNZ": "New Zealand spelling", "SPIE": "Irish spelling", "SPZA": "South African spelling", "SPIN": "Indian spelling"}
DOMAINS = {
    "DMATH": "mathematics", "DPHYS": "physics", "DASTL": "astronomy", "DGEOL": "geology", "DCHEM": "chemistry", "DBIOL": "biology", "DANAT": "anatomy", "DZOOL": "zoology", "DBOTN": "botany", "DORGC": "organic chemistry",
    "DBCHM": "biochemistry", "DMEDI": "medicine", "DCOMP": "computing", "DLAWW": "law", "DMILL": "military", "DNAUT": "nautical", "DAVIA": "aviation", "DFINN": "finance", "DTRAN": "transport", "DWEAP": "weaponry",
    "DLING": "linguistics", "DPHIL": "philosophy", "DRELI": "religion", "DSPRT": "sports", "DGAMB": "gaming", "DMUSC": "music", "DGAST": "gastronomy", "DFASH": "fashion", "DARCR": "architecture",
}
PHRASES = {"IDIM": "idiom", "PRVB": "proverb", "PPHR": "prepositional_phrase", "NPHR": "noun_phrase", "VPHR": "verb_phrase", "APHR": "adverbial_phrase"}
MORPHOLOGY = {"SIMP": "simple", "COMP": "compound", "PREF": "prefixed", "SUFF": "suffixed", "AFFX": "affixed", "CIRC": "circumfixed"}
#: Least rank of each frequency tier; Z is unranked.
TIER_FROM = dict(zip(string.ascii_uppercase, (1, 21, 101, 201, 301, 401, 501, 1001, 2001, 3001, 4001, 5001, 10001, 20001, 30001, 40001, 50001, 60001, 70001, 80001, 90001, 100001, 200001, 300001, 400001)))
PROFANE_CODES, PROFANE_NAMES = ("RVLG", "ROFF", "RDEG"), ("vulgar", "offensive", "derogatory")
DATED_CODES, DATED_NAMES = ("TARC", "TOBS", "TDAT"), ("archaic", "obsolete", "dated")
JARGON = ("medical", "legal", "technical", "scientific")
LICENSES = {"wikt": "CC-BY-SA-4.0", "wordnet": "CC-BY-4.0", "eowl": "UKACD", "brysbaert": "Research", "frequency": "CC-BY-SA-4.0"}
LABEL_CODES = {
    "informal": "RINF", "colloquial": "RINF", "slang": "RSLG", "vulgar": "RVLG", "offensive": "ROFF", "derogatory": "ROFF", "ethnic slur": "ROFF", "pejorative": "ROFF", "euphemistic": "REUP", "humorous": "RHUM",
    "literary": "RLIT", "poetic": "RLIT", "childish": "RCHD", "baby talk": "RCHD", "infantile": "RCHD", "puerile": "RCHD", "nonstandard": "RNST", "proscribed": "RNST", "aave": "RAAV", "archaic": "TARC", "obsolete": "TOBS",
    "dated": "TDAT", "historical": "THIS", "rare": "TRAR", "british": "ENGB", "uk": "ENGB", "scottish": "ENSC", "scotland": "ENSC", "us": "ENUS", "american": "ENUS", "canadian": "ENCA", "australia": "ENAU", "australian": "ENAU",
    "ireland": "ENIE", "irish": "ENIE", "new zealand": "ENNZ", "south africa": "ENZA", "south african": "ENZA", "india": "ENIN", "indian": "ENIN", "american spelling": "SPUS", "us spelling": "SPUS", "british spelling": "SPGB",
    "uk spelling": "SPGB", "commonwealth spelling": "SPGB", "canadian spelling": "SPCA", "australian spelling": "SPAU", "irish spelling": "SPIE", "new zealand spelling": "SPNZ", "south african spelling": "SPZA", "indian spelling": "SPIN",
}
DOMAIN_LABELS = {
    "DMATH": ["mathematics", "math", "maths", "algebra", "geometry", "calculus", "set theory", "number theory"], "DPHYS": ["physics"], "DASTL": ["astronomy", "astrophysics", "cosmology"], "DGEOL": ["geology", "mineralogy"],
    "DCHEM": ["chemistry"], "DBIOL": ["biology"], "DANAT": ["anatomy", "anatomical"], "DZOOL": ["zoology", "ornithology", "entomology"], "DBOTN": ["botany", "mycology"], "DORGC": ["organic chemistry", "organic compound"],
    "DBCHM": ["biochemistry", "enzyme", "protein"], "DMEDI": ["medicine", "medical"], "DCOMP": ["computing", "internet", "programming"], "DLAWW": ["law", "legal"], "DMILL": ["military"], "DNAUT": ["nautical"], "DAVIA": ["aviation"],
    "DFINN": ["finance", "banking", "economics", "accounting", "business"], "DTRAN": ["rail", "railways", "automotive", "transport"], "DWEAP": ["weapons", "firearms", "archery"], "DLING": ["linguistics", "grammar", "phonetics", "syntax"],
    "DPHIL": ["philosophy", "ethics", "logic"], "DRELI": ["religion", "theology", "biblical"], "DSPRT": ["sports", "baseball", "cricket", "football", "tennis", "golf"], "DGAMB": ["poker", "card games", "chess", "gambling"],
    "DMUSC": ["music"], "DGAST": ["cooking", "brewing"], "DFASH": ["clothing", "fashion", "textiles"], "DARCR": ["architecture", "construction"],
}
QUALIFIERS = ("_", "or", "and", "also", "chiefly", "often", "sometimes", "usually", "especially", "mostly", "mainly", "primarily", "particularly", "generally", "now", "originally", "formerly", "by extension", "figurative", "figuratively", "usu.", "esp.")
NORMAL_LABELS = {"u.s.": "us", "u.s": "us", "usa": "us", "america": "us", "u.k.": "uk", "u.k": "uk", "britain": "british", "coll.": "colloquial", "colloq": "colloquial", "derog": "derogatory"}
FLAG_TEMPLATES = {
    "ABRV": ["abbr of", "abbrev of", "abbreviation of", "initialism of", "acronym of"],
    "INFL": ["plural of", "past tense of", "past participle of", "present participle of", "third-person singular of", "en-third-person singular of", "comparative of", "superlative of", "inflection of", "infl of", "form of"],
    "ALTH": ["alt form", "alt sp", "alt form of", "alt sp of", "alternative form of", "alternative spelling of", "altform", "altspelling", "standard spelling of"],
}
FROM_SPELLING = {"commonwealth": "commonwealth spelling", "british form": "british spelling", "british": "british spelling", "irish": "irish spelling", "american": "american spelling", "us": "us spelling", "canadian": "canadian spelling", "australian": "australian spelling", "new zealand": "new zealand spelling", "south africa": "south african spelling", "indian": "indian spelling"}
HEAD_TEMPLATES = {"en-noun": "NOU", "en-prop": "NAM", "en-verb": "VRB", "en-adj": "ADJ", "en-adv": "ADV"}
MORPH_TEMPLATES = {"suffix": "suffix", "suf": "suffix", "prefix": "prefix", "pre": "prefix", "confix": "confix", "compound": "compound", "affix": "affix", "af": "affix", "surf": "affix"}
SPECIAL_PREFIXES = ("Wiktionary:", "Template:", "Module:", "Category:", "Appendix:", "Help:", "MediaWiki:", "User:", "Reconstruction:", "Thesaurus:", "Rhymes:", "Citations:", "Index:", "Concordance:", "Talk:", "File:")
IGNORED_HEADERS = ("etymology", "etymology %d", "pronunciation", "pronunciation %d", "usage notes", "notes", "synonyms", "antonyms", "related terms", "derived terms", "descendants", "translations", "references", "further reading", "see also", "quotations", "conjugation", "declension", "inflection", "alternative forms", "anagrams")
# --- end of fixed values ----------------------------------------------------

POS_OF_NAME = {name: code for code, names in POS.items() for name in names}
TAG_NAMES = {name: code for table in (REGISTER, TEMPORAL, REGION) for code, name in table.items()}
CATEGORIES = ("register", "temporal", "domain", "region")
TIERS = [*TIER_FROM, "Z"]
TIER_SCORE = {t: 100 - 4 * i for i, t in enumerate(TIERS)}
DOMAIN_OF_LABEL = {label: code for code, labels in DOMAIN_LABELS.items() for label in labels}


def pos_code(name: str) -> str:
    """Code of a part of speech; an unknown name in upper case."""
    return POS_OF_NAME.get(name.lower(), name.upper())


def label_code(name: str) -> str:
    """Code of a label; an unmapped name as it is."""
    return TAG_NAMES.get(name, name)


def tier_range(tier: str) -> tuple[int | None, int | None]:
    """Ranks of a tier; Z has none, Y is open."""
    if tier == "Z":
        return None, None
    i = TIERS.index(tier)
    return TIER_FROM[tier], TIER_FROM[TIERS[i + 1]] - 1 if tier != "Y" else None


def check_codes() -> list[str]:
    """Violations of shape and uniqueness over all tables; empty if none."""
    tables = {3: [POS], 4: [FLAGS, REGISTER, TEMPORAL, REGION, SPELLING, PHRASES, MORPHOLOGY], 5: [DOMAINS]}
    seen, out = set(), []
    for width, group in tables.items():
        for code in (c for t in group for c in t):
            if len(code) != width or not (code.isalpha() and code.isupper()):
                out.append(f"shape: {code}")
            if code in seen:
                out.append(f"twice: {code}")
            seen.add(code)
    return out
