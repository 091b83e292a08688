"""Text normalization as column expressions; Arrow functions only for what Spark has none of: NFKD, scripts, Latin readings."""

from __future__ import annotations

import unicodedata

import pandas as pd
from pyspark.sql import Column
from pyspark.sql import functions as F
from pyspark.sql import types as T

#: Latin letters that decompose to a base letter and marks, by rule; folded without leaving the JVM.
_FOLD = {chr(c): b for c in [*range(0xC0, 0x250), *range(0x1E00, 0x1F00)] if len(b := "".join(x for x in unicodedata.normalize("NFKD", chr(c)) if not unicodedata.combining(x))) == 1 and b != chr(c)}
_FROM, _TO = "".join(_FOLD), "".join(_FOLD.values())
_INDIC = "".join(chr(b + 0x66 + d) for b in range(0x900, 0xD80, 0x80) for d in range(10))
#: Null-like address components, compared after normalization.
NULL_LIKE = ["null", "na", "n a", "none", "nan", "-", ""]
#: Unicode blocks of the Indic scripts, each 0x80 wide, from U+0900.
SCRIPTS = ["devanagari", "bengali", "gurmukhi", "gujarati", "oriya", "tamil", "telugu", "kannada", "malayalam"]


@F.pandas_udf(T.StringType())
def nfkd(s: pd.Series) -> pd.Series:
    return s.map(lambda x: None if x is None else unicodedata.normalize("NFKD", x))


def cleaned(c: Column) -> Column:
    """Lower-case text after NFKD: marks of Latin and format characters off, punctuation and symbols to single spaces."""
    bare = F.regexp_replace(c, r"[\x{0300}-\x{036F}\p{Cf}]", "")
    return F.trim(F.regexp_replace(bare, r"[\p{P}\p{S}\p{Z}\p{C}]+", " "))


def folded(c: Column, full: bool = True) -> Column:
    """Lower case and NFKD, of every script by an Arrow function; else of Latin letters with marks alone, in the JVM."""
    return nfkd(F.lower(c)) if full else F.translate(F.lower(c), _FROM, _TO)


def base_norm(c: Column, full: bool = True) -> Column:
    """Lower case, marks off, punctuation and symbols to single spaces."""
    return cleaned(folded(c, full))


def tokens(c: Column) -> Column:
    """Words between spaces; none of an empty text."""
    return F.filter(F.split(c, " "), lambda x: x != "")


def script_of(text: str) -> str:
    """The script most letters are of; any letter outside the Indic blocks counts as latin; none: other. Ties: the Indic block that comes first."""
    if text.isascii():
        return "latin" if any(map(str.isalpha, text)) else "other"
    counts: dict[int, int] = {}
    for c in text:
        if c.isalpha():
            block = (ord(c) - 0x900) // 0x80
            block = block if 0 <= block < len(SCRIPTS) else -1
            counts[block] = counts.get(block, 0) + 1
    latin = counts.pop(-1, 0)
    top = max(counts, key=counts.get, default=-1)
    return SCRIPTS[top] if top >= 0 and counts[top] >= latin else "latin" if latin else "other"


@F.pandas_udf(T.StringType())
def script(text: pd.Series) -> pd.Series:
    return text.map(lambda x: script_of(x or ""))


#: Readings of the Indic blocks, which share one layout: independent vowels from offset 0x05, consonants from 0x15, vowel signs from 0x3E.
_VOWELS = "a ā i ī u ū r l e e e ai o o o au".split()
_CONSONANTS = "k kh g gh n c ch j jh n t th d dh n t th d dh n n p ph b bh m y r r l l l v s s s h".split()
_SIGNS = "ā i ī u ū r r e e e ai o o o au".split()
_NUKTA, _VIRAMA = 0x3C, 0x4D
_OTHER = {0x01: "m", 0x02: "n", 0x03: "h", 0x70: "n"} | {0x66 + d: str(d) for d in range(10)}
#: Malayalam consonants without a vowel have letters of their own.
_CHILLUS = {0xD7A: "n", 0xD7B: "n", 0xD7C: "r", 0xD7D: "l", 0xD7E: "l", 0xD7F: "k"}


def read_indic(text: str) -> str:
    """Indic letters in Latin ones, other characters as they are: a consonant carries an a unless a vowel sign or the virama follows.

    The bare a that ends a word of two letters or more is dropped; then marks go, the case is lowered and ph is read f."""
    out, bare = [], False
    for c in text:
        at = ord(c) - 0x900
        k = at % 0x80 if 0 <= at < 0x480 else -1
        if bare and k not in (_NUKTA, _VIRAMA) and not 0x3E <= k <= 0x4C:
            out.append("a")
        if k == _NUKTA:
            continue
        bare = 0x15 <= k <= 0x39
        if bare:
            out.append(_CONSONANTS[k - 0x15])
        elif 0x05 <= k <= 0x14:
            out.append(_VOWELS[k - 0x05])
        elif 0x3E <= k <= 0x4C:
            out.append(_SIGNS[k - 0x3E])
        elif k != _VIRAMA:
            out.append(_CHILLUS.get(ord(c)) or _OTHER.get(k, c))
    words = ("".join(out) + "a" * bare).split()
    plain = unicodedata.normalize("NFKD", " ".join(w[:-1] if len(w) > 1 and w[-1] == "a" else w for w in words))
    return "".join(x for x in plain if not unicodedata.combining(x)).lower().replace("ph", "f")


@F.pandas_udf(T.StringType())
def transliterated(text: pd.Series, of: pd.Series) -> pd.Series:
    """Texts whose script is Indic in Latin letters; others as they are."""
    return pd.Series([read_indic(x) if x and s in SCRIPTS else x for x, s in zip(text, of, strict=True)], dtype="object")


#: Patterns of postcodes, by country.
IN_PIN = r"(?<!\d)([1-9]\d{2})\s?(\d{3})(?!\d)"
US_ZIP = r"(?:\b[A-Za-z]{2}\s+|^\s*|,\s*)(\d{5})(?:-\d{4})?\s*(?:,|$)"
FR_CP = r"(?:^|,)\s*(\d{5})(?!\s+(?:r\b|r\.|rue|av|bd|boulevard|chemin|place|all|impasse|route|quai|cours))(?:\s+[^\d,][^,]*)?\s*(?=,|$)"


def postcode(address: Column, country: Column) -> Column:
    """The first postcode of an address as its country writes it; null where there is none, and for other countries."""
    pin = F.concat(*[F.regexp_extract(address, "(?U)" + IN_PIN, g) for g in (1, 2)])
    found = F.when(country == "India", pin).when(country == "US", F.regexp_extract(address, "(?U)" + US_ZIP, 1)).when(country == "France", F.regexp_extract(address, "(?iU)" + FR_CP, 1))
    return F.nullif(found, F.lit(""))


#: Legal forms of all countries, and those that India and France have besides; keys are normalized before use.
UNIVERSAL_LEGAL = {
    "inc": "inc", "incorporated": "inc",
    "corp": "corp", "corporation": "corp",
    "llc": "llc",
    "llp": "llp",
    "lp": "lp",
    "pllc": "pllc",
    "pc": "pc",
    "plc": "plc",
    "co": "co", "company": "co",
    "ltd": "ltd", "limited": "ltd",
}
INDIA_LEGAL = {
    "pvt": "pvt", "private": "pvt",
    "ltd": "ltd", "limited": "ltd",
    "llp": "llp",
    "प्राइवेट": "pvt", "प्रा": "pvt", "प्रायवेट": "pvt",
    "लिमिटेड": "ltd", "लि": "ltd",
    "ప్రైవేట్": "pvt", "లిమిటెడ్": "ltd",
    "ಪ್ರೈವೇಟ್": "pvt", "ಲಿಮಿಟೆಡ್": "ltd",
    "பிரைவேட்": "pvt", "லிமிடெட்": "ltd",
}
FRANCE_LEGAL = {
    "sarl": "sarl", "sas": "sas", "sasu": "sasu", "eurl": "eurl",
    "sa": "sa", "sci": "sci", "snc": "snc", "ei": "ei",
}
#: What makes a name a domain, and the words dropped from such a name.
DOMAIN = r"(?i)\b[a-z0-9][a-z0-9-]*\.(com|net|org|io|biz|info|in|co)\b"
DOMAIN_TOKENS = ["www", "com", "net", "org", "io", "biz", "info", "co", "in", "uk"]
#: Address words of all countries, and those that India and France have besides.
GENERIC_ADDRESS = {
    "st": "street", "str": "street",
    "rd": "road",
    "ave": "avenue", "av": "avenue",
    "blvd": "boulevard",
    "dr": "drive",
    "ln": "lane",
    "ct": "court",
    "hwy": "highway",
    "pkwy": "parkway",
    "pl": "place",
    "ste": "suite",
    "apt": "apartment",
    "no": "number",
}
INDIA_ADDRESS = {
    "nr": "near", "opp": "opposite", "soc": "society",
    "flr": "floor", "no": "number", "h": "house",
}
FRANCE_ADDRESS = {
    "r": "rue", "n": "number",
    "bd": "boulevard", "av": "avenue", "ave": "avenue",
    "all": "allee", "imp": "impasse", "rte": "route",
    "chem": "chemin", "fg": "faubourg", "pl": "place",
}


def plain_norm(text: str) -> str:
    """What base_norm makes of one text, in Python: for keys of the tables above."""
    kept = [c for c in unicodedata.normalize("NFKD", text.lower()) if not (0x300 <= ord(c) <= 0x36F or unicodedata.category(c) == "Cf")]
    return " ".join("".join(" " if unicodedata.category(c)[0] in "PSZC" else c for c in kept).split())


def by_country(country: Column, general: dict[str, str], **also: dict[str, str]) -> Column:
    """A map column: the general table, with a country's own entries over it."""
    literal = lambda m: F.create_map(*[F.lit(x) for k, v in m.items() for x in (plain_norm(k), v)])
    out = None
    for name, own in also.items():
        out = (F if out is None else out).when(country == name, literal({**general, **own}))
    return literal(general) if out is None else out.otherwise(literal(general))


def legal_form(words: Column, country: Column) -> tuple[Column, Column]:
    """Words without legal forms, and the forms' codes joined by _ (pvt and ltd lead as pvt_ltd). Unknown countries use the general list."""
    vocabulary = by_country(country, UNIVERSAL_LEGAL, India=INDIA_LEGAL, France=FRANCE_LEGAL)
    codes = F.array_sort(F.array_distinct(F.filter(F.transform(words, lambda x: vocabulary[x]), lambda x: x.isNotNull())))
    both = F.array_contains(codes, "pvt") & F.array_contains(codes, "ltd")
    rest = F.filter(codes, lambda x: ~x.isin("pvt", "ltd"))
    joined = F.array_join(F.when(both, F.concat(F.array(F.lit("pvt_ltd")), rest)).otherwise(codes), "_")
    return F.filter(words, lambda x: vocabulary[x].isNull()), joined


def is_domain(raw: Column) -> Column:
    return raw.rlike(DOMAIN)


def expand_address(words: Column, country: Column) -> Column:
    """Abbreviations spelled out, the country's own first."""
    table = by_country(country, GENERIC_ADDRESS, India=INDIA_ADDRESS, France=FRANCE_ADDRESS)
    return F.transform(words, lambda x: F.coalesce(table[x], x))


def folded_address(address: Column, full: bool = True) -> Column:
    """Lower case and NFKD, with U+0001 for the commas, so that other commas, which NFKD makes one of, part nothing."""
    return folded(F.translate(address, "\u0001,", " \u0001"), full)


def address_components(folded: Column, country: Column) -> Column:
    """Comma-separated parts of a folded address, normalized and spelled out; empty and null-like ones dropped."""
    parts = F.filter(F.transform(F.split(folded, "\u0001"), lambda p: cleaned(p)), lambda x: (x != "") & ~x.isin(NULL_LIKE))
    return F.transform(parts, lambda p: F.array_join(expand_address(tokens(p), country), " "))


def address_numbers(address: Column) -> Column:
    """Runs of digits, Indic ones as ASCII, without leading zeros, each once in order of appearance."""
    plain = F.translate(address, _INDIC, "0123456789" * 9)
    return F.array_distinct(F.transform(F.regexp_extract_all(plain, F.lit(r"(\d+)"), F.lit(1)), lambda x: F.regexp_replace(x, "^0+(.)", "$1")))


def entity_number(entity: Column) -> Column:
    """The number of an id such as S1-12."""
    return F.substring(entity, 4, 18).try_cast("bigint")


def country_code(country: Column, countries: tuple[str, ...] = ("US", "India", "France")) -> Column:
    """The place of a country in the list, 9 for others."""
    return F.coalesce(*[F.when(country == c, i) for i, c in enumerate(countries)], F.lit(9))


def country_norm(country: Column) -> Column:
    return F.lower(F.regexp_replace(F.coalesce(country, F.lit("")), r"(?U)^\s+|\s+$", ""))
