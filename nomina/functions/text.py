"""Name clean-up as native column expressions (no Python workers involved)."""

from __future__ import annotations

import unicodedata
from collections.abc import Callable

from pyspark.sql import Column
from pyspark.sql import functions as F

# --- Fixed values -----------------------------------------------------------

# Characters Python's str.strip and \s treat as white space. SQL TRIM only knows U+0020.
WHITESPACE = (
    "\t\n\x0b\x0c\r\x1c\x1d\x1e\x1f \x85\xa0\u1680"
    "\u2000\u2001\u2002\u2003\u2004\u2005\u2006\u2007\u2008\u2009\u200a"
    "\u2028\u2029\u202f\u205f\u3000"
)
# Java's \w and \d are ASCII-only, so Unicode classes are spelled out.
WORD = r"\p{L}\p{N}_"
DIGITS = r"\p{Nd}+"

# Legal-form words removed from Russian names, in order of removal.
LEGAL_FORM_WORDS = [
    "ооо",
    "OOO",
    "OAO",
    "AO",
    "ЗАО",
    "ОАО",
    "ПАО",
    "АО",
    "ЗАО",
    "ОАО",
    "ПАО",
    "АО",
    "ЗАО",
    "общество с огранниченной ответственностью",
    "оао",
    "ао",
    "гк",
    "зао",
    "лтд",
    "нпф",
    "групп",
    "дистрибьюшн",
    "лимитед",
]

# Organisation terms dropped from the end of a name; "." inside a term is literal.
ORGANISATION_SUFFIXES = [
    "a.b.", "a.g.", "a.s.", "a/s", "ab", "ag", "aps", "as", "asa", "b.v.", "bhd", "bv", "bvba",
    "c.a.", "c.v.", "co", "company", "corp", "corporation", "d.o.o.", "doo", "e.v.", "eood", "ev",
    "gesmbh", "gmbh", "gmbh & co kg", "gmbh & co. kg", "hf", "inc", "incorporated", "k.k.", "k.s.",
    "kft", "kg", "kgaa", "kk", "l.l.c.", "l.l.p.", "l.p.", "lda", "limited", "llc", "llp", "lp",
    "ltd", "ltda", "mbh", "n.v.", "nv", "nyrt", "ohg", "ood", "oy", "oyj", "p.l.c.", "plc",
    "private limited", "pt", "pte", "pte ltd", "pty", "pty ltd", "pvt", "pvt ltd", "s.a.", "s.a.i.c.",
    "s.a.r.l.", "s.a.s.", "s.l.", "s.p.a.", "s.r.l.", "s.r.o.", "sa", "sarl", "sas", "sdn bhd", "se",
    "sia", "sl", "sp. z o.o.", "spa", "spol. s r.o.", "srl", "sro", "uab", "ug", "zrt",
]

# Latin spellings of Cyrillic letters that take exactly one character ...
CYRILLIC_SINGLE = {
    "а": "a", "б": "b", "в": "v", "г": "g", "д": "d", "е": "e", "з": "z", "и": "i", "й": "i",
    "к": "k", "л": "l", "м": "m", "н": "n", "о": "o", "п": "p", "р": "r", "с": "s", "т": "t",
    "у": "u", "ф": "f", "ъ": '"', "ы": "y", "ь": "'", "э": "e", "і": "i",
}
# ... and of those that take several.
CYRILLIC_MULTI = {
    "ё": "io", "ж": "zh", "х": "kh", "ц": "ts", "ч": "ch", "ш": "sh", "щ": "shch", "ю": "iu",
    "я": "ia", "є": "ie", "ї": "yi",
}
# Latin letters that Unicode does not decompose into a base letter plus a mark.
LATIN_SINGLE = {"ø": "o", "Ø": "O", "ł": "l", "Ł": "L", "đ": "d", "Đ": "D", "ð": "d", "Ð": "D", "ħ": "h", "ı": "i"}
LATIN_MULTI = {"ß": "ss", "ẞ": "Ss", "æ": "ae", "Æ": "AE", "œ": "oe", "Œ": "OE", "þ": "th", "Þ": "Th"}
PUNCTUATION_SINGLE = {"“": '"', "”": '"', "„": '"', "‘": "'", "’": "'", "–": "-", "\xa0": " "}
PUNCTUATION_MULTI = {"«": "<<", "»": ">>", "—": "--", "…": "...", "№": "No", "€": "EUR"}

# --- Tables derived from the fixed values ------------------------------------


def _accented_latin() -> dict[str, str]:
    """Accented letters of the Latin blocks mapped to their base letter (rule: canonical decomposition)."""
    blocks = [*range(0xC0, 0x250), *range(0x1E00, 0x1F00)]
    bases = {chr(cp): unicodedata.normalize("NFD", chr(cp))[0] for cp in blocks}
    return {ch: base for ch, base in bases.items() if ch != base and base.isascii()}


def _with_upper(table: dict[str, str]) -> dict[str, str]:
    return table | {ch.upper(): latin.capitalize() for ch, latin in table.items() if ch.upper() != ch}


SINGLE_LETTERS = _with_upper(CYRILLIC_SINGLE) | _accented_latin() | LATIN_SINGLE | PUNCTUATION_SINGLE
MULTI_LETTERS = _with_upper(CYRILLIC_MULTI) | LATIN_MULTI | PUNCTUATION_MULTI


def _literal_pattern(text: str) -> str:
    return "".join(f"\\{ch}" if ch in r".&/|()[]{}*+?^$" else ch for ch in text)


def _suffix_pattern() -> str:
    """Anchored tail: any run of (separator, organisation term), then trailing punctuation."""
    terms = sorted(ORGANISATION_SUFFIXES, key=lambda t: (-len(t), t))
    alternatives = "|".join(_literal_pattern(t) for t in terms)
    return rf"(?i)(?:[^{WORD}]+(?:{alternatives})\.?)*[^{WORD}.]*\z"


SUFFIX_PATTERN = _suffix_pattern()

# --- Steps --------------------------------------------------------------------


def strip(c: Column) -> Column:
    return F.btrim(c, F.lit(WHITESPACE))


def lowercase(c: Column) -> Column:
    return F.lower(c)


def remove_legal_forms(c: Column) -> Column:
    """Drop legal-form words wherever they occur, also inside words.

    Which words apply is decided on the original text; they are then removed in
    list order, so a word that an earlier removal puts together stays.
    """
    rest = c
    for word in LEGAL_FORM_WORDS:
        # Replacing the empty string changes nothing, which keeps `rest` a single reference.
        rest = F.replace(rest, F.when(c.contains(word), word).otherwise(""), F.lit(""))
    return strip(rest)


def remove_organisation_suffixes(c: Column) -> Column:
    """Drop trailing organisation terms (LLC, Ltd, GmbH ...) and trailing punctuation."""
    return strip(F.regexp_replace(c, SUFFIX_PATTERN, ""))


def _eliminate(c: Column, pattern: str) -> Column:
    spaced = strip(F.regexp_replace(c, pattern, " "))
    # Runs of two or more blanks vanish altogether: "a 1 b" becomes "ab", "a1b" becomes "a b".
    return F.regexp_replace(spaced, f"[{WHITESPACE}]{{2,}}", "")


def remove_numbers(c: Column) -> Column:
    return _eliminate(c, DIGITS)


def remove_non_words(c: Column) -> Column:
    return _eliminate(c, f"[^{WORD}]+")


def transliterate(c: Column) -> Column:
    """Spell Cyrillic and accented Latin letters in ASCII; other scripts are kept."""
    singles = "".join(SINGLE_LETTERS)
    out = F.translate(c, singles, "".join(SINGLE_LETTERS[ch] for ch in singles))
    for letter, latin in MULTI_LETTERS.items():
        out = F.replace(out, F.lit(letter), F.lit(latin))
    return out


def capitalize(c: Column) -> Column:
    """First letter upper case, the rest lower case (not one capital per word)."""
    return F.concat(F.upper(F.substring(c, 1, 1)), F.lower(F.substring(c, 2, 2**31 - 1)))


def normalize(c: Column, extract_entity: Callable[[Column], Column] | None = None) -> Column:
    """The whole clean-up. The order matters: the steps do not commute."""
    if extract_entity is not None:
        c = extract_entity(c)
    for step in (
        remove_legal_forms,
        remove_organisation_suffixes,
        remove_numbers,
        remove_non_words,
        transliterate,
        lowercase,
    ):
        c = step(c)
    return c


# --- Tokens -------------------------------------------------------------------


def words(c: Column) -> Column:
    """Tokens between runs of white space."""
    return F.array_remove(F.split(strip(c), f"[{WHITESPACE}]+"), "")


def index_terms(c: Column) -> Column:
    """Lower-cased word tokens as a full-text index sees them; dots and apostrophes inside words stay."""
    return F.regexp_extract_all(F.lower(c), F.lit(rf"[{WORD}]+(?:[.'][{WORD}]+)*"), F.lit(0))


# --- URLs ---------------------------------------------------------------------


def percent_decode(c: Column) -> Column:
    """Decode %XX escapes; "+" and malformed escapes stay as they are."""
    sound = F.regexp_replace(F.replace(c, F.lit("+"), F.lit("%2B")), "%(?![0-9A-Fa-f]{2})", "%25")
    return F.coalesce(F.try_url_decode(sound), c)


def plus_for_spaces(c: Column) -> Column:
    return F.replace(c, F.lit(" "), F.lit("+"))
