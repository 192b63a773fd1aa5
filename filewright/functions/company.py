"""Company names (C1-C9): endings, normal form and slug, as Column expressions that stay inside code generation."""

from __future__ import annotations

from pyspark.sql import Column, functions as F

from filewright.functions.scalars import any_of, blank_to_null, let, replace_first, squeeze, trim_all
from filewright.functions.vocab import ENDINGS_KEPT, ENDINGS_STRIPPED, LEGAL_FORMS, RENAMED

#: In compat mode the last stripped entry is taken as the character class that its brackets spell.
_CLASS = ENDINGS_STRIPPED[-1]


def endings(compat: bool = False) -> str:
    words = any_of(ENDINGS_STRIPPED[:-1]) + "|" + (_CLASS if compat else any_of([_CLASS]))
    return f"{any_of(ENDINGS_KEPT)}|{words}|{'|'.join(LEGAL_FORMS)}"


def stripped(compat: bool = False) -> str:
    """The endings that can be stripped: the phrase that ends in COMPANY loses that word first, and then is none."""
    return any_of(ENDINGS_STRIPPED[:-2]) + ("|" + _CLASS if compat else "")


def has_ending(c: Column, compat: bool = False) -> Column:
    """The name ends like a company's."""
    return F.coalesce(trim_all(c).rlike(rf"(?i)\b(?:{endings(compat)})\z"), F.lit(False))


def is_ending(c: Column, compat: bool = False) -> Column:
    """The whole text is an ending."""
    return F.coalesce(trim_all(c).rlike(rf"(?i)^(?:{endings(compat)})\z"), F.lit(False))


def has_anywhere(c: Column, compat: bool = False) -> Column:
    """An ending stands as a word anywhere."""
    return F.coalesce(trim_all(c).rlike(rf"(?i)\b(?:{endings(compat)})\b"), F.lit(False))


def strip_endings(c: Column, compat: bool = False) -> Column:
    """Without punctuation, and without any of the stripped endings at the end, however many there are."""
    c = squeeze(F.regexp_replace(c, "[.,;:!?]", ""))
    phrase = "" if compat else rf"|\s*{any_of([_CLASS])}"  # begins with no letter, so no word boundary before it
    return trim_all(F.regexp_replace(c, rf"(?i)(?:\s*\b(?:{stripped(compat)}){phrase})+\s*\z", ""))


def remove_phrases(c: Column) -> Column:
    """C4: without the first of two phrases, a comma and a full stop."""
    for literal in (*ENDINGS_STRIPPED[-2:], ",", "."):
        c = trim_all(replace_first(c, literal))
    return c


def renamed(c: Column) -> Column:
    """C6."""
    names = F.create_map(*(F.lit(x) for pair in RENAMED.items() for x in pair))
    return let(c, lambda x: F.coalesce(F.try_element_at(names, F.lower(x)), x))


def normal_name(c: Column, compat: bool = False) -> Column:
    """The normal form of a company's name; null if nothing is left."""
    return blank_to_null(remove_phrases(renamed(strip_endings(c, compat))))


#: Digits and letters that nothing stripped from a name has.
_LASTING = "".join(x for x in "0123456789abcdefghijklmnopqrstuvwxyz" if x not in "".join(ENDINGS_STRIPPED).lower())


def is_nameless(c: Column) -> Column:
    """The name normalizes to nothing. Most names show by a letter that is never stripped that they don't."""
    return F.when(c.rlike(f"(?i)[{_LASTING}]"), F.lit(False)).otherwise(normal_name(c).isNull())


def fold(c: Column) -> Column:
    """Letters of Latin-1 and Latin Extended-A without their marks."""
    import unicodedata

    pairs = [(chr(i), unicodedata.normalize("NFD", chr(i))) for i in range(0xC0, 0x180)]
    pairs = [(a, b[0]) for a, b in pairs if len(b) > 1]
    return F.regexp_replace(F.translate(c, "".join(a for a, _ in pairs), "".join(b for _, b in pairs)), "[\\u0300-\\u036f]", "")


def slug(c: Column) -> Column:
    """The key of a company, from its name."""
    c = F.regexp_replace(F.lower(trim_all(c)), "\\s+", "-")
    c = fold(F.replace(F.regexp_replace(c, "-&-", "-and-"), F.lit("/"), F.lit("-")))
    return F.regexp_replace(F.replace(c, F.lit("--"), F.lit("-")), "^-|-\\z", "")


def company(name: Column, cik: Column | None = None, crd: Column | None = None, compat: bool = False) -> Column:
    """(company_hash_id, company_name, cik, crd), null if the name normalizes to nothing; 0 and '' become null."""
    cik = F.lit(None).cast("long") if cik is None else F.nullif(cik.cast("long"), F.lit(0))
    crd = F.lit(None).cast("string") if crd is None else F.nullif(crd.cast("string"), F.lit(""))
    row = lambda n: F.when(n.isNotNull(), F.struct(slug(n).alias("company_hash_id"), n.alias("company_name"), cik.alias("cik"), crd.alias("crd")))
    return let(normal_name(name, compat), row)
