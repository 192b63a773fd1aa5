"""Person names (R1, R2): a grammar of titles, particles, suffixes and nicknames, as Column expressions."""

from __future__ import annotations

from pyspark.sql import Column, functions as F

from filewright.functions.scalars import any_of, let, replace_first, squeeze

# Words before a name, after a name, and those that belong to the family name.
TITLES = ["dr", "mr", "mrs", "ms", "prof", "hon", "rev", "sir"]
SUFFIXES = {"jr": "Jr.", "2nd": "Jr.", "sr": "Sr.", "ii": "II", "iii": "III", "iv": "IV", "v": "V", "esq": "Esq.", "phd": "PhD", "md": "MD", "cpa": "CPA"}
PARTICLES = ["del", "de", "la", "van", "von", "der", "den", "di", "da", "le", "bin", "al", "st"]


def fix_case(c: Column) -> Column:
    """Capital letters at the start of words, after hyphens and after O' and D'."""
    joined = F.array_join(F.transform(F.split(F.lower(c), "-"), lambda p: F.initcap(p)), "-")
    irish = lambda j: F.when(j.rlike("^[OD]'[a-z]"), F.concat(F.substring(j, 1, 2), F.upper(F.substring(j, 3, 1)), j.substr(F.lit(4), F.length(j)))).otherwise(j)
    return let(joined, irish)


def _bare(w: Column) -> Column:
    return F.replace(F.lower(w), F.lit("."), F.lit(""))


def _in_order(text: Column) -> Column:
    """"Last, First" turns round unless a suffix follows the comma."""
    ends = any_of(list(SUFFIXES))
    after = F.regexp_extract(text, "^([^,]+),\\s*(.+)\\z", 2)
    turns = text.contains(",") & (after != "") & ~F.lower(after).rlike(rf"^(?:{ends})\.?\z")
    return F.when(turns, F.concat(after, F.lit(" "), F.regexp_extract(text, "^([^,]+),", 1))).otherwise(text)


def _titled(words: Column) -> Column:
    """(title, words without it)."""
    has = _bare(F.get(words, F.lit(0))).isin(TITLES)
    return F.struct(F.when(has, F.get(words, F.lit(0))).alias("title"), F.when(has, F.slice(words, F.lit(2), F.greatest(F.size(words) - 1, F.lit(0)))).otherwise(words).alias("words"))


def _suffixed(t: Column) -> Column:
    """(title, suffix, words without them)."""
    known = F.create_map(*(F.lit(x) for pair in SUFFIXES.items() for x in pair))
    found = F.when(F.size(t["words"]) > 2, F.try_element_at(known, _bare(F.get(t["words"], F.size(t["words"]) - 1))))
    return F.struct(t["title"].alias("title"), found.alias("suffix"), F.when(found.isNotNull(), F.slice(t["words"], F.lit(1), F.size(t["words"]) - 1)).otherwise(t["words"]).alias("words"))


def _named(t: Column) -> Column:
    """The parts of the name, null unless there are two words."""
    words = t["words"]
    n = F.size(words)
    before = F.get(words, n - 2)
    split = F.when((n > 2) & F.lower(before).isin(PARTICLES), n - 2).otherwise(n - 1)
    middle = F.array_join(F.transform(F.slice(words, F.lit(2), F.greatest(split - 1, F.lit(0))), fix_case), " ")
    last = F.concat_ws(" ", F.when(split < n - 1, F.lower(before)), fix_case(F.get(words, n - 1)))
    parts = F.struct(fix_case(F.get(words, F.lit(0))).alias("first"), middle.alias("middle"), last.alias("last"), F.coalesce(t["suffix"], F.lit("")).alias("suffix"), F.coalesce(fix_case(t["title"]), F.lit("")).alias("title"))
    return F.when(n >= 2, parts)


def person(name: Column, cik: Column | None = None, crd: Column | None = None) -> Column:
    """(first, middle, last, suffix, title, nick, cik, crd, person_hash_id), null without a first and last name."""
    cik = F.lit(None).cast("long") if cik is None else F.nullif(cik.cast("long"), F.lit(0))
    crd = F.lit(None).cast("string") if crd is None else F.nullif(crd.cast("string"), F.lit(""))

    def row(text: Column) -> Column:
        nick = F.regexp_extract(text, "[\"(“]([^\")”]+)[\")”]", 1)
        plain = squeeze(F.regexp_replace(text, "[\"(“][^\")”]*[\")”]", " "))
        words = let(plain, lambda x: F.filter(F.split(F.replace(_in_order(x), F.lit(","), F.lit(" ")), "\\s+"), lambda w: w != ""))
        parts = let(let(let(words, _titled), _suffixed), _named)
        fields = ("first", "middle", "last", "suffix", "title")
        whole = lambda p: F.when(p.isNotNull(), F.struct(*(p[f].alias(f) for f in fields), nick.alias("nick"), cik.alias("cik"), crd.alias("crd"), slug(p["first"], p["middle"], nick, p["last"], p["suffix"]).alias("person_hash_id")))
        return let(parts, whole)

    return let(squeeze(replace_first(name, "/s/")), row)


def is_nameless(name: Column) -> Column:
    """The name has no first and last name. Two plain words without a title before them are always some."""
    plain = rf"(?i)^(?!(?:{any_of(TITLES)}) )[a-z0-9]+(?: [a-z0-9]+)+\z"
    return F.when(name.rlike(plain), F.lit(False)).otherwise(person(name).isNull())


def slug(*parts: Column) -> Column:
    """R2: the parts that aren't null, joined by dashes, lower-cased, with single dashes and none at the ends."""
    c = F.lower(F.concat_ws("-", *parts))
    c = F.regexp_replace(F.regexp_replace(c, "[. ]", "-"), "--+", "-")
    return F.regexp_replace(squeeze(c), "^-|-\\z", "")
