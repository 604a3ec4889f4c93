"""Normalisation of names, addresses, domains and countries as Column expressions.

Everything but the Unicode normal forms is built in. Those are an Arrow UDF that
gets nulls for rows of plain ASCII, which no normal form changes.
"""

from __future__ import annotations

import unicodedata

import pandas as pd
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import StringType

from . import constants as C

EDGE = " ,.-_"
CUT = "\u0001"


def let(value: Column, body) -> Column:
    """body(value) with the value worked out once, however often body names it."""
    return F.transform(F.array(value), body)[0]


def settle(df: DataFrame, **columns: Column) -> DataFrame:
    """df with the columns, worked out once a row: the optimiser can't copy their expressions into what reads them, as it does with plain projections."""
    return df.select("*", F.explode(F.array(F.struct(*[c.alias(n) for n, c in columns.items()]))).alias("_settled")).select(*[F.col(f"`{c}`") for c in df.columns if c not in columns], *[F.col(f"_settled.{n}").alias(n) for n in columns])


def lookup(table: dict[str, str], key: Column) -> Column:
    """The table's value, null where it has none."""
    return F.try_element_at(F.create_map(*[F.lit(x) for pair in table.items() for x in pair]), key)


def strip(x: Column) -> Column:
    """Without white space of any kind at its ends."""
    return F.regexp_replace(x, r"(?U)^\s+|\s+$", "")


def strip_chars(x: Column, chars: str) -> Column:
    return F.btrim(x, F.lit(chars))


def is_missing(x: Column) -> Column:
    return x.isNull() | F.lower(strip(x)).isin(*C.NULL_LITERALS)


def is_ascii(x: Column) -> Column:
    return x.rlike(r"^[\x00-\x7F]*\z")


@F.pandas_udf(StringType())
def _nfkc(x: pd.Series) -> pd.Series:
    return x.map(lambda s: None if s is None else unicodedata.normalize("NFKC", s))


@F.pandas_udf(StringType())
def _base_letters(x: pd.Series) -> pd.Series:
    return x.map(lambda s: None if s is None else unicodedata.normalize("NFKD", s).encode("ascii", "ignore").decode())


def nfkc(x: Column) -> Column:
    return F.when(is_ascii(x), x).otherwise(_nfkc(F.when(~is_ascii(x), x)))


def strip_accents(x: Column) -> Column:
    """Decomposed, and only its ASCII characters."""
    return F.when(is_ascii(x), x).otherwise(_base_letters(F.when(~is_ascii(x), x)))


def clean(x: Column) -> Column:
    """Runs of what is no letter, mark or number as one space; none at the ends."""
    return F.trim(F.regexp_replace(x, r"[^\p{L}\p{M}\p{N}]+", " "))


def tokens(x: Column) -> Column:
    return F.filter(F.split(x, " "), lambda t: t != "")


def spell_and(x: Column) -> Column:
    return F.replace(x, F.lit("&"), F.lit(" and "))


def letters_of(x: Column, ranges: tuple[tuple[str, str], ...]) -> Column:
    """How many letters and marks of x lie in the ranges."""
    inside = "".join(f"\\x{{{a}}}-\\x{{{b}}}" for a, b in ranges)
    return F.length(F.regexp_replace(x, rf"[^[\p{{L}}\p{{M}}&&[{inside}]]]", ""))


def script_counts(x: Column) -> dict[str, Column]:
    """By script; "all" has letters and marks of any."""
    found = {name: letters_of(x, ranges) for name, ranges in C.SCRIPTS}
    found["all"] = F.length(F.regexp_replace(x, r"[^\p{L}\p{M}]", ""))
    return found


def script_from_counts(counts: dict[str, Column]) -> Column:
    """The script of most letters, "mixed" or "unknown"."""
    names = [name for name, _ in C.SCRIPTS]

    def decide(n: Column) -> Column:
        total, every = n["all"], {**{x: n[x] for x in names}, "other": n["other"]}
        most = F.greatest(*every.values())
        dominant = F.coalesce(*[F.when(c == most, F.lit(name)) for name, c in every.items()])

        def mixed(d: Column) -> Column:
            second = F.lit(False)
            for name, c in every.items():
                second = second | ((d != name) & (c >= 2) & ((c >= 0.05 * total) | (c >= 3)))
            return F.when(total == 0, "unknown").when(second | (most < 0.7 * total), "mixed").otherwise(d)

        return let(dominant, mixed)

    known = F.struct(*[counts[x].alias(x) for x in names], counts["all"].alias("all"))
    whole = lambda n: F.struct(*[n[x].alias(x) for x in names], n["all"].alias("all"), (n["all"] - sum((n[x] for x in names[1:]), n[names[0]])).alias("other"))
    return let(let(known, whole), decide)


def detect_script(x: Column) -> Column:
    return F.when(is_missing(x), "unknown").otherwise(script_from_counts(script_counts(x)))


def normalise_country(x: Column) -> Column:
    u = strip(nfkc(x))
    return F.when(is_missing(x), "").otherwise(F.coalesce(lookup(C.COUNTRIES, F.lower(u)), F.when(F.length(u) <= 3, F.upper(u)).otherwise(F.initcap(u))))


def _spellings(forms: tuple[str, ...]) -> str:
    return "|".join(f.replace(".", r"\.") for f in forms)


def legal_patterns(forms=C.LEGAL_FORMS) -> list[tuple[str, str, str, str]]:
    """Canonical form and the patterns for it at the end, start and middle; groups hold what is left of the name."""
    out = []
    for canon, spellings in forms:
        out.append((canon, *(p.replace("{0}", _spellings(spellings)) for p in C.FORM_AT)))
    return out


FLAGS = "(?iusU)"


def legal_form(x: Column, forms=C.LEGAL_FORMS) -> Column:
    """canon + CUT + the name without it; null if the name has none. x: a column of its own, without white space at its ends.

    First a form split around the name, then each form at the end, then at the start, then inside; an empty rest
    doesn't count. One expression that stops at the first hit; names without any spelling skip it."""

    def found(canon: str, rest: Column) -> Column:
        return let(strip_chars(rest, EDGE), lambda r: F.when(r != "", F.concat(F.lit(canon + CUT), r)))

    patterns = legal_patterns(forms)
    steps = [found("pvt_ltd", F.regexp_extract(x, C.SPLIT_FORM, 1))]
    steps += [found(canon, F.regexp_extract(x, FLAGS + end, 1)) for canon, end, _, _ in patterns]
    steps += [found(canon, F.regexp_extract(x, FLAGS + start, 1)) for canon, _, start, _ in patterns]
    steps += [F.when(x.rlike(FLAGS + inside), found(canon, F.regexp_replace(F.concat(F.regexp_extract(x, FLAGS + inside, 1), F.lit(" "), F.regexp_extract(x, FLAGS + inside, 2)), r"(?U)\s+", " "))) for canon, _, _, inside in patterns]
    every = "|".join(_spellings(s) for _, s in forms)
    return F.when(x.rlike(rf"(?iuU)(?:^|[\s,])(?:{every}|pvt\.?|private)(?:\.|[\s,]|$)"), F.coalesce(*steps))


def domain_stem(name: Column) -> Column:
    """The main label of the first domain in the name; null if there is none."""
    domain = F.regexp_replace(F.lower(F.regexp_extract(name, C.DOMAIN, 1)), r"^www\.", "")
    parts = F.split(F.regexp_replace(domain, rf"\.(?:{C.TLDS})$", ""), r"\.")
    main = let(parts, lambda p: F.when((F.size(p) > 1) & ~F.element_at(p, -1).isin("co", "com"), F.element_at(p, -1)).otherwise(p[0]))
    return F.when(name.rlike(C.DOMAIN), main)


def without_url(name: Column, stem: Column) -> Column:
    """The name without a piped URL; the words of the stem if nothing is left."""
    rest = strip_chars(F.regexp_replace(name, C.PIPED_URL, ""), " |,.-_")
    return F.when(stem.isNull(), name).otherwise(let(rest, lambda r: F.when(r != "", r).otherwise(let(F.trim(F.regexp_replace(stem, "[-_.]", " ")), lambda w: F.when(w != "", w).otherwise(name)))))


def core_domain(name: Column) -> Column:
    """Struct of stem and compact: the core of the domain that the string is or has; empty strings if it has none."""
    text = strip(name)
    back = F.reverse(F.filter(F.transform(F.split(text, r"\|"), strip), lambda p: p != ""))

    def part(b: Column) -> Column:
        sure = F.filter(b, lambda p: p.rlike(r"(?i)https?://|www\d*\.") | p.rlike("(?i)" + C.EXTENDED))
        likely = F.filter(b, lambda p: p.rlike(r"(?i)\.[a-z]{2,}"))
        return F.coalesce(F.get(sure, F.lit(0)), F.get(likely, F.lit(0)), F.get(b, F.lit(0)))

    s = strip_accents(F.lower(F.when(text.contains("|"), let(back, part)).otherwise(text)))

    def read(s: Column) -> Column:
        shown = s.rlike(r"^https?://") | s.rlike(r"\bwww\d*\.") | s.rlike(C.EXTENDED)
        host = strip(F.split(F.regexp_replace(s, r"^(?:https?://)?(?:www\d*\.)?", ""), r"(?U)[:/?#\s]", 2)[0])
        return F.when(shown, strip_chars(F.regexp_replace(host, C.EXTENDED, ""), ".-_ "))

    def core(bare: Column) -> Column:
        def choose(labels: Column) -> Column:
            telling = F.filter(labels, lambda p: ~p.isin(*C.SUBDOMAINS))
            return F.when(F.size(labels) > 1, F.coalesce(F.try_element_at(telling, F.lit(-1)), F.try_element_at(labels, F.lit(-1)))).otherwise(bare)

        return let(F.filter(F.split(bare, r"\."), lambda p: p != ""), choose)

    def name_it(c: Column) -> Column:
        def both(compact: Column) -> Column:
            good = F.coalesce(F.length(compact) >= 2, F.lit(False))
            return F.struct(F.when(good, F.trim(F.regexp_replace(c, "[-_.]+", " "))).otherwise("").alias("stem"), F.when(good, compact).otherwise("").alias("compact"))

        return let(F.regexp_replace(c, "[^a-z0-9]", ""), both)

    return let(let(let(s, read), core), name_it)


def address_tokens(lowered: Column, abbreviations: dict[str, str] = C.ADDRESS_ABBREVIATIONS) -> Column:
    """Tokens of a lower-cased address: box numbers joined, null words dropped, abbreviations spelt out."""
    boxed = F.regexp_replace(lowered, r"(?U)\bp\.?\s*o\.?\s*box\b", "pobox")
    kept = F.filter(tokens(clean(boxed)), lambda t: ~t.isin(*C.ADDRESS_NULL_TOKENS))
    return F.transform(kept, lambda t: F.coalesce(lookup(abbreviations, t), t))


def domain_tokens(stem: Column) -> Column:
    """The words of a domain's stem."""
    return F.filter(F.split(F.coalesce(stem, F.lit("")), "[-_.]+"), lambda w: w != "")


def normalise_name(x: Column) -> Column:
    """A name's normal form, "" for a missing one."""
    return F.when(is_missing(x), "").otherwise(F.coalesce(clean(spell_and(F.lower(strip(nfkc(x))))), F.lit("")))


def normalise_address(x: Column) -> Column:
    """An address's normal form, "" for a missing one."""
    return F.when(is_missing(x), "").otherwise(F.coalesce(F.array_join(address_tokens(F.lower(strip(nfkc(x)))), " "), F.lit("")))
