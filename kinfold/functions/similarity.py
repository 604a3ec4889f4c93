"""Similarities of strings and token sets as Column expressions."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

from .text import tokens


def flag(condition: Column) -> Column:
    return F.when(condition, 1.0).otherwise(0.0)


def edit_similarity(a: Column, b: Column) -> Column:
    """1 - distance / longer length; 1 if both are empty, 0 if one is."""
    longer = F.greatest(F.length(a), F.length(b))
    return F.when((a == "") & (b == ""), 1.0).when((a == "") | (b == ""), 0.0).otherwise(1.0 - F.levenshtein(a, b) / longer)


def quick_edit_similarity(a: Column, b: Column) -> Column:
    """Like edit_similarity, but lengths that differ by four fifths or more decide alone."""
    longer, differ = F.greatest(F.length(a), F.length(b)), F.abs(F.length(a) - F.length(b))
    return F.when(a == b, 1.0).when((a == "") | (b == ""), 0.0).when(differ >= 0.8 * longer, 1.0 - differ / longer).otherwise(1.0 - F.levenshtein(a, b) / longer)


def jaccard(a: Column, b: Column) -> Column:
    """Of two arrays as sets; 1 if both are empty."""
    union = F.size(F.array_union(a, b))
    return F.when(union == 0, 1.0).otherwise(F.size(F.array_intersect(a, b)) / union)


def token_jaccard(a: Column, b: Column) -> Column:
    return jaccard(tokens(a), tokens(b))


def token_overlap(a: Column, b: Column) -> Column:
    return F.size(F.array_intersect(tokens(a), tokens(b)))


def grams(x: Column, n: int = 3) -> Column:
    """The set of n-grams; a shorter string is its own. One pass of a pattern that looks ahead, for a lambda over places costs a hundred times as much."""
    return F.when(x == "", F.array().cast("array<string>")).when(F.length(x) < n, F.array(x)).otherwise(F.array_distinct(F.regexp_extract_all(x, F.lit(f"(?s)(?=(.{{{n}}}))"), F.lit(1))))


def gram_jaccard(a: Column, b: Column, n: int = 3) -> Column:
    return F.when(a == b, 1.0).when((a == "") | (b == ""), 0.0).otherwise(jaccard(grams(a, n), grams(b, n)))


def weighted_jaccard(a: Column, b: Column, weights: list[Column], default: float) -> Column:
    """Weight of the shared over that of all tokens; weights: maps by token, the first that has it counts."""

    def total(x: Column) -> Column:
        return F.aggregate(F.array_sort(x), F.lit(0.0), lambda s, t: s + F.coalesce(*[F.try_element_at(w, t) for w in weights], F.lit(default)))

    union = F.array_union(a, b)
    return F.when(F.size(union) == 0, 1.0).when((F.size(a) == 0) | (F.size(b) == 0), 0.0).otherwise(total(F.array_intersect(a, b)) / total(union))


def numbers(address: Column) -> Column:
    return F.filter(tokens(address), lambda t: t.rlike(r"^\p{Nd}+$"))


def number_match(a: Column, b: Column) -> Column:
    """1 if the addresses share a number, 0 if not, -1 if either has none."""
    x, y = numbers(a), numbers(b)
    return F.when((F.size(x) == 0) | (F.size(y) == 0), -1.0).otherwise(flag(F.arrays_overlap(x, y)))


def postal_match(a: Column, b: Column) -> Column:
    """The same for numbers of five or six digits."""
    x, y = (F.filter(numbers(c), lambda t: F.length(t).isin(5, 6)) for c in (a, b))
    return F.when((F.size(x) == 0) | (F.size(y) == 0), -1.0).otherwise(flag(F.arrays_overlap(x, y)))


def stem_match(name: Column, stem: Column, is_domain: Column) -> Column:
    """1 if the stem is one of the name's tokens, 0.75 if either is part of the other, else 0."""
    low, words = F.lower(stem), tokens(F.lower(name))
    joined = F.array_join(words, "")
    return F.when(~is_domain | (stem == ""), 0.0).when(F.array_contains(words, low), 1.0).when(F.contains(joined, low) | F.contains(low, joined), 0.75).otherwise(0.0)


def length_ratio(a: Column, b: Column) -> Column:
    return F.abs(F.length(a) - F.length(b)) / F.greatest(F.length(a), F.length(b), F.lit(1))


def acronym(words: Column) -> Column:
    return F.array_join(F.transform(words, lambda t: F.substring(t, 1, 1)), "")


def country_match(a: Column, b: Column) -> Column:
    """1 if both countries are known and alike but for case, 0 if not, -1 if either isn't known."""
    low = [F.lower(F.coalesce(x, F.lit(""))) for x in (a, b)]
    known = [~x.isin("", "nan", "none", "null") for x in low]
    return F.when(known[0] & known[1], flag(low[0] == low[1])).otherwise(-1.0)


#: Other names.
name_jaccard, name_edit_similarity, address_token_overlap = token_jaccard, edit_similarity, token_overlap
