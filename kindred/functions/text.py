"""Column functions on strings and sets."""

from __future__ import annotations

import unicodedata

import pandas as pd
from pyspark.sql import Column
from pyspark.sql import functions as F


def _folded(text: pd.Series) -> pd.Series:
    def fold(t: str | None) -> str:
        if not t:
            return ""
        if t.isascii():
            return t
        for ligature, letters in (("œ", "oe"), ("Œ", "Oe"), ("æ", "ae"), ("Æ", "Ae")):
            t = t.replace(ligature, letters)
        return "".join(c for c in unicodedata.normalize("NFKD", t) if not unicodedata.combining(c))

    return text.map(fold, na_action=None)


def fold_accents(text: Column | str) -> Column:
    """Ligatures spelt out, compatibility decomposition, combining marks dropped. A null is an empty string.

    Spark has no Unicode normaliser, so this is an Arrow UDF; ASCII values pass through it untouched.
    """
    return F.pandas_udf(_folded, "string")(text)


def squeezed(text: Column) -> Column:
    """Everything but letters, numbers and _ becomes one space; none at the ends."""
    return F.trim(F.regexp_replace(text, r"(?U)[^\p{L}\p{N}_]+", " "))


def joined(squeezed_text: Column) -> Column:
    """A squeezed text without its spaces, which are its only white space."""
    return F.replace(squeezed_text, F.lit(" "), F.lit(""))


def words(text: Column) -> Column:
    return F.filter(F.split(text, " "), lambda w: w != "")


def characters(text: Column) -> Column:
    return F.filter(F.split(text, ""), lambda c: c != "")


def grams(text: Column, n: int) -> Column:
    """Distinct n-grams; the text itself if it is shorter; none of an empty text. Linear in the text's length."""
    chars = characters(text)
    every = F.zip_with(chars, F.slice(chars, 2, F.greatest(F.length(text), F.lit(1))), lambda x, y: F.concat(x, y))
    for k in range(2, n):
        every = F.zip_with(every, F.slice(chars, k + 1, F.greatest(F.length(text), F.lit(1))), lambda x, y: F.concat(x, y))
    return (
        F.when(F.length(text) >= n, F.array_distinct(F.slice(every, F.lit(1), F.greatest(F.length(text) - (n - 1), F.lit(0)))))
        .when(F.length(text) > 0, F.array(text))
        .otherwise(F.array().cast("array<string>"))
    )


def jaccard(a: Column, b: Column) -> Column:
    """0 if either set is empty. The arrays must be distinct."""
    shared = F.size(F.array_intersect(a, b))
    return F.when((F.size(a) == 0) | (F.size(b) == 0), F.lit(0.0)).otherwise(shared / (F.size(a) + F.size(b) - shared))


def edit_similarity(a: Column, b: Column, cap: int | None = 80) -> Column:
    """1 - distance / longer length; 0 if either is empty, 1 if they are equal. Both are cut to `cap` characters; None: whole."""
    x, y = (a, b) if cap is None else (F.left(a, F.lit(cap)), F.left(b, F.lit(cap)))
    far = F.levenshtein(x, y) / F.greatest(F.length(x), F.length(y))
    return F.when((F.length(a) == 0) | (F.length(b) == 0), F.lit(0.0)).when(a == b, F.lit(1.0)).otherwise(F.lit(1.0) - far)


def edit_distance(a: str, b: str) -> int:
    """Levenshtein distance of whole texts: a column of the matrix is the bits of one integer (Myers, Hyyrö)."""
    text, pattern = sorted((a, b), key=len)
    first = next((i for i, c in enumerate(text) if c != pattern[i]), len(text))
    text, pattern = text[first:], pattern[first:]
    last = next((i for i in range(len(text)) if text[-1 - i] != pattern[-1 - i]), len(text))
    text, pattern = text[: len(text) - last], pattern[: len(pattern) - last]
    if not text:
        return len(pattern)
    at: dict[str, int] = {}
    for i, c in enumerate(pattern):
        at[c] = at.get(c, 0) | 1 << i
    every, end = (1 << len(pattern)) - 1, 1 << len(pattern) - 1
    up, down, distance = every, 0, len(pattern)
    for c in text:
        x = at.get(c, 0) | down
        diagonal = (((x & up) + up) ^ up | x) & every
        right, left = down | every ^ (diagonal | up), diagonal & up
        distance += bool(right & end) - bool(left & end)
        right, left = right << 1 | 1, left << 1
        up, down = (left | every ^ (every & (diagonal | right))) & every, right & diagonal
    return distance


def common_prefix(a: Column, b: Column) -> Column:
    """How many leading characters agree."""
    n = F.least(F.length(a), F.length(b))
    differs = F.array_position(F.zip_with(characters(a), characters(b), lambda x, y: F.coalesce(x == y, F.lit(False))), False)
    return F.when(n == 0, F.lit(0)).when(differs > 0, (differs - 1).cast("int")).otherwise(n)


def common_suffix(a: Column, b: Column) -> Column:
    return common_prefix(F.reverse(a), F.reverse(b))


def has_non_latin(text: Column) -> Column:
    """Whether a letter lies beyond U+024F."""
    return text.rlike(r"[\p{L}&&[^\x{0}-\x{24F}]]")


def flag(condition: Column) -> Column:
    return F.coalesce(condition, F.lit(False)).cast("double")
