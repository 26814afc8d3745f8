"""Several views of names and addresses, as projections."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from kindred.functions import fixed
from kindred.functions.text import fold_accents, grams, joined, squeezed, words

def _factored(patterns: list[str]) -> str:
    r"""One pattern for alternatives of the form \b(x)\b, with what all begin with tested once: the first letter, then \b."""
    assert all(p.startswith(r"\b(") and p.endswith(r")\b") and p[3].isalpha() for p in patterns)
    inner = [p[3:-3] for p in patterns]
    letters = "".join(sorted({way[0] for p in inner for way in p.split("|")}))
    return f"(?=[{letters}])\\b(?:{'|'.join(f'(?:{p})' for p in inner)})\\b"


LEGAL = "(?iU)" + _factored(fixed.LEGAL_SUFFIXES)


def country_of(country: Column) -> Column:
    return F.upper(F.trim(F.coalesce(country, F.lit(""))))


def unleet(text: Column) -> Column:
    """Digits and signs that stand for letters inside words."""
    s = F.regexp_replace(text, "^[@#]+", "")
    s = F.replace(F.replace(s, F.lit("@"), F.lit("a")), F.lit("$"), F.lit("s"))
    for digit, letter in (("0", "o"), ("8", "b"), ("1", "l")):
        s = F.regexp_replace(s, f"(?<=[a-zA-Z]){digit}(?=[a-zA-Z])", letter)
    return F.regexp_replace(s, r"(?U)\b8(?=[a-zA-Z])", "b")


def without_legal(text: Column) -> Column:
    return F.regexp_replace(text, LEGAL, " ")


def name_text(folded: Column) -> Column:
    """The normalised name of an accent-folded one."""
    s = F.regexp_replace(F.lower(folded), "(?i)" + fixed.URL_PREFIX, "")
    s = F.regexp_replace(s, "(?i)" + fixed.DOMAIN_SUFFIX, "")
    s = F.replace(F.replace(s, F.lit("&"), F.lit(" and ")), F.lit("+"), F.lit(" plus "))
    return squeezed(without_legal(s))


def name_tokens(normalized: Column) -> Column:
    stop = F.array(*map(F.lit, fixed.NAME_STOPWORDS))
    return F.filter(words(normalized), lambda w: ~F.array_contains(stop, w))


def sorted_tokens(tokens: Column) -> Column:
    return F.array_join(F.sort_array(F.array_distinct(tokens)), " ")


def leet_compact(folded: Column) -> Column:
    return joined(squeezed(without_legal(unleet(F.lower(folded)))))


def aliases(raw: Column) -> Column:
    """Names without an honorific, and those before and behind a trade-name marker."""
    plain = F.trim(F.regexp_replace(raw, "(?iU)" + fixed.HONORIFIC, ""))
    parts = r"(?isU)^(.*?)(?=[cdft])" + fixed.TRADE_NAME + "(.*)$"
    before, after = F.trim(F.regexp_extract(raw, parts, 1)), F.trim(F.regexp_extract(raw, parts, 3))
    return F.array_compact(
        F.array(
            F.when((plain != "") & (F.lower(plain) != F.lower(raw)), plain),
            F.when(F.length(before) >= 3, before),
            F.when(F.length(after) >= 3, after),
        )
    )


def alias_compact(folded_alias: Column) -> Column:
    return joined(squeezed(without_legal(F.lower(folded_alias))))


def numbers_of(folded_lower: Column) -> Column:
    found = F.regexp_extract_all(folded_lower, F.lit(r"(?U)(?=\d)\b\d{1,7}\b"), F.lit(0))
    return F.array_distinct(F.transform(found, lambda n: F.when(F.ltrim(n, F.lit("0")) == "", F.lit("0")).otherwise(F.ltrim(n, F.lit("0")))))


def address_words(folded: Column) -> Column:
    """Words with their abbreviations expanded, in order."""
    table = F.create_map(*(F.lit(x) for pair in fixed.ADDRESS_ABBREVIATIONS.items() for x in pair))
    return F.transform(words(squeezed(F.lower(folded))), lambda w: F.coalesce(F.try_element_at(table, w), w))


def salient(tokens: Column) -> Column:
    common = F.array(*map(F.lit, fixed.COMMON_STREET_WORDS))
    return F.filter(tokens, lambda w: (F.length(w) >= 4) & ~F.array_contains(common, w))


def normalized(entities: DataFrame) -> DataFrame:
    """Views of entities (entity_id, business_name, business_address, country and any other columns).

    Empty and null fields have empty views. Accent folding is the only step outside the JVM; it runs once for the name,
    its aliases and the address together.
    """
    return views(texts(entities))


def texts(entities: DataFrame) -> DataFrame:
    """The normalised texts that all other views are worked out from: what is worth keeping of a record."""
    raw = entities.withColumns(
        {
            "name_raw": F.coalesce("business_name", F.lit("")),
            "addr_raw": F.when(F.trim(F.coalesce("business_address", F.lit(""))) == "", F.lit("")).otherwise(F.col("business_address")),
            "country": country_of(F.col("country")),
        }
    ).drop("business_name", "business_address")
    # Folding keeps \x1f, so one call serves all three: name, aliases, address.
    mark = "\x1f"
    packed = F.concat_ws(mark, F.replace("name_raw", F.lit(mark), F.lit(" ")), F.replace("addr_raw", F.lit(mark), F.lit(" ")), F.array_join(F.transform(aliases(F.col("name_raw")), lambda a: F.replace(a, F.lit(mark), F.lit(" "))), mark))
    folded = raw.withColumn("__folded", F.split(fold_accents(packed), mark))
    name, address = F.element_at("__folded", 1), F.element_at("__folded", 2)
    more = F.filter(F.slice("__folded", 3, F.greatest(F.size("__folded") - 2, F.lit(1))), lambda a: a != "")
    return folded.withColumns({"name_norm": name_text(name), "leet_compact": leet_compact(name), "addr_norm": F.array_join(address_words(address), " "), "addr_numbers": numbers_of(F.lower(address)), "__aliases": F.transform(more, alias_compact)}).drop("__folded")


def views(of: DataFrame, only: Sequence[str] = (), more: dict[str, Column] | None = None) -> DataFrame:
    """All views of records from their texts. only: these columns of them, with more, which is made of views."""
    step = of.withColumns({"name_compact": joined(F.col("name_norm")), "name_tokens": name_tokens(F.col("name_norm")), "addr_compact": F.replace("addr_norm", F.lit(" "), F.lit("")), "addr_tokens": F.filter(words(F.col("addr_norm")), lambda w: F.length(w) >= 2)})
    made = step.withColumns(
        {
            "name_sorted": sorted_tokens(F.col("name_tokens")),
            "name_grams": grams(F.col("name_compact"), 3),
            "dba_compacts": F.filter("__aliases", lambda a: (a != "") & (a != F.col("name_compact"))),
            "addr_salient": salient(F.col("addr_tokens")),
        }
    )
    return made.withColumns(more or {}).select(*only, *(more or {})) if only else made.drop("__aliases")
