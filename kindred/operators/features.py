"""The 87 features of a pair, in nine groups."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from kindred.functions import fixed
from kindred.functions.text import common_prefix, common_suffix, edit_similarity, flag, grams, has_non_latin, jaccard
from kindred.operators import blockwise, refine
from kindred.operators.blocking import longest_token
from kindred.operators.normalize import LEGAL

_c = F.col


def record_values() -> dict[str, Column]:
    """What quality features need of one record."""
    return {
        "name_len": F.length("name_raw"),
        "addr_len": F.length("addr_raw"),
        "name_count": F.size("name_tokens"),
        "addr_count": F.size("addr_tokens"),
        "non_latin": (has_non_latin(_c("name_raw")) | has_non_latin(_c("addr_raw"))).cast("int"),
        "has_url": (_c("name_raw").rlike("(?i)" + fixed.URL_PREFIX) | _c("name_raw").rlike("(?i)" + fixed.DOMAIN_SUFFIX)).cast("int"),
        "has_legal": _c("name_raw").rlike(LEGAL).cast("int"),
        "has_dba": (_c("name_raw").rlike("(?iU)" + fixed.TRADE_NAME) | (F.size("dba_compacts") > 0)).cast("int"),
    }


def _postal() -> Column:
    return F.array_distinct(F.regexp_extract_all("addr_norm", F.lit("(?U)" + fixed.POSTAL), F.lit(0)))


def record_grams(records: DataFrame) -> DataFrame:
    """Adds what features need of one record, so that no pair repeats it."""
    return records.withColumns(
        {
            "g2": grams(_c("name_compact"), 2),
            "g4": grams(_c("name_compact"), 4),
            "a3": grams(_c("addr_compact"), 3),
            "a4": grams(_c("addr_compact"), 4),
            "l3": grams(_c("leet_compact"), 3),
            "longest": longest_token(_c("name_tokens")),
            "postal": _postal(),
            "tail": F.slice("addr_tokens", F.greatest(F.size("addr_tokens") - 1, F.lit(1)), 2),
            **record_values(),
        }
    )


RECORD_VIEWS = [*refine.VIEWS, "g2", "g4", "a3", "a4", "l3", "longest", "postal", "tail", "name_len", "addr_len", "name_count", "addr_count", "non_latin", "has_url", "has_legal", "has_dba"]
FREQUENCY_VIEWS = ["freq_name", "freq_compact", "freq_country_name"]


def _equal(view: str) -> Column:
    return flag((_c(f"q_{view}") != "") & (_c(f"q_{view}") == _c(f"t_{view}")))


def _within(view: str) -> Column:
    q, t = _c(f"q_{view}"), _c(f"t_{view}")
    return flag((q != "") & (t != "") & (F.contains(q, t) | F.contains(t, q)))


def _run(length: Column, q: Column, t: Column) -> Column:
    return F.when((q == "") | (t == ""), F.lit(0.0)).otherwise(length / F.greatest(F.length(q), F.length(t), F.lit(1)))


def name_features() -> dict[str, Column]:
    q, t = _c("q_name_compact"), _c("t_name_compact")
    return {
        "name_normalized_exact": _equal("name_norm"),
        "name_compact_exact": _equal("name_compact"),
        "name_token_jaccard": refine.name_token_similarity(),
        "name_char_2gram_jaccard": jaccard(_c("q_g2"), _c("t_g2")),
        "name_char_3gram_jaccard": refine.name_gram_similarity(),
        "name_char_4gram_jaccard": jaccard(_c("q_g4"), _c("t_g4")),
        "name_edit_similarity": edit_similarity(_c("q_name_norm"), _c("t_name_norm")),
        "name_levenshtein_compact_sim": edit_similarity(q, t, 60),
        "name_compact_containment": _within("name_compact"),
        "name_prefix_similarity": _run(common_prefix(q, t), q, t),
        "name_suffix_similarity": _run(common_suffix(q, t), q, t),
        "name_token_count_diff": F.abs(F.size("q_name_tokens") - F.size("t_name_tokens")).cast("double"),
        "name_shared_token_count": F.size(F.array_intersect("q_name_tokens", "t_name_tokens")).cast("double"),
        "name_longest_token_match": flag((_c("q_longest") != "") & (_c("q_longest") == _c("t_longest"))),
    }


def address_features() -> dict[str, Column]:
    return {
        "addr_normalized_exact": _equal("addr_norm"),
        "addr_compact_exact": _equal("addr_compact"),
        "addr_token_jaccard": refine.addr_token_similarity(),
        "addr_char_3gram_jaccard": jaccard(_c("q_a3"), _c("t_a3")),
        "addr_char_4gram_jaccard": jaccard(_c("q_a4"), _c("t_a4")),
        "addr_edit_similarity": edit_similarity(_c("q_addr_norm"), _c("t_addr_norm")),
        "addr_shared_numbers_count": F.size(F.array_intersect("q_addr_numbers", "t_addr_numbers")).cast("double"),
        "addr_exact_number_match": refine.number_match(),
        "addr_postal_code_match": flag(F.arrays_overlap("q_postal", "t_postal")),
        "addr_locality_overlap": jaccard(F.array_distinct("q_addr_salient"), F.array_distinct("t_addr_salient")),
        "addr_state_overlap": flag(F.arrays_overlap("q_tail", "t_tail")),
        "addr_containment": _within("addr_compact"),
        "addr_token_count_diff": F.abs(F.size("q_addr_tokens") - F.size("t_addr_tokens")).cast("double"),
        "addr_is_missing_either": flag((_c("q_addr_norm") == "") | (_c("t_addr_norm") == "")),
    }


def view_features() -> dict[str, Column]:
    q, t = _c("q_name_compact"), _c("t_name_compact")
    alias = ((q != "") & F.array_contains("t_dba_compacts", q)) | ((t != "") & F.array_contains("q_dba_compacts", t)) | F.arrays_overlap("q_dba_compacts", "t_dba_compacts")
    return {"view_leet_name_exact": _equal("leet_compact"), "view_leet_name_sim": jaccard(_c("q_l3"), _c("t_l3")), "view_dba_alias_match": flag(alias)}


def provenance_features() -> dict[str, Column]:
    named = zip(fixed.FEATURE_GROUPS["provenance"], fixed.STRATEGIES, strict=False)
    return {f: flag(F.array_contains("strategies", s)) for f, s in named} | {"prov_strategy_count": F.size("strategies").cast("double")}


def quality_features() -> dict[str, Column]:
    out = {}
    for s in "qt":
        out[f"qual_{s}_name_len"] = _c(f"{s}_name_len").cast("double")
        out[f"qual_{s}_addr_len"] = _c(f"{s}_addr_len").cast("double")
        out[f"qual_{s}_name_token_count"] = _c(f"{s}_name_count").cast("double")
        out[f"qual_{s}_addr_token_count"] = _c(f"{s}_addr_count").cast("double")
        out[f"qual_addr_missing_{s}"] = flag(_c(f"{s}_addr_len") == 0)
        out[f"qual_non_latin_script_{s}"] = flag(_c(f"{s}_non_latin") == 1)
    out["qual_mixed_script_pair"] = flag(_c("q_non_latin") != _c("t_non_latin"))
    for k in ("url", "legal", "dba"):
        out[{"url": "qual_has_url_domain", "legal": "qual_has_legal_suffix", "dba": "qual_has_dba"}[k]] = flag((_c(f"q_has_{k}") == 1) | (_c(f"t_has_{k}") == 1))
    return out


def country_features() -> dict[str, Column]:
    q, t = _c("q_country"), _c("t_country")
    missing = (q == "") | (t == "")
    return {"country_exact_match": flag(~missing & (q == t)), "country_missing_either": flag(missing), "country_conflict": flag(~missing & (q != t))}


def derived_features() -> dict[str, Column]:
    """Features that are functions of others: read from columns, so that each similarity is computed once."""
    name, addr, same, place, number = (_c(c) for c in ("name_token_jaccard", "addr_token_jaccard", "country_exact_match", "addr_locality_overlap", "addr_exact_number_match"))
    near = flag(place >= 0.5)
    weighted = 0.35 * _c("name_char_3gram_jaccard") + 0.30 * name + 0.20 * _c("refine_containment") + 0.10 * addr + 0.05 * number
    return {
        "name_sorted_token_jaccard": name,  # equal sorted tokens are equal sets: 1, or 0 without tokens
        "addr_leading_zero_number_match": number,
        "cross_strong_name_strong_addr": flag((name >= 0.7) & (addr >= 0.5)),
        "cross_strong_name_weak_addr": flag((name >= 0.8) & (addr < 0.2)),
        "cross_weak_name_strong_addr": flag((name < 0.3) & (addr >= 0.7)),
        "cross_exact_number_similar_name": flag((number == 1) & (name >= 0.5)),
        "cross_exact_locality_similar_name": flag((place >= 0.5) & (name >= 0.5)),
        "cross_same_country_name_sim": same * name,
        "cross_same_country_addr_sim": same * addr,
        "cross_agreement_count": _c("name_normalized_exact") + _c("name_compact_exact") + _c("addr_normalized_exact") + number + same + near,
        "country_normalized_match": same,
        "view_compact_name_match": _c("name_compact_exact"),
        "view_compact_addr_match": _c("addr_compact_exact"),
        "refine_composite_score": F.when(_c("refine_provenance_bypass") == 1, F.lit(1.0)).otherwise(weighted),
        "refine_ngram_sim": _c("name_char_3gram_jaccard"),
        "refine_token_sim": name,
        "refine_addr_token_sim": addr,
        "refine_number_match": number,
    }


class FrequencyStore:
    """Counts of names among training anchors: three aggregated tables, joined by equality."""

    def __init__(self, records: DataFrame) -> None:
        count = F.count(F.lit(1)).alias("n")
        self.name = records.filter("name_norm <> ''").groupBy(_c("name_norm").alias("k")).agg(count)
        self.compact = records.filter("name_compact <> ''").groupBy(_c("name_compact").alias("k")).agg(count)
        self.country = records.filter("name_compact <> '' and country <> ''").groupBy(F.concat_ws("|", "country", "name_compact").alias("k")).agg(count)

    def save(self, path: str) -> None:
        for part in ("name", "compact", "country"):
            getattr(self, part).write.mode("overwrite").parquet(f"{path}/{part}")

    @classmethod
    def load(cls, spark: SparkSession, path: str) -> FrequencyStore:
        store = cls.__new__(cls)
        for part in ("name", "compact", "country"):
            setattr(store, part, spark.read.parquet(f"{path}/{part}"))
        return store

    def counts(self, records: DataFrame) -> DataFrame:
        """entity_id, freq_name, freq_compact, freq_country_name of records; unseen names count 0."""
        # Names meet by 128 bits of hash, so that no join deals texts.
        hashed = lambda k, view: (F.xxhash64(k).alias(f"k_{view}"), F.xxhash64(F.lit("2"), k).alias(f"l_{view}"))
        found = records.select("entity_id", *hashed(_c("name_norm"), "name"), *hashed(_c("name_compact"), "compact"), *hashed(F.concat_ws("|", "country", "name_compact"), "country_name"))
        for table, view in ((self.name, "name"), (self.compact, "compact"), (self.country, "country_name")):
            found = found.join(table.select(*hashed(_c("k"), view), _c("n").cast("double").alias(f"freq_{view}")), [f"k_{view}", f"l_{view}"], "left")
        return found.select("entity_id", *FREQUENCY_VIEWS).fillna(0.0, FREQUENCY_VIEWS)

    def attach(self, records: DataFrame) -> DataFrame:
        """Adds the counts to records. Slim rows are looked up, a row for each record and not for each pair."""
        return records.join(self.counts(records), "entity_id")


def without_frequencies(records: DataFrame) -> DataFrame:
    return records.withColumns({f"freq_{view}": F.lit(0.0) for view in ("name", "compact", "country_name")})


def pair_features(pairs: DataFrame, queries: DataFrame, targets: DataFrame, store: FrequencyStore | None = None) -> DataFrame:
    """source1_entity_id, target_entity_id, target_source and the 87 features of pairs (s1_id, target_id, strategies).

    NaN and infinite values become 0. Without a store all frequencies are 0.
    """
    known = store.attach if store else without_frequencies
    viewed = refine.with_views(pairs, known(record_grams(queries)), known(record_grams(targets)), RECORD_VIEWS + FREQUENCY_VIEWS)
    base = name_features() | address_features() | view_features() | provenance_features() | quality_features() | country_features()
    base |= {"refine_containment": refine.containment(), "refine_provenance_bypass": flag(refine.bypassed())}
    base |= {f"freq_{s}_{view}": _c(f"{s}_freq_{view}") for s in "qt" for view in ("name", "compact", "country_name")}
    frame = viewed.withColumns(base)
    frame = frame.withColumns(derived_features())
    return _out(frame, fixed.FEATURES)


def _out(frame: DataFrame, columns: Sequence[str], finite: bool = False) -> DataFrame:
    """finite: NaN, infinite and null values are 0 already."""
    source = F.substring("target_id", 1, 2)
    return frame.select(_c("s1_id").alias("source1_entity_id"), _c("target_id").alias("target_entity_id"), F.when(source.isin("S2", "S3"), source).otherwise("UNKNOWN").alias("target_source"), *(columns if finite else _finite(columns)))


def _finite(columns: Sequence[str]) -> list[Column]:
    return [F.when(F.isnan(f) | (F.abs(_c(f)) == float("inf")), F.lit(0.0)).otherwise(F.coalesce(_c(f), F.lit(0.0))).alias(f) for f in columns]


#: What derived features read besides blockwise.PARTS, the country's features and the bypass.
_READ = {
    "cross_exact_locality_similar_name": ["addr_locality_overlap"],
    "cross_agreement_count": ["name_normalized_exact", "name_compact_exact", "addr_normalized_exact", "addr_locality_overlap"],
    "view_compact_name_match": ["name_compact_exact"],
    "view_compact_addr_match": ["addr_compact_exact"],
    "name_whole_edit_similarity": ["name_long_edit_similarity"],
}


def candidate_features(queries: DataFrame, targets: DataFrame, strategies: Sequence[str], max_block_size: int, k: int, threshold: float, store: FrequencyStore | None = None, columns: Sequence[str] = fixed.FEATURES) -> DataFrame:
    """pair_features, or columns of them, of the candidates that blockwise.scored_pairs and refine.top_k give.

    Values are worked out in the block where a pair is made, from the texts that are there. Only they are dealt by
    anchor, once; no pair is joined with its records. Frequencies come with the records.
    """
    wanted = list(dict.fromkeys([*columns, *(r for f in columns for r in _READ.get(f, []))]))
    quality = [f for f in columns if f.startswith("qual_")]
    frequency = [f for f in columns if f.startswith("freq_")]
    sides = [r.withColumn("postal", _postal()) for r in (queries, targets)] if "addr_postal_code_match" in wanted else [queries, targets]
    known = None
    if frequency and store:
        known = store.counts(queries).withColumn("is_query", F.lit(True)).union(store.counts(targets).withColumn("is_query", F.lit(False)))
    frame = blockwise.featured_pairs(*sides, strategies, max_block_size, k, threshold, wanted, record_values() if quality else {}, known)
    base = {f: edit_similarity(_c(f"q_{f}"), _c(f"t_{f}"), cap) for f, (_, _, cap) in blockwise.EDITS.items() if f in wanted}
    if "name_whole_edit_similarity" in base:
        long = _c("name_long_edit_similarity")
        base["name_whole_edit_similarity"] = F.when(long >= 0, long).otherwise(base["name_whole_edit_similarity"])
    base |= {f: c for f, c in provenance_features().items() if f in wanted} | country_features() | {"refine_provenance_bypass": flag(refine.bypassed())}
    base |= quality_features() if quality else {}
    base |= {f"freq_{s}_{v.removeprefix('freq_')}": _c(f"{s}_{v}") if store else F.lit(0.0) for s in "qt" for v in FREQUENCY_VIEWS} if frequency else {}
    frame = frame.withColumns(base)
    frame = frame.withColumns({f: c for f, c in derived_features().items() if f in columns})
    best = refine.top_k(frame.select("s1_id", "target_id", "strategies", "first_rank", "score", *_finite(columns)), k, threshold)
    return _out(best, columns, finite=True)


def labelled(features: DataFrame, truth: DataFrame) -> DataFrame:
    """Adds label: whether (s1_id, target_id) is in the long truth table."""
    t = truth.select(_c("s1_id").alias("source1_entity_id"), _c("target_id").alias("target_entity_id"), F.lit(1).alias("__hit")).distinct()
    return features.join(t, ["source1_entity_id", "target_entity_id"], "left").withColumn("label", F.coalesce("__hit", F.lit(0))).drop("__hit")


def labelled_by_anchor(features: DataFrame, truth: DataFrame) -> DataFrame:
    """labelled, by wide truth (s1_id, targets): rows that are dealt by anchor stay where they are."""
    known = truth.select(_c("s1_id").alias("source1_entity_id"), "targets")
    hit = F.coalesce(F.array_contains("targets", _c("target_entity_id")), F.lit(False))
    return features.join(known, "source1_entity_id", "left").withColumn("label", hit.cast("int")).drop("targets")
