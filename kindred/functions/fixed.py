"""Patterns, word lists and thresholds that linkage results depend on."""

# Fixed values.
URL_PREFIX = r"^https?://(www\.)?|^www\."
DOMAIN_SUFFIX = r"\.(com|org|net|in|fr|co|io|biz|info|gov|edu|us|eu|me|tech|store)(\.[a-z]{2})?$"

LEGAL_SUFFIXES = [
    r"\b(l\.?l\.?c\.?|limited liability company)\b",
    r"\b(inc\.?|incorporated)\b",
    r"\b(corp\.?|corporation)\b",
    r"\b(ltd\.?|limited)\b",
    r"\b(co\.?|company)\b",
    r"\b(plc\.?|public limited company)\b",
    r"\b(gmbh|ag|bv|nv)\b",
    r"\b(pvt\.?\s*ltd\.?|private\s+limited)\b",
    r"\b(l\.?l\.?p\.?|limited liability partnership)\b",
    r"\b(pvt\.?|private)\b",
    r"\b(s\.?a\.?r\.?l\.?|societe a responsabilite limitee)\b",
    r"\b(s\.?a\.?s\.?|s\.?a\.?s\.?u\.?|societe par actions simplifiee)\b",
    r"\b(s\.?c\.?i\.?|societe civile immobiliere)\b",
    r"\b(e\.?u\.?r\.?l\.?)\b",
    r"\b(s\.?a\.?|societe anonyme)\b",
    r"\b(snc|gie|ei)\b",
]

ADDRESS_ABBREVIATIONS = {
    "st": "street", "str": "street",
    "rd": "road",
    "ave": "avenue", "av": "avenue",
    "blvd": "boulevard", "bvd": "boulevard",
    "dr": "drive",
    "ln": "lane",
    "pkwy": "parkway", "pky": "parkway",
    "trl": "trail",
    "ct": "court",
    "pl": "place",
    "cir": "circle",
    "hwy": "highway",
    "fwy": "freeway",
    "expy": "expressway",
    "ste": "suite",
    "apt": "apartment",
    "fl": "floor",
    "bldg": "building",
    "dept": "department",
    "ctr": "center",
    "sq": "square",
    "ter": "terrace",
    "al": "alley",
    "plz": "plaza",
    "pk": "park",
    "gt": "gate",
    "no": "number",
}

NAME_STOPWORDS = [
    "the", "and", "of", "for", "in", "at", "by", "to", "on", "a", "an",
    "de", "du", "la", "le", "des", "et", "en", "pour", "par", "sur",
    "ka", "ki", "ke", "aur", "se",
]

COMMON_STREET_WORDS = [
    "street", "road", "avenue", "boulevard", "drive", "lane", "parkway",
    "trail", "court", "place", "circle", "highway", "freeway", "expressway",
    "suite", "apartment", "floor", "building", "department", "center", "square",
    "near", "opp", "opposite", "beside", "behind", "block", "sector", "plot",
]

TRADE_NAME = r"\b(dba|t/a|f/k/a|trading\s+as|doing\s+business\s+as|c/o)\b"
HONORIFIC = r"^\s*(shri|shree|m/s|smt|smts)\s+"
POSTAL = r"\b(\d{5}(?:-\d{4})?|\d{6})\b"

STRATEGIES = [
    "exact_name",
    "sorted_name_tokens",
    "first_two_name_tokens",
    "longest_name_token",
    "name_prefix_6",
    "name_address_combo",
    "address_exact_combo",
    "name_leet_compact",
    "name_dba_alias",
    "address_salient_combo",
]
DEFAULT_STRATEGIES = STRATEGIES[:7]
BYPASS_STRATEGIES = ["exact_name", "sorted_name_tokens", "name_leet_compact", "name_dba_alias"]
MAX_BLOCK_SIZE = 500
SCORE_THRESHOLD = 0.15
TOP_K = 50
MATCH_THRESHOLD = 0.70

FEATURE_GROUPS = {
    "name": [
        "name_normalized_exact", "name_compact_exact", "name_token_jaccard", "name_sorted_token_jaccard",
        "name_char_2gram_jaccard", "name_char_3gram_jaccard", "name_char_4gram_jaccard", "name_edit_similarity",
        "name_levenshtein_compact_sim", "name_compact_containment", "name_prefix_similarity", "name_suffix_similarity",
        "name_token_count_diff", "name_shared_token_count", "name_longest_token_match",
    ],
    "address": [
        "addr_normalized_exact", "addr_compact_exact", "addr_token_jaccard", "addr_char_3gram_jaccard",
        "addr_char_4gram_jaccard", "addr_edit_similarity", "addr_shared_numbers_count", "addr_exact_number_match",
        "addr_leading_zero_number_match", "addr_postal_code_match", "addr_locality_overlap", "addr_state_overlap",
        "addr_containment", "addr_token_count_diff", "addr_is_missing_either",
    ],
    "cross": [
        "cross_strong_name_strong_addr", "cross_strong_name_weak_addr", "cross_weak_name_strong_addr",
        "cross_exact_number_similar_name", "cross_exact_locality_similar_name", "cross_same_country_name_sim",
        "cross_same_country_addr_sim", "cross_agreement_count",
    ],
    "country": ["country_exact_match", "country_normalized_match", "country_missing_either", "country_conflict"],
    "view": [
        "view_leet_name_exact", "view_leet_name_sim", "view_dba_alias_match", "view_compact_name_match",
        "view_compact_addr_match",
    ],
    "provenance": [
        "prov_exact_name", "prov_sorted_tokens", "prov_first_two_tokens", "prov_longest_token", "prov_name_prefix",
        "prov_name_address", "prov_address_exact", "prov_name_leet", "prov_name_dba", "prov_address_salient",
        "prov_strategy_count",
    ],
    "refine": [
        "refine_composite_score", "refine_ngram_sim", "refine_token_sim", "refine_containment",
        "refine_addr_token_sim", "refine_number_match", "refine_provenance_bypass",
    ],
    "quality": [
        "qual_q_name_len", "qual_t_name_len", "qual_q_addr_len", "qual_t_addr_len", "qual_q_name_token_count",
        "qual_t_name_token_count", "qual_q_addr_token_count", "qual_t_addr_token_count", "qual_addr_missing_q",
        "qual_addr_missing_t", "qual_non_latin_script_q", "qual_non_latin_script_t", "qual_mixed_script_pair",
        "qual_has_url_domain", "qual_has_legal_suffix", "qual_has_dba",
    ],
    "frequency": [
        "freq_q_name", "freq_t_name", "freq_q_compact", "freq_t_compact", "freq_q_country_name",
        "freq_t_country_name",
    ],
}
#: Features that are no whole numbers.
FRACTIONS = [
    "name_token_jaccard", "name_sorted_token_jaccard", "name_char_2gram_jaccard", "name_char_3gram_jaccard",
    "name_char_4gram_jaccard", "name_edit_similarity", "name_levenshtein_compact_sim", "name_prefix_similarity",
    "name_suffix_similarity", "addr_token_jaccard", "addr_char_3gram_jaccard", "addr_char_4gram_jaccard",
    "addr_edit_similarity", "addr_locality_overlap", "cross_same_country_name_sim", "cross_same_country_addr_sim",
    "view_leet_name_sim", "refine_composite_score", "refine_ngram_sim", "refine_token_sim", "refine_containment",
    "refine_addr_token_sim",
]
FEATURES = [f for group in FEATURE_GROUPS.values() for f in group]
