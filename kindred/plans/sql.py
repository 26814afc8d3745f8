"""The linkage queries in SQL, for comparison by another engine. Regular expressions there have no look-behind."""

from __future__ import annotations

from kindred.functions import fixed


def _list(words) -> str:
    return "[" + ", ".join(f"'{w}'" for w in words) + "]"


LEGAL = "|".join(fixed.LEGAL_SUFFIXES)
_ABBREVIATIONS = " ".join(f"WHEN '{a}' THEN '{b}'" for a, b in fixed.ADDRESS_ABBREVIATIONS.items())
_FOLD = "strip_accents(replace(replace(replace(replace({}, 'œ', 'oe'), 'Œ', 'Oe'), 'æ', 'ae'), 'Æ', 'Ae'))"


def _grams(text: str, n: int) -> str:
    return f"CASE WHEN length({text}) >= {n} THEN list_distinct(list_transform(range(1, length({text}) - {n - 2}), lambda i: substr({text}, i, {n}))) WHEN length({text}) > 0 THEN [{text}] ELSE []::VARCHAR[] END"


def _jaccard(a: str, b: str) -> str:
    return f"CASE WHEN len({a}) = 0 OR len({b}) = 0 THEN 0e0 ELSE len(list_intersect({a}, {b}))::DOUBLE / (len({a}) + len({b}) - len(list_intersect({a}, {b}))) END"


def _unleet(text: str) -> str:
    s = f"replace(replace(regexp_replace({text}, '^[@#]+', ''), '@', 'a'), '$', 's')"
    for digit, letter in (("0", "o"), ("8", "b"), ("1", "l")):
        for _ in range(2):  # two passes for letters that serve both neighbours
            s = f"regexp_replace({s}, '([a-zA-Z]){digit}([a-zA-Z])', '\\1{letter}\\2', 'g')"
    return f"regexp_replace({s}, '\\b8([a-zA-Z])', 'b\\1', 'g')"


def _compact(text: str) -> str:
    return f"regexp_replace(regexp_replace({text}, '{LEGAL}', ' ', 'gi'), '[^\\pL\\pN_]+', '', 'g')"


_TRADE = f"(?is)^(.*?){fixed.TRADE_NAME}(.*)$"
_VIEWS = f"""
source_lines AS (
  SELECT 'S' || (doc_id % 3 + 1)::VARCHAR AS source, doc_id, lang, unnest(string_split(text, chr(10))) AS line, unnest(range(len(string_split(text, chr(10))))) AS place FROM documents
), source_records AS (
  SELECT source, line, min_by(lang, [doc_id, place]) AS lang, list_min(list(doc_id * 1048576 + place)) AS seq FROM source_lines WHERE trim(line) <> '' GROUP BY source, line
), ents AS (
  SELECT source || '-' || seq::VARCHAR AS entity_id, source, regexp_extract(line, '^[^.]+', 0) AS business_name,
         length(line)::VARCHAR || ' ' || substr(line, length(regexp_extract(line, '^[^.]+', 0)) + 1) AS business_address, lang AS country, seq
  FROM source_records
), folded AS (
  SELECT *, {_FOLD.format("business_name")} AS name_fold, {_FOLD.format("business_address")} AS addr_fold FROM ents
), step1 AS (
  SELECT entity_id, source, seq, business_name AS name_raw, CASE WHEN trim(business_address) = '' THEN '' ELSE business_address END AS addr_raw,
         upper(trim(country)) AS country,
         trim(regexp_replace(regexp_replace(replace(replace(regexp_replace(regexp_replace(lower(name_fold), '{fixed.URL_PREFIX}', '', 'i'), '{fixed.DOMAIN_SUFFIX}', '', 'i'), '&', ' and '), '+', ' plus '), '{LEGAL}', ' ', 'gi'), '[^\\pL\\pN_]+', ' ', 'g')) AS name_norm,
         {_compact(_unleet("lower(name_fold)"))} AS leet_compact,
         list_filter([
           CASE WHEN trim(regexp_replace(business_name, '{fixed.HONORIFIC}', '', 'i')) NOT IN ('') AND lower(trim(regexp_replace(business_name, '{fixed.HONORIFIC}', '', 'i'))) <> lower(business_name) THEN trim(regexp_replace(business_name, '{fixed.HONORIFIC}', '', 'i')) END,
           CASE WHEN length(trim(regexp_extract(business_name, '{_TRADE}', 1))) >= 3 THEN trim(regexp_extract(business_name, '{_TRADE}', 1)) END,
           CASE WHEN length(trim(regexp_extract(business_name, '{_TRADE}', 3))) >= 3 THEN trim(regexp_extract(business_name, '{_TRADE}', 3)) END
         ], lambda a: a IS NOT NULL) AS names,
         list_distinct(list_transform(regexp_extract_all(lower(addr_fold), '\\b\\d{{1,7}}\\b'), lambda n: CASE WHEN ltrim(n, '0') = '' THEN '0' ELSE ltrim(n, '0') END)) AS addr_numbers,
         list_transform(list_filter(string_split(trim(regexp_replace(lower(addr_fold), '[^\\pL\\pN_]+', ' ', 'g')), ' '), lambda w: w <> ''), lambda w: CASE w {_ABBREVIATIONS} ELSE w END) AS addr_words
  FROM folded
), step2 AS (
  SELECT *, replace(name_norm, ' ', '') AS name_compact,
         list_filter(string_split(name_norm, ' '), lambda w: w <> '' AND NOT list_contains({_list(fixed.NAME_STOPWORDS)}, w)) AS name_tokens,
         coalesce(array_to_string(addr_words, ' '), '') AS addr_norm, coalesce(array_to_string(addr_words, ''), '') AS addr_compact,
         list_filter(addr_words, lambda w: length(w) >= 2) AS addr_tokens,
         list_transform(names, lambda a: {_compact(f"lower({_FOLD.format('a')})")}) AS alias_compacts
  FROM step1
), norm AS (
  SELECT *, coalesce(array_to_string(list_sort(list_distinct(name_tokens)), ' '), '') AS name_sorted, {_grams("name_compact", 3)} AS name_grams,
         list_filter(alias_compacts, lambda a: a <> '' AND a <> name_compact) AS dba_compacts,
         list_filter(addr_tokens, lambda w: length(w) >= 4 AND NOT list_contains({_list(fixed.COMMON_STREET_WORDS)}, w)) AS addr_salient,
         coalesce(list_filter(name_tokens, lambda w: length(w) = list_max(list_transform(name_tokens, lambda x: length(x))))[1], '') AS longest
  FROM step2
), single_keys AS (
  SELECT entity_id, source, seq, 'exact_name' AS strategy, 0 AS ord, country || '|' || name_compact AS key FROM norm WHERE name_compact <> ''
  UNION ALL SELECT entity_id, source, seq, 'sorted_name_tokens', 1, country || '|' || name_sorted FROM norm WHERE name_sorted <> ''
  UNION ALL SELECT entity_id, source, seq, 'first_two_name_tokens', 2, country || '|' || name_tokens[1] || '_' || name_tokens[2] FROM norm WHERE len(name_tokens) >= 2
  UNION ALL SELECT entity_id, source, seq, 'longest_name_token', 3, country || '|' || longest FROM norm WHERE length(longest) >= 5
  UNION ALL SELECT entity_id, source, seq, 'name_prefix_6', 4, country || '|' || substr(name_compact, 1, 6) FROM norm WHERE length(name_compact) >= 6
  UNION ALL SELECT entity_id, source, seq, 'name_address_combo', 5, country || '|' || name_tokens[1] || '|' || list_min(addr_numbers) FROM norm WHERE len(name_tokens) >= 1 AND len(addr_numbers) > 0
  UNION ALL SELECT entity_id, source, seq, 'address_exact_combo', 6, country || '|' || list_min(addr_numbers) || '|' || addr_tokens[1] FROM norm WHERE len(addr_numbers) > 0 AND len(addr_tokens) > 0
  UNION ALL SELECT entity_id, source, seq, 'name_leet_compact', 7, country || '|' || leet_compact FROM norm WHERE leet_compact <> ''
  UNION ALL SELECT entity_id, source, seq, 'address_salient_combo', 9, country || '|' || list_min(addr_numbers) || '|' || addr_salient[1] FROM norm WHERE len(addr_numbers) > 0 AND len(addr_salient) > 0
), alias_keys AS (
  SELECT entity_id, source, seq, i - 1 AS key_ord, country || '|' || CASE WHEN source = 'S1' AND i > len(dba_compacts) THEN name_compact ELSE dba_compacts[i] END AS key
  FROM (SELECT *, unnest(range(1, len(dba_compacts) + 1 + CASE WHEN source = 'S1' AND name_compact <> '' THEN 1 ELSE 0 END)) AS i FROM norm)
), all_keys AS (
  SELECT entity_id, source, seq, strategy, ord, 0 AS key_ord, key FROM single_keys
  UNION ALL SELECT entity_id, source, seq, 'name_dba_alias', 8, key_ord, key FROM alias_keys
), qkeys AS (SELECT * FROM all_keys WHERE source = 'S1'
), tkeys AS (SELECT * FROM all_keys WHERE source <> 'S1'
), usable AS (SELECT strategy, key FROM tkeys GROUP BY strategy, key HAVING count(*) <= {fixed.MAX_BLOCK_SIZE}
), matches AS (
  SELECT q.entity_id AS s1_id, q.strategy, q.ord, q.key_ord, q.key, t.entity_id AS target_id, t.seq AS target_seq
  FROM qkeys q JOIN usable USING (strategy, key) JOIN tkeys t USING (strategy, key)
), pairs AS (
  SELECT s1_id, target_id, list_sort(list(DISTINCT strategy)) AS strategies, min([ord, key_ord, target_seq]) AS first_rank FROM matches GROUP BY s1_id, target_id
), viewed AS (
  SELECT p.*, q.country AS q_country, t.country AS t_country, q.name_raw AS q_name_raw, t.name_raw AS t_name_raw, q.addr_raw AS q_addr_raw, t.addr_raw AS t_addr_raw,
         q.name_norm AS qn, t.name_norm AS tn, q.name_compact AS qc, t.name_compact AS tc, q.name_sorted AS qs, t.name_sorted AS ts,
         q.name_tokens AS q_tokens, t.name_tokens AS t_tokens, list_distinct(q.name_tokens) AS qt, list_distinct(t.name_tokens) AS tt, q.name_grams AS q3, t.name_grams AS t3,
         q.leet_compact AS ql, t.leet_compact AS tl, q.dba_compacts AS qd, t.dba_compacts AS td, q.longest AS qlong, t.longest AS tlong,
         q.addr_norm AS qan, t.addr_norm AS tan, q.addr_compact AS qac, t.addr_compact AS tac, q.addr_tokens AS qal, t.addr_tokens AS tal,
         list_distinct(q.addr_tokens) AS qa, list_distinct(t.addr_tokens) AS ta, q.addr_numbers AS qnum, t.addr_numbers AS tnum,
         list_distinct(q.addr_salient) AS qsal, list_distinct(t.addr_salient) AS tsal
  FROM pairs p JOIN norm q ON q.entity_id = s1_id JOIN norm t ON t.entity_id = target_id
), parts AS (
  SELECT *, {_jaccard("q3", "t3")} AS j3, {_jaccard("qt", "tt")} AS jt, {_jaccard("qa", "ta")} AS ja,
         CASE WHEN len(list_intersect(qnum, tnum)) > 0 THEN 1e0 ELSE 0e0 END AS num,
         CASE WHEN qc = '' OR tc = '' THEN 0e0 WHEN qc = tc OR ql = tc OR tl = qc THEN 1e0 WHEN list_contains(td, qc) OR list_contains(qd, tc) THEN 1e0
              WHEN contains(qc, tc) OR contains(tc, qc) THEN 0.6e0 WHEN length(qc) >= 4 AND length(tc) >= 4 AND left(qc, 4) = left(tc, 4) THEN 0.3e0 ELSE 0e0 END AS cont,
         list_has_any(strategies, {_list(fixed.BYPASS_STRATEGIES)}) AS bypass
  FROM viewed
), scored AS (
  SELECT *, CASE WHEN q_country <> '' AND t_country <> '' AND q_country <> t_country THEN -1e0 WHEN bypass THEN 1e0
                 ELSE 0.35e0 * j3 + 0.30e0 * jt + 0.20e0 * cont + 0.10e0 * ja + 0.05e0 * num END AS score
  FROM parts
), ranked AS (
  SELECT *, row_number() OVER (PARTITION BY s1_id ORDER BY score DESC, first_rank)::INTEGER AS rank FROM scored
  WHERE score >= 0 AND (list_has_any(strategies, ['exact_name', 'sorted_name_tokens']) OR score >= {fixed.SCORE_THRESHOLD}e0)
), cands AS (SELECT * FROM ranked WHERE rank <= {fixed.TOP_K}
), freq AS (SELECT name_norm AS k, count(*)::DOUBLE AS n FROM norm WHERE source = 'S1' AND name_norm <> '' GROUP BY 1
), freq_c AS (SELECT name_compact AS k, count(*)::DOUBLE AS n FROM norm WHERE source = 'S1' AND name_compact <> '' GROUP BY 1
), freq_k AS (SELECT country || '|' || name_compact AS k, count(*)::DOUBLE AS n FROM norm WHERE source = 'S1' AND name_compact <> '' AND country <> '' GROUP BY 1
), truth_long AS (
  SELECT a.entity_id AS s1_id, b.entity_id AS target_id FROM ents a JOIN ents b ON a.source = 'S1' AND b.source <> 'S1' AND lower(a.business_name) = lower(b.business_name) AND lower(a.business_address) = lower(b.business_address)
), truth AS (
  SELECT a.entity_id AS s1_id, list_sort(list_filter(list(target_id), lambda x: x IS NOT NULL)) AS targets
  FROM ents a LEFT JOIN truth_long ON a.entity_id = s1_id WHERE a.source = 'S1' GROUP BY a.entity_id
), coverage AS (
  SELECT t.s1_id, len(targets) AS links, len(list_intersect(targets, found)) AS captured, len(found) AS n_candidates,
         len(list_filter(targets, lambda x: starts_with(x, 'S2'))) AS links_s2, len(list_filter(list_intersect(targets, found), lambda x: starts_with(x, 'S2'))) AS captured_s2,
         len(list_filter(targets, lambda x: starts_with(x, 'S3'))) AS links_s3, len(list_filter(list_intersect(targets, found), lambda x: starts_with(x, 'S3'))) AS captured_s3
  FROM (SELECT t.s1_id, t.targets, list_filter(list(c.target_id), lambda x: x IS NOT NULL) AS found FROM truth t LEFT JOIN cands c USING (s1_id) GROUP BY ALL) t
), predicted AS (SELECT s1_id, target_id FROM cands WHERE score >= 0.5e0
), anchors AS (
  SELECT s1_id, len(targets) AS n, len(found) AS m, len(list_intersect(targets, found)) AS tp
  FROM (SELECT t.s1_id, t.targets, list_filter(list(p.target_id), lambda x: x IS NOT NULL) AS found FROM truth t LEFT JOIN predicted p USING (s1_id) GROUP BY ALL)
), rates AS (
  SELECT *, CASE WHEN n = 0 AND m = 0 THEN 1e0 WHEN n = 0 OR m = 0 THEN 0e0 ELSE tp::DOUBLE / m END AS precision,
         CASE WHEN n = 0 AND m = 0 THEN 1e0 WHEN n = 0 OR m = 0 THEN 0e0 ELSE tp::DOUBLE / n END AS recall FROM anchors
), fbeta AS (
  SELECT *, CASE WHEN 0.25e0 * precision + recall > 0 THEN 1.25e0 * precision * recall / (0.25e0 * precision + recall) ELSE 0e0 END AS f_beta, m - tp AS fp, n - tp AS fn,
         n = tp AND m = tp AS exact_match, n = 0 AS is_singleton FROM rates
)"""


def _flag(condition: str) -> str:
    return f"CASE WHEN {condition} THEN 1e0 ELSE 0e0 END"


def _edit(a: str, b: str, cap: int | None) -> str:
    cut = lambda x: x if cap is None else f"left({x}, {cap})"
    plain = lambda x: f"regexp_replace(replace({cut(x)}, 'ß', '#'), '[^\\x00-\\x7f]', '~', 'g')"  # noqa: E731  the other engine counts bytes
    return f"CASE WHEN {a} = '' OR {b} = '' THEN 0e0 WHEN {a} = {b} THEN 1e0 ELSE 1e0 - levenshtein({plain(a)}, {plain(b)})::DOUBLE / greatest(length({cut(a)}), length({cut(b)})) END"


def _run(side: str) -> str:
    return f"CASE WHEN qc = '' OR tc = '' THEN 0e0 ELSE len(list_filter(range(1, least(length(qc), length(tc)) + 1), lambda i: {side}(qc, i) = {side}(tc, i)))::DOUBLE / greatest(length(qc), length(tc), 1) END"


_POSTAL = lambda text: f"list_distinct(regexp_extract_all({text}, '{fixed.POSTAL}'))"
_URL = lambda text: f"(regexp_matches({text}, '{fixed.URL_PREFIX}', 'i') OR regexp_matches({text}, '{fixed.DOMAIN_SUFFIX}', 'i'))"
#: Word boundaries of the other engine know ASCII letters only.
_found = lambda text, pattern: f"regexp_matches(regexp_replace({text}, '[^\\x00-\\x7f]', 'z', 'g'), '{pattern}', 'i')"
_BASE = {
    "name_normalized_exact": _flag("qn <> '' AND qn = tn"),
    "name_compact_exact": _flag("qc <> '' AND qc = tc"),
    "name_token_jaccard": "jt",
    "name_sorted_token_jaccard": "CASE WHEN qs = ts AND qs <> '' THEN 1e0 ELSE jt END",
    "name_char_2gram_jaccard": _jaccard(f"({_grams('qc', 2)})", f"({_grams('tc', 2)})"),
    "name_char_3gram_jaccard": "j3",
    "name_char_4gram_jaccard": _jaccard(f"({_grams('qc', 4)})", f"({_grams('tc', 4)})"),
    "name_edit_similarity": _edit("qn", "tn", 80),
    "name_levenshtein_compact_sim": _edit("qc", "tc", 60),
    "name_compact_containment": _flag("qc <> '' AND tc <> '' AND (contains(qc, tc) OR contains(tc, qc))"),
    "name_prefix_similarity": _run("left"),
    "name_suffix_similarity": _run("right"),
    "name_token_count_diff": "abs(len(q_tokens) - len(t_tokens))::DOUBLE",
    "name_shared_token_count": "len(list_intersect(qt, tt))::DOUBLE",
    "name_longest_token_match": _flag("qlong <> '' AND qlong = tlong"),
    "addr_normalized_exact": _flag("qan <> '' AND qan = tan"),
    "addr_compact_exact": _flag("qac <> '' AND qac = tac"),
    "addr_token_jaccard": "ja",
    "addr_char_3gram_jaccard": _jaccard(f"({_grams('qac', 3)})", f"({_grams('tac', 3)})"),
    "addr_char_4gram_jaccard": _jaccard(f"({_grams('qac', 4)})", f"({_grams('tac', 4)})"),
    "addr_edit_similarity": _edit("qan", "tan", 80),
    "addr_shared_numbers_count": "len(list_intersect(qnum, tnum))::DOUBLE",
    "addr_exact_number_match": "num",
    "addr_leading_zero_number_match": "num",
    "addr_postal_code_match": _flag(f"len(list_intersect({_POSTAL('qan')}, {_POSTAL('tan')})) > 0"),
    "addr_locality_overlap": _jaccard("qsal", "tsal"),
    "addr_state_overlap": _flag("len(list_intersect(qal[-2:], tal[-2:])) > 0"),
    "addr_containment": _flag("qac <> '' AND tac <> '' AND (contains(qac, tac) OR contains(tac, qac))"),
    "addr_token_count_diff": "abs(len(qal) - len(tal))::DOUBLE",
    "addr_is_missing_either": _flag("qan = '' OR tan = ''"),
    "country_exact_match": _flag("q_country <> '' AND q_country = t_country"),
    "country_normalized_match": _flag("q_country <> '' AND q_country = t_country"),
    "country_missing_either": _flag("q_country = '' OR t_country = ''"),
    "country_conflict": _flag("q_country <> '' AND t_country <> '' AND q_country <> t_country"),
    "view_leet_name_exact": _flag("ql <> '' AND ql = tl"),
    "view_leet_name_sim": _jaccard(f"({_grams('ql', 3)})", f"({_grams('tl', 3)})"),
    "view_dba_alias_match": _flag("(qc <> '' AND list_contains(td, qc)) OR (tc <> '' AND list_contains(qd, tc)) OR list_has_any(qd, td)"),
    "view_compact_name_match": _flag("qc <> '' AND qc = tc"),
    "view_compact_addr_match": _flag("qac <> '' AND qac = tac"),
    **{f: _flag(f"list_contains(strategies, '{s}')") for f, s in zip(fixed.FEATURE_GROUPS["provenance"], fixed.STRATEGIES, strict=False)},
    "prov_strategy_count": "len(strategies)::DOUBLE",
    "refine_composite_score": "CASE WHEN bypass THEN 1e0 ELSE 0.35e0 * j3 + 0.30e0 * jt + 0.20e0 * cont + 0.10e0 * ja + 0.05e0 * num END",
    "refine_ngram_sim": "j3",
    "refine_token_sim": "jt",
    "refine_containment": "cont",
    "refine_addr_token_sim": "ja",
    "refine_number_match": "num",
    "refine_provenance_bypass": _flag("bypass"),
    "qual_q_name_len": "length(q_name_raw)::DOUBLE",
    "qual_t_name_len": "length(t_name_raw)::DOUBLE",
    "qual_q_addr_len": "length(q_addr_raw)::DOUBLE",
    "qual_t_addr_len": "length(t_addr_raw)::DOUBLE",
    "qual_q_name_token_count": "len(q_tokens)::DOUBLE",
    "qual_t_name_token_count": "len(t_tokens)::DOUBLE",
    "qual_q_addr_token_count": "len(qal)::DOUBLE",
    "qual_t_addr_token_count": "len(tal)::DOUBLE",
    "qual_addr_missing_q": _flag("q_addr_raw = ''"),
    "qual_addr_missing_t": _flag("t_addr_raw = ''"),
    "qual_non_latin_script_q": _flag("regexp_matches(q_name_raw || q_addr_raw, '[\\x{0370}-\\x{10FFFF}]') AND regexp_matches(regexp_replace(q_name_raw || q_addr_raw, '[\\x{0000}-\\x{024F}]', '', 'g'), '\\pL')"),
    "qual_non_latin_script_t": _flag("regexp_matches(t_name_raw || t_addr_raw, '[\\x{0370}-\\x{10FFFF}]') AND regexp_matches(regexp_replace(t_name_raw || t_addr_raw, '[\\x{0000}-\\x{024F}]', '', 'g'), '\\pL')"),
    "qual_has_url_domain": _flag(f"{_URL('q_name_raw')} OR {_URL('t_name_raw')}"),
    "qual_has_legal_suffix": _flag(f"{_found('q_name_raw', LEGAL)} OR {_found('t_name_raw', LEGAL)}"),
    "qual_has_dba": _flag(f"{_found('q_name_raw', fixed.TRADE_NAME)} OR {_found('t_name_raw', fixed.TRADE_NAME)} OR len(qd) > 0 OR len(td) > 0"),
    "freq_q_name": "coalesce(a.n, 0e0)",
    "freq_t_name": "coalesce(b.n, 0e0)",
    "freq_q_compact": "coalesce(c.n, 0e0)",
    "freq_t_compact": "coalesce(d.n, 0e0)",
    "freq_q_country_name": "coalesce(e.n, 0e0)",
    "freq_t_country_name": "coalesce(f.n, 0e0)",
}
_CROSS = {
    "cross_strong_name_strong_addr": _flag("jt >= 0.7e0 AND ja >= 0.5e0"),
    "cross_strong_name_weak_addr": _flag("jt >= 0.8e0 AND ja < 0.2e0"),
    "cross_weak_name_strong_addr": _flag("jt < 0.3e0 AND ja >= 0.7e0"),
    "cross_exact_number_similar_name": _flag("num = 1 AND jt >= 0.5e0"),
    "cross_exact_locality_similar_name": _flag("addr_locality_overlap >= 0.5e0 AND jt >= 0.5e0"),
    "cross_same_country_name_sim": "country_exact_match * jt",
    "cross_same_country_addr_sim": "country_exact_match * ja",
    "cross_agreement_count": "name_normalized_exact + name_compact_exact + addr_normalized_exact + num + country_exact_match + CASE WHEN addr_locality_overlap >= 0.5e0 THEN 1e0 ELSE 0e0 END",
    "qual_mixed_script_pair": _flag("qual_non_latin_script_q <> qual_non_latin_script_t"),
}
_FEATS = f""", base AS (
  SELECT s1_id, target_id, jt, ja, num, {", ".join(f"{v} AS {k}" for k, v in _BASE.items())}
  FROM cands LEFT JOIN freq a ON a.k = qn LEFT JOIN freq b ON b.k = tn LEFT JOIN freq_c c ON c.k = qc LEFT JOIN freq_c d ON d.k = tc
  LEFT JOIN freq_k e ON e.k = q_country || '|' || qc LEFT JOIN freq_k f ON f.k = t_country || '|' || tc
), feats AS (SELECT *, {", ".join(f"{v} AS {k}" for k, v in _CROSS.items())} FROM base
), labelled AS (
  SELECT x.*, CASE WHEN substr(x.target_id, 1, 2) IN ('S2', 'S3') THEN substr(x.target_id, 1, 2) ELSE 'UNKNOWN' END AS target_source,
         CASE WHEN l.s1_id IS NULL THEN 0 ELSE 1 END AS label, round(refine_composite_score, 6) AS prob
  FROM feats x LEFT JOIN truth_long l ON l.s1_id = x.s1_id AND l.target_id = x.target_id
)"""


WHOLE_EDIT = f"SELECT s1_id, target_id, round({_edit('qn', 'tn', None)}, 9) AS value FROM cands"


def with_views(select: str) -> str:
    """A whole statement: the views that the select may use, then the select (or more views and a select)."""
    needs = any(w in select for w in ("feats", "labelled"))
    more = select.removeprefix("WITH ") if select.startswith("WITH ") else None
    head = "WITH " + _VIEWS.strip() + (_FEATS if needs else "")
    return f"{head}, {more}" if more else f"{head}\n{select}"


def capped(cap: int) -> str:
    return f"""WITH small AS (SELECT strategy, key FROM tkeys GROUP BY strategy, key HAVING count(*) <= {cap})
SELECT q.entity_id AS s1_id, t.entity_id AS target_id, array_to_string(list_sort(list(DISTINCT q.strategy)), ',') AS strategies
FROM qkeys q JOIN small USING (strategy, key) JOIN tkeys t USING (strategy, key) GROUP BY 1, 2"""


URL_ORACLE = f"""SELECT page_id, regexp_replace(regexp_replace(lower(url), '{fixed.URL_PREFIX}', '', 'i'), '{fixed.DOMAIN_SUFFIX}', '', 'i') AS value FROM pages"""
WIDE = """SELECT e.entity_id AS source1_entity_id, coalesce(array_to_string(list_sort(list_filter(list(target_id), lambda x: x IS NOT NULL)), ','), '') AS candidate_entity_ids
FROM ents e LEFT JOIN cands ON e.entity_id = s1_id WHERE source = 'S1' GROUP BY e.entity_id"""
K_SENSITIVITY = """WITH ks AS (SELECT unnest([1, 2, 50, 75, 100, 150]) AS k), marked AS (
  SELECT r.*, l.s1_id IS NOT NULL AS hit FROM ranked r LEFT JOIN truth_long l ON l.s1_id = r.s1_id AND l.target_id = r.target_id)
SELECT k, (SELECT count(*) FROM truth_long) AS links, count(*) FILTER (rank <= k AND hit) AS captured,
       round(count(*) FILTER (rank <= k AND hit)::DOUBLE / (SELECT count(*) FROM truth_long), 9) AS recall, count(*) FILTER (rank <= k) AS n_pairs
FROM ks, marked GROUP BY k"""
ABLATION = """WITH of_exp(experiment, strategies) AS (VALUES """ + ", ".join(
    f"('{n}', {_list(s)})" for n, s in (("EXP-001", ["exact_name"]), ("EXP-002", ["exact_name", "name_address_combo", "address_exact_combo"]), ("EXP-003", fixed.DEFAULT_STRATEGIES))
) + """), found AS (SELECT DISTINCT experiment, s1_id, target_id FROM of_exp JOIN matches ON list_contains(strategies, strategy))
SELECT experiment, count(*) AS n_pairs, count(l.s1_id) AS captured FROM found f LEFT JOIN truth_long l ON l.s1_id = f.s1_id AND l.target_id = f.target_id GROUP BY experiment"""
PER_ANCHOR = "SELECT s1_id, round(precision, 9) AS precision, round(recall, 9) AS recall, round(f_beta, 9) AS f_beta, tp::INTEGER AS tp, fp::INTEGER AS fp, fn::INTEGER AS fn, exact_match, is_singleton FROM fbeta"
MACRO = """SELECT round(avg(f_beta), 9) AS macro_f05, round(avg(precision), 9) AS macro_precision, round(avg(recall), 9) AS macro_recall, round(avg(exact_match::INT), 9) AS exact_match_accuracy,
 sum(tp)::BIGINT AS total_tp, sum(fp)::BIGINT AS total_fp, sum(fn)::BIGINT AS total_fn, count(*) FILTER (is_singleton) AS singleton_count,
 round(coalesce(avg(exact_match::INT) FILTER (is_singleton), 0), 9) AS singleton_accuracy, count(*) FILTER (NOT is_singleton) AS non_singleton_count,
 round(coalesce(avg(f_beta) FILTER (NOT is_singleton), 0), 9) AS non_singleton_macro_f05 FROM fbeta"""
BLOCKING = """SELECT round(sum(captured) / sum(links), 9) AS candidate_recall_overall, round(CASE WHEN sum(links_s2) = 0 THEN 1 ELSE sum(captured_s2) / sum(links_s2) END, 9) AS candidate_recall_s2,
 round(CASE WHEN sum(links_s3) = 0 THEN 1 ELSE sum(captured_s3) / sum(links_s3) END, 9) AS candidate_recall_s3,
 round(count(*) FILTER (links > 0 AND links = captured)::DOUBLE / count(*) FILTER (links > 0), 9) AS s1_coverage,
 sum(links)::BIGINT AS total_true_links, sum(captured)::BIGINT AS retrieved_true_links, count(*) AS total_s1_evaluated, count(*) FILTER (links > 0) AS non_singleton_s1_count,
 count(*) FILTER (links > 0 AND links = captured) AS fully_covered_s1_count, round(avg(n_candidates), 9) AS candidate_avg, round(quantile_cont(n_candidates, 0.5), 9) AS candidate_median,
 min(n_candidates) AS candidate_min, max(n_candidates) AS candidate_max, round(quantile_cont(n_candidates, 0.9), 9) AS candidate_p90, round(quantile_cont(n_candidates, 0.95), 9) AS candidate_p95,
 round(quantile_cont(n_candidates, 0.99), 9) AS candidate_p99, round(100e0 * count(*) FILTER (n_candidates = 0) / count(*), 9) AS pct_zero_candidates,
 round(100e0 * count(*) FILTER (n_candidates > 100) / count(*), 9) AS pct_gt_100_candidates, round(100e0 * count(*) FILTER (n_candidates > 1000) / count(*), 9) AS pct_gt_1000_candidates,
 round(100e0 * count(*) FILTER (n_candidates > 10000) / count(*), 9) AS pct_gt_10000_candidates, count(*) FILTER (links = 0) AS singleton_s1_count,
 round(100e0 * count(*) FILTER (links = 0 AND n_candidates = 0) / count(*) FILTER (links = 0), 9) AS singleton_pct_clean_zero_cands,
 round(coalesce(avg(n_candidates) FILTER (links = 0), 0), 9) AS singleton_candidate_avg FROM coverage"""
REDUCTION = """SELECT n * 10320219 AS total_theoretical_pairs, m AS total_final_candidate_pairs, round(n * 10320219 / m::DOUBLE, 9) AS reduction_ratio, round(100e0 * (1 - m / (n * 10320219)::DOUBLE), 9) AS reduction_percentage
FROM (SELECT count(*) AS n FROM ents WHERE source = 'S1'), (SELECT count(*) AS m FROM cands)"""
FALSE_NEGATIVES = """WITH missed AS (SELECT * FROM truth_long WHERE NOT EXISTS (SELECT 1 FROM matches m WHERE m.strategy = 'address_salient_combo' AND m.s1_id = truth_long.s1_id AND m.target_id = truth_long.target_id))
SELECT s1_id, target_id, a.business_name AS s1_name, b.business_name AS target_name, a.business_address AS s1_address, b.business_address AS target_address, upper(trim(a.country)) AS country,
 CASE WHEN upper(trim(a.country)) <> upper(trim(b.country)) AND a.country <> '' AND b.country <> '' THEN 'country_mismatch' WHEN trim(b.business_address) = '' THEN 'missing_target_address'
      WHEN regexp_matches(b.business_name, '[^\\x00-\\x7f]') AND NOT regexp_matches(a.business_name, '[^\\x00-\\x7f]') THEN 'transliteration_script_difference'
      WHEN contains(lower(b.business_name), '.com') AND NOT contains(lower(a.business_name), '.com') THEN 'url_domain_representation'
      WHEN length(a.business_name) > 0 AND length(b.business_name) > 0 AND abs(length(a.business_name) - length(b.business_name)) <= 2 THEN 'character_typo_spelling_variation'
      ELSE 'token_vocabulary_difference' END AS category
FROM missed JOIN ents a ON a.entity_id = s1_id JOIN ents b ON b.entity_id = target_id"""
LOSS = """WITH chosen AS (SELECT s1_id, target_id, list_sort(list(DISTINCT strategy)) AS strategies, min([ord, key_ord, target_seq]) AS first_rank FROM matches WHERE strategy IN ('name_address_combo', 'name_prefix_6') GROUP BY 1, 2
), own AS (
  SELECT c.s1_id, c.target_id, c.first_rank, CASE WHEN q_country <> '' AND t_country <> '' AND q_country <> t_country THEN -1e0 ELSE 0.35e0 * j3 + 0.30e0 * jt + 0.20e0 * cont + 0.10e0 * ja + 0.05e0 * num END AS score
  FROM chosen c JOIN parts p ON p.s1_id = c.s1_id AND p.target_id = c.target_id
), best AS (SELECT *, row_number() OVER (PARTITION BY s1_id ORDER BY score DESC, first_rank) AS rank FROM own WHERE score >= 0.9e0
), marks AS (
  SELECT CASE WHEN b.rank = 1 THEN NULL WHEN o.s1_id IS NULL THEN 'BLOCKING_MISS' WHEN o.score < 0 THEN 'COUNTRY_FILTER_MISS' WHEN o.score < 0.9e0 THEN 'REFINEMENT_MISS' ELSE 'TOP_K_MISS' END AS stage
  FROM truth_long l LEFT JOIN own o ON o.s1_id = l.s1_id AND o.target_id = l.target_id LEFT JOIN best b ON b.s1_id = l.s1_id AND b.target_id = l.target_id)
SELECT stage, count(*) AS n, round(100e0 * count(*) / (SELECT count(*) FROM marks WHERE stage IS NOT NULL), 2) AS pct_of_missing, round(100e0 * count(*) / (SELECT count(*) FROM marks), 2) AS pct_of_links
FROM marks WHERE stage IS NOT NULL GROUP BY stage"""
SWEEP = """WITH steps AS (SELECT round(0.05e0 * i, 2) AS threshold FROM range(1, 20) t(i)), counts AS (
  SELECT t.s1_id, threshold, len(targets) AS n, count(l.s1_id) AS m, coalesce(sum(l.label), 0) AS tp
  FROM truth t CROSS JOIN steps LEFT JOIN labelled l ON l.s1_id = t.s1_id AND l.prob >= threshold GROUP BY ALL
), each AS (
  SELECT *, CASE WHEN n = 0 AND m = 0 THEN 1e0 WHEN n = 0 OR m = 0 THEN 0e0 ELSE tp::DOUBLE / m END AS p, CASE WHEN n = 0 AND m = 0 THEN 1e0 WHEN n = 0 OR m = 0 THEN 0e0 ELSE tp::DOUBLE / n END AS r FROM counts
), sums AS (
  SELECT threshold, round(avg(CASE WHEN 0.25e0 * p + r > 0 THEN 1.25e0 * p * r / (0.25e0 * p + r) ELSE 0e0 END), 9) AS macro_f05, round(avg(p), 9) AS macro_precision, round(avg(r), 9) AS macro_recall, sum(m)::BIGINT AS predicted_match_count
  FROM each GROUP BY threshold)
SELECT *, row_number() OVER (ORDER BY macro_f05 DESC, threshold) = 1 AS is_best FROM sums"""
CEILINGS = """WITH m AS (SELECT l.s1_id, x.prob FROM truth_long l LEFT JOIN labelled x ON x.s1_id = l.s1_id AND x.target_id = l.target_id), c AS (
  SELECT count(*) AS n, count(prob) AS cand, count(*) FILTER (prob >= 0.7e0) AS hit FROM m)
SELECT n AS total_ground_truth_links, cand AS candidate_represented_true_links, hit AS model_captured_true_links, round(100e0 * cand / n, 2) AS candidate_generation_recall_ceiling_pct,
 round(100e0 * hit / cand, 2) AS model_recall_within_candidates_pct, round(100e0 * hit / n, 2) AS final_end_to_end_recall_pct, n - cand AS blocking_miss_count, cand - hit AS model_discrimination_miss_count FROM c"""
_FP = {
    "same_address_different_business": "addr_normalized_exact = 1 AND name_token_jaccard < 0.3e0",
    "shared_commercial_complex": "addr_exact_number_match = 1 AND name_token_jaccard < 0.5e0",
    "generic_name_collision": "name_compact_exact = 1 AND addr_token_jaccard < 0.2e0",
    "dba_confusion": "view_dba_alias_match = 1",
    "address_only_evidence": "addr_token_jaccard >= 0.7e0 AND name_token_jaccard < 0.2e0",
    "legal_suffix_collisions": "qual_has_legal_suffix = 1 AND name_edit_similarity >= 0.6e0 AND addr_token_jaccard < 0.3e0",
}
_FN = {
    "cross_script_names": "qual_mixed_script_pair = 1",
    "missing_address": "qual_addr_missing_t = 1",
    "weak_address": "addr_token_jaccard < 0.2e0 AND qual_addr_missing_t = 0",
    "brand_renames": "name_token_jaccard < 0.2e0 AND addr_token_jaccard >= 0.6e0",
    "severe_typos": "name_token_jaccard < 0.5e0 AND name_char_3gram_jaccard >= 0.3e0",
    "borderline_refinement_score": "refine_composite_score >= 0.15e0 AND refine_composite_score < 0.35e0",
}
_CASES = [(kind, c, f"{wrong} AND {cond}") for kind, wrong, causes in (("false_positive", "label = 0 AND prob >= 0.7e0", _FP), ("false_negative", "label = 1 AND prob < 0.7e0", _FN)) for c, cond in causes.items()]
ERRORS = (
    "WITH causes AS ("
    + " UNION ALL ".join(f"SELECT '{k}' AS kind, '{c}' AS category, count(*) FILTER ({cond}) AS n FROM labelled" for k, c, cond in _CASES)
    + """), totals AS (SELECT 'false_positive' AS kind, count(*) FILTER (label = 0 AND prob >= 0.7e0) AS n FROM labelled UNION ALL SELECT 'false_negative', count(*) FILTER (label = 1 AND prob < 0.7e0) FROM labelled)
SELECT * FROM causes UNION ALL SELECT t.kind, 'other', greatest(0, t.n - (SELECT sum(n) FROM causes c WHERE c.kind = t.kind))::BIGINT FROM totals t"""
)
_CURVE = """WITH g AS (SELECT prob, sum(label)::DOUBLE AS pos, sum(1 - label)::DOUBLE AS neg FROM labelled GROUP BY prob), s AS (
  SELECT *, sum(pos) OVER w AS cp, sum(neg) OVER w AS cn, sum(pos) OVER () AS ap, sum(neg) OVER () AS an FROM g WINDOW w AS (ORDER BY prob DESC))"""
ROC = _CURVE + " SELECT round(CASE WHEN any_value(ap) > 0 AND any_value(an) > 0 THEN sum(pos * (an - cn + neg / 2)) / any_value(ap * an) ELSE 0.5 END, 9) AS roc_auc FROM s"
AP = _CURVE + " SELECT round(coalesce(sum(CASE WHEN ap > 0 THEN pos / ap * cp / (cp + cn) END), 0), 9) AS average_precision FROM s"
_STATS = "WITH long AS (" + " UNION ALL ".join(f"SELECT '{f}' AS feature, {f} AS x, label::DOUBLE AS y FROM labelled" for f in fixed.FEATURES) + """), stats AS (
  SELECT feature, count(DISTINCT x) AS n_unique, min(x) AS min, max(x) AS max, avg(x) AS mean, quantile_cont(x, 0.5) AS median, stddev_samp(x) AS std, CASE WHEN stddev_pop(x) > 0 AND stddev_pop(y) > 0 THEN corr(x, y) END AS r FROM long GROUP BY feature)"""
AUDIT = _STATS + """ SELECT feature, n_unique, round(min, 9) AS min, round(max, 9) AS max, round(mean, 9) AS mean, round(median, 9) AS median, round(std, 9) AS std,
 coalesce(std, 0) < 1e-7 OR n_unique <= 1 AS is_constant, round(CASE WHEN coalesce(std, 0) < 1e-7 OR n_unique <= 1 THEN 0 ELSE coalesce(r, 0) END, 6) AS label_correlation FROM stats"""
TOP_CORRELATION = _STATS + " SELECT feature, round(abs(CASE WHEN coalesce(std, 0) < 1e-7 OR n_unique <= 1 THEN 0 ELSE coalesce(r, 0) END), 4) AS r FROM stats ORDER BY r DESC, feature LIMIT 10"
SPLIT = """SELECT entity_id, row_number() OVER (ORDER BY md5('42|' || entity_id), entity_id) <= round_even((SELECT count(*) FROM ents WHERE source = 'S1') * 0.2e0, 0) AS is_validation FROM ents WHERE source = 'S1'"""
DISTRACTORS = """WITH needed AS (SELECT DISTINCT target_id FROM truth_long), other AS (
  SELECT entity_id, source, row_number() OVER (PARTITION BY source ORDER BY seq) AS k FROM ents WHERE source <> 'S1' AND entity_id NOT IN (SELECT target_id FROM needed))
SELECT entity_id, source FROM ents WHERE source <> 'S1' AND entity_id IN (SELECT target_id FROM needed) UNION ALL SELECT entity_id, source FROM other WHERE k <= 50"""
PROFILE = """WITH long AS (""" + " UNION ALL ".join(f"SELECT source, '{c}' AS col, coalesce({c}, '') AS value FROM ents" for c in ("business_name", "business_address", "country")) + """)
SELECT source, col AS "column", count(*) AS n_rows, count(*) FILTER (value = '') AS n_missing, count(DISTINCT value) AS n_distinct, min(length(value)) AS min_length, round(avg(length(value)), 9) AS avg_length, max(length(value)) AS max_length FROM long GROUP BY 1, 2"""
GT_SUMMARY = """SELECT count(*) FILTER (len(targets) = 0) AS zero, count(*) FILTER (len(targets) = 1) AS single, count(*) FILTER (len(targets) > 1) AS multi, sum(len(targets))::BIGINT AS links,
 (SELECT count(DISTINCT target_id) FROM truth_long) AS unique_targets, (SELECT count(*) FROM (SELECT target_id FROM truth_long GROUP BY 1 HAVING count(DISTINCT s1_id) > 1)) AS multi_anchor_targets FROM truth"""
VIOLATIONS = """WITH s AS (SELECT entity_id AS s1, seq FROM ents WHERE source = 'S1'
), cl AS (SELECT s1, CASE s1 WHEN 'S1-0' THEN 1 WHEN 'S1-1' THEN 0 ELSE seq END AS line, list_concat(list_filter(list(DISTINCT target_id), lambda x: x IS NOT NULL), CASE WHEN s1 = 'S1-0' THEN ['S2-unknown'] ELSE [] END) AS items FROM s LEFT JOIN (SELECT * FROM matches WHERE strategy = 'exact_name') ON s1 = s1_id GROUP BY s1, seq
), ml AS (SELECT s1, CASE s1 WHEN 'S1-0' THEN 1 WHEN 'S1-1' THEN 0 ELSE seq END AS line, list_concat(list_filter(list(DISTINCT target_id), lambda x: x IS NOT NULL), CASE WHEN s1 = 'S1-0' THEN ['S2-unknown'] ELSE [] END) AS items FROM s LEFT JOIN truth_long ON s1 = s1_id GROUP BY s1, seq
), pool AS (SELECT entity_id FROM ents WHERE source <> 'S1'
), files AS (SELECT 'candidates' AS f, * FROM cl UNION ALL SELECT 'matches', * FROM ml
), items AS (SELECT f, s1, unnest(items) AS item FROM files)
SELECT f || '_not_sorted' AS rule, a.s1 AS s1_id, a.line::VARCHAR AS detail FROM files a JOIN (SELECT f, line + 1 AS line, s1 AS above FROM files) b USING (f, line) WHERE a.s1 < above
UNION ALL SELECT f || '_unknown_target', s1, item FROM items WHERE item NOT IN (SELECT entity_id FROM pool)
UNION ALL SELECT 'match_not_in_candidates', s1, NULL FROM cl JOIN ml USING (s1) WHERE len(list_filter(ml.items, lambda x: NOT list_contains(cl.items, x))) > 0"""
DIAGNOSTICS = """WITH per AS (SELECT t.s1_id, count(c.target_id) AS n FROM truth t LEFT JOIN cands c USING (s1_id) GROUP BY 1), s AS (SELECT round(score, 6) AS score FROM cands)
SELECT round(avg(n), 9) AS mean, round(quantile_cont(n, 0.5), 9) AS median, round(quantile_cont(n, 0.9), 9) AS p90, round(quantile_cont(n, 0.95), 9) AS p95, round(quantile_cont(n, 0.99), 9) AS p99, max(n) AS max,
 round(avg((n = 0)::INT), 9) AS zero_share, """ + ", ".join(
    ["(SELECT count(*) FROM s) AS n_pairs"]
    + [f"(SELECT round(quantile_cont(score, {p / 100}), 9) FROM s) AS score_p{p:02d}" for p in (1, 5, 25, 50, 75, 95, 99)]
    + [f"(SELECT count(*) FILTER (score >= {t}e0) FROM s) AS at_least_{round(100 * t)}" for t in (0.15, 0.25, 0.5, 0.7, 0.9)]
) + " FROM per"

AT_THRESHOLD = _CURVE + """, curve AS (
  SELECT CASE WHEN any_value(ap) > 0 AND any_value(an) > 0 THEN sum(pos * (an - cn + neg / 2)) / any_value(ap * an) ELSE 0.5 END AS roc_auc,
         coalesce(sum(CASE WHEN ap > 0 THEN pos / ap * cp / (cp + cn) END), 0) AS pr_auc FROM s
), chosen AS (SELECT s1_id, target_id FROM labelled WHERE prob >= 0.7e0
), counts AS (
  SELECT t.s1_id, len(targets) AS n, count(c.target_id) AS m, count(c.target_id) FILTER (list_contains(targets, c.target_id)) AS tp FROM truth t LEFT JOIN chosen c USING (s1_id) GROUP BY ALL
), each AS (
  SELECT *, CASE WHEN n = 0 AND m = 0 THEN 1e0 WHEN n = 0 OR m = 0 THEN 0e0 ELSE tp::DOUBLE / m END AS p, CASE WHEN n = 0 AND m = 0 THEN 1e0 WHEN n = 0 OR m = 0 THEN 0e0 ELSE tp::DOUBLE / n END AS r FROM counts
), scores AS (SELECT *, CASE WHEN 0.25e0 * p + r > 0 THEN 1.25e0 * p * r / (0.25e0 * p + r) ELSE 0e0 END AS f FROM each
), pair AS (SELECT count(*) FILTER (prob >= 0.7e0 AND label = 1) AS tp, count(*) FILTER (prob >= 0.7e0) AS chosen, count(*) FILTER (label = 1) AS pos FROM labelled)
SELECT 0.7e0 AS threshold, round(avg(f), 4) AS macro_f05, round(avg(p), 4) AS macro_precision, round(avg(r), 4) AS macro_recall,
 (SELECT round(CASE WHEN chosen = 0 THEN 0 ELSE tp / chosen END, 4) FROM pair) AS pairwise_precision, (SELECT round(CASE WHEN pos = 0 THEN 0 ELSE tp / pos END, 4) FROM pair) AS pairwise_recall,
 (SELECT round(roc_auc, 4) FROM curve) AS roc_auc, (SELECT round(pr_auc, 4) FROM curve) AS pr_auc, round(coalesce(avg(f) FILTER (n = 1), 0), 4) AS singleton_f05,
 round(coalesce(avg(f) FILTER (n > 1), 0), 4) AS multi_match_f05, round(coalesce(avg((m = 0)::INT) FILTER (n = 0), 0), 4) AS zero_match_accuracy, (SELECT chosen FROM pair) AS predicted_match_count FROM scores"""
_NAMES = fixed.FEATURE_GROUPS["name"]
CORRELATED = " UNION ALL ".join(
    f"SELECT '{a}' AS a, '{b}' AS b, round(corr({a}, {b}), 6) AS r FROM labelled HAVING stddev_pop({a}) > 0 AND stddev_pop({b}) > 0 AND abs(corr({a}, {b})) >= 0.9" for i, a in enumerate(_NAMES) for b in _NAMES[i + 1 :]
)
_SETS = {
    "EXP-001": (["exact_name"], None, None), "EXP-002": (["exact_name", "name_address_combo", "address_exact_combo"], None, None), "EXP-003": (fixed.DEFAULT_STRATEGIES, None, None),
    "EXP-004": (fixed.DEFAULT_STRATEGIES, 0.15, 50), "EXP-005": (fixed.DEFAULT_STRATEGIES, 0.25, 30), "EXP-010": ([*fixed.DEFAULT_STRATEGIES, "name_leet_compact"], 0.15, 50),
    "EXP-011": ([*fixed.DEFAULT_STRATEGIES, "name_dba_alias"], 0.15, 50), "EXP-012": ([*fixed.DEFAULT_STRATEGIES, "address_salient_combo"], 0.15, 50), "EXP-013": (fixed.STRATEGIES, 0.15, 50),
}
EXPERIMENTS = """WITH of_exp(experiment, allowed, least, k) AS (VALUES """ + ", ".join(f"('{n}', {_list(s)}, {'NULL::DOUBLE' if t is None else f'{t}e0'}, {'NULL::BIGINT' if k is None else k})" for n, (s, t, k) in _SETS.items()) + """
), met AS (
  SELECT experiment, least, k, s1_id, target_id, list(DISTINCT strategy) AS own, min([ord, key_ord, target_seq]) AS first FROM of_exp JOIN matches ON list_contains(allowed, strategy) GROUP BY ALL
), judged AS (
  SELECT m.*, CASE WHEN q_country <> '' AND t_country <> '' AND q_country <> t_country THEN -1e0
                   WHEN list_has_any(own, """ + _list(fixed.BYPASS_STRATEGIES) + """) THEN 1e0 ELSE 0.35e0 * j3 + 0.30e0 * jt + 0.20e0 * cont + 0.10e0 * ja + 0.05e0 * num END AS own_score
  FROM met m JOIN parts p ON p.s1_id = m.s1_id AND p.target_id = m.target_id
), placed AS (
  SELECT *, row_number() OVER (PARTITION BY experiment, s1_id ORDER BY own_score DESC, first) AS place FROM judged
  WHERE least IS NULL OR (own_score >= 0 AND (list_has_any(own, ['exact_name', 'sorted_name_tokens']) OR own_score >= least))
), counted AS (
  SELECT experiment, count(*) AS n_pairs, count(l.s1_id) AS captured FROM placed p LEFT JOIN truth_long l ON l.s1_id = p.s1_id AND l.target_id = p.target_id WHERE k IS NULL OR place <= k GROUP BY experiment)
SELECT experiment, n_pairs, (SELECT count(*) FROM truth_long) AS links, captured, round(captured::DOUBLE / (SELECT count(*) FROM truth_long), 9) AS recall,
 round(n_pairs::DOUBLE / (SELECT count(*) FROM truth), 9) AS mean_candidates FROM counted"""
