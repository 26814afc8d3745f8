"""Feature values of pairs, worked out in Python where the texts of both records are at hand.

They are those of the columns in `features`. What a feature needs of one record is made once for all its pairs of a
piece, and never leaves the worker.
"""

from __future__ import annotations

from collections.abc import Callable, Iterator, Sequence
from functools import cached_property

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc

from kindred.functions import fixed
from kindred.functions.text import edit_distance

_STOP, _COMMON = frozenset(fixed.NAME_STOPWORDS), frozenset(fixed.COMMON_STREET_WORDS)
#: Characters of the texts whose grams a worker holds at once; a longer pair is alone.
CHARACTERS_AT_ONCE = 1 << 19


def _grams(text: str, n: int) -> frozenset[str]:
    return frozenset(text[i : i + n] for i in range(len(text) - n + 1)) if len(text) >= n else frozenset([text] if text else [])


class Record:
    """A record's texts and the sets made of them, each when first asked for."""

    def __init__(self, name: str, addr: str, leet: str | None, aliases: list[str] | None, numbers: list[str] | None, postal: list[str] | None) -> None:
        self.name, self.addr, self._leet, self.aliases, self.numbers, self.postal = name, addr, leet, frozenset(aliases or ()), frozenset(numbers or ()), frozenset(postal or ())

    compact = cached_property(lambda r: r.name.replace(" ", ""))
    leet = cached_property(lambda r: r.compact if r._leet is None else r._leet)
    addr_compact = cached_property(lambda r: r.addr.replace(" ", ""))
    tokens = cached_property(lambda r: [w for w in r.name.split(" ") if w and w not in _STOP])
    token_set = cached_property(lambda r: frozenset(r.tokens))
    longest = cached_property(lambda r: max(r.tokens, key=len, default=""))
    addr_tokens = cached_property(lambda r: [w for w in r.addr.split(" ") if len(w) >= 2])
    salient = cached_property(lambda r: frozenset(w for w in r.addr_tokens if len(w) >= 4 and w not in _COMMON))
    tail = cached_property(lambda r: frozenset(r.addr_tokens[-2:]))
    g2 = cached_property(lambda r: _grams(r.compact, 2))
    g4 = cached_property(lambda r: _grams(r.compact, 4))
    a3 = cached_property(lambda r: _grams(r.addr_compact, 3))
    a4 = cached_property(lambda r: _grams(r.addr_compact, 4))
    l3 = cached_property(lambda r: _grams(r.leet, 3))


def _jaccard(a: frozenset, b: frozenset) -> float:
    if not a or not b:
        return 0.0
    n = len(a & b)
    return n / (len(a) + len(b) - n)


def _run(a: str, b: str) -> float:
    """Leading characters that agree, as a share of the longer text."""
    if not a or not b:
        return 0.0
    n = next((i for i, (x, y) in enumerate(zip(a, b, strict=False)) if x != y), min(len(a), len(b)))
    return n / max(len(a), len(b))


def _within(a: str, b: str) -> bool:
    return a != "" and b != "" and (a in b or b in a)


def _alias(a: Record, b: Record) -> bool:
    return bool(a.aliases or b.aliases) and ((a.compact != "" and a.compact in b.aliases) or (b.compact != "" and b.compact in a.aliases) or not a.aliases.isdisjoint(b.aliases))


def _edited(a: str, b: str) -> float:
    """text.edit_similarity of whole texts."""
    if not a or not b:
        return 0.0
    return 1.0 if a == b else 1.0 - edit_distance(a, b) / max(len(a), len(b))


#: Spark's levenshtein takes time by the product of both lengths; above this length of the shorter text, bits do.
LONG = 256


VALUES: dict[str, Callable[[Record, Record], float]] = {
    "name_normalized_exact": lambda a, b: a.name != "" and a.name == b.name,
    "name_compact_exact": lambda a, b: a.compact != "" and a.compact == b.compact,
    "name_char_2gram_jaccard": lambda a, b: _jaccard(a.g2, b.g2),
    "name_char_4gram_jaccard": lambda a, b: _jaccard(a.g4, b.g4),
    "name_compact_containment": lambda a, b: _within(a.compact, b.compact),
    "name_prefix_similarity": lambda a, b: _run(a.compact, b.compact),
    "name_suffix_similarity": lambda a, b: _run(a.compact[::-1], b.compact[::-1]),
    "name_token_count_diff": lambda a, b: abs(len(a.tokens) - len(b.tokens)),
    "name_shared_token_count": lambda a, b: len(a.token_set & b.token_set),
    "name_longest_token_match": lambda a, b: a.longest != "" and a.longest == b.longest,
    "addr_normalized_exact": lambda a, b: a.addr != "" and a.addr == b.addr,
    "addr_compact_exact": lambda a, b: a.addr_compact != "" and a.addr_compact == b.addr_compact,
    "addr_char_3gram_jaccard": lambda a, b: _jaccard(a.a3, b.a3),
    "addr_char_4gram_jaccard": lambda a, b: _jaccard(a.a4, b.a4),
    "addr_shared_numbers_count": lambda a, b: len(a.numbers & b.numbers),
    "addr_postal_code_match": lambda a, b: not a.postal.isdisjoint(b.postal),
    "addr_locality_overlap": lambda a, b: _jaccard(a.salient, b.salient),
    "addr_state_overlap": lambda a, b: not a.tail.isdisjoint(b.tail),
    "addr_containment": lambda a, b: _within(a.addr_compact, b.addr_compact),
    "addr_token_count_diff": lambda a, b: abs(len(a.addr_tokens) - len(b.addr_tokens)),
    "addr_is_missing_either": lambda a, b: a.addr == "" or b.addr == "",
    "view_leet_name_exact": lambda a, b: a.leet != "" and a.leet == b.leet,
    "view_leet_name_sim": lambda a, b: _jaccard(a.l3, b.l3),
    "view_dba_alias_match": _alias,
    "name_long_edit_similarity": lambda a, b: _edited(a.name, b.name) if min(len(a.name), len(b.name)) > LONG else -1.0,
}


def _pieces(size: np.ndarray) -> Iterator[tuple[int, int]]:
    group = (np.cumsum(size) - size) // CHARACTERS_AT_ONCE
    cuts = [*np.flatnonzero(np.r_[True, group[1:] != group[:-1]]).tolist(), len(size)]
    yield from zip(cuts, cuts[1:], strict=False)


def values(columns: Sequence[pa.Array], q: np.ndarray, t: np.ndarray, wanted: Sequence[str]) -> dict[str, np.ndarray]:
    """wanted of VALUES for pairs of rows q and t. columns: what Record takes, in its order."""
    out = {f: np.empty(len(q)) for f in wanted}
    if not wanted or not len(q):
        return out
    size = sum(pc.utf8_length(c).to_numpy() for c in columns[:2])
    for i, j in _pieces(size[q] + size[t]):
        rows = np.unique(np.concatenate([q[i:j], t[i:j]]))
        made = dict(zip(rows.tolist(), (Record(*x) for x in zip(*(c.take(pa.array(rows)).to_pylist() for c in columns), strict=True)), strict=True))
        pairs = [(made[a], made[b]) for a, b in zip(q[i:j].tolist(), t[i:j].tolist(), strict=True)]
        for f in wanted:
            of = VALUES[f]
            out[f][i:j] = [of(a, b) for a, b in pairs]
    return out
