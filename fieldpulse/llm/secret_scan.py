"""Secret scans with a trigram inverted index.

From every rule's regular expression a Boolean query over trigrams is derived that each match must satisfy: strings that
must occur give a conjunction of their trigrams, alternatives a disjunction. A task indexes its documents shard by shard:
for each trigram of some rule, the sorted list of documents that hold it. Intersecting and uniting these postings leaves the candidate
documents of a rule, and only they are searched with the expression itself. A rule without mandatory trigrams searches all documents.
The index ignores the case of ASCII letters, which can only add candidates.
"""

from __future__ import annotations

import re
import re._constants as rc
import re._parser as parser
from collections.abc import Iterator
from dataclasses import dataclass
from functools import lru_cache

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame

from fieldpulse.llm.tables import ship
from fieldpulse.llm.words import LOWER, Slice, slices


@dataclass(frozen=True)
class Rule:
    """A kind of secret: a match counts if its ``group`` has at least ``least`` characters. Failing matches are not tried again."""
    kind: str
    pattern: str
    group: int = 0
    least: int = 1


# The three base rules.
BASE_RULES = (
    Rule("assign", r"""(?ai:(password|passwd|secret|token|api_?key))["']?\x20*[:=]\x20*["']?([A-Za-z0-9+/_.=-]+)""", 2, 6),
    Rule("access", r"AKIA[A-Z0-9]+", 0, 20),
    Rule("hex", r"[0-9a-f]+", 0, 24),
)
# Published formats of credentials.
MORE_RULES = (
    Rule("private_key", r"-----BEGIN (?:[A-Z]+ ){0,3}PRIVATE KEY-----"),
    Rule("github", r"\b(?:gh[pousr]_[A-Za-z0-9]{36,}|github_pat_[A-Za-z0-9_]{60,})"),
    Rule("slack", r"\bxox[abprs]-[A-Za-z0-9-]{20,}"),
    Rule("google", r"\bAIza[0-9A-Za-z_-]{35}"),
    # Parts are taken whole and begin where a run begins, so that a long run is not tried from each of its places.
    Rule("jwt", r"(?<![A-Za-z0-9_-])eyJ[A-Za-z0-9_-]{10,}+\.eyJ[A-Za-z0-9_-]{10,}+\.[A-Za-z0-9_-]{10,}"),
)
RULES = BASE_RULES + MORE_RULES

MOST_STRINGS = 64

# A query is True (no condition), a trigram, or ("and" | "or", queries).
Query = bool | str | tuple


def _all(queries: list[Query]) -> Query:
    queries = [q for q in dict.fromkeys(queries) if q is not True]
    return True if not queries else queries[0] if len(queries) == 1 else ("and", tuple(queries))


def _any(queries: list[Query]) -> Query:
    queries = list(dict.fromkeys(queries))
    return True if True in queries or not queries else queries[0] if len(queries) == 1 else ("or", tuple(queries))


def _holds(strings: frozenset[str]) -> Query:
    """One of the strings must occur."""
    return _any([_all([s[i:i + 3] for i in range(len(s) - 2)]) for s in sorted(strings)])


def _class(members: list) -> frozenset[str] | None:
    """The lower-cased characters of a small class."""
    held = set()
    for kind, value in members:
        if kind is rc.LITERAL:
            held.add(chr(value).lower())
        elif kind is rc.RANGE and value[1] - value[0] < 8:
            held.update(chr(c).lower() for c in range(value[0], value[1] + 1))
        else:
            return None
    return frozenset(held) if len(held) <= 8 and all(c.isascii() for c in held) else None


def _derive(items) -> tuple[frozenset[str] | None, Query]:
    """(all strings a sequence can match, if these are few; the condition that its matches satisfy otherwise)."""
    exact, found, whole = frozenset({""}), [], True
    for kind, value in items:
        strings, query = None, True
        if kind is rc.LITERAL:
            strings = frozenset({chr(value).lower()}) if value < 128 else None
        elif kind is rc.IN:
            strings = _class(value)
        elif kind is rc.AT:
            continue
        elif kind is rc.SUBPATTERN:
            # Without the ASCII flag, letters outside ASCII may match those of the rule.
            if not value[1] & re.IGNORECASE or value[1] & re.ASCII:
                strings, query = _derive(value[3])
        elif kind is rc.BRANCH:
            parts = [_derive(part) for part in value[1]]
            if all(part[0] is not None for part in parts):
                strings = frozenset().union(*(part[0] for part in parts))
            else:
                query = _any([_holds(s) if s is not None else q for s, q in parts])
        elif kind in (rc.MAX_REPEAT, rc.MIN_REPEAT, rc.POSSESSIVE_REPEAT):
            least, most, body = value
            inner, held = _derive(body)
            if inner is not None and (least, most) == (0, 1):
                strings = inner | {""}
            elif inner is not None and least == most and least <= 4:
                strings = frozenset({""})
                for _ in range(least):
                    strings = frozenset(a + b for a in strings for b in inner) if len(strings) * len(inner) <= MOST_STRINGS else None
                    if strings is None:
                        break
            if strings is None and least:
                query = _holds(inner) if inner is not None else held
        if strings is not None and len(strings) * len(exact) <= MOST_STRINGS:
            exact = frozenset(a + b for a in exact for b in strings)
            continue
        found += [_holds(exact), query if strings is None else _holds(strings)]
        exact, whole = frozenset({""}), False
    return (exact, True) if whole else (None, _all([*found, _holds(exact)]))


@lru_cache(maxsize=256)
def trigram_query(pattern: str) -> Query:
    """The condition on (lower-case) trigrams that a text must satisfy to match; True if there is none."""
    parsed = parser.parse(pattern)
    if parsed.state.flags & re.IGNORECASE and not parsed.state.flags & re.ASCII:
        return True
    exact, query = _derive(parsed)
    return _holds(exact) if exact is not None else query


def _trigrams(query: Query) -> set[str]:
    if isinstance(query, str):
        return {query}
    return set() if query is True else set().union(*(_trigrams(q) for q in query[1]))


def postings(part: Slice, wanted: list[str]) -> dict[str, np.ndarray]:
    """For each wanted trigram the sorted documents of the shard that hold it."""
    data = LOWER[part.data]
    if len(data) < 3:
        return {}
    small = data & 0x7F
    code = (small[:-2].astype(np.int32) << 14) | (small[1:-1].astype(np.int32) << 7) | small[2:]
    number = np.full(1 << 21, -1, np.int16)
    number[[(ord(t[0]) << 14) | (ord(t[1]) << 7) | ord(t[2]) for t in wanted]] = np.arange(len(wanted))
    held = number[code]
    at = np.flatnonzero(held >= 0)
    at = at[(data[at] < 128) & (data[at + 1] < 128) & (data[at + 2] < 128)]
    doc = np.searchsorted(part.offsets, at, "right") - 1
    inside = at + 3 <= part.offsets[doc + 1]
    pairs = np.unique(held[at[inside]].astype(np.int64) * part.n_docs + doc[inside])
    cuts = np.searchsorted(pairs, np.arange(len(wanted) + 1) * part.n_docs)
    return {t: pairs[a:b] - i * part.n_docs for i, (t, a, b) in enumerate(zip(wanted, cuts, cuts[1:]))}


def matching(query: Query, index: dict[str, np.ndarray], n_docs: int) -> np.ndarray:
    """Documents of the shard that satisfy the query."""
    if query is True:
        return np.arange(n_docs)
    if isinstance(query, str):
        return index.get(query, np.zeros(0, np.int64))
    parts = [matching(q, index, n_docs) for q in query[1]]
    result = parts[0]
    for part in parts[1:]:
        result = np.intersect1d(result, part, assume_unique=True) if query[0] == "and" else np.union1d(result, part)
    return result


SPANS = "array<struct<kind:string,start:int,end:int>>"


def find_secrets(docs: DataFrame, rules: tuple[Rule, ...] = RULES) -> DataFrame:
    """(doc_id, spans) of every row of ``docs(doc_id, text)``: code point spans by start, then by the order of the rules.

    Per rule the matches are leftmost and do not overlap; those of different rules may. A null text is empty and has no spans.
    Repeated rows stay. Other columns are not used.
    """
    ship(docs.sparkSession)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        compiled = [(rule, re.compile(rule.pattern), trigram_query(rule.pattern)) for rule in rules]
        wanted = sorted(set().union(*(_trigrams(query) for _, _, query in compiled)))
        span = pa.struct([("kind", pa.string()), ("start", pa.int32()), ("end", pa.int32())])
        for batch in batches:
            for part in slices(batch.column("text")):
                index = postings(part, wanted)
                texts: dict[int, str] = {}
                found: list[list] = [[] for _ in range(part.n_docs)]
                for order, (rule, expression, query) in enumerate(compiled):
                    for doc in matching(query, index, part.n_docs).tolist():
                        if doc not in texts:
                            texts[doc] = part.text(doc).decode("utf-8", "replace")
                        for match in expression.finditer(texts[doc]):
                            if match.end(rule.group) - match.start(rule.group) >= rule.least:
                                found[doc].append((match.start(), order, match.end()))
                rows = [[{"kind": rules[order].kind, "start": a, "end": b} for a, order, b in sorted(spans)] for spans in found]
                yield pa.record_batch([batch.column("doc_id").slice(part.first, part.n_docs), pa.array(rows, pa.list_(span))], ["doc_id", "spans"])
    return docs.select("doc_id", "text").mapInArrow(run, f"doc_id {docs.schema['doc_id'].dataType.simpleString()}, spans {SPANS}")
