"""Secret scan: a trigram index says which texts a rule's regex can match at all.

From each regex a Boolean query over trigrams is derived that every match must satisfy. Each
task indexes its texts, a segment of bounded size at a time: for each trigram a posting list of
the texts that hold it, letters A-Z lowered. The query's lists are intersected and united, and
only the texts that remain are searched with the regex. A rule without mandatory trigrams is
searched for in every text of the segment. ``trigram_index`` keeps the same lists as a table.

Spans are in code points, the end exclusive. Matches of one kind do not overlap; those that fail
a rule's minimum length are dropped. NULL text counts as empty: no spans. Repeated documents are
scanned one by one. Other columns are not read.
"""

from __future__ import annotations

import hashlib
import re
from collections.abc import Iterator
from dataclasses import dataclass
from functools import cached_property
from re import _constants as op
from re import _parser as parser

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from gaugemill.llm.words import slices

# A query is True (anything may match), a trigram, or ("and" | "or", queries).
Query = bool | int | tuple

MOST_TEXTS = 1 << 12  # texts of a segment


@dataclass(frozen=True)
class Rule:
    """A kind of secret. ``group`` of a match must have ``shortest`` characters."""

    kind: str
    pattern: str
    shortest: int = 0
    group: int = 0
    any_case: bool = False

    @cached_property
    def regex(self) -> re.Pattern:
        flags = re.IGNORECASE | re.ASCII if self.any_case else re.ASCII
        return re.compile(self.pattern, flags)

    @cached_property
    def query(self) -> Query:
        return trigram_query(self.pattern)

    def spans(self, text: str) -> list[tuple[int, int]]:
        return [
            match.span()
            for match in self.regex.finditer(text)
            if len(match[self.group]) >= self.shortest
        ]


# The base kinds, in the order in which they are listed.
BASE_RULES = (
    Rule(
        "assign",
        r"""(password|passwd|secret|token|api_?key)["']?\x20*[:=]\x20*["']?([A-Za-z0-9+/_.=-]+)""",
        shortest=12,
        group=2,
        any_case=True,
    ),
    Rule("access", r"AKIA[A-Z0-9]+", shortest=18),
    Rule("hex", r"[0-9a-f]{16,}"),  # runs are maximal, so shorter ones need not be matched
)
MORE_RULES = (
    Rule("private_key", r"-----BEGIN [A-Z ]*PRIVATE KEY-----"),
    Rule("code_host", r"gh[pousr]_[A-Za-z0-9]{36,}"),
    Rule("chat", r"xox[abprs]-[A-Za-z0-9-]{10,}"),
    Rule("web_token", r"eyJ[A-Za-z0-9_-]{8,}\.eyJ[A-Za-z0-9_-]{8,}\.[A-Za-z0-9_-]{8,}"),
    Rule("maps_key", r"AIza[A-Za-z0-9_-]{35}"),
    Rule("payment", r"[rs]k_(?:live|test)_[A-Za-z0-9]{16,}"),
    Rule("bearer", r"bearer\x20+[A-Za-z0-9+/_.=-]{20,}", any_case=True),
)


# Queries


def trigram_query(pattern: str) -> Query:
    """What trigrams, A-Z lowered, a text must hold for the regex to match somewhere."""
    return _simplified(_of(list(parser.parse(pattern))))


_MOST_STRINGS = 64  # alternatives that are multiplied out at most


def _of(items: list) -> Query:
    """A sequence of parsed items: trigrams of the exact strings in it, and its parts' queries."""
    parts: list[Query] = []
    exact = {b""}  # all strings that the items since the last break can match
    for code, value in items:
        found, query = _exact(code, value)
        if found is not None and len(found) * len(exact) <= _MOST_STRINGS:
            exact = {before + after for before in exact for after in found}
            continue
        parts.append(_holds(exact))
        if found is not None and len(found) <= _MOST_STRINGS:
            exact = found
        else:
            parts.append(query)
            exact = {b""}
    return ("and", [*parts, _holds(exact)])


def _exact(code, value) -> tuple[set[bytes] | None, Query]:
    """All strings an item matches, if they are few; else a query that its matches satisfy."""
    if code is op.LITERAL:
        return ({chr(value).encode().lower()} if value < 128 else None), True
    if code is op.IN:
        strings: set[bytes] = set()
        for kind, what in value:
            if kind is op.LITERAL and what < 128:
                strings.add(chr(what).encode().lower())
            elif kind is op.RANGE and what[1] < 128 and what[1] - what[0] < 8:
                strings |= {chr(c).encode().lower() for c in range(what[0], what[1] + 1)}
            else:
                return None, True
        return (strings if len(strings) <= 8 else None), True
    if code is op.SUBPATTERN:
        return _sequence(list(value[-1]))
    if code is op.BRANCH:
        branches = [_sequence(list(branch)) for branch in value[1]]
        if all(strings is not None for strings, _ in branches):
            return set().union(*(strings for strings, _ in branches)), True
        return None, ("or", [_of(list(branch)) for branch in value[1]])
    if code in (op.MAX_REPEAT, op.MIN_REPEAT, op.POSSESSIVE_REPEAT):
        least, most, inner = value
        strings, _ = _sequence(list(inner))
        if strings is not None and least == 0 and most == 1:
            return strings | {b""}, True
        if strings is not None and least == most and len(strings) ** least <= _MOST_STRINGS:
            repeated = {b""}
            for _ in range(least):
                repeated = {before + after for before in repeated for after in strings}
            return repeated, True
        return None, (_of(list(inner)) if least > 0 else True)
    if code is op.ATOMIC_GROUP:
        return _sequence(list(value))
    return None, True  # a class, an assertion, any character: nothing is mandatory


def _sequence(items: list) -> tuple[set[bytes] | None, Query]:
    exact = {b""}
    for code, value in items:
        found, _ = _exact(code, value)
        if found is None or len(found) * len(exact) > _MOST_STRINGS:
            return None, _of(items)
        exact = {before + after for before in exact for after in found}
    return exact, True


def _holds(strings: set[bytes]) -> Query:
    """One of the strings is there, as far as trigrams tell."""
    if any(len(string) < 3 for string in strings):
        return True
    return ("or", [("and", [_code(s[i : i + 3]) for i in range(len(s) - 2)]) for s in strings])


def _code(trigram: bytes) -> int:
    return trigram[0] << 16 | trigram[1] << 8 | trigram[2]


def _simplified(query: Query) -> Query:
    if not isinstance(query, tuple):
        return query
    name, parts = query[0], [_simplified(part) for part in query[1]]
    if name == "and":
        parts = [part for part in parts if part is not True]
        if not parts:
            return True
    elif any(part is True for part in parts):
        return True
    return parts[0] if len(parts) == 1 else (name, parts)


# Index


class Segment:
    """Posting lists of some texts: for each trigram the ascending texts that hold it."""

    def __init__(self, data: np.ndarray, offsets: np.ndarray) -> None:
        self.texts = len(offsets) - 1
        upper = (data >= 0x41) & (data <= 0x5A)
        low = (data + upper.astype(np.uint8) * np.uint8(32)).astype(np.int64)
        codes = low[:-2] << 16 | low[1:-1] << 8 | low[2:]
        text = np.repeat(np.arange(self.texts), np.diff(offsets))[: len(codes)]
        whole = np.arange(len(codes)) + 3 <= offsets[1:][text]
        pairs = np.sort(codes[whole] << 16 | text[whole])
        first = np.ones(len(pairs), bool)
        first[1:] = pairs[1:] != pairs[:-1]
        pairs = pairs[first]
        self.postings = pairs & 0xFFFF
        trigrams = pairs >> 16
        starts = np.ones(len(pairs), bool)
        starts[1:] = trigrams[1:] != trigrams[:-1]
        self.trigrams = trigrams[starts]
        self.first = np.append(np.flatnonzero(starts), len(pairs))

    def posting(self, trigram: int) -> np.ndarray:
        at = np.searchsorted(self.trigrams, trigram)
        if at == len(self.trigrams) or self.trigrams[at] != trigram:
            return self.postings[:0]
        return self.postings[self.first[at] : self.first[at + 1]]

    def candidates(self, query: Query) -> np.ndarray:
        """Ascending texts that satisfy a query."""
        if query is True:
            return np.arange(self.texts)
        if not isinstance(query, tuple):
            return self.posting(query)
        name, parts = query
        found = self.candidates(parts[0])
        for part in parts[1:]:
            if name == "and":
                if not found.size:
                    break
                found = np.intersect1d(found, self.candidates(part), assume_unique=True)
            else:
                found = np.union1d(found, self.candidates(part))
        return found


def _segments(texts: pa.Array) -> Iterator[tuple[int, int, Segment]]:
    for row, end, data, offsets in slices(texts):
        for begin in range(0, end - row, MOST_TEXTS):
            some = offsets[begin : min(begin + MOST_TEXTS, end - row) + 1]
            yield row + begin, row + begin + len(some) - 1, Segment(
                data[some[0] : some[-1]], some - some[0]
            )


def trigram_index(docs: DataFrame) -> DataFrame:
    """The posting lists as a table: trigram and ``doc_ids``, a row per segment.

    Rows without an id cannot be referred to and are left out; nothing is shuffled.
    """

    def index(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for row, _, segment in _segments(batch.column(1)):
                yield pa.RecordBatch.from_arrays(
                    [
                        pa.array(segment.trigrams, pa.int32()),
                        pa.ListArray.from_arrays(
                            pa.array(segment.first, pa.int32()),
                            batch.column(0).take(pa.array(segment.postings + row)),
                        ),
                    ],
                    names=["trigram", "doc_ids"],
                )

    named = docs.select(F.col("doc_id").cast("long"), "text").where(F.col("doc_id").isNotNull())
    return named.mapInArrow(index, "trigram int, doc_ids array<long>")


# Scan


def scan_secrets(docs: DataFrame, rules: tuple[Rule, ...] = BASE_RULES + MORE_RULES) -> DataFrame:
    """Per document the spans of each rule, by start, then in the order of the rules."""

    def scan(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for row, end, segment in _segments(batch.column(1)):
                texts = batch.column(1).slice(row, end - row)
                found: list[list] = [[] for _ in range(end - row)]
                read: dict[int, str] = {}
                for place, rule in enumerate(rules):
                    for at in segment.candidates(rule.query).tolist():
                        if at not in read:
                            read[at] = texts[at].as_py() or ""
                        found[at].extend((a, place, b) for a, b in rule.spans(read[at]))
                spans = [
                    [
                        {"kind": rules[place].kind, "start": a, "end": b}
                        for a, place, b in sorted(each)
                    ]
                    for each in found
                ]
                yield pa.RecordBatch.from_arrays(
                    [batch.column(0).slice(row, end - row), pa.array(spans, _SPANS)],
                    names=["doc_id", "spans"],
                )

    return docs.select(F.col("doc_id").cast("long"), "text").mapInArrow(
        scan, "doc_id long, spans array<struct<kind: string, start: long, end: long>>"
    )


_SPANS = pa.list_(pa.struct([("kind", pa.string()), ("start", pa.int64()), ("end", pa.int64())]))


def digests(found: DataFrame, base: tuple[Rule, ...] = BASE_RULES) -> DataFrame:
    """Counts of the base kinds, a checksum of their spans, and all spans as text."""

    def joined(spans):
        texts = F.transform(
            spans, lambda span: F.concat_ws(":", span["kind"], span["start"], span["end"])
        )
        return F.array_join(texts, ",")

    def of(*kinds: str):
        return F.filter("spans", lambda span: span["kind"].isin(*kinds))

    kinds = [rule.kind for rule in base]
    return found.select(
        "doc_id",
        *(F.size(of(kind)).cast("long").alias(f"n_{kind}") for kind in kinds),
        F.sha2(joined(of(*kinds)), 256).alias("base_sha256"),
        joined(F.col("spans")).alias("spans"),
    )
