"""Secret scans with multipart credential linking.

Some parts of a credential can be told by their form alone: an assignment to a name such
as ``token``, an access identifier, a long hex number. Others are weak: a value of the
length of a secret, a user or client identifier, the address of an endpoint mean nothing
by themselves. The parts of a document are intervals; intervals of one scope are joined,
and a weak candidate is reported only where the scope holds parts that complete it: an
identifier with a secret, or an endpoint beside both.

A scope is a paragraph (text without a blank line), split where two parts in a row are
further apart than ``reach`` characters. The join is a sweep over the parts in order of
their start, so its cost is linear in the parts of a document, however many they are.

Defined results: NULL and empty texts have no spans; repeated rows are scanned each by
itself; spans count code points, end exclusive; of weak parts that overlap a base part or
an earlier weak part, the earlier one stays; an address stays whole where base parts or
secrets lie in it, and what lies in its query counts for its scope; ties in start go by the order of ``KINDS``.
"""

from __future__ import annotations

import math
import re
from collections import Counter
from collections.abc import Iterator
from dataclasses import dataclass

import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

#: Order of kinds for spans with the same start; the first three are the base kinds.
KINDS = ("assign", "access", "hex", "secret", "identifier", "endpoint")
BASE = KINDS[:3]
_RANK = {k: i for i, k in enumerate(KINDS)}

# The names are matched in either case of ASCII letters, and of those alone.
_ASSIGN = re.compile(
    r"""(?ai:password|passwd|secret|token|api_?key)["']?\x20*[:=]\x20*["']?"""
    r"([A-Za-z0-9+/_.=-]+)"
)
_ACCESS = re.compile(r"AKIA[A-Z0-9]+")
_HEX = re.compile(r"[0-9a-f]{32,}")
# Weak parts. A secret is a run of 20 characters or more that has mixed content. No
# part has a longest length: a span reaches to the end of its value.
_SECRET = re.compile(r"(?<![A-Za-z0-9+/_=-])[A-Za-z0-9+/_=-]{20,}(?![A-Za-z0-9+/_=-])")
_IDENTIFIER = re.compile(
    r"""(?ai:\b(?:access[_-]?key[_-]?id|client[_-]?id|account[_-]?id|user(?:name)?|login))"""
    r"""["']?\x20*[:=]\x20*["']?([A-Za-z0-9_.@-]{3,})"""
)
_ENDPOINT = re.compile(
    r"(?:https?|postgres(?:ql)?|mysql|mongodb|redis|amqps?|s3|ftp)://[^\s\"'<>]{4,}"
    r"|(?ai:\b(?:endpoint|host(?:name)?|server))[\"']?\x20*[:=]\x20*[\"']?"
    r"[A-Za-z0-9-]+(?:\.[A-Za-z0-9-]+)+(?::[0-9]+)?"
)
_BLANK = re.compile(r"\n[ \t\r\f\v]*\n")


@dataclass(frozen=True)
class Scan:
    assign_length: int = 8
    access_length: int = 16
    reach: int = 400
    min_entropy: float = 3.0


@dataclass(frozen=True, order=True)
class Span:
    start: int
    rank: int
    end: int

    @property
    def kind(self) -> str:
        return KINDS[self.rank]

    def __str__(self) -> str:
        return f"{self.kind}:{self.start}:{self.end}"


def base_spans(text: str, scan: Scan = Scan()) -> list[Span]:
    """Leftmost matches per kind that do not overlap, without those that are too short."""
    spans = [
        Span(m.start(), 0, m.end())
        for m in _ASSIGN.finditer(text)
        if m.end(1) - m.start(1) >= scan.assign_length
    ]
    spans += [
        Span(m.start(), 1, m.end())
        for m in _ACCESS.finditer(text)
        if m.end() - m.start() >= scan.access_length
    ]
    spans += [Span(m.start(), 2, m.end()) for m in _HEX.finditer(text)]
    return sorted(spans)


def _looks_secret(value: str, least: float) -> bool:
    """Digits and letters of both cases, spread like chance rather than like a word."""
    if not (
        any(c.isdigit() for c in value)
        and any(c.islower() for c in value)
        and any(c.isupper() for c in value)
    ):
        return False
    counts = Counter(value)
    n = len(value)
    return -sum(c / n * math.log2(c / n) for c in counts.values()) >= least


def weak_parts(text: str, taken: list[Span], scan: Scan = Scan()) -> list[Span]:
    """Candidates that need a partner, outside the base spans and each other."""
    found = [
        Span(m.start(), _RANK["secret"], m.end())
        for m in _SECRET.finditer(text)
        if _looks_secret(m.group(), scan.min_entropy)
    ]
    found += [Span(m.start(), 4, m.end()) for m in _IDENTIFIER.finditer(text)]
    found += [Span(m.start(), 5, m.end()) for m in _ENDPOINT.finditer(text)]
    # Sweep with the base spans first at equal starts; keep what starts after all kept.
    kept, reach, at = [], -1, 0
    for span in sorted(found):
        # An address may hold base parts, such as a token in its query.
        end = span.start + 1 if span.kind == "endpoint" else span.end
        while at < len(taken) and taken[at].start < end:
            reach = max(reach, taken[at].end)
            at += 1
        if span.start >= reach:
            kept.append(span)
            reach = span.end
    return kept


def _carried(text: str, address: Span, scan: Scan) -> set[int]:
    """Ranks of the weak parts in the query of an address, such as a signature."""
    query = text.find("?", address.start, address.end)
    if query < 0:
        return set()
    ranks = {4} if _IDENTIFIER.search(text, query, address.end) else set()
    if any(
        _looks_secret(m.group(), scan.min_entropy)
        for m in _SECRET.finditer(text, query, address.end)
    ):
        ranks.add(3)
    return ranks


def linked(text: str, base: list[Span], weak: list[Span], scan: Scan) -> list[Span]:
    """Weak parts whose scope holds an identifier and a secret, base parts counted.

    An access span is an identifier; an assigned or hex value is a secret. An endpoint
    is reported beside both of them, never by itself.
    """
    parts = sorted(base + weak)
    breaks = [m.start() for m in _BLANK.finditer(text)]
    out: list[Span] = []
    scope: list[Span] = []
    end, at = -1, 0

    def close() -> None:
        ranks = {s.rank for s in scope}
        for s in scope:
            if s.kind == "endpoint":
                ranks |= _carried(text, s, scan)
        if ranks & {1, 4} and ranks & {0, 2, 3}:
            out.extend(s for s in scope if s.rank >= len(BASE))

    for part in parts:
        crossed = False
        while at < len(breaks) and breaks[at] < part.start:
            crossed |= breaks[at] >= end
            at += 1
        if scope and (crossed or part.start - end > scan.reach):
            close()
            scope = []
        scope.append(part)
        end = max(end, part.end)
    close()
    return out


def spans_of(text: str | None, scan: Scan = Scan()) -> tuple[list[Span], list[Span]]:
    """Base spans, and all spans with those that linking adds."""
    if not text:
        return [], []
    base = base_spans(text, scan)
    weak = weak_parts(text, base, scan)
    if not weak:
        return base, base
    return base, sorted(base + linked(text, base, weak, scan))


_SCHEMA = (
    "doc_id long, n_assign long, n_access long, n_hex long, base_spans string, spans string"
)


def scan(
    docs: DataFrame, id: str = "doc_id", text: str = "text", how: Scan = Scan()
) -> DataFrame:
    """One row per input row: counts of the base kinds, base spans and all spans.

    Spans are written ``kind:start:end``, joined by commas in order of start.
    """

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            counts: list[list[int]] = [[], [], []]
            base_text, all_text = [], []
            for value in batch.column(1):
                base, spans = spans_of(value.as_py(), how)
                for rank, column in enumerate(counts):
                    column.append(sum(s.rank == rank for s in base))
                base_text.append(",".join(map(str, base)))
                all_text.append(",".join(map(str, spans)))
            yield pa.RecordBatch.from_arrays(
                [
                    batch.column(0),
                    *[pa.array(c, pa.int64()) for c in counts],
                    pa.array(base_text, pa.string()),
                    pa.array(all_text, pa.string()),
                ],
                names=["doc_id", "n_assign", "n_access", "n_hex", "base_spans", "spans"],
            )

    chosen = docs.select(F.col(id).cast("long").alias("doc_id"), F.col(text).alias("text"))
    return chosen.mapInArrow(run, _SCHEMA)
