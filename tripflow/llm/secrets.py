"""Secret scanning through a trigram index.

Each rule's regular expression gives a Boolean query over the trigrams that any
match must contain. Every task indexes its documents a segment at a time, intersects
the postings and runs the expression on the candidates only. Rules whose
expressions have no mandatory trigram are run on every document.
"""

from __future__ import annotations

import re
from collections.abc import Iterator, Sequence
from dataclasses import dataclass
from itertools import product
from re import _constants as C
from re import _parser

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tripflow.llm.tokenizing import runs
from tripflow.llm.words import bytes_of


@dataclass(frozen=True)
class Rule:
    """``pattern`` finds leftmost matches that do not overlap; those whose group ``group``
    has fewer than ``least`` characters are dropped. Letters match in either case where
    the pattern says so; classes are ASCII."""

    name: str
    pattern: str
    group: int = 0
    least: int = 1


# Runs of one class are taken whole, so asking for their least length in the pattern
# finds the same matches as dropping the short ones.
BASE_RULES: tuple[Rule, ...] = (
    Rule(
        "assign",
        r"""(?i:(password|passwd|secret|token|api_?key))["']?\x20*[:=]\x20*["']?([A-Za-z0-9+/_.=-]+)""",
        group=2,
        least=6,
    ),
    Rule("access", r"AKIA[A-Z0-9]{16,}"),
    Rule("hex", r"[0-9a-f]{24,}"),
)

MORE_RULES: tuple[Rule, ...] = (
    Rule("private_key", r"-----BEGIN [A-Z ]*PRIVATE KEY-----"),
    Rule("code_host", r"gh[opsru]_[A-Za-z0-9]{36,}"),
    Rule("chat", r"xox[abprs]-[A-Za-z0-9-]{10,}"),
    Rule("web_token", r"eyJ[A-Za-z0-9_-]{10,}\.eyJ[A-Za-z0-9_-]{10,}"),
)

_MOST_STRINGS = 64
#: A query: a trigram, ("and", ...) or ("or", ...) of queries, or True where nothing is mandatory.
Query = bytes | tuple | bool


def _all_of(parts: list[Query]) -> Query:
    parts = list(dict.fromkeys(p for p in parts if p is not True))
    return True if not parts else parts[0] if len(parts) == 1 else ("and", *parts)


def _any_of(parts: list[Query]) -> Query:
    parts = list(dict.fromkeys(parts))
    return True if True in parts else parts[0] if len(parts) == 1 else ("or", *parts)


def _string(text: str) -> Query:
    raw = text.encode().lower()  # bytes fold ASCII letters only
    return _all_of([raw[i : i + 3] for i in range(len(raw) - 2)])


class _Walk:
    """Collects the strings a stretch of the pattern can match while they are few."""

    def __init__(self):
        self.strings: set[str] = {""}
        self.clauses: list[Query] = []
        self.open = True  # nothing but the strings was met so far

    def cut(self) -> None:
        self.clauses.append(_any_of([_string(s) for s in sorted(self.strings)]))
        self.strings, self.open = {""}, False

    def append(self, choices: set[str]) -> None:
        if len(self.strings) * len(choices) > _MOST_STRINGS:
            self.cut()
        if len(choices) > _MOST_STRINGS:
            self.cut()
        else:
            self.strings = {a + b for a, b in product(self.strings, choices)}

    def walk(self, nodes) -> "_Walk":
        for op, arg in nodes:
            if op is C.LITERAL:
                self.append({chr(arg)})
            elif op is C.IN and all(o is C.LITERAL for o, _ in arg):
                self.append({chr(a) for _, a in arg})
            elif op is C.SUBPATTERN:
                self._choice([arg[-1]])
            elif op is C.BRANCH:
                self._choice(arg[1])
            elif op in (C.MAX_REPEAT, C.MIN_REPEAT, C.POSSESSIVE_REPEAT):
                least, most, inner = arg
                if (least, most) == (0, 1) and (few := _Walk().walk(inner)).open:
                    self.append(few.strings | {""})
                elif least == 0:
                    self.cut()
                else:
                    self._choice([inner])
                    if most > 1:
                        self.cut()
            elif op is not C.AT:
                self.cut()
        return self

    def _choice(self, branches) -> None:
        walks = [_Walk().walk(b) for b in branches]
        if all(w.open for w in walks):
            self.append(set().union(*(w.strings for w in walks)))
        else:
            self.cut()
            self.clauses.append(_any_of([w.query() for w in walks]))

    def query(self) -> Query:
        if self.strings != {""}:
            return _all_of([*self.clauses, _any_of([_string(s) for s in sorted(self.strings)])])
        return _all_of(self.clauses)


def trigram_query(pattern: str) -> Query:
    """What trigrams every match of the pattern contains, ASCII letters folded to lower case."""
    return _Walk().walk(_parser.parse(pattern, re.ASCII)).query()


def _trigrams(query: Query) -> set[bytes]:
    if isinstance(query, bytes):
        return {query}
    return set().union(*map(_trigrams, query[1:])) if isinstance(query, tuple) else set()


_FOLD = np.arange(256, dtype=np.uint8)
_FOLD[65:91] += 32


class SegmentIndex:
    """Postings of the wanted trigrams in a run of texts: which texts contain each."""

    def __init__(self, wanted: Sequence[bytes]):
        self.number = {t: n for n, t in enumerate(wanted, 1)}
        self.table = np.zeros(1 << 24, np.uint16)
        for t, n in self.number.items():
            self.table[int.from_bytes(t, "big")] = n

    def build(self, texts: pa.StringArray) -> None:
        self.size = len(texts)
        raw, ends = bytes_of(texts)
        folded = _FOLD[raw].astype(np.uint32)
        found = self.table[(folded[:-2] << 16) | (folded[1:-1] << 8) | folded[2:]] if len(folded) > 2 else np.zeros(0, np.uint16)
        at = np.flatnonzero(found)
        row = np.searchsorted(ends, at, "right") - 1
        inside = at + 3 <= ends[row + 1]
        self.rows, self.numbers = row[inside], found[at][inside]

    def holds(self, query: Query) -> np.ndarray:
        """For each text whether the query holds."""
        if query is True:
            return np.ones(self.size, bool)
        if isinstance(query, bytes):
            out = np.zeros(self.size, bool)
            out[self.rows[self.numbers == self.number[query]]] = True
            return out
        parts = [self.holds(q) for q in query[1:]]
        return np.logical_and.reduce(parts) if query[0] == "and" else np.logical_or.reduce(parts)


_SPAN = pa.struct([("rule", pa.string()), ("start", pa.int32()), ("end", pa.int32())])


def scan_secrets(
    docs: DataFrame,
    rules: Sequence[Rule] = (*BASE_RULES, *MORE_RULES),
    *,
    id_col: str = "doc_id",
    text_col: str = "text",
) -> DataFrame:
    """One row per document: doc_id and spans, an array of (rule, start, end) by start, then rule.

    Starts and ends are code points, the end exclusive. A null text counts as empty
    and has no spans; null ids and rows that repeat pass through; other columns are
    not read; an empty table gives no rows. Nothing is shuffled: a segment of about a
    megabyte of texts is indexed and searched where it was read.
    """
    rows = docs.select(F.col(id_col).cast("long").alias("doc_id"), F.coalesce(F.col(text_col), F.lit("")).alias("text"))
    queries = [trigram_query(r.pattern) for r in rules]
    wanted = sorted(set().union(*map(_trigrams, queries)))

    def scan(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        patterns = [re.compile(r.pattern, re.ASCII) for r in rules]
        index = SegmentIndex(wanted)
        for batch in batches:
            texts = batch.column(1)
            spans: list[list[tuple]] = [[] for _ in range(len(texts))]
            for a, b in runs(texts):
                segment = texts.slice(a, b - a)
                index.build(segment)
                plain: dict[int, str] = {}
                for k, (rule, pattern, query) in enumerate(zip(rules, patterns, queries)):
                    for n in np.flatnonzero(index.holds(query)).tolist():
                        if n not in plain:
                            plain[n] = segment[n].as_py()
                        for m in pattern.finditer(plain[n]):
                            if m.end(rule.group) - m.start(rule.group) >= rule.least:
                                spans[a + n].append((m.start(), k, m.end()))
            found = [[{"rule": rules[k].name, "start": s, "end": e} for s, k, e in sorted(row)] for row in spans]
            yield pa.RecordBatch.from_arrays(
                [batch.column(0), pa.array(found, pa.list_(_SPAN))], names=["doc_id", "spans"]
            )

    return rows.mapInArrow(scan, "doc_id long, spans array<struct<rule:string,start:int,end:int>>")
