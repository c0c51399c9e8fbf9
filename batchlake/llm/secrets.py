"""Secrets in texts, found by one deterministic automaton for all rules.

All rules are compiled together (subset construction, minimisation) for reading backwards. One pass
over the bytes of a batch, from its end to its beginning, marks every byte at which a match of some
rule begins. Then each rule takes its marks from left to right: the first one, the longest match
from there (by the rule's own small forward automaton), the next mark after it, and so on. So a
rule gives its leftmost non-overlapping matches; those that are too short are dropped and not tried
again elsewhere.

Defined results: null and empty texts have no spans; rows with null or repeated ids are returned
as they are. Only the id and the text are read. A text of any length is scanned whole.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame

from batchlake.llm import automaton
from batchlake.llm.arrow import SPANS, SPANS_ARROW, ship, steps, text_bytes, with_columns


@dataclass(frozen=True)
class Rule:
    """Matches of ``pattern`` whose counted part has ``least`` characters or more.

    The counted part is the whole match, or what follows the first of the bytes ``after``, blanks
    and a quote.
    """

    kind: str
    pattern: str
    least: int = 0
    fold: bool = False
    after: bytes = b""

    def long_enough(self, match: bytes) -> bool:
        if self.after:
            at = min(k for k in (match.find(bytes([c])) for c in self.after) if k >= 0)
            match = match[at + 1 :].lstrip(b" ")
            match = match[match[:1] in (b'"', b"'") :]
        return len(match) >= self.least


#: The base rules. A run of hex digits is one match, so its least length can be part
#: of the pattern; the same holds for no rule whose dropped matches hide others.
BASE = [
    Rule(
        "assign",
        r"""(password|passwd|secret|token|api_?key)["']?\x20*[:=]\x20*["']?[A-Za-z0-9+/_.=-]+""",
        least=12,
        fold=True,
        after=b":=",
    ),
    Rule("access", r"AKIA[A-Z0-9]+", least=18),
    Rule("hex", r"[0-9a-f]{16,}"),
]
#: Further rules: published key formats.
FURTHER = [
    Rule("private_key", r"-----BEGIN [A-Z ]*PRIVATE KEY-----"),
    Rule("github", r"gh[opusr]_[A-Za-z0-9]+", least=40),
    Rule("slack", r"xox[abprs]-[A-Za-z0-9-]+", least=24),
    Rule("google", r"AIza[A-Za-z0-9_-]+", least=39),
    Rule("stripe", r"[rs]k_live_[A-Za-z0-9]+", least=24),
    Rule("jwt", r"eyJ[A-Za-z0-9_-]+\.eyJ[A-Za-z0-9_-]+\.[A-Za-z0-9_-]+"),
]
RULES = [*BASE, *FURTHER]


@dataclass(frozen=True)
class Scanner:
    """``backward`` finds where matches begin, ``forward`` (one per rule) where they end."""

    rules: tuple[Rule, ...]
    backward: automaton.Automaton
    forward: tuple[automaton.Automaton, ...]

    def marks(self, data: np.ndarray) -> np.ndarray:
        """For each byte, a bit per rule that has a match beginning there."""
        states = automaton.states_of(self.backward, data[::-1])
        return self.backward.accepts[states][::-1]

    def spans(self, data: np.ndarray) -> list[tuple[int, int, int]]:
        """(start, rule, end) in bytes over texts that are followed by break bytes."""
        marks, whole, found = self.marks(data), None, []
        begun = np.flatnonzero(marks)
        for r, rule in enumerate(self.rules):
            starts = begun[(marks[begun] >> r & 1).astype(bool)]
            at = 0
            while at < len(starts):
                whole = data.tobytes() if whole is None else whole
                start = int(starts[at])
                end = automaton.longest(self.forward[r], whole, start)
                if rule.long_enough(whole[start:end]):
                    found.append((start, r, end))
                at = max(at + 1, int(np.searchsorted(starts, end)))
        return sorted(found)


def compile_rules(rules: list[Rule] = RULES) -> Scanner:
    trees = [automaton.parse(r.pattern, r.fold) for r in rules]
    return Scanner(
        tuple(rules),
        automaton.determinise([automaton.mirror(t) for t in trees], anywhere=True),
        tuple(automaton.determinise([t], anywhere=False) for t in trees),
    )


def scan(column: pa.Array, scanner: Scanner) -> list[list[dict]]:
    """Spans of each text in code points, by start, then rule."""
    column = pc.fill_null(column.cast(pa.string()), "")
    data, sizes = text_bytes(column)
    data = np.insert(data, np.cumsum(sizes), automaton.BREAK)
    ends = np.cumsum(sizes + 1)
    spans: list[list[dict]] = [[] for _ in range(len(column))]
    heads, at = None, -1
    for start, r, end in scanner.spans(data):
        row = int(np.searchsorted(ends, start, side="right"))
        if row != at:
            at, first = row, int(ends[row] - sizes[row] - 1)
            heads = np.concatenate(([0], np.cumsum((data[first : int(ends[row])] & 0xC0) != 0x80)))
        spans[row].append(
            {"kind": scanner.rules[r].kind, "start": int(heads[start - first]), "end": int(heads[end - first])}
        )
    return spans


def find_secrets(
    docs: DataFrame, rules: list[Rule] = RULES, doc_id: str = "doc_id", text: str = "text"
) -> DataFrame:
    """One row per document: id and ``spans`` (kind, start, end), by start, then rule."""
    ship(docs.sparkSession)
    scanner = compile_rules(rules)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in steps(batches, text):
            spans = pa.array(scan(batch.column(text), scanner), SPANS_ARROW)
            yield pa.RecordBatch.from_arrays([batch.column(doc_id), spans], [doc_id, "spans"])

    kind = docs.schema[doc_id].dataType.simpleString()
    return with_columns(docs, doc_id, text).mapInArrow(run, f"`{doc_id}` {kind}, {SPANS}")
