"""Quality rules as a short-circuit cascade."""

from __future__ import annotations

import time
from collections.abc import Callable, Iterator
from dataclasses import dataclass
from functools import cached_property

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

SYMBOLS = b"#*$%&|<>"
#: Longest text in the sample that orders the rules; with its row count the proven bound of what the driver gets.
SAMPLE_BYTES = 1 << 16


class TextMeasures:
    """Counts over one whole text, each computed when first asked for. Words are split at ASCII white space."""

    def __init__(self, text: str | None):
        self.text = text or ""

    @cached_property
    def data(self) -> bytes:
        return self.text.encode("utf-8", "surrogatepass")

    @cached_property
    def words(self) -> list[bytes]:
        return self.data.split()  # bytes split at the six ASCII blanks only

    @cached_property
    def lines(self) -> list[bytes]:
        return [x for x in self.data.split(b"\n") if x.split()]

    @cached_property
    def n_words(self) -> int:
        return len(self.words)

    @cached_property
    def n_lines(self) -> int:
        return len(self.lines)

    @cached_property
    def word_chars(self) -> int:
        return len(self.text) - sum(map(self.data.count, (b" ", b"\t", b"\n", b"\x0b", b"\x0c", b"\r")))

    @cached_property
    def n_symbols(self) -> int:
        return sum(self.data.count(c) for c in SYMBOLS)

    @cached_property
    def n_upper(self) -> int:
        b = np.frombuffer(self.data, np.uint8)
        return int(((b >= 65) & (b <= 90)).sum())

    @cached_property
    def n_dup_lines(self) -> int:
        return len(self.lines) - len(set(self.lines))

    @cached_property
    def n_repeat_words(self) -> int:
        """Words in windows of three words that occur twice or more, the first occurrence included."""
        n = len(self.words)
        if n < 4:
            return 0
        ids: dict[bytes, int] = {}
        w = np.fromiter((ids.setdefault(x, len(ids)) for x in self.words), np.int64, n)
        _, pair = np.unique(w[:-2] * len(ids) + w[1:-1], return_inverse=True)  # both factors are under the word count
        _, window, count = np.unique(pair * len(ids) + w[2:], return_inverse=True, return_counts=True)
        hit = count[window] > 1
        covered = np.zeros(n, bool)
        for k in range(3):
            covered[k:n - 2 + k] |= hit
        return int(covered.sum())


@dataclass(frozen=True)
class Rule:
    """Rejects a text when ``rejects(measures)`` is true."""

    name: str
    rejects: Callable[[TextMeasures], bool]


#: The rules applied when none are given; whole-number comparisons, so that any engine gives the same verdict.
RULES = [
    Rule("few_words", lambda m: m.n_words < 50),
    Rule("repeated_words", lambda m: 100 * m.n_repeat_words > 50 * m.n_words),
    Rule("symbols", lambda m: 10 * m.n_symbols > m.n_words),
    Rule("repeated_lines", lambda m: 10 * m.n_dup_lines > 3 * m.n_lines),
    Rule("capitals", lambda m: 10 * m.n_upper > 3 * m.word_chars),
    Rule("word_length", lambda m: m.word_chars < 2 * m.n_words or m.word_chars > 14 * m.n_words),
]


def order_rules(docs: DataFrame, rules: list[Rule], text_col: str = "text", sample_rows: int = 400) -> list[Rule]:
    """The rules by rejections per cost, both estimated on a sample of at most ``sample_rows`` texts.

    The sample decides only the order in which rules are tried, never a verdict. It is taken from the first partitions that
    have enough texts of at most ``SAMPLE_BYTES`` bytes; no others are read and nothing is shuffled. A rule's cost is the
    time it takes on a fresh text, so what rules share is charged to each. Equal ratios keep the given order.
    """
    short = docs.select(F.col(text_col).alias("t")).where(F.octet_length("t") <= SAMPLE_BYTES)
    texts = [r["t"] for r in short.take(sample_rows)]
    gain = []
    for rule in rules:
        began = time.perf_counter()
        rejected = sum(bool(rule.rejects(TextMeasures(t))) for t in texts)
        gain.append(rejected / max(time.perf_counter() - began, 1e-9))
    return [rules[i] for i in sorted(range(len(rules)), key=lambda i: (-gain[i], i))]


def passes(m: TextMeasures, cascade: list[Rule]) -> bool:
    """True if no rule rejects; the first that does ends the cascade."""
    return not any(rule.rejects(m) for rule in cascade)


def apply_rules(docs: DataFrame, rules: list[Rule] | None = None, text_col: str = "text",
                measures: tuple[str, ...] = (), sample_rows: int = 400) -> DataFrame:
    """All columns of ``docs``, the asked-for ``measures`` (long) and ``kept``: no rule rejects the whole text.

    Per-row work in one scan without a shuffle; a text's measures are computed only when a rule or ``measures`` asks.

    Defined cases: a null text counts as empty; repeated rows are each judged; an empty table stays empty; without
    rules everything is kept; columns named like a measure or ``kept`` are replaced, all others stay as they are.
    """
    rules = RULES if rules is None else rules
    cascade = order_rules(docs, rules, text_col, sample_rows)
    docs = docs.drop("kept", *[m for m in measures if m != text_col])

    def judge(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            counted = [TextMeasures(t) for t in batch.column(text_col).to_pylist()]
            new = [pa.array([getattr(m, name) for m in counted], pa.int64()) for name in measures]
            new.append(pa.array([passes(m, cascade) for m in counted], pa.bool_()))
            yield pa.RecordBatch.from_arrays([*batch.columns, *new], names=[*batch.schema.names, *measures, "kept"])

    schema = ", ".join([f"`{f.name}` {f.dataType.simpleString()}" for f in docs.schema.fields]
                       + [f"{m} long" for m in measures] + ["kept boolean"])
    return docs.mapInArrow(judge, schema)
