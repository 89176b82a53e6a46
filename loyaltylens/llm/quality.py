"""Quality rules as a cascade that stops at the first rejection."""

from __future__ import annotations

import time
from collections import Counter
from collections.abc import Callable, Iterator
from dataclasses import dataclass
from functools import cached_property

import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from loyaltylens.llm.common import pieces, texts

# The characters between words, and those that count as symbols.
SPACE = " \t\n\x0b\x0c\r"
SYMBOLS = "#*$%&|<>"

# Cost and selectivity of the rules are estimated on about this many rows.
SAMPLE_ROWS = 2000


class Text:
    """A text and what the rules measure in it; each figure is computed when it is first asked for."""

    def __init__(self, data: bytes) -> None:
        self.data = data

    @cached_property
    def text(self) -> str:
        return self.data.decode()

    @cached_property
    def words(self) -> list[bytes]:
        return self.data.split()

    @cached_property
    def n_words(self) -> int:
        return len(self.words)

    @cached_property
    def word_chars(self) -> int:
        return len(self.text) - sum(map(self.text.count, SPACE))

    @cached_property
    def n_symbols(self) -> int:
        return sum(map(self.text.count, SYMBOLS))

    @cached_property
    def lines(self) -> list[str]:
        return [line for line in self.text.split("\n") if line.strip(SPACE)]

    @cached_property
    def n_dup_lines(self) -> int:
        return len(self.lines) - len(set(self.lines))

    @cached_property
    def n_repeat_words(self) -> int:
        """Words in windows of three words that the text has twice or more."""
        windows = list(zip(self.words, self.words[1:], self.words[2:]))
        if len(set(windows)) == len(windows):
            return 0
        counts = Counter(windows)
        covered = bytearray(self.n_words)
        for place, window in enumerate(windows):
            if counts[window] > 1:
                covered[place : place + 3] = b"\1\1\1"
        return sum(covered)

    @cached_property
    def n_letter_words(self) -> int:
        """Words with a letter."""
        return sum(any(map(str.isalpha, w)) for w in self.text.translate(SPACE_TABLE).split(" ") if w)

    @cached_property
    def n_upper(self) -> int:
        return sum(map(str.isupper, self.text))


SPACE_TABLE = str.maketrans(dict.fromkeys(SPACE, " "))


@dataclass(frozen=True)
class Rule:
    name: str
    rejects: Callable[[Text], bool]


BASE = (
    Rule("few_words", lambda t: t.n_words < 50),
    Rule("repeated_words", lambda t: 100 * t.n_repeat_words > 50 * t.n_words),
)
# Limits of published filters for web text, or wider.
VERDICT = (
    Rule("symbols", lambda t: 10 * t.n_symbols > t.n_words),
    Rule("duplicate_lines", lambda t: 100 * t.n_dup_lines > 40 * len(t.lines)),
    Rule("word_length", lambda t: not 3 * t.n_words <= t.word_chars <= 10 * t.n_words),
    Rule("letters", lambda t: 100 * t.n_letter_words < 80 * t.n_words),
    Rule("upper_case", lambda t: 100 * t.n_upper > 50 * t.word_chars),
)
RULES = (*BASE, *VERDICT)


def rule_order(rows: DataFrame, rules: tuple[Rule, ...], sample_rows: int = SAMPLE_ROWS) -> list[int]:
    """The rules by rejections per second, highest first, as measured on a sample.

    The order changes how long the cascade takes, never what it decides.
    """
    total = rows.count()
    sample = rows if total <= sample_rows else rows.sample(sample_rows / total, seed=7)

    def measure(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        seconds, rejected = [0.0] * len(rules), [0] * len(rules)
        for _, found in pieces(batches):
            for data in found:
                for n, rule in enumerate(rules):
                    began = time.perf_counter()
                    rejected[n] += rule.rejects(Text(data))
                    seconds[n] += time.perf_counter() - began
        yield pa.RecordBatch.from_arrays(
            [pa.array(range(len(rules)), pa.int32()), pa.array(seconds), pa.array(rejected, pa.int64())],
            ["rule", "seconds", "rejected"],
        )

    measured = sample.mapInArrow(measure, "rule int, seconds double, rejected bigint")
    each = measured.groupBy("rule").agg(F.sum("seconds").alias("seconds"), F.sum("rejected").alias("rejected"))
    rate = {r["rule"]: r["rejected"] / max(r["seconds"], 1e-9) for r in each.collect()}
    return sorted(range(len(rules)), key=lambda n: (-rate.get(n, 0.0), n))


def quality(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", rules: tuple[Rule, ...] = VERDICT) -> DataFrame:
    """The base figures of every document, base_failed, and kept.

    A document is kept if neither the base rules nor any rule of the cascade reject it.  The cascade sees only
    documents that the base rules pass and stops at the first rejection.  A missing text is empty and fails for
    its few words; rows that repeat an id come back as often as they are there.
    """
    rows = texts(docs, id_col, text_col).withColumn("doc_id", F.col("doc_id").cast("bigint"))
    cascade = [rules[n] for n in rule_order(rows, rules)]
    figures = ["n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words"]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for ids, found in pieces(batches):
            each = [Text(data) for data in found]
            columns = [pa.array([getattr(t, f) for t in each], pa.int64()) for f in figures]
            failed = [any(r.rejects(t) for r in BASE) for t in each]
            kept = [not f and not any(r.rejects(t) for r in cascade) for f, t in zip(failed, each)]
            yield pa.RecordBatch.from_arrays(
                [ids.cast(pa.int64()), *columns, pa.array(failed, pa.bool_()), pa.array(kept, pa.bool_())],
                ["doc_id", *figures, "base_failed", "kept"],
            )

    schema = ", ".join(["doc_id bigint", *(f"{f} bigint" for f in figures), "base_failed boolean", "kept boolean"])
    return rows.mapInArrow(run, schema)


def passing(docs: DataFrame, text_col: str = "text", rules: tuple[Rule, ...] = RULES) -> DataFrame:
    """The rows of ``docs`` that no rule rejects, with all their columns as they are.

    All rules are in the cascade, so a document costs only the rules up to the one that rejects it, and nothing
    is shuffled or joined.
    """
    rows = docs.select(F.lit(0).alias("doc_id"), F.coalesce(docs[text_col], F.lit("")).alias("text"))
    cascade = [rules[n] for n in rule_order(rows, rules)]
    place = docs.columns.index(text_col)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            keep = []
            for value in batch.column(place):
                text = Text((value.as_py() or "").encode())
                keep.append(not any(rule.rejects(text) for rule in cascade))
            yield batch.filter(pa.array(keep, pa.bool_()))

    return docs.mapInArrow(run, docs.schema)
