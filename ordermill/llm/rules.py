"""Quality rules as a short-circuit cascade.

Rules judge one document each, so their order changes the cost and never the verdict. A small
sample of whole documents gives each rule's cost (seconds a document) and selectivity (share it
rejects); rules run in the order of rejections per second, and a document that one rule rejects
is not shown to the next. Batches are worked on as arrays, and survivors are packed before the next rule.

Defined results: a null text has no words and is judged as an empty one; repeated rows are judged
alike; an empty table gives an empty result; columns named like an added one are replaced, others
pass through. A sample without rejections leaves the rules in their given order.
"""

from __future__ import annotations

import time
from collections.abc import Callable, Iterable, Iterator
from dataclasses import dataclass
from functools import cached_property

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from ordermill.llm import words as W
from ordermill.llm.common import map_arrow, quoted, without

SYMBOLS = "#*$%&|<>"
MEASURES = ("n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words")


def _table(characters: str) -> np.ndarray:
    out = np.zeros(256, bool)
    out[list(characters.encode())] = True
    return out


_SYMBOL = _table(SYMBOLS)
_UPPER = _table("".join(map(chr, range(65, 91))))
_LETTER = _UPPER | _table("".join(map(chr, range(97, 123))))


class Features:
    """What rules ask of a batch of texts; each is worked out when first asked for."""

    def __init__(self, texts: pa.Array):
        self.texts = texts

    @cached_property
    def words(self) -> W.Words:
        return W.split(self.texts)

    @cached_property
    def raw(self) -> tuple[np.ndarray, np.ndarray]:
        return W.text_buffers(self.texts)

    def take(self, rows: np.ndarray) -> Features:
        """The same for some of the texts; the counts worked out so far go with them."""
        out = Features(self.texts.take(pa.array(rows)))
        for name in ("n_words", "word_chars", "n_symbols", "n_upper", "n_letters", "n_repeat_words"):
            if name in self.__dict__:
                out.__dict__[name] = self.__dict__[name][rows]
        if "_lines" in self.__dict__:
            out.__dict__["_lines"] = tuple(x[rows] for x in self._lines)
        return out

    def _per_text(self, flags: np.ndarray) -> np.ndarray:
        sums = np.concatenate(([0], np.cumsum(flags, dtype=np.int64)))
        return np.diff(sums[self.raw[1]])

    @cached_property
    def n_words(self) -> np.ndarray:
        return self.words.counts

    @cached_property
    def word_chars(self) -> np.ndarray:
        data = self.raw[0]
        return self._per_text(~W.BLANK[data] & ((data & 0xC0) != 0x80))

    @cached_property
    def n_symbols(self) -> np.ndarray:
        return self._per_text(_SYMBOL[self.raw[0]])

    @cached_property
    def n_upper(self) -> np.ndarray:
        return self._per_text(_UPPER[self.raw[0]])

    @cached_property
    def n_letters(self) -> np.ndarray:
        return self._per_text(_LETTER[self.raw[0]])

    @cached_property
    def _lines(self) -> tuple[np.ndarray, np.ndarray]:
        """(lines with a word, those of them that equal an earlier line) of each text."""
        data, offsets = self.raw
        ends = np.union1d(np.flatnonzero(data == 0x0A), offsets[1:])
        begins = np.concatenate(([0], np.where(data[np.minimum(ends[:-1], len(data) - 1)] == 0x0A, ends[:-1] + 1, ends[:-1]))) if len(ends) else ends
        if len(ends):  # a line break at a text's very end opens the next text's first line at its own offset
            begins = np.maximum(begins, offsets[np.searchsorted(offsets, ends, "left") - 1].clip(0))
        solid = np.concatenate(([0], np.cumsum(~W.BLANK[data])))
        real = solid[ends] > solid[np.minimum(begins, ends)]
        begins, ends = begins[real], ends[real]
        lines = W.Words(data, offsets, begins, ends, np.searchsorted(begins, offsets))
        doc = lines.document().astype(np.uint64)
        key = W.mixed(lines.hashes() + doc * np.uint64(W.BASE))
        _, first = np.unique(key, return_index=True)
        n = lines.counts
        return n, n - np.bincount(doc[first].astype(np.int64), minlength=len(n))

    @property
    def n_lines(self) -> np.ndarray:
        return self._lines[0]

    @property
    def n_dup_lines(self) -> np.ndarray:
        return self._lines[1]

    @cached_property
    def n_repeat_words(self) -> np.ndarray:
        """Words in three-word windows that the text holds twice or more."""
        w = self.words
        h, at, first = W.runs(w, w.hashes(), 3)
        doc = np.repeat(np.arange(len(first) - 1), np.diff(first)).astype(np.uint64)
        key = W.mixed(h + doc * np.uint64(W.BASE))
        order = np.argsort(key)
        same = key[order[1:]] == key[order[:-1]]
        repeated = np.zeros(len(key), bool)
        repeated[order[1:][same]] = True
        repeated[order[:-1][same]] = True
        covered = np.zeros(len(w.start), bool)
        for i in range(3):
            covered[at[repeated] + i] = True
        sums = np.concatenate(([0], np.cumsum(covered, dtype=np.int64)))
        return np.diff(sums[w.first])


@dataclass(frozen=True)
class Rule:
    name: str
    rejects: Callable[[Features], np.ndarray]


#: The two base rules, then symbol, line, word-length and capital rules; whole numbers, so that verdicts are exact.
BASE_RULES = (
    Rule("few_words", lambda f: f.n_words < 50),
    Rule("repeated_phrases", lambda f: 100 * f.n_repeat_words > 50 * f.n_words),
)
RULES = (
    *BASE_RULES,
    Rule("symbols", lambda f: 10 * f.n_symbols > f.n_words),
    Rule("repeated_lines", lambda f: 2 * f.n_dup_lines > f.n_lines),
    Rule("word_length", lambda f: (f.word_chars < 2 * f.n_words) | (f.word_chars > 12 * f.n_words)),
    Rule("capitals", lambda f: 2 * f.n_upper > f.n_letters),
)
SAMPLE_PER_TASK = 64


def estimate(docs: DataFrame, rules: tuple[Rule, ...], text: str = "text", per_task: int = SAMPLE_PER_TASK) -> dict[str, tuple[float, float]]:
    """Seconds a document and share rejected of each rule, on the first ``per_task`` documents of every task's first batch.

    The sample only sets the order in which rules run. One row a rule and task reaches the sums, one a rule the driver.
    """

    def run(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            texts = batch.column(0).slice(0, per_task)
            if len(texts):
                found = []
                for rule in rules:
                    began = time.perf_counter()
                    found.append((int(rule.rejects(Features(texts)).sum()), time.perf_counter() - began))
                yield pa.RecordBatch.from_pydict({
                    "rule": [r.name for r in rules], "n": [len(texts)] * len(rules),
                    "rejected": [x for x, _ in found], "seconds": [s for _, s in found],
                })
                return

    sampled = map_arrow(docs.select(quoted(text)), run, "rule string, n long, rejected long, seconds double")
    sums = sampled.groupBy("rule").agg(F.sum("n").alias("n"), F.sum("rejected").alias("rejected"), F.sum("seconds").alias("seconds"))
    return {r.rule: (r.seconds / r.n, r.rejected / r.n) for r in sums.collect()}


def ordered(rules: tuple[Rule, ...], figures: dict[str, tuple[float, float]]) -> tuple[Rule, ...]:
    """Rules by rejections per second, most first; ties and unknown rules as given."""
    gain = {name: share / max(cost, 1e-9) for name, (cost, share) in figures.items()}
    return tuple(sorted(rules, key=lambda r: -gain.get(r.name, 0.0)))


def judge(texts: pa.Array, rules: tuple[Rule, ...], whole: Features | None = None) -> np.ndarray:
    """Position of the rule that rejects each text, -1 for none; later rules see only what is left.

    ``whole`` may hold counts of all texts that are known already; rules work out the others for the texts that reach them.
    """
    verdict = np.full(len(texts), -1)
    rows, f = np.arange(len(texts)), whole or Features(texts)
    left = np.ones(len(rows), bool)
    for k, rule in enumerate(rules):
        hit = rule.rejects(f) & left
        verdict[rows[hit]] = k
        left &= ~hit
        if not left.any():
            break
        if not left.all():
            rows, f, left = rows[left], f.take(np.flatnonzero(left)), np.ones(int(left.sum()), bool)
    return verdict


def cascade(docs: DataFrame, rules: tuple[Rule, ...] = RULES, text: str = "text", measures: bool = False,
            per_task: int = SAMPLE_PER_TASK) -> DataFrame:
    """``docs`` with ``kept`` and ``rejected_by`` (a rule that rejects, null if kept).

    ``measures`` adds the five counts of MEASURES for every document; rules look these up, and what else a rule asks
    is worked out for the documents that reach it.
    """
    order = ordered(rules, estimate(docs, rules, text, per_task))
    added = (MEASURES if measures else ()) + ("kept", "rejected_by")
    base = without(docs, added)
    columns = base.columns
    at = columns.index(text)
    fields = [T.StructField(m, T.LongType()) for m in added[:-2]]
    schema = T.StructType([*base.schema.fields, *fields, T.StructField("kept", T.BooleanType()), T.StructField("rejected_by", T.StringType())])
    names = np.array([r.name for r in order] + [None], dtype=object)

    def run(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for lo, hi in W.batches(batch.column(at), 2 << 20):
                part = batch.slice(lo, hi - lo)
                whole = Features(part.column(at))
                counts = [pa.array(getattr(whole, m), pa.int64()) for m in added[:-2]]
                verdict = judge(part.column(at), order, whole)
                yield pa.RecordBatch.from_arrays(
                    [*part.columns, *counts, pa.array(verdict < 0), pa.array(names[verdict], pa.string())],
                    names=[*columns, *added])

    return map_arrow(base, run, schema)
