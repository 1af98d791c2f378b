"""Quality rules as a short-circuit cascade.

Every rule rejects or passes a text on its own. Cost (seconds per text) and selectivity
(share rejected) of each rule are estimated on a bounded sample of ``sample`` texts; the
rules then run in the order of rejection per cost, each only on the texts that no earlier
rule rejected. The order changes the time, never the verdict.

Words are runs of characters other than space and the five ASCII line and tab characters.
Null text has no words. Empty text and texts of white space are too short. Repeated rows
are judged alike; an empty table gives no rows; only the text column (and, in ``measure``,
the key) is read, other columns pass through ``cascade`` untouched.
"""

from __future__ import annotations

import time
from collections.abc import Callable, Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from statweave.llm.base import Renamed, WordTable, chunks, mix, per_text, text_bytes

BLANK = b" \t\n\r\x0b\x0c"
SYMBOLS = b"#*$%&|<>"
NOT_A_CHAR_IN_WORDS = bytes(range(0x80, 0xC0)) + BLANK
WINDOW = 8


def word_counts(texts: list[bytes]) -> np.ndarray:
    return np.array([len(t.split()) for t in texts], np.int64)


def word_chars(texts: list[bytes]) -> np.ndarray:
    """Code points in words."""
    return np.array([len(t.translate(None, NOT_A_CHAR_IN_WORDS)) for t in texts], np.int64)


def symbols(texts: list[bytes]) -> np.ndarray:
    return np.array([len(t) - len(t.translate(None, SYMBOLS)) for t in texts], np.int64)


def _lines(text: bytes) -> list[bytes]:
    return [line for line in text.split(b"\n") if line.strip()]


def lines(texts: list[bytes]) -> np.ndarray:
    return np.array([len(_lines(t)) for t in texts], np.int64)


def duplicate_lines(texts: list[bytes]) -> np.ndarray:
    """Lines with a word that equal an earlier line."""
    return np.array([len(own) - len(set(own)) for own in map(_lines, texts)], np.int64)


def repeated_words(texts: list[bytes]) -> np.ndarray:
    """Words inside windows of eight words that occur twice or more in the text."""
    result = np.zeros(len(texts), np.int64)
    for first, last in chunks(texts):
        table = WordTable()
        numbers, sizes = table.number([t.split() for t in texts[first:last]])
        result[first:last] = _repeated(numbers, sizes)
    return result


def _repeated(numbers: np.ndarray, sizes: np.ndarray) -> np.ndarray:
    if len(numbers) < WINDOW:
        return np.zeros(len(sizes), np.int64)
    owner = np.repeat(np.arange(len(sizes)), sizes)
    starts = np.flatnonzero(owner[: len(owner) - WINDOW + 1] == owner[WINDOW - 1 :])
    if not len(starts):
        return np.zeros(len(sizes), np.int64)
    hashed = mix(numbers.astype(np.uint64) + np.uint64(1))
    key = mix(owner[starts].astype(np.uint64))
    for i in range(WINDOW):
        key = key * np.uint64(0x9E3779B97F4A7C15) + hashed[starts + i]
    order = np.argsort(key, kind="stable")
    same = key[order][1:] == key[order][:-1]
    one, two = starts[order[:-1][same]], starts[order[1:][same]]
    equal = owner[one] == owner[two]
    for i in range(WINDOW):
        equal &= numbers[one + i] == numbers[two + i]
    if not equal.all():  # two different windows share a hash: compare the windows themselves
        windows = np.column_stack([owner[starts], *[numbers[starts + i] for i in range(WINDOW)]])
        _, group, count = np.unique(windows, axis=0, return_inverse=True, return_counts=True)
        one = two = starts[count[group.ravel()] > 1]
    step = np.zeros(len(numbers) + 1, np.int64)
    found = np.unique(np.concatenate([one, two]))
    step[found] += 1
    np.add.at(step, found + WINDOW, -1)
    return per_text((np.cumsum(step[:-1]) > 0).astype(np.int64), sizes)


@dataclass(frozen=True)
class QualityRule:
    """``rejects`` maps a list of texts to an array of booleans."""

    name: str
    rejects: Callable[[list[bytes]], np.ndarray]


def base_fails(n_words: np.ndarray, n_repeat_words: np.ndarray) -> np.ndarray:
    return (n_words < 20) | (100 * n_repeat_words > 30 * n_words)


DEFAULT_RULES = (
    QualityRule("too_short", lambda t: word_counts(t) < 20),
    QualityRule("repeats_windows", lambda t: 100 * repeated_words(t) > 30 * word_counts(t)),
    QualityRule("symbols", lambda t: 10 * symbols(t) > 3 * word_counts(t)),
    QualityRule("repeats_lines", lambda t: 10 * duplicate_lines(t) > 3 * lines(t)),
    QualityRule("long_words", lambda t: word_chars(t) > 15 * word_counts(t)),
    QualityRule("short_words", lambda t: word_chars(t) < 2 * word_counts(t)),
)


def rule_order(texts: list[bytes], rules: tuple[QualityRule, ...]) -> list[QualityRule]:
    """Rules by rejected share per second on the sample, the best first."""
    gain = {}
    for rule in rules:
        began = time.perf_counter()
        rejected = rule.rejects(texts) if texts else np.zeros(0, bool)
        cost = (time.perf_counter() - began) / max(1, len(texts))
        gain[rule.name] = (float(rejected.mean()) if len(rejected) else 0.0) / max(cost, 1e-9)
    return sorted(rules, key=lambda r: (-gain[r.name], r.name))


def sampled_texts(docs: DataFrame, text: str, sample: int) -> list[bytes]:
    """At most ``sample`` texts of a Bernoulli sample; only cost and order depend on them."""
    total = max(1, docs.count())
    part = docs.select(text_bytes(F.col(text)).alias("t")).sample(min(1.0, 3 * sample / total), seed=11).limit(sample)
    return [bytes(r.t) for r in part.collect() if r.t is not None]


def passes(texts: list[bytes], ordered: list[QualityRule]) -> np.ndarray:
    alive = np.arange(len(texts))
    for rule in ordered:
        if len(alive):
            alive = alive[~rule.rejects([texts[i] for i in alive])]
    kept = np.zeros(len(texts), bool)
    kept[alive] = True
    return kept


def judged(
    docs: DataFrame,
    text: str = "text",
    rules: tuple[QualityRule, ...] = DEFAULT_RULES,
    sample: int = 300,
    measures: dict[str, Callable[[list[bytes]], np.ndarray]] | None = None,
) -> DataFrame:
    """``docs`` without ``text``, with the ``measures`` (long) and ``_passed`` (boolean)."""
    ordered = rule_order(sampled_texts(docs, text, sample), rules)
    measures = measures or {}
    others = [F.col(c) for c in docs.columns if c != text]
    source = docs.select(*others, text_bytes(F.col(text)).alias("_text"))
    schema = docs.select(*others, *[F.lit(0).cast("bigint").alias(n) for n in measures], F.lit(True).alias("_passed")).schema

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            values = [v or b"" for v in batch.column(batch.num_columns - 1).to_pylist()]
            columns = [batch.column(i) for i in range(batch.num_columns - 1)]
            columns += [pa.array(measure(values), pa.int64()) for measure in measures.values()]
            columns.append(pa.array(passes(values, ordered), pa.bool_()))
            yield pa.RecordBatch.from_arrays(columns, names=[f.name for f in schema])

    return source.mapInArrow(run, schema)


def cascade(docs: DataFrame, text: str = "text", rules: tuple[QualityRule, ...] = DEFAULT_RULES, sample: int = 300) -> DataFrame:
    """The rows that every rule passes, with their own columns."""
    own = Renamed(docs)
    keep = own.df.withColumn("_judged", F.col(own.name(text)))
    return own.back(judged(keep, "_judged", rules, sample).where("_passed"))


def quality_report(docs: DataFrame, text: str = "text", key: str = "doc_id") -> DataFrame:
    """The base measures and the verdict of every row."""
    measures = {
        "n_words": word_counts,
        "word_chars": word_chars,
        "n_symbols": symbols,
        "n_dup_lines": duplicate_lines,
        "n_repeat_words": repeated_words,
    }
    rows = judged(docs.select(key, text), text, measures=measures)
    failed = (F.col("n_words") < 20) | (100 * F.col("n_repeat_words") > 30 * F.col("n_words"))
    return rows.select(key, *measures, failed.alias("base_failed"), (~failed & F.col("_passed")).alias("kept"))
