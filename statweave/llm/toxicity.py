"""Toxicity: subword-bag embeddings averaged into a linear softmax, trained jointly in numpy.

A word is the bag of its character n-grams (with its borders) hashed into ``buckets`` rows
of an embedding table; words of one spelling family share rows, so an unseen misspelling
scores like its relatives. A text is cut into windows of at most ``WINDOW`` words; the
subword vectors of a window's different words are averaged and a linear softmax gives its probability; the text's score
is that of its worst window, so a long text does not dilute one insult. Table and softmax
are trained together; see ``fit`` for how labels of texts become labels of windows.

The fit reads a bounded sample of labelled rows: at most ``per_label`` texts of each label in
the order of a hash, of at most ``max_chars`` characters each. It runs in one task, so the
driver meets the model only. Every text is scored whole.

Null and empty texts score like a window without words: the bias alone. Repeated rows score
alike; an empty table gives no rows. Without labels of both kinds every score is the share
of toxic labels (0 without labels). Labels that disagree on one key count as toxic; equal
hashes in the sample are ordered by key. Texts of any length are scored whole, in chunks.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from statweave.llm.base import Renamed, WordTable, chunks, mix, per_text, text_bytes
from statweave.plans.staging import stage_table

WINDOW = 2
BUCKETS, DIM = 1 << 16, 8
MIN_TEXTS, DECAY, LEAST_BAG = 3, 1e-5, 16
HARD_WINDOWS = 3  # per toxic text and round
WINDOWS_DRAWN = 20_000  # clean windows a round learns from, besides the hardest ones


def subwords(words: list[bytes], buckets: int = BUCKETS) -> tuple[np.ndarray, np.ndarray]:
    """Bucket numbers of the 3- to 5-grams of every word with its borders, and how many each has."""
    marked = ["<" + w.decode("utf-8", "replace") + ">" for w in words]
    sizes = np.array([len(m) for m in marked], np.int64)
    if not len(sizes):
        return np.zeros(0, np.int64), sizes
    chars = np.frombuffer("".join(marked).encode("utf-32-le", "surrogatepass"), np.uint32).astype(np.uint64)
    begin = np.cumsum(sizes) - sizes
    grams, owners = [], []
    for n in (3, 4, 5):
        many = np.maximum(sizes - n + 1, 0)
        if n == 3:
            many = np.maximum(many, 1)  # a word too short for n-grams is one gram
        owner = np.repeat(np.arange(len(sizes)), many)
        at = begin[owner] + np.arange(len(owner)) - np.repeat(np.cumsum(many) - many, many)
        h = np.full(len(at), n, np.uint64)
        for i in range(n):
            inside = at + i < begin[owner] + sizes[owner]
            h = mix(h * np.uint64(31) + np.where(inside, chars[np.minimum(at + i, len(chars) - 1)], 0))
        grams.append((h & np.uint64(buckets - 1)).astype(np.int64))
        owners.append(owner)
    owner = np.concatenate(owners)
    order = np.argsort(owner, kind="stable")
    return np.concatenate(grams)[order], np.bincount(owner, minlength=len(sizes))


def windows(numbers: np.ndarray, sizes: np.ndarray, width: int = WINDOW) -> tuple[np.ndarray, ...]:
    """Texts of the given sizes cut into windows of even length, repeated words left out.

    Returns the words that stay, the sizes of the texts and of the windows without the
    repeated words, and how many windows each text has (one at least).
    """
    many = np.maximum(-(-sizes // width), 1)
    owner = np.repeat(np.arange(len(sizes)), many)
    turn = np.arange(len(owner)) - (np.cumsum(many) - many)[owner]
    size = sizes[owner] // many[owner] + (turn < sizes[owner] % many[owner])
    window = np.repeat(np.arange(len(size)), size)
    fresh = np.ones(len(numbers), bool)
    for back in range(1, width):
        fresh[back:] &= (numbers[back:] != numbers[:-back]) | (window[back:] != window[:-back])
    kept = fresh.astype(np.int64)
    return numbers[fresh], per_text(kept, sizes), per_text(kept, size), many


def average(total: np.ndarray, count: np.ndarray) -> np.ndarray:
    """Mean over a bag; a bag of few subwords counts as ``LEAST_BAG``, so one short word is no extreme."""
    return total / np.maximum(count, LEAST_BAG)


class Model:
    """Embeddings projected on the softmax's weight difference, and the bias."""

    def __init__(self, projected: np.ndarray, bias: float):
        self.projected, self.bias = projected.astype(np.float64), float(bias)

    def word_scores(self, words: list[bytes]) -> tuple[np.ndarray, np.ndarray]:
        """Sum of the projected subwords of every word, and their number."""
        grams, many = subwords(words, len(self.projected))
        return per_text(self.projected[grams], many), many.astype(np.float64)


class _Bags:
    """Texts as words, words as subwords, and windows over them."""

    def __init__(self, texts: list[bytes]):
        words = WordTable()
        parts = [words.number([t.split() for t in texts[first:last]]) for first, last in chunks(texts)]
        numbers, sizes = (np.concatenate([p[i] for p in parts]) for i in (0, 1))
        self.numbers, self.sizes, self.window_size, self.window_many = windows(numbers, sizes)
        grams, self.many = subwords(words.take_fresh())
        self.grams = grams.astype(np.int32)
        self.start = np.cumsum(self.many) - self.many
        self.window_start = np.cumsum(self.window_size) - self.window_size
        self.text_of = np.repeat(np.arange(len(texts)), self.window_many)
        self.first = np.cumsum(self.window_many) - self.window_many

    def spread(self, words: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """Subwords of the given words one after the other, and how many each has."""
        many = self.many[words]
        return self.grams[np.repeat(self.start[words] - (np.cumsum(many) - many), many) + np.arange(int(many.sum()))], many

    def texts_with(self, chosen: np.ndarray) -> np.ndarray:
        """In how many of the chosen texts each subword occurs."""
        total, ends = np.zeros(BUCKETS, np.int64), np.cumsum(self.sizes)
        for text in np.flatnonzero(chosen):
            own = np.unique(self.numbers[ends[text] - self.sizes[text] : ends[text]])
            total[np.unique(self.spread(own)[0])] += 1
        return total

    def window_values(self, projected: np.ndarray) -> np.ndarray:
        """Average of the projected subwords over every window."""
        word, many = per_text(projected[self.grams], self.many), self.many.astype(float)
        total = per_text(word[self.numbers], self.window_size)
        return average(total, per_text(many[self.numbers], self.window_size))

    def worst(self, values: np.ndarray) -> np.ndarray:
        return np.maximum.reduceat(values, self.first)

    def bag(self, chosen: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """Subwords of the chosen windows, and how many each window has."""
        size = self.window_size[chosen]
        at = np.repeat(self.window_start[chosen] - (np.cumsum(size) - size), size) + np.arange(int(size.sum()))
        grams, many = self.spread(self.numbers[at])
        return grams, per_text(many, size)


def _run_sums(values: np.ndarray, index: np.ndarray, begin: np.ndarray, rows: int = 1 << 16) -> np.ndarray:
    """Sums of ``values[index]`` over the runs of ``index`` that begin at ``begin``, some runs at a time."""
    ends, first = np.append(begin[1:], len(index)), 0
    out = np.empty((len(begin), values.shape[1]), values.dtype)
    while first < len(begin):
        last = max(first + 1, int(np.searchsorted(ends, begin[first] + rows, side="right")))
        part = index[begin[first] : ends[last - 1]]
        out[first:last] = np.add.reduceat(values[part], begin[first:last] - begin[first], axis=0)
        first = last
    return out


def _descend(grams, sizes, target, table, weights, bias, steps: int, rate: float) -> None:
    """Joint descent of table and softmax on some windows, in place.

    Steps are scaled per matrix, not per entry, so that a subword moves in proportion to
    the windows that ask for it and rare ones stay near zero.
    """
    used, local = np.unique(grams, return_inverse=True)
    local = local.astype(np.int32)
    windows_back = np.repeat(np.arange(len(sizes), dtype=np.int32), sizes)[np.argsort(local, kind="stable")]
    filled = (np.cumsum(sizes) - sizes)[sizes > 0]
    many = np.bincount(local, minlength=len(used))
    back_start = np.cumsum(many) - many
    count = np.maximum(sizes, LEAST_BAG)[:, None]
    weight = np.where(target == 1, 0.5 / max(target.sum(), 1), 0.5 / max((1 - target).sum(), 1))[:, None]
    own, moment = table[used], [0.0, 0.0, 0.0]
    for _ in range(steps):
        summed = _run_sums(own, local, filled)
        mean = np.zeros((len(sizes), DIM))
        mean[sizes > 0] = average(summed, sizes[sizes > 0, None])
        logits = mean @ weights + bias
        odds = np.exp(logits - logits.max(axis=1, keepdims=True))
        wrong = (odds / odds.sum(axis=1, keepdims=True) - np.column_stack([1 - target, target])) * weight
        to_mean = (wrong @ weights.T) / count
        gradients = (_run_sums(to_mean.astype(np.float32), windows_back, back_start) + DECAY * own, mean.T @ wrong, wrong.sum(axis=0))
        for i, (value, gradient) in enumerate(zip((own, weights, bias), gradients)):
            moment[i] = 0.9 * moment[i] + gradient
            value -= rate * moment[i] / (np.sqrt(np.mean(moment[i] ** 2)) + 1e-9)
    table[used] = own


def fit(
    texts: list[bytes], labels: np.ndarray, rounds: int = 6, steps: int = 60, share: float | None = None, seed: int = 5
) -> Model:
    """Train on three quarters of the texts, set scale and bias on the other quarter.

    ``share`` is the part of toxic texts where the model will be used, if that differs from
    the part among ``texts``; the bias is shifted to it.

    Toxic windows are not marked: the first round takes those whose subwords are most
    typical of toxic texts, later rounds those that the model finds toxic. Clean windows
    are drawn at random at first, later the ones that look most toxic are added.
    """
    rng = np.random.default_rng(seed)
    fold = rng.permutation(len(texts)) % 4 == 0
    part = [i for i in range(len(texts)) if not fold[i]]
    if len(set(labels[part].tolist())) < 2 or len(set(labels[fold].tolist())) < 2:
        part, fold = list(range(len(texts))), np.ones(len(texts), bool)
    bags, toxic = _Bags([texts[i] for i in part]), labels[part] == 1
    bad, good = bags.texts_with(toxic), bags.texts_with(~toxic)
    rate = np.log((bad + 1) / (toxic.sum() + 20)) - np.log((good + 1) / ((~toxic).sum() + 20))
    rate = np.where(bad + good >= MIN_TEXTS, np.maximum(rate, 0), 0)
    values = bags.window_values(rate)
    table = rng.normal(0, 0.01, (BUCKETS, DIM)).astype(np.float32)
    weights, bias = np.zeros((DIM, 2)), np.zeros(2)
    weights[:, 1], weights[:, 0] = 0.5, -0.5
    toxic_window, cut = toxic[bags.text_of], None
    clean, hard = np.flatnonzero(~toxic_window), np.zeros(0, np.int64)
    for turn in range(rounds):
        best = bags.worst(values)[bags.text_of]
        marked = toxic_window & ((values >= 0.999 * best) if cut is None else (values >= np.minimum(cut, best)))
        drawn = rng.choice(clean, min(len(clean), WINDOWS_DRAWN), replace=False)
        if turn:
            worst = clean[np.argsort(-values[clean], kind="stable")[: HARD_WINDOWS * int(toxic.sum())]]
            hard = np.union1d(hard, worst)
        chosen = np.unique(np.concatenate([np.flatnonzero(marked), drawn, hard]))
        grams, sizes = bags.bag(chosen)
        keep = (bad + good)[grams] >= MIN_TEXTS
        grams, sizes = grams[keep], per_text(keep.astype(np.int64), sizes)
        _descend(grams, sizes, toxic_window[chosen].astype(float), table, weights, bias, steps, 0.05 / (1 + turn))
        values = bags.window_values(_projected(table, weights, bad + good))
        cut = float(np.quantile(values[clean], 0.999)) if len(clean) else 0.0
    projected = _projected(table, weights, bad + good)
    del bags, values
    held = _Bags([texts[i] for i in np.flatnonzero(fold)])
    slope, bias_of = _calibrate(held.worst(held.window_values(projected)), labels[fold])
    if share is not None:
        here = float(labels.mean())
        odds = lambda x: np.log((x + 1e-3) / (1 - x + 1e-3))
        bias_of += odds(share) - odds(here)
    return Model(projected * slope, bias_of)


def _projected(table: np.ndarray, weights: np.ndarray, texts: np.ndarray) -> np.ndarray:
    return np.where(texts >= MIN_TEXTS, table @ (weights[:, 1] - weights[:, 0]), 0.0)


def _calibrate(value: np.ndarray, label: np.ndarray) -> tuple[float, float]:
    """Slope and bias of a logistic curve from a text's worst window to its label (Newton steps)."""
    scale = max(float(value.std()), 1e-9)
    x = np.column_stack([value / scale, np.ones(len(value))])
    beta = np.zeros(2)
    for _ in range(30):
        p = 1 / (1 + np.exp(-np.clip(x @ beta, -30, 30)))
        hessian = (x * (p * (1 - p))[:, None]).T @ x + np.diag([1e-2, 1e-3])
        beta += np.linalg.solve(hessian, x.T @ (label - p) - np.array([1e-2, 1e-3]) * beta)
    return max(beta[0], 0.0) / scale, beta[1]


def labelled_sample(
    docs: DataFrame, labels: DataFrame, label: str, key: str, text: str, usable: Column, per_label: int, max_chars: int
) -> tuple[DataFrame, float]:
    """``_label, _text`` in one ordered partition, and the share of label 1 among all labelled rows.

    Keys are chosen first, from keys and labels alone; texts are then fetched for the at
    most ``2 * per_label`` chosen keys, so no text is shuffled to find the sample. A key
    with several rows gives its smallest text.
    """
    known = labels.where(F.col(label).isNotNull()).groupBy(F.col(key).alias("_key")).agg(F.max(label).alias("_label"))
    fits = F.coalesce(F.length(text) <= max_chars, F.lit(False))
    rows = docs.where(usable).groupBy(F.col(key).alias("_key")).agg(F.count("*").alias("_rows"), F.max(fits).alias("_fits"))
    joined = stage_table(rows.join(known, "_key"))
    counted = {r["_label"]: r["n"] for r in joined.groupBy("_label").agg(F.sum("_rows").alias("n")).collect()}
    parts = [
        joined.where("_fits").where(F.col("_label") == value).orderBy(F.xxhash64("_key"), "_key").limit(per_label)
        for value in (0, 1)
    ]
    chosen = stage_table(parts[0].union(parts[1]).select("_key", "_label"))
    source = docs.where(usable & fits).select(F.col(key).alias("_key"), F.lower(text).cast("binary").alias("_text"))
    fetched = source.join(F.broadcast(chosen), "_key").groupBy("_key", "_label").agg(F.min("_text").alias("_text"))
    sample = fetched.repartition(1).sortWithinPartitions("_label", F.xxhash64("_key"), "_key")  # at most 2 * per_label rows
    return sample.select("_label", "_text"), counted.get(1, 0) / max(1, sum(counted.values()))


def train(
    docs: DataFrame,
    labels: DataFrame,
    label: str = "toxic",
    key: str = "doc_id",
    text: str = "text",
    usable: Column | None = None,
    per_label: int = 1500,
    max_chars: int = 50_000,
) -> Model:
    usable = F.lit(True) if usable is None else usable
    sample, share = labelled_sample(docs, labels, label, key, text, usable, per_label, max_chars)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        texts, values = [], []
        for batch in batches:
            values += batch.column(0).to_pylist()
            texts += batch.column(1).to_pylist()
        if len(set(values)) == 2:
            model = fit(texts, np.array(values), share=share)
            yield pa.RecordBatch.from_arrays([pa.array([model.projected.tobytes()], pa.binary()), pa.array([model.bias])], names=["projected", "bias"])

    found = sample.mapInArrow(run, "projected binary, bias double").collect()
    if not found:
        return Model(np.zeros(BUCKETS), np.log((share + 1e-6) / (1 - share + 1e-6)))
    return Model(np.frombuffer(found[0]["projected"]), found[0]["bias"])


def scored(docs: DataFrame, model: Model, text: str = "text") -> DataFrame:
    """``docs`` without ``text``, with ``_score``; a caller's column of that name is replaced."""
    own = Renamed(docs)
    names = [c for c in own.names if c not in (text, "_score")]
    others = [own.name(c) for c in names]
    source = own.df.select(*others, text_bytes(F.lower(F.col(own.name(text)).cast("string"))).alias("_lower"))
    schema = own.df.select(*others, F.lit(0.0).alias("_score")).schema
    shared = docs.sparkSession.sparkContext.broadcast((model.projected, model.bias))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        model = Model(*shared.value)
        words, score, many = WordTable(), np.zeros(0), np.zeros(0)
        for batch in batches:
            texts = [v or b"" for v in batch.column(batch.num_columns - 1).to_pylist()]
            result = np.zeros(len(texts))
            for first, last in chunks(texts):
                if words.trim():
                    score, many = np.zeros(0), np.zeros(0)
                numbers, sizes = words.number([t.split() for t in texts[first:last]])
                new = model.word_scores(words.take_fresh())
                score, many = np.concatenate([score, new[0]]), np.concatenate([many, new[1]])
                numbers, _, window_size, window_many = windows(numbers, sizes)
                logit = average(per_text(score[numbers], window_size), per_text(many[numbers], window_size))
                worst = np.maximum.reduceat(logit, np.cumsum(window_many) - window_many)
                result[first:last] = 1 / (1 + np.exp(-np.clip(worst + model.bias, -60, 60)))
            columns = [batch.column(i) for i in range(batch.num_columns - 1)]
            yield pa.RecordBatch.from_arrays([*columns, pa.array(result)], names=[f.name for f in schema])

    return source.mapInArrow(run, schema).toDF(*names, "_score")


def remove_toxic(docs: DataFrame, model: Model, text: str = "text", threshold: float = 0.3) -> DataFrame:
    """The rows that score below ``threshold``, with their own columns."""
    own = Renamed(docs)
    judged = scored(own.df.withColumn("_judged", F.col(own.name(text))), model, "_judged")
    return own.back(judged.where(F.col("_score") < threshold))
