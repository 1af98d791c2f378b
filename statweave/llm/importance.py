"""Resampling towards a target distribution by hashed n-gram importance weights.

Features are all runs of 1 … ``grams`` consecutive words, joined by one space, repeats
counted. A feature's bucket is the CRC-32 of its bytes modulo ``buckets``. CRCs are computed
for the distinct features of a chunk at once: features of equal length form a matrix of
bytes, one table lookup per column updates the CRCs of all its rows, and the buckets are
scattered back to the occurrences. (A feature longer than ``LONG`` bytes would make a matrix
of one row; its CRC is taken by ``zlib``, which gives the same number.)

1. Bucket counts of all documents and of all target texts: one vector per task, summed by
   Spark; at most ``buckets`` rows reach the driver.
2. A bucket's gain is the floored, scaled log ratio of its smoothed shares; a document's
   weight is the sum of the gains of its features.
3. The draw adds Gumbel noise from a hash of the key to the weight and takes the highest
   scores of the documents with enough words, so it is a sample without replacement in
   proportion to the importance weights, and the same on every run. The rank is a row
   number over ranges of the scores; no task sees more than its range.

Words: runs of ASCII letters and digits and of all non-ASCII characters, A-Z lowered.
Null and empty texts have no words, no features and weight 0; texts are read whole, in
chunks, however long. Equal scores go to the smaller key, a null key is the largest of all
and its noise is that of the seed alone; rows equal in score and key are drawn in the order
in which they are read. Repeated rows count as often as they occur. Empty documents give no
rows; an empty target gives every feature the gain of an unseen one. Working columns have
a leading underscore; callers' columns may have any name.
"""

from __future__ import annotations

import math
import zlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from statweave.llm.base import Renamed, WordTable, chunks, per_text, text_bytes
from statweave.plans.prefix_sum import bucketed, offset_buckets
from statweave.plans.staging import stage_table

BUCKETS = 10_000
SCALE = 1000  # gains and noise are floored to thousandths of a nat
LONG = 4096
POLYNOMIAL = 0xEDB88320  # fixed value: CRC-32, reflected
_WORD = set(b"abcdefghijklmnopqrstuvwxyz0123456789") | set(range(128, 256))
_FOLD = bytes((b + 32 if 65 <= b <= 90 else b) if (b + 32 if 65 <= b <= 90 else b) in _WORD else 32 for b in range(256))


def crc_steps() -> np.ndarray:
    """What each value of the low byte adds to the rest of a CRC."""
    value = np.arange(256, dtype=np.uint32)
    for _ in range(8):
        value = np.where(value & 1, (value >> 1) ^ np.uint32(POLYNOMIAL), value >> 1).astype(np.uint32)
    return value


STEPS = crc_steps()


def crc_of_rows(matrix: np.ndarray) -> np.ndarray:
    """CRC-32 of every row of a matrix of bytes, column by column."""
    crc = np.full(len(matrix), 0xFFFFFFFF, np.uint32)
    for column in np.ascontiguousarray(matrix.T):
        crc = STEPS[(crc ^ column) & 0xFF] ^ (crc >> np.uint32(8))
    return ~crc


def crc32(features: list[bytes]) -> np.ndarray:
    """CRC-32 of every feature, by matrices of features of equal length."""
    sizes = np.fromiter(map(len, features), np.int64, len(features))
    order = np.argsort(sizes, kind="stable")
    result = np.zeros(len(features), np.uint32)
    cut = np.flatnonzero(np.diff(sizes[order], prepend=-1))
    for first, last in zip(cut.tolist(), [*cut[1:].tolist(), len(order)]):
        own, width = order[first:last], int(sizes[order[first]])
        if width > LONG:
            result[own] = [zlib.crc32(features[i]) for i in own]
        else:
            flat = np.frombuffer(b"".join(features[i] for i in own), np.uint8)
            result[own] = crc_of_rows(flat.reshape(len(own), width))
    return result


class Hasher:
    """Buckets of all features of some texts, one text after the other."""

    def __init__(self, grams: int, buckets: int):
        self.grams, self.buckets = grams, buckets
        self.table, self.known = WordTable(), np.zeros(0, np.int64)

    def __call__(self, texts: list[bytes]) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        """(buckets, features per text, words per text)."""
        if self.table.trim():
            self.known = np.zeros(0, np.int64)
        numbers, sizes = self.table.number([t.translate(_FOLD).split() for t in texts])
        fresh = crc32(self.table.take_fresh()) % self.buckets
        self.known = np.concatenate([self.known, fresh.astype(np.int64)])
        if self.grams == 1:
            return self.known[numbers], sizes, sizes
        words = list(self.table)
        owner = np.repeat(np.arange(len(sizes)), sizes)
        found, owners = [self.known[numbers]], [owner]
        run, names = numbers, words
        for n in range(2, self.grams + 1):
            left = run[: max(len(run) - 1, 0)]  # the run of n - 1 words that begins at each word
            next_word = numbers[n - 1 :][: len(left)]
            left = left[: len(next_word)]
            inside = owner[: len(left)] == owner[n - 1 :][: len(left)]
            pair = left * len(words) + next_word
            distinct, run = np.unique(np.where(inside, pair, -1), return_inverse=True)
            names = [b" ".join((names[p // len(words)], words[p % len(words)])) if p >= 0 else b"" for p in distinct.tolist()]
            found.append((crc32(names) % self.buckets).astype(np.int64)[run][inside])
            owners.append(owner[: len(left)][inside])
        every = np.concatenate(owners)
        order = np.argsort(every, kind="stable")
        return np.concatenate(found)[order], np.bincount(every, minlength=len(sizes)).astype(np.int64), sizes


def bucket_counts(texts: DataFrame, text: str = "text", grams: int = 1, buckets: int = BUCKETS) -> np.ndarray:
    """How often features fall into each bucket, over all rows."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        hasher, total = Hasher(grams, buckets), np.zeros(buckets, np.int64)
        for batch in batches:
            values = [v or b"" for v in batch.column(0).to_pylist()]
            for first, last in chunks(values):
                total += np.bincount(hasher(values[first:last])[0], minlength=buckets)
        used = np.flatnonzero(total)
        yield pa.RecordBatch.from_arrays([pa.array(used), pa.array(total[used])], names=["bucket", "n"])

    counted = texts.select(text_bytes(F.col(text)).alias("_text")).mapInArrow(run, "bucket bigint, n bigint")
    result = np.zeros(buckets, np.int64)
    for row in counted.groupBy("bucket").agg(F.sum("n").alias("n")).collect():  # at most ``buckets`` rows
        result[row["bucket"]] = row["n"]
    return result


def bucket_gains(source: np.ndarray, target: np.ndarray) -> np.ndarray:
    """Floored ``SCALE`` · ln of (target share / source share), both smoothed by one per bucket."""
    size, s_all, t_all = len(source), int(source.sum()), int(target.sum())
    return np.array(
        [
            math.floor(SCALE * math.log((t + 1) * (s_all + size) / ((s + 1) * (t_all + size))))
            for s, t in zip(source.tolist(), target.tolist())
        ],
        np.int64,
    )


def weighed(docs: DataFrame, gains: np.ndarray, text: str = "text", grams: int = 1) -> DataFrame:
    """``docs`` without ``text``, with _features, _words and _weight."""
    others = [c for c in docs.columns if c != text]
    zero = F.lit(0).cast("bigint")
    schema = docs.select(*others, zero.alias("_features"), zero.alias("_words"), zero.alias("_weight")).schema
    sent = docs.sparkSession.sparkContext.broadcast(gains)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        gains = sent.value
        hasher = Hasher(grams, len(gains))
        for batch in batches:
            values = [v or b"" for v in batch.column(batch.num_columns - 1).to_pylist()]
            parts = [np.zeros((3, 0), np.int64)]
            for first, last in chunks(values):
                found, many, words = hasher(values[first:last])
                parts.append(np.stack([many, words, per_text(gains[found], many)]))
            columns = [batch.column(i) for i in range(batch.num_columns - 1)]
            columns += [pa.array(c) for c in np.concatenate(parts, axis=1)]
            yield pa.RecordBatch.from_arrays(columns, names=[f.name for f in schema])

    return docs.select(*others, text_bytes(F.col(text)).alias("_text")).mapInArrow(run, schema)


def noise(key: Column, seed: str) -> Column:
    """Floored, scaled Gumbel noise from the first 32 bits of a digest of seed and key."""
    digest = F.sha2(F.concat(F.lit(f"{seed}:"), F.coalesce(key.cast("string"), F.lit(""))), 256)
    part = F.conv(F.substring(digest, 1, 8), 16, 10).cast("double")
    return F.floor(-SCALE * F.log(-F.log((part + 0.5) / 4294967296.0)))


def scored(
    docs: DataFrame,
    target: DataFrame,
    key: str = "doc_id",
    text: str = "text",
    target_text: str = "text",
    grams: int = 1,
    buckets: int = BUCKETS,
    seed: str = "2024",
) -> DataFrame:
    """``docs`` without ``text``, with _features, _words, _weight and _score."""
    gains = bucket_gains(bucket_counts(docs, text, grams, buckets), bucket_counts(target, target_text, grams, buckets))
    return weighed(docs, gains, text, grams).withColumn("_score", F.col("_weight") + noise(F.col(key), seed))


def ranked(rows: DataFrame, key: str, least_words: int = 20, percent: int = 10) -> DataFrame:
    """``rows`` (staged, with _words and _score) and _rank: 1, 2, 3 … for the drawn ones, else null."""
    eligible = rows.where(F.col("_words") >= least_words)
    place = F.struct(
        (-F.col("_score")).alias("score"), F.col(key).isNull().alias("none"), F.col(key).alias("key"), F.col("_row").alias("row")
    )
    tagged = bucketed(eligible.withColumn("_place", place), "_place")
    # one row per range; the number of eligible rows comes with it
    offsets = offset_buckets(tagged.withColumn("_one", F.lit(1).cast("bigint")), ["_one"])
    number = F.expr("row_number() OVER (PARTITION BY _bucket ORDER BY _place)") + F.col("_off__one")
    drawn = F.col("_number") <= F.floor(F.col("_total__one") * percent / 100)
    numbered = tagged.join(F.broadcast(offsets), "_bucket").withColumn("_number", number.cast("bigint"))
    first = numbered.select(*rows.columns, F.when(drawn, F.col("_number")).alias("_rank"))
    rest = rows.where(F.coalesce(F.col("_words") < least_words, F.lit(True)))
    return first.unionByName(rest.withColumn("_rank", F.lit(None).cast("bigint")))


def importance_report(
    docs: DataFrame, target: DataFrame, key: str = "doc_id", text: str = "text", least_words: int = 20, percent: int = 10, **options
) -> DataFrame:
    """Every row's key, n_features, weight, score and rank (null where it is not drawn)."""
    own = Renamed(docs.select(key, text))
    rows = scored(own.df, target, own.name(key), own.name(text), **options)
    staged = stage_table(rows.withColumn("_row", F.monotonically_increasing_id()))
    return ranked(staged, own.name(key), least_words, percent).select(
        F.col(own.name(key)).alias(key),
        F.col("_features").alias("n_features"),
        F.col("_weight").alias("weight"),
        F.col("_score").alias("score"),
        F.col("_rank").alias("rank"),
    )


def resample(
    docs: DataFrame, target: DataFrame, key: str = "doc_id", text: str = "text", least_words: int = 20, percent: int = 10, **options
) -> DataFrame:
    """The drawn documents with their own columns."""
    own = Renamed(docs)
    judged = own.df.withColumn("_judged", F.col(own.name(text)))
    staged = stage_table(
        scored(judged, target.select(F.col(options.pop("target_text", "text")).alias("text")), own.name(key), "_judged", **options)
        .withColumn("_row", F.monotonically_increasing_id())
    )
    places = ranked(staged.select(own.name(key), "_words", "_score", "_row"), own.name(key), least_words, percent)
    drawn = places.where("_rank IS NOT NULL").select("_row")
    return own.back(staged.join(drawn, "_row", "left_semi"))
