"""Near-duplicate classes by SuperMinHash signatures, banding, verification and union-find.

1. One pass writes every row with its word-sequence fingerprint, the size of its shingle set
   and its band keys. In a SuperMinHash signature of ``slots`` values every shingle draws a
   random permutation of the slots step by step, offers ``step + random`` to the slot it
   reaches, and stops when no slot can still fall below its step; the correlated ranks make
   the estimate's variance lower than with independent hashes.
2. Equal word sequences become one node, so exact copies cost one row each from here on.
3. Nodes that share a band key are candidates. A bucket is a star to its smallest node, never
   all its pairs; connected stars are candidate groups.
4. Candidate groups are verified on the full shingle sets: each text is compared with
   the ones that a prefix filter leaves and that union-find has not joined yet, so every
   link between two classes of a group is looked for and none is listed twice. Groups above
   ``group_shingles`` are dealt out as pairs of parts, which keeps a task bounded.
5. Verified forests are joined by union-find, inside Arrow batches first and then by rounds
   of hooking and pointer jumping over tables in the shared folder.

With 32 bands of 5 slots a pair at similarity 0.85 is missed with a chance of about 1e-8,
at 0.8 of 3e-6.

Words: runs of characters other than space and the five ASCII line and tab characters, A-Z
lowered. A set holds the distinct shingles of ``words`` words; a shorter text is one shingle.
A text without words, or null, has an empty set and is linked with nothing. Repeated rows
are exact copies. A null key counts as larger than any other. An empty table gives no rows.
Working columns have a leading underscore.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from statweave.llm.base import Renamed, WordTable, chunks, mix, text_bytes
from statweave.plans.staging import stage_table

SLOTS, BANDS = 160, 32
ELEMENTS = 1 << 15
GROUP_SHINGLES = 3_000_000
GOLDEN = np.uint64(0x9E3779B97F4A7C15)


class Shingler:
    """Shingle sets of texts as sorted arrays of 64-bit hashes."""

    def __init__(self, words: int):
        self.words, self.table, self.hashes = words, WordTable(), np.zeros(0, np.uint64)

    def sets(self, texts: list[bytes]) -> list[np.ndarray]:
        if self.table.trim():
            self.hashes = np.zeros(0, np.uint64)
        numbers, sizes = self.table.number([t.split() for t in texts])
        fresh = self.table.take_fresh()
        self.hashes = np.concatenate([self.hashes, np.fromiter(map(xxhash.xxh3_64_intdigest, fresh), np.uint64, len(fresh))])
        hashed = self.hashes[numbers]
        rolled = np.zeros(len(hashed), np.uint64)
        for i in range(self.words):
            rolled[: len(hashed) - i] = rolled[: len(hashed) - i] * GOLDEN + mix(hashed[i:] + np.uint64(i))
        rolled = mix(rolled)
        result, at = [], 0
        for size in sizes.tolist():
            if size >= self.words:
                result.append(np.unique(rolled[at : at + size - self.words + 1]))
            elif size:
                whole = np.uint64(size)
                for h in hashed[at : at + size]:
                    whole = mix(np.array([whole ^ h]))[0]
                result.append(np.array([whole]))
            else:
                result.append(np.zeros(0, np.uint64))
            at += size
        return result


def super_minhash(sets: list[np.ndarray], slots: int = SLOTS) -> np.ndarray:
    """One row of ``slots`` values per set; empty sets keep infinity."""
    signature = np.full((len(sets), slots), np.inf)
    start = 0
    while start < len(sets):
        end, total = start, 0
        while end < len(sets) and (end == start or total + len(sets[end]) <= ELEMENTS):
            total += len(sets[end])
            end += 1
        if end == start + 1:  # one long text: its elements in parts, each against the values so far
            for i in range(0, total, ELEMENTS):
                _draw([sets[start][i : i + ELEMENTS]], signature[start:end])
        else:
            _draw(sets[start:end], signature[start:end])
        start = end
    return signature


def _draw(sets: list[np.ndarray], signature: np.ndarray) -> None:
    slots = signature.shape[1]
    element = np.concatenate(sets)
    owner = np.repeat(np.arange(len(sets)), [len(s) for s in sets])
    flat = signature.reshape(-1)
    order = None  # permutation so far, one row per element
    for step in range(slots):
        live = signature.max(axis=1) > step
        keep = live[owner]
        if not keep.all():
            element, owner = element[keep], owner[keep]
            order = None if order is None else order[keep]
        if not len(element):
            return
        drawn = mix(element + np.uint64((2 * step + 1) * int(GOLDEN) % 2**64))
        other = step + (((drawn & np.uint64(0xFFFFFFFF)) * np.uint64(slots - step)) >> np.uint64(32)).astype(np.int64)
        rows = np.arange(len(element))
        if order is None:
            order = np.tile(np.arange(slots, dtype=np.uint16), (len(element), 1))
        slot = order[rows, other].astype(np.int64)
        order[rows, other] = order[:, step]
        np.minimum.at(flat, owner * slots + slot, step + (drawn >> np.uint64(32)).astype(np.float64) / 2**32)


def band_keys(signature: np.ndarray, bands: int = BANDS) -> np.ndarray:
    bits = signature.view(np.uint64).reshape(len(signature), bands, -1)
    keys = np.broadcast_to(mix(np.arange(bands, dtype=np.uint64)), bits.shape[:2]).copy()
    for i in range(bits.shape[2]):
        keys = mix(keys * GOLDEN + bits[:, :, i])
    return keys.view(np.int64)


def signed(docs: DataFrame, text: str, words: int, slots: int, bands: int) -> DataFrame:
    """Staged ``docs`` with _row, _fp (null without words), _n and _bands."""
    source = docs.withColumn("_row", F.monotonically_increasing_id())
    kept, place = source.columns, source.columns.index(text)
    if docs.schema[text].dataType != T.StringType():  # a string travels to Python once and is lowered there
        source, place = source.withColumn("_string", F.col(text).cast("string")), len(kept)
    schema = source.select(
        *kept,
        F.lit(b"").alias("_fp"),
        F.lit(0).cast("bigint").alias("_n"),
        F.array(F.lit(0).cast("bigint")).alias("_bands"),
    ).schema
    schema["_fp"].nullable = True

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        shingler = Shingler(words)
        for batch in batches:
            texts = [v.lower() if v else b"" for v in batch.column(place).cast(pa.binary()).to_pylist()]
            prints = [xxhash.xxh3_128_digest(b" ".join(w)) if (w := t.split()) else None for t in texts]
            sizes, keys = [], []
            for first, last in chunks(texts):
                sets = shingler.sets(texts[first:last])
                sizes.extend(map(len, sets))
                found = band_keys(super_minhash(sets, slots), bands)
                keys.extend(found[i] if len(s) else found[i][:0] for i, s in enumerate(sets))
            columns = [batch.column(i) for i in range(len(kept))]
            offsets = np.concatenate([[0], np.cumsum([len(k) for k in keys])]).astype(np.int32)
            values = np.concatenate(keys) if keys else np.zeros(0, np.int64)
            columns += [
                pa.array(prints, pa.binary()),
                pa.array(sizes, pa.int64()),
                pa.ListArray.from_arrays(pa.array(offsets), pa.array(values)),
            ]
            yield pa.RecordBatch.from_arrays(columns, names=[f.name for f in schema])

    return stage_table(source.mapInArrow(run, schema))


def _forest(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Union-find inside each batch: edges (a, b) to (a, root), root the smallest of its tree."""
    for batch in batches:
        parent: dict[int, int] = {}

        def find(x: int) -> int:
            root = x
            while (up := parent.get(root, root)) != root:
                root = up
            while (up := parent.get(x, x)) != root:
                parent[x], x = root, up
            return root

        for a, b in zip(batch.column(0).to_pylist(), batch.column(1).to_pylist()):
            parent.setdefault(a, a)
            parent.setdefault(b, b)
            ra, rb = find(a), find(b)
            if ra != rb:
                parent[max(ra, rb)] = min(ra, rb)
        nodes = [n for n in parent if find(n) != n]
        yield pa.RecordBatch.from_arrays(
            [pa.array(nodes, pa.int64()), pa.array([find(n) for n in nodes], pa.int64())], names=["a", "b"]
        )


def components(edges: DataFrame) -> DataFrame:
    """(id, label) of every node of the edges (a, b): label is the smallest node it reaches.

    Each round hooks every root to its smallest neighbour, shortens the paths by pointer
    jumping and contracts the edges; it ends when no edge joins two roots.
    """
    left = stage_table(edges.mapInArrow(_forest, "a bigint, b bigint").distinct())
    labels = left.select(F.col("a").alias("id")).union(left.select("b")).distinct().withColumn("label", F.col("id"))
    while not left.isEmpty():
        pairs = left.select(F.greatest("a", "b").alias("id"), F.least("a", "b").alias("to"))
        hooks = stage_table(pairs.groupBy("id").agg(F.min("to").alias("to")))
        while True:
            above = hooks.select(F.col("id").alias("to"), F.col("to").alias("up"))
            jumped = stage_table(hooks.join(above, "to", "left").select("id", F.coalesce("up", "to").alias("to"), "up"))
            hooks = jumped.select("id", "to")
            if jumped.where("up IS NOT NULL").isEmpty():
                break
        labels = stage_table(
            labels.join(hooks.select(F.col("id").alias("label"), "to"), "label", "left").select(
                "id", F.coalesce("to", "label").alias("label")
            )
        )
        a = hooks.select(F.col("id").alias("a"), F.col("to").alias("ra"))
        b = hooks.select(F.col("id").alias("b"), F.col("to").alias("rb"))
        left = stage_table(
            left.join(a, "a", "left")
            .join(b, "b", "left")
            .select(F.coalesce("ra", "a").alias("a"), F.coalesce("rb", "b").alias("b"))
            .where("a != b")
            .distinct()
        )
    return labels


def linked(sets: list[np.ndarray], percent: int) -> np.ndarray:
    """Class number of each set, joining sets with 100·|A∩B| ≥ percent·|A∪B|.

    Texts are taken from short to long. Sets that meet the bound share one of their
    ``n − ceil(percent·n/100) + 1`` rarest shingles; only those are indexed.
    """
    count = len(sets)
    sizes = np.array([len(s) for s in sets], np.int64)
    flat, frequency = np.unique(np.concatenate(sets), return_inverse=True, return_counts=True)[1:]
    begin = np.cumsum(sizes) - sizes
    rarity = np.lexsort((flat, frequency[flat], np.repeat(np.arange(count), sizes)))
    flat = flat[rarity]  # inside each set, the rarest shingles first
    group = np.arange(count)
    index: dict[int, list[int]] = {}
    flag = np.zeros(len(frequency), bool)
    for x in np.argsort(sizes, kind="stable").tolist():
        n = int(sizes[x])
        own = flat[begin[x] : begin[x] + n]
        prefix = own[: n - (percent * n + 99) // 100 + 1].tolist()
        near = np.unique(np.array([y for p in prefix for y in index.get(p, ())], np.int64))
        for p in prefix:
            index.setdefault(p, []).append(x)
        near = near[100 * sizes[near] >= percent * n]
        flag[own] = True
        step = 8
        while len(near := near[group[near] != group[x]]):
            some, near = near[:step], near[step:]
            step = min(4 * step, 4096)
            spans = np.concatenate([np.arange(begin[y], begin[y] + sizes[y]) for y in some])
            common = np.add.reduceat(flag[flat[spans]].astype(np.int64), np.cumsum(sizes[some]) - sizes[some])
            for y in some[100 * common >= percent * (n + sizes[some] - common)]:
                if group[y] != group[x]:
                    group[group == max(group[x], group[y])] = min(group[x], group[y])
        flag[own] = False
    return group


def verified(candidates: DataFrame, words: int, percent: int) -> DataFrame:
    """Edges (a, b) of a forest inside each group: rows _group, _left, _right, _id, _text."""

    def run(table: pa.Table) -> pa.Table:
        ids = table.column("_id").to_numpy()
        shingler, sets = Shingler(words), []
        texts = [t.lower() for t in table.column("_text").to_pylist()]
        for first, last in chunks(texts):
            sets.extend(shingler.sets(texts[first:last]))
        group = linked(sets, percent)
        smallest = np.full(len(ids), np.iinfo(np.int64).max)
        np.minimum.at(smallest, group, ids)
        root = smallest[group]
        joined = ids != root
        return pa.table({"a": ids[joined], "b": root[joined]})

    grouped = candidates.groupBy("_group", "_left", "_right")
    return grouped.applyInArrow(run, "a bigint, b bigint")


def classes(
    docs: DataFrame,
    key: str = "doc_id",
    text: str = "text",
    words: int = 5,
    percent: int = 80,
    slots: int = SLOTS,
    bands: int = BANDS,
    group_shingles: int = GROUP_SHINGLES,
) -> DataFrame:
    """The rows of ``docs`` with _n (set size), _class (smallest key of the class) and _first.

    ``_first`` is true for one row of every class, one with the smallest key.
    """
    rows = signed(docs, text, words, slots, bands)
    place = F.struct(F.col(key).isNull().alias("none"), F.col(key).alias("key"), F.col("_row").alias("row"))
    nodes = stage_table(
        rows.where("_fp IS NOT NULL")
        .groupBy("_fp")
        .agg(F.min(place).alias("_place"), F.first("_n").alias("_n"), F.first("_bands").alias("_bands"))
        .withColumn("_id", F.col("_place.row"))
    )
    banded = nodes.select("_id", F.explode("_bands").alias("band"))
    heads = banded.groupBy("band").agg(F.min("_id").alias("head"), F.count("*").alias("c")).where("c > 1").drop("c")
    stars = banded.join(heads, "band").where("_id != head").select(F.col("_id").alias("a"), F.col("head").alias("b"))
    groups = components(stars)
    sized = nodes.select("_id", "_n").join(groups.withColumnRenamed("id", "_id"), "_id")
    totals = sized.groupBy("label").agg(F.ceil(F.sum("_n") / group_shingles).alias("parts"))
    spread = (
        sized.join(totals, "label")
        .withColumn("part", F.pmod(F.xxhash64("_id"), "parts").cast("int"))
        .withColumn("other", F.explode(F.sequence(F.lit(0), (F.col("parts") - 1).cast("int"))))
        .select(
            F.col("_id"),
            F.col("label").alias("_group"),
            F.least("part", "other").alias("_left"),
            F.greatest("part", "other").alias("_right"),
        )
    )
    texts = rows.select(F.col("_row").alias("_id"), text_bytes(F.col(text)).alias("_text"))
    links = components(stage_table(verified(texts.join(spread, "_id"), words, percent)))
    labelled = nodes.select("_fp", "_id", "_place").join(
        links.select(F.col("id").alias("_id"), "label"), "_id", "left"
    ).withColumn("label", F.coalesce("label", "_id"))
    best = labelled.groupBy("label").agg(F.min("_place").alias("_best"))
    named = labelled.join(best, "label").select("_fp", "_best")
    joined = rows.drop("_bands").join(named, "_fp", "left")
    alone = F.col("_fp").isNull()
    return joined.select(
        *docs.columns,
        "_n",
        F.when(alone, F.col(key)).otherwise(F.col("_best.key")).alias("_class"),
        F.when(alone, True).otherwise(F.col("_row") == F.col("_best.row")).alias("_first"),
    )


def near_dedup(docs: DataFrame, key: str = "doc_id", text: str = "text", **options) -> DataFrame:
    """One row of every class, with its own columns; rows without words all stay."""
    own = Renamed(docs)
    return own.back(classes(own.df, own.name(key), own.name(text), **options).where("_first"))


def class_report(docs: DataFrame, key: str = "doc_id", text: str = "text", **options) -> DataFrame:
    own = Renamed(docs.select(key, text))
    found = classes(own.df, own.name(key), own.name(text), **options)
    return found.select(
        F.col(own.name(key)).alias(key),
        F.col("_n").alias("n_shingles"),
        F.col("_class").alias("component_id"),
        F.col(own.name(key)).eqNullSafe(F.col("_class")).alias("kept"),
    )
