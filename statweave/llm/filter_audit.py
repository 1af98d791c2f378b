"""Filter interaction audit: what each filter removes alone, in every order, and on average.

Four filters judge a text by itself; the fifth fails a document whose whole text equals that
of a document with a smaller key, anywhere in the table. Duplicates are found by radix
(path-compressed) tries over whole texts that hold the smallest key at each terminal:

1. An Arrow batch computes the masks of filters A–D, inserts its texts into a trie and
   passes a text on only for the rows with its smallest key; all others are duplicates
   already. A group of copies thus sends at most one text per batch, however large it is.
2. The texts that are left are range-partitioned by prefixes of adaptive length: a prefix
   with more than a block of text below it (``block_bytes``, or a 64th of all text where that is
   less) is lengthened fourfold until it is not.
   Equal texts have equal prefixes, so they meet in one task. A prefix whose rows are all
   one text needs no further splitting: its smallest key is a plain aggregate, combined
   before its shuffle, so copies beyond a block never meet in one task.
3. Each range inserts its whole texts into a trie and traverses it: rows above the smallest
   key of their terminal are duplicates. Texts are dropped here; a row is its key and mask.
4. Masks are joined with the labels by key and reduced to counts per part and mask; the
   orders are evaluated on at most 32 masks a part, never on documents.

Words: runs of characters other than space and the five ASCII line and tab characters,
case-sensitive. Null reads as an empty text; a null part is the empty string. A null key is larger than
any other and has no labels; rows that repeat key and text are counted each, and none of
them makes the other a duplicate. Labels that disagree on one key count as 1. Texts of any
length are judged and compared whole. An empty table gives no rows. Callers' columns may
have any name.
"""

from __future__ import annotations

import math
from collections.abc import Iterator
from itertools import permutations

import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from statweave.llm.base import text_bytes
from statweave.plans.staging import stage_table

FILTERS = "ABCDE"
DUPLICATE = 16  # the bit of filter E
BLOCK_BYTES = 16 << 20
FIRST_PREFIX = 16
RANGES = 64  # at least
ROW_BYTES = 64  # what a row counts for beside its text
_UPPER = b"ABCDEFGHIJKLMNOPQRSTUVWXYZ"
_MARKS = b"#$%&*|"


def text_mask(text: bytes) -> int:
    """Bits 1, 2, 4, 8: too few words, too few different words, too many capitals, a markup character."""
    words = text.split()
    capitals = len(text) - len(text.translate(None, _UPPER))
    points = len(text.decode("utf-8", "replace"))
    return (
        (len(words) < 50)
        | (100 * len(set(words)) < 65 * len(words)) << 1
        | (100 * capitals > 5 * points) << 2
        | (len(text.translate(None, _MARKS)) < len(text)) << 3
    )


def _common(a: bytes, b: bytes) -> int:
    """Length of the common prefix, by halving."""
    low, high = 0, min(len(a), len(b))
    while low < high:
        middle = (low + high + 1) // 2
        if a[low:middle] == b[low:middle]:
            low = middle
        else:
            high = middle - 1
    return low


class Node:
    """An edge's bytes, the branches below it by their first byte, and the rows that end here."""

    __slots__ = ("edge", "below", "rows", "least")

    def __init__(self, edge: bytes):
        self.edge, self.below, self.rows, self.least = edge, {}, None, None


class RadixTrie:
    """Whole texts; every terminal holds its rows and the smallest key among them (null is largest)."""

    def __init__(self):
        self.root = Node(b"")

    def insert(self, text: bytes, key, row: int) -> None:
        node, at = self.root, 0
        while at < len(text):
            child = node.below.get(text[at])
            if child is None:
                child = node.below[text[at]] = Node(text[at:])
            elif not text.startswith(child.edge, at):
                same = _common(child.edge, text[at : at + len(child.edge)])
                upper = node.below[text[at]] = Node(child.edge[:same])
                child.edge = child.edge[same:]
                upper.below[child.edge[0]] = child
                child = upper
            node, at = child, at + len(child.edge)
        if node.rows is None:
            node.rows, node.least = [row], key
        else:
            node.rows.append(row)
            if key is not None and (node.least is None or key < node.least):
                node.least = key

    def terminals(self) -> Iterator[Node]:
        stack = [self.root]
        while stack:
            node = stack.pop()
            if node.rows is not None:
                yield node
            stack.extend(node.below.values())


def equal_texts(texts: list[bytes], keys: list) -> Iterator[tuple[list[int], list[int]]]:
    """For each different text the rows with its smallest key, and the others."""
    trie = RadixTrie()
    for row, (text, key) in enumerate(zip(texts, keys)):
        trie.insert(text, key, row)
    for node in trie.terminals():
        least = [r for r in node.rows if keys[r] == node.least]
        yield least, [r for r in node.rows if keys[r] != node.least] if len(least) < len(node.rows) else []


def masked_texts(docs: DataFrame, key: str, text: str, part: str) -> DataFrame:
    """Staged (_key, _part, _mask, _n, _bytes, _prefix, _text).

    _text and its first bytes _prefix are null where the row's duplicate bit is settled.
    """
    source = docs.select(
        F.col(key).alias("_key"),
        F.coalesce(F.col(part).cast("string"), F.lit("")).alias("_part"),
        F.coalesce(text_bytes(F.col(text).cast("string")), F.lit(b"")).alias("_text"),
    )
    kinds = {f.name: f.dataType.simpleString() for f in source.schema}
    schema = f"_key {kinds['_key']}, _part string, _mask int, _n bigint, _bytes bigint, _prefix binary, _text binary"

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            keys, parts, texts = (batch.column(i).to_pylist() for i in range(3))
            kept, masks, many, sent = [], [], [], []
            for least, others in equal_texts(texts, keys):
                mask, by_part = text_mask(texts[least[0]]), {}
                for r in least:  # equal key and text: one row per part passes the text on
                    by_part.setdefault(parts[r], []).append(r)
                kept += [rows[0] for rows in by_part.values()] + others
                masks += [mask] * len(by_part) + [mask | DUPLICATE] * len(others)
                many += [len(rows) for rows in by_part.values()] + [1] * len(others)
                sent += [texts[least[0]]] * len(by_part) + [None] * len(others)
            at = pa.array(kept, pa.int64())
            columns = [batch.column(0).take(at), batch.column(1).take(at), pa.array(masks, pa.int32()), pa.array(many, pa.int64())]
            columns.append(pa.array([None if t is None else len(t) for t in sent], pa.int64()))
            columns.append(pa.array([None if t is None else t[:FIRST_PREFIX] for t in sent], pa.binary()))
            columns.append(pa.array(sent, pa.binary()))
            yield pa.RecordBatch.from_arrays(columns, names="_key _part _mask _n _bytes _prefix _text".split())

    return stage_table(source.mapInArrow(run, schema))


def adaptive_prefix(texts: DataFrame, block_bytes: int) -> DataFrame:
    """``texts`` with _prefix as long as its block needs, and _single: all rows of the prefix are one text.

    One aggregation per length over the prefixes, and a second one over the rows of heavy
    ones. Heavy prefixes are at most the table's bytes / ``block_bytes``; they are broadcast.
    """
    length, marked = FIRST_PREFIX, texts.withColumn("_single", F.lit(False))
    while True:
        size = F.sum(F.col("_bytes") + ROW_BYTES)
        heavy = stage_table(marked.where("NOT _single").groupBy("_prefix").agg(size.alias("s")).where(F.col("s") > block_bytes).select("_prefix"))
        if heavy.isEmpty():
            return marked
        below = marked.where("NOT _single").join(F.broadcast(heavy), "_prefix")
        judged = stage_table(below.groupBy("_prefix").agg((F.min("_text") == F.max("_text")).alias("_one")))
        length *= 4
        longer = F.when(~F.col("_one"), F.substring("_text", 1, length)).otherwise(F.col("_prefix"))
        marked = marked.join(F.broadcast(judged), "_prefix", "left").withColumns(
            {"_prefix": longer, "_single": F.col("_single") | F.coalesce("_one", F.lit(False))}
        ).drop("_one")
        if judged.where("NOT _one").isEmpty():
            return marked


def settled(rows: DataFrame, block_bytes: int = BLOCK_BYTES) -> DataFrame:
    """(_key, _part, _mask, _n) of all rows of ``masked_texts``, with the duplicate bit."""
    names = ["_key", "_part", "_mask", "_n"]
    texts = rows.where(F.col("_text").isNotNull())
    size = texts.agg(F.sum(F.col("_bytes") + ROW_BYTES)).first()[0] or 0
    block_bytes = min(block_bytes, max(size // RANGES, 1))
    schema = rows.select(*names).schema

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held = [batch for batch in batches if batch.num_rows]
        if not held:
            return
        table = pa.Table.from_batches(held)
        mask = table.column("_mask").to_pylist()
        for _, others in equal_texts(table.column("_text").to_pylist(), table.column("_key").to_pylist()):
            for r in others:
                mask[r] |= DUPLICATE
        columns = [table.column("_key"), table.column("_part"), pa.array(mask, pa.int32()), table.column("_n")]
        yield from pa.table(columns, names=names).to_batches()

    prefixed = adaptive_prefix(texts, block_bytes)
    ranged = prefixed.where("NOT _single").repartitionByRange(max(1, math.ceil(size / block_bytes)), "_prefix")
    place = lambda key: F.struct(key.isNull(), key)
    single = prefixed.where("_single").drop("_text")
    least = single.groupBy("_prefix").agg(F.min(place(F.col("_key"))).alias("_least"))  # one row per heavy single text
    copies = single.join(F.broadcast(least), "_prefix").select(
        "_key", "_part", F.col("_mask").bitwiseOR(F.when(place(F.col("_key")) > F.col("_least"), DUPLICATE).otherwise(0)).alias("_mask"), "_n"
    )
    tries = ranged.select(*names, "_text").mapInArrow(run, schema)
    return tries.unionByName(copies).unionByName(rows.where(F.col("_text").isNull()).select(*names))


def mask_counts(
    docs: DataFrame,
    labels: DataFrame,
    key: str = "doc_id",
    text: str = "text",
    part: str = "source",
    quality: str = "quality",
    toxic: str = "toxic",
    block_bytes: int = BLOCK_BYTES,
) -> DataFrame:
    """(part, mask, n, good, toxic): documents of each part by the set of filters they fail."""
    rows = settled(masked_texts(docs, key, text, part), block_bytes)
    known = labels.where(F.col(key).isNotNull()).groupBy(F.col(key).alias("_key")).agg(
        F.max(F.coalesce(F.col(quality) == 1, F.lit(False))).cast("bigint").alias("_good"),
        F.max(F.coalesce(F.col(toxic) == 1, F.lit(False))).cast("bigint").alias("_toxic"),
    )
    joined = rows.join(known, "_key", "left")
    return joined.groupBy(F.col("_part").alias("part"), F.col("_mask").alias("mask")).agg(
        F.sum("_n").alias("n"),
        F.sum(F.coalesce(F.col("_good") * F.col("_n"), F.lit(0))).alias("good"),
        F.sum(F.coalesce(F.col("_toxic") * F.col("_n"), F.lit(0))).alias("toxic"),
    )


def orders() -> list[tuple[str, int, int, int]]:
    """(order, step, bit of the step's filter, bits of the filters before it) of all orders."""
    rows = []
    for letters in permutations(FILTERS):
        before = 0
        for step, letter in enumerate(letters, 1):
            own = 1 << FILTERS.index(letter)
            rows.append(("".join(letters), step, own, before))
            before |= own
    return rows


def order_report(counts: DataFrame) -> DataFrame:
    """One row per part, order and step from ``mask_counts``."""
    spark = counts.sparkSession
    by_part = counts.groupBy("part").agg(F.collect_list(F.struct("mask", "n", "good", "toxic")).alias("_masks"))  # 32 at most

    def total(name: str, holds) -> F.Column:
        return F.aggregate(
            "_masks", F.lit(0).cast("bigint"), lambda acc, m: acc + F.when(holds(m["mask"]), m[name]).otherwise(F.lit(0).cast("bigint"))
        )

    has = lambda bits: lambda mask: mask.bitwiseAND(bits) != 0
    own, before = F.col("_step.own"), F.col("_step.before")
    removed = lambda mask: has(own)(mask) & ~has(before)(mask)
    # a document is removed by its first failed filter: each of its k filters comes first in 120 / k orders
    every = len(list(permutations(FILTERS)))
    shapley = F.aggregate(
        "_masks",
        F.lit(0).cast("bigint"),
        lambda acc, m: acc
        + F.when(has(own)(m["mask"]), (m["n"] * every / F.bit_count(m["mask"])).cast("bigint")).otherwise(F.lit(0).cast("bigint")),
    )
    plan = F.array(
        *[
            F.struct(F.lit(o).alias("order"), F.lit(s).alias("step"), F.lit(f).alias("own"), F.lit(b).alias("before"))
            for o, s, f, b in orders()
        ]
    )
    return by_part.select("part", "_masks", F.explode(plan).alias("_step")).select(
        "part",
        F.col("_step.order").alias("filter_order"),
        F.col("_step.step").alias("step"),
        total("n", lambda mask: mask.bitwiseAND(own.bitwiseOR(before)) == 0).alias("kept"),
        total("n", removed).alias("removed"),
        total("n", lambda mask: has(own)(mask) & has(before)(mask)).alias("redundant"),
        total("n", lambda mask: mask == own).alias("unique_fails"),
        total("good", removed).alias("good_lost"),
        total("toxic", removed).alias("toxic_lost"),
        shapley.alias("shapley"),
    )


def audit(docs: DataFrame, labels: DataFrame, **options) -> DataFrame:
    """Counts of every part, order of the filters and step; see ``mask_counts`` for the options."""
    return order_report(stage_table(mask_counts(docs, labels, **options)))


def duplicate_flags(docs: DataFrame, key: str = "doc_id", text: str = "text", block_bytes: int = BLOCK_BYTES) -> DataFrame:
    """(key, duplicate, n): whether a smaller key has the same text; ``n`` rows that repeat key and text."""
    rows = masked_texts(docs.withColumn("_none", F.lit("")), key, text, "_none")
    return settled(rows, block_bytes).select(
        F.col("_key").alias(key), (F.col("_mask") >= DUPLICATE).alias("duplicate"), F.col("_n").alias("n")
    )
