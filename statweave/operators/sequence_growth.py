"""Sequential patterns by level-wise growth over blocks of sequences.

The places of an item in a sequence are a bitmap of ``WORD`` places a number. A block holds the
items and bitmaps of up to ``BLOCK`` sequences; a level sends every block through the frequent
patterns of the level before, ``CHUNK`` of them a row and ``PASS`` rows at a time. A task finds
where a pattern's last itemset can match in all sequences of its block at once and counts the
sequences in which it grows by one frequent item,

* as a new itemset: the item's places after the pattern's first place, or
* into the last itemset, for items above its last: the places that both share,

so each pattern is reached in one way only and each sequence counts once. Only counts per block,
pattern and item are shuffled: a pattern's occurrences are never rows. Patterns and results are
tables; a task holds one block and one row of patterns, whatever the support, and no
projected database is gathered in a task or on the driver.

Null sequences and itemsets are empty; null items are left out; an item that repeats in an
itemset counts once. Every row counts for the support, also an empty one. No rows give no
patterns.
"""

from __future__ import annotations

import math
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from statweave.plans.prefix_sum import row_index
from statweave.plans.staging import broadcast_if_small, stage_table

BLOCK, BLOCKS = 1024, 32  # sequences a block, blocks a task
CHUNK, PASS = 2048, 4  # patterns a row, rows at a time

WORD = 62  # places a bigint; its two highest bits stay free, so no step overflows


def item_places(sequences: DataFrame, column: str = "sequence") -> DataFrame:
    """Staged ``_sid, _item, _bits``: where each item occurs in each sequence."""
    numbered = stage_table(sequences.select(F.monotonically_increasing_id().alias("_sid"), F.col(column).alias("_sequence")))
    places = numbered.select("_sid", F.size("_sequence").alias("_size"), F.posexplode("_sequence").alias("_at", "_set"))
    items = places.select("_sid", "_size", "_at", F.explode("_set").alias("_item")).where(F.col("_item").isNotNull())
    bit = F.expr(f"shiftleft(1L, cast(_at % {WORD} AS int))")
    words = items.groupBy("_sid", "_size", "_item", F.floor(F.col("_at") / WORD).cast("int").alias("_word")).agg(F.bit_or(bit).alias("_value"))
    held = words.groupBy("_sid", "_size", "_item").agg(F.map_from_entries(F.collect_list(F.struct("_word", "_value"))).alias("_map"))
    every = F.sequence(F.lit(0), F.floor((F.col("_size") - 1) / WORD).cast("int"))
    bits = F.transform(every, lambda w: F.coalesce(F.try_element_at("_map", w), F.lit(0).cast("bigint")))
    return stage_table(held.select("_sid", "_item", bits.alias("_bits")))


def _later(bits: np.ndarray) -> np.ndarray:
    """All places after the first one of each row; none after none."""
    given = bits != 0
    first = given.argmax(axis=1)
    rows = np.arange(len(bits))
    word = bits[rows, first]
    after = np.where(np.arange(bits.shape[1]) > first[:, None], np.int64(-1), np.int64(0))
    after[rows, first] = ~(word ^ (word - 1))
    after[~given.any(axis=1)] = 0
    return after


def _occurrences(entries: pa.StructArray) -> tuple[np.ndarray, np.ndarray, np.ndarray, int]:
    """(sequence within the block, item code, bitmaps as a matrix) in the order of the codes, and the number of sequences."""
    known, sequence = np.unique(entries.field("_sid").to_numpy(zero_copy_only=False), return_inverse=True)
    code = entries.field("_code").to_numpy(zero_copy_only=False)
    length = entries.field("_bits").value_lengths().to_numpy(zero_copy_only=False)
    words = entries.field("_bits").flatten().to_numpy(zero_copy_only=False)
    bits = np.zeros((len(code), length.max()), np.int64)
    row = np.repeat(np.arange(len(code)), length)
    bits[row, np.arange(len(words)) - np.repeat(np.cumsum(length) - length, length)] = words
    order = np.argsort(code, kind="stable")
    return sequence[order], code[order], bits[order], len(known)


def _grown(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """``_id, _code, _wide, _n``: in how many sequences of the block each pattern grows by each item."""
    for batch in batches:
        for at in range(batch.num_rows):
            sequence, code, bits, size = _occurrences(batch.column("_entries").slice(at, 1).flatten())
            codes, local = np.unique(code, return_inverse=True)

            def own(item: int) -> np.ndarray:
                """Places of one item in every sequence."""
                held = slice(*np.searchsorted(code, [item, item + 1]))
                places = np.zeros((size, bits.shape[1]), np.int64)
                places[sequence[held]] = bits[held]
                return places

            ids, items, wide, counts = [], [], [], []
            walked, stack = [], []
            for entry in batch.column("_patterns")[at].as_py():
                way = [(item, place > 0) for element in entry["_steps"] for place, item in enumerate(element)]
                same = 0
                while same < min(len(way), len(walked)) and way[same] == walked[same]:
                    same += 1
                del stack[same:]
                for item, within in way[same:]:
                    places = own(item)
                    if stack:
                        places &= stack[-1] if within else _later(stack[-1])
                    stack.append(places)
                walked, found = way, stack[-1]
                for widening, allowed in ((False, _later(found)), (True, found)):
                    first = np.searchsorted(code, way[-1][0] + 1) if widening else 0
                    hit = (bits[first:] & allowed[sequence[first:]]).any(axis=1)
                    number = np.bincount(local[first:][hit], minlength=len(codes))
                    some = np.flatnonzero(number)
                    ids.append(np.full(len(some), entry["_id"]))
                    items.append(codes[some])
                    wide.append(np.full(len(some), widening))
                    counts.append(number[some])
            columns = [pa.array(np.concatenate(c)) for c in (ids, items, wide, counts)]
            yield pa.RecordBatch.from_arrays(columns, names=["_id", "_code", "_wide", "_n"])


def _blocks(items: DataFrame, sequences: int) -> DataFrame:
    """Staged ``_entries``: the rows ``_sid, _code, _bits`` of up to ``BLOCK`` sequences a row."""
    packed = items.groupBy(F.floor(F.col("_sid") / BLOCK).alias("_block")).agg(F.collect_list(F.struct("_sid", "_code", "_bits")).alias("_entries"))
    slots = items.sparkSession.sparkContext.defaultParallelism
    return stage_table(packed.select("_entries").repartition(max(slots, math.ceil(sequences / BLOCK / BLOCKS))))


def _counts(blocks: DataFrame, patterns: DataFrame, number: int, least: int) -> DataFrame:
    """``_id, _code, _wide, freq`` of the patterns that stay frequent when they grow by the item."""
    rows = patterns.groupBy(F.floor(F.col("_id") / CHUNK).alias("_chunk")).agg(
        F.array_sort(F.collect_list(F.struct("_id", "_steps"))).alias("_patterns")
    )
    found = None
    for first in range(0, math.ceil(number / CHUNK), PASS):
        some = F.broadcast(rows.where(F.col("_chunk").between(first, first + PASS - 1)).select("_patterns"))
        partial = blocks.crossJoin(some).mapInArrow(_grown, "_id bigint, _code bigint, _wide boolean, _n bigint")
        sums = partial.groupBy("_id", "_code", "_wide").agg(F.sum("_n").alias("freq")).where(F.col("freq") >= least)
        part = stage_table(sums)
        found = part if found is None else found.unionByName(part)
    return found


def grow_patterns(sequences: DataFrame, min_support: float = 0.5, max_length: int = 5, column: str = "sequence") -> DataFrame:
    """``sequence ARRAY<ARRAY>, freq``: subsequences of at most ``max_length`` items in ``min_support`` of all rows."""
    size = sequences.count()
    least = math.ceil(min_support * size)
    places = item_places(sequences, column)
    frequent = places.groupBy("_item").agg(F.count("*").alias("freq")).where(F.col("freq") >= least)
    coded = stage_table(row_index(frequent, "_item", "_code"))  # codes in the order of the items
    names = broadcast_if_small(coded.select("_item", "_code"))
    blocks = None
    level = stage_table(coded.select(F.array(F.array("_item")).alias("_pattern"), F.array(F.array("_code")).alias("_steps"), "freq"))
    results = level
    for _ in range(2, max_length + 1):
        number = level.count()
        if number == 0:
            break
        if blocks is None:
            blocks = _blocks(places.join(names, "_item").select("_sid", "_code", "_bits"), size)
        patterns = stage_table(row_index(level.select("_pattern", "_steps"), "_steps", "_id"))
        grown = _counts(blocks, patterns, number, least).join(patterns, "_id").join(names, "_code")

        def ways(prefix: str, item: str):
            head, last = F.slice(prefix, 1, F.size(prefix) - 1), F.element_at(prefix, -1)
            widened = F.concat(head, F.array(F.concat(last, F.array(item))))
            return F.when(F.col("_wide"), widened).otherwise(F.concat(prefix, F.array(F.array(item))))

        level = stage_table(grown.select(ways("_pattern", "_item").alias("_pattern"), ways("_steps", "_code").alias("_steps"), "freq"))
        results = results.unionByName(level)
    return results.select(F.col("_pattern").alias("sequence"), "freq")
