"""Benchmark decontamination with suffix arrays over the training text.

Every Arrow chunk of documents is a shard with a suffix array of its own over word
numbers. Words get the numbers of the benchmark's vocabulary; any other word is a break.
Only suffixes that begin a run of vocabulary words as long as the shortest window are
sorted, which leaves every possible match in. Every suffix of every benchmark item is
then binary-searched: the range of suffixes that begin with its window gives all verbatim
occurrences and their places, the neighbours of its place in the order the longest match.

The benchmark is read in blocks of at most ``BLOCK_WORDS`` words (a longer item is a block
of its own); a block is broadcast, and with several blocks each is matched to all rows, its
hits are written before the next block is read, and all hits are united per row. Documents are not shuffled for one block.

Words: runs of ASCII letters and digits and of all non-ASCII characters, A-Z lowered. A
window is ``size`` consecutive words of an item; an item with fewer words, but not none, is
one window. Null or empty text has no words, no hits, and stays. Repeated rows are judged
alike. Without benchmark rows nothing is hit. Equal item ids count once; items with a null
id hit like others and count as one item, which the digest of ids leaves out.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from statweave.llm.base import Renamed, chunks, shared, text_bytes

SIZE = 10
BLOCK_WORDS = 1_000_000
_WORD = set(b"abcdefghijklmnopqrstuvwxyz0123456789") | set(range(128, 256))
_FOLD = bytes((b + 32 if 65 <= b <= 90 else b) if (b + 32 if 65 <= b <= 90 else b) in _WORD else 32 for b in range(256))


def words_of(text: bytes | None) -> list[bytes]:
    return text.translate(_FOLD).split() if text else []


class BenchmarkBlock:
    """Items of one block: vocabulary, word numbers, suffixes and windows."""

    def __init__(self, items: list[tuple[str | None, list[bytes]]], size: int):
        self.names = [name for name, _ in items]
        self.vocabulary = {w: i + 1 for i, w in enumerate(dict.fromkeys(w for _, ws in items for w in ws))}
        lengths = np.array([len(ws) for _, ws in items], np.int64)
        self.tokens = np.array([self.vocabulary[w] for _, ws in items for w in ws], np.int32)
        owner = np.repeat(np.arange(len(items)), lengths)
        ends = np.cumsum(lengths)
        left = ends[owner] - np.arange(len(owner))  # words from here to the item's end
        self.owner, self.left = owner, left
        short = lengths[owner] < size
        is_start = np.where(short, left == lengths[owner], left >= size)
        self.window_at = np.flatnonzero(is_start)
        self.window_length = np.minimum(size, lengths[owner[self.window_at]])
        self.shortest = int(self.window_length.min()) if len(self.window_length) else size


def suffix_array(tokens: np.ndarray, places: np.ndarray, run: np.ndarray) -> np.ndarray:
    """``places`` in the order of the suffixes of ``tokens`` that begin there.

    A suffix ends at the next break (token 0); ``run`` is its length. Ranks of prefixes of
    length 1, 2, 4 … are refined until all differ or no suffix is longer; equal suffixes
    keep the order of their places.
    """
    rank = np.zeros(len(tokens) + 1, np.int64)
    rank[: len(tokens)] = tokens
    inner = np.flatnonzero(tokens)  # every place inside a run takes part in the ranks
    length, longest = 1, int(run.max()) if len(run) else 0
    while length < longest:
        second = rank[np.minimum(inner + length, len(tokens))]
        second = np.where(run[inner] > length, second, 0)
        key = rank[inner] * (rank.max() + 1) + second  # the first ranks are word numbers, maybe above len(tokens)
        values, new = np.unique(key, return_inverse=True)
        fresh = np.zeros_like(rank)
        fresh[inner] = new + 1
        rank, length = fresh, 2 * length
        if len(values) == len(inner):
            break
    return places[np.lexsort((places, rank[places]))]


def _compare(tokens, run, places, query, starts, limits):
    """Sign of suffix minus query over at most ``limits`` words, and the common length."""
    same = np.zeros(len(places), np.int64)
    sign = np.zeros(len(places), np.int64)
    open_ = np.arange(len(places))
    while len(open_):
        at = same[open_]
        done = at >= limits[open_]
        open_ = open_[~done]
        at = at[~done]
        ended = run[places[open_]] <= at
        mine = np.where(ended, 0, tokens[np.minimum(places[open_] + at, len(tokens) - 1)])
        theirs = query[starts[open_] + at]
        equal = mine == theirs
        sign[open_[~equal]] = np.sign(mine[~equal].astype(np.int64) - theirs[~equal])
        open_ = open_[equal]
        same[open_] += 1
    return sign, same


def _bound(tokens, run, array, query, starts, limits, right: bool) -> np.ndarray:
    """Binary search: first place in ``array`` not below (or above, ``right``) each query."""
    low, high = np.zeros(len(starts), np.int64), np.full(len(starts), len(array), np.int64)
    while True:
        live = np.flatnonzero(low < high)
        if not len(live):
            return low
        middle = (low[live] + high[live]) // 2
        sign, _ = _compare(tokens, run, array[middle], query, starts[live], limits[live])
        below = sign <= 0 if right else sign < 0
        low[live] = np.where(below, middle + 1, low[live])
        high[live] = np.where(below, high[live], middle)


class Shard:
    """Word numbers of some documents, one after the other with a break between them."""

    def __init__(self, texts: list[list[bytes]], block: BenchmarkBlock):
        get = block.vocabulary.get
        self.sizes = np.fromiter(map(len, texts), np.int64, len(texts))
        flat: list[int] = []
        for ws in texts:
            flat.extend(get(w, 0) for w in ws)
            flat.append(0)
        self.tokens = np.array(flat, np.int32)
        self.first = np.cumsum(self.sizes + 1) - (self.sizes + 1)
        breaks = np.where(self.tokens == 0, np.arange(len(self.tokens)), len(self.tokens))
        after = np.minimum.accumulate(breaks[::-1])[::-1]
        self.run = after - np.arange(len(self.tokens))
        # only runs that can hold a window are kept; shorter ones become breaks
        begins = (self.tokens != 0) & np.concatenate([[True], self.tokens[:-1] == 0])
        whole = np.zeros(len(self.tokens), np.int64)
        whole[begins] = self.run[begins]
        group = np.cumsum(begins)
        size = np.concatenate([[0], whole[begins]])[group]
        self.tokens = np.where(size >= block.shortest, self.tokens, 0)
        self.run = np.where(self.tokens != 0, self.run, 0)
        places = np.flatnonzero(self.run >= block.shortest)
        self.array = suffix_array(self.tokens, places, self.run)

    def document(self, places: np.ndarray) -> np.ndarray:
        return np.searchsorted(self.first, places, side="right") - 1

    def occurrences(self, block: BenchmarkBlock) -> tuple[np.ndarray, np.ndarray]:
        """(place, window) of every verbatim occurrence of every window."""
        starts, limits = block.window_at, block.window_length
        low = _bound(self.tokens, self.run, self.array, block.tokens, starts, limits, False)
        high = _bound(self.tokens, self.run, self.array, block.tokens, starts, limits, True)
        count = high - low
        window = np.repeat(np.arange(len(starts)), count)
        offset = np.arange(len(window)) - np.repeat(np.cumsum(count) - count, count)
        return self.array[low[window] + offset], window

    def longest(self, block: BenchmarkBlock) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        """For every benchmark suffix the longest match: its place, start in the block and length."""
        starts = np.arange(len(block.tokens))
        if not len(self.array):
            return starts[:0], starts[:0], starts[:0]
        at = _bound(self.tokens, self.run, self.array, block.tokens, starts, block.left, False)
        best, place = np.zeros(len(starts), np.int64), np.zeros(len(starts), np.int64)
        for neighbour in (at - 1, at):
            there = self.array[np.clip(neighbour, 0, len(self.array) - 1)]
            _, same = _compare(self.tokens, self.run, there, block.tokens, starts, block.left)
            better = same > best
            best, place = np.where(better, same, best), np.where(better, there, place)
        found = np.flatnonzero(best > 0)
        return place[found], starts[found], best[found]


def benchmark_blocks(
    benchmark: DataFrame, size: int, key: str, text: str, block_words: int
) -> Iterator[BenchmarkBlock]:
    """Blocks of bounded size, read one after the other; items without words are left out."""
    items, words = [], 0
    named = benchmark.select(F.col(key).cast("string").alias("k"), text_bytes(F.col(text)).alias("t"))
    for row in named.where("t IS NOT NULL").toLocalIterator():
        own = words_of(bytes(row.t))
        if not own:
            continue
        if items and words + len(own) > block_words:
            yield BenchmarkBlock(items, size)
            items, words = [], 0
        items.append((row.k, own))
        words += len(own)
    yield BenchmarkBlock(items, size)


def _hits(docs: DataFrame, block: BenchmarkBlock) -> DataFrame:
    """Columns of ``docs`` without ``_text``, with _n_words, _hit (runs start, end) and _items."""
    sent = shared(docs, block)
    others = [F.col(c) for c in docs.columns if c != "_text"]
    zero = F.lit(0).cast("bigint")
    schema = docs.select(
        *others,
        zero.alias("_n_words"),
        F.array(zero).alias("_from"),
        F.array(zero).alias("_to"),
        F.array(F.lit(None).cast("string")).alias("_items"),
    ).schema
    arrow = [pa.int64(), pa.list_(pa.int64()), pa.list_(pa.int64()), pa.list_(pa.string())]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        block = sent()
        for batch in batches:
            values = batch.column(batch.num_columns - 1).to_pylist()
            rows = [[], [], [], []]
            for first, last in chunks(values):
                shard = Shard([words_of(v) for v in values[first:last]], block)
                froms, tos, items = [[[] for _ in range(last - first)] for _ in range(3)]
                place, window = shard.occurrences(block)
                if len(place):
                    step = np.zeros(len(shard.tokens) + 1, np.int64)
                    np.add.at(step, place, 1)
                    np.add.at(step, place + block.window_length[window], -1)
                    covered = np.concatenate([[0], (np.cumsum(step[:-1]) > 0).astype(np.int8), [0]])
                    edge = np.diff(covered)
                    begin, end = np.flatnonzero(edge == 1), np.flatnonzero(edge == -1)
                    for d, b, e in zip(shard.document(begin).tolist(), begin.tolist(), end.tolist()):
                        froms[d].append(b - int(shard.first[d]))
                        tos[d].append(e - int(shard.first[d]))
                    pairs = np.unique(shard.document(place) * len(block.names) + block.owner[block.window_at[window]])
                    for d, i in zip((pairs // len(block.names)).tolist(), (pairs % len(block.names)).tolist()):
                        items[d].append(block.names[i])
                for column, part in zip(rows, (shard.sizes.tolist(), froms, tos, items)):
                    column.extend(part)
            columns = [batch.column(i) for i in range(batch.num_columns - 1)]
            columns += [pa.array(c, t) for c, t in zip(rows, arrow)]
            yield pa.RecordBatch.from_arrays(columns, names=[f.name for f in schema])

    return docs.mapInArrow(run, schema)


def _digest(items: set[str]) -> str:
    return hashlib.sha256(",".join(sorted(items)).encode()).hexdigest()


def contamination(
    docs: DataFrame,
    benchmark: DataFrame,
    text: str = "text",
    item_key: str = "item_id",
    item_text: str = "text",
    size: int = SIZE,
    block_words: int = BLOCK_WORDS,
) -> DataFrame:
    """``docs`` without ``text``, with ``_n_words``, ``_n_hit`` and ``_items`` (sorted ids)."""
    others = [c for c in docs.columns if c != text]
    source = docs.select(*others, text_bytes(F.col(text)).alias("_text"))
    blocks = benchmark_blocks(benchmark, size, item_key, item_text, block_words)
    block, following = next(blocks), next(blocks, None)
    if following is None:
        found = _hits(source, block)
        n_hit = F.aggregate(
            F.zip_with("_from", "_to", lambda a, b: b - a), F.lit(0).cast("bigint"), lambda acc, x: acc + x
        )
        return found.select(
            *others, "_n_words", n_hit.alias("_n_hit"), F.array_sort(F.array_distinct("_items")).alias("_items")
        )
    # several blocks: rows get a number, the runs of all blocks are united per row
    from statweave.plans.staging import stage_table

    numbered = stage_table(source.withColumn("_row", F.monotonically_increasing_id()))
    parts = []
    while block is not None:
        parts.append(stage_table(_hits(numbered.select("_row", "_text"), block)))
        block, following = following, next(blocks, None)
    merged = parts[0]
    for part in parts[1:]:
        merged = merged.unionByName(part)
    runs = merged.groupBy("_row").agg(
        F.max("_n_words").alias("_n_words"),
        F.array_sort(F.flatten(F.collect_list(F.arrays_zip("_from", "_to")))).alias("_runs"),
        F.array_sort(F.array_distinct(F.flatten(F.collect_list("_items")))).alias("_items"),
    )
    united = F.aggregate(
        "_runs",
        F.struct(F.lit(0).cast("bigint").alias("end"), F.lit(0).cast("bigint").alias("n")),
        lambda acc, r: F.struct(
            F.greatest(acc["end"], r["_to"]).alias("end"),
            (acc["n"] + F.greatest(F.lit(0), r["_to"] - F.greatest(acc["end"], r["_from"]))).alias("n"),
        ),
        lambda acc: acc["n"],
    )
    return numbered.drop("_text").join(runs, "_row").select(*others, "_n_words", united.alias("_n_hit"), "_items")


def contamination_report(docs: DataFrame, benchmark: DataFrame, key: str = "doc_id", **options) -> DataFrame:
    found = contamination(docs.select(key, options.get("text", "text")), benchmark, **options)
    return found.select(
        key,
        F.col("_n_words").alias("n_words"),
        F.col("_n_hit").alias("n_hit"),
        F.size("_items").cast("bigint").alias("n_items"),
        F.sha2(F.concat_ws(",", "_items"), 256).alias("items_sha256"),
        (F.col("_n_hit") > 0).alias("contaminated"),
    )


def decontaminate(docs: DataFrame, benchmark: DataFrame, text: str = "text", **options) -> DataFrame:
    """The rows without any window of the benchmark, with their own columns."""
    own = Renamed(docs)
    kept = contamination(own.df.withColumn("_judged", F.col(own.name(text))), benchmark, "_judged", **options)
    return own.back(kept.where("_n_hit = 0"))


def longest_matches(
    docs: DataFrame,
    benchmark: DataFrame,
    key: str = "doc_id",
    text: str = "text",
    item_key: str = "item_id",
    item_text: str = "text",
    size: int = SIZE,
    block_words: int = BLOCK_WORDS,
) -> DataFrame:
    """Per benchmark suffix the longest verbatim match of at least ``size`` words over all shards.

    Columns: item, item_start, length, and ``doc`` and ``doc_start`` (in words) of one place;
    ties take the smallest document and start.
    """
    source = docs.select(F.col(key).alias("doc"), text_bytes(F.col(text)).alias("_text"))
    doc_type = source.schema["doc"].dataType.simpleString()
    parts = []
    for block in benchmark_blocks(benchmark, size, item_key, item_text, block_words):
        sent = shared(docs, block)

        def run(batches: Iterator[pa.RecordBatch], sent=sent) -> Iterator[pa.RecordBatch]:
            block = sent()
            begin = np.flatnonzero(np.diff(block.owner, prepend=-1)) if len(block.owner) else block.owner
            for batch in batches:
                values = batch.column(1).to_pylist()
                for first, last in chunks(values):
                    shard = Shard([words_of(v) for v in values[first:last]], block)
                    place, start, length = shard.longest(block)
                    long = length >= size
                    place, start, length = place[long], start[long], length[long]
                    d = shard.document(place)
                    yield pa.RecordBatch.from_arrays(
                        [
                            batch.column(0).take(pa.array(d + first)),
                            pa.array([block.names[i] for i in block.owner[start]], pa.string()),
                            pa.array(start - begin[block.owner[start]], pa.int64()),
                            pa.array(length, pa.int64()),
                            pa.array(place - shard.first[d], pa.int64()),
                        ],
                        names=["doc", "item", "item_start", "length", "doc_start"],
                    )

        parts.append(source.mapInArrow(run, f"doc {doc_type}, item string, item_start bigint, length bigint, doc_start bigint"))
    found = parts[0]
    for part in parts[1:]:
        found = found.unionByName(part)
    best = F.min(F.struct((-F.col("length")).alias("l"), "doc", "doc_start")).alias("b")
    return found.groupBy("item", "item_start").agg(best).select(
        "item", "item_start", (-F.col("b.l")).alias("length"), "b.doc", "b.doc_start"
    )
