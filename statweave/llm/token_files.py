"""Token-id files with Re-Pair grammar compression per shard and random-access decoding.

Documents are range-partitioned and sorted by key; a partition's task encodes them one
after the other and writes shards of about ``SHARD_TOKENS`` ids (whole documents). In a
shard, rounds of Re-Pair replace the most frequent pairs of ids by new symbols; a round
takes every pair that occurs at least ``1 / SHRINK`` times as often as the most frequent one,
and rounds go on until no pair occurs ``MIN_PAIRS`` times. (A rule costs two symbols and its
length, so rarer pairs make a shard larger: 1.19, 1.13, 1.19, 1.27 and 1.38 bytes an id
at 2, 4, 8, 16 and 32, without a grammar 2.) Pairs never cross a document's end.

File format (Parquet, one row per shard): ``part`` and ``shard`` (order of the shards),
``keys`` and ``sizes`` (documents and their numbers of ids), ``first`` (position of the
shard's first id in its part), ``base`` (symbols from here on are rules), ``rules`` (left and
right symbol of each rule), ``lengths`` (ids that each rule expands to) and ``symbols``; the
last three are packed to ``width`` bits a symbol and ``length_width`` bits a length, lowest bit first.

Null text is empty: its document has the end id only. Null keys come first; rows with
equal keys are ordered by a hash of their text. An empty table gives no shards.
"""

from __future__ import annotations

import zlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from statweave.llm.base import block_count, chunks, text_bytes
from statweave.llm.tokens import process_encoder
from statweave.plans.staging import stage_table

SHARD_TOKENS = 1 << 19
MIN_PAIRS, SHRINK = 4, 8
BIN_BITS = 19


def repair(ids: np.ndarray, sizes: np.ndarray, min_pairs: int = MIN_PAIRS) -> tuple[np.ndarray, np.ndarray, np.ndarray, int]:
    """(symbols, rules, lengths, base) of the ids of documents with the given sizes."""
    symbols = ids.astype(np.uint32)
    base = int(ids.max()) + 1 if len(ids) else 1
    ends = np.zeros(len(ids), bool)
    ends[np.cumsum(sizes)[np.asarray(sizes) > 0] - 1] = True
    rules, count, least = [], 0, None
    while len(symbols) > 1:
        left, right = symbols[:-1], symbols[1:]
        bins = ((left * np.uint32(0x9E3779B1) + right * np.uint32(0x85EBCA77)) >> np.uint32(32 - BIN_BITS)).astype(np.intp)
        np.putmask(bins, ends[:-1], 1 << BIN_BITS)  # pairs that cross a document's end
        amount = np.bincount(bins, minlength=(1 << BIN_BITS) + 1)  # no pair occurs more often than its bin
        amount[1 << BIN_BITS] = 0
        top = int(amount.max()) // SHRINK
        least = max(min_pairs, top if least is None else min(top, least))
        place = np.flatnonzero((amount >= least).take(bins))
        order, ranked, width = _ranked(left.take(place), right.take(place), base + count)
        start = np.flatnonzero(np.concatenate([np.ones(min(len(place), 1), bool), ranked[1:] != ranked[:-1]]))
        times = np.diff(start, append=len(place))
        often = times >= least
        which = np.full(len(place), -1)
        which[order[np.repeat(often, times)]] = np.repeat(np.arange(np.count_nonzero(often)), times[often])
        found = ranked[start[often]]
        hit = np.flatnonzero(which >= 0)
        place, which = place.take(hit), which.take(hit)
        # of neighbouring candidates every second one is taken, from the left
        head = np.flatnonzero(np.diff(place, prepend=-2) != 1)
        run = np.repeat(head, np.diff(head, append=len(place)))
        taken = (np.arange(len(place)) - run) % 2 == 0
        used = np.bincount(which[taken], minlength=len(found))
        taken &= used[which] >= 2
        chosen = np.flatnonzero(used >= 2)
        if not len(chosen):
            if least <= min_pairs:
                break
            least = max(min_pairs, least // SHRINK)
            continue
        number = np.zeros(len(found), np.int64)
        number[chosen] = np.arange(len(chosen))
        at = place[taken]
        symbols[at] = (base + count + number[which[taken]]).astype(np.uint32)
        keep = np.ones(len(symbols), bool)
        keep[at + 1] = False
        ends[at] = ends[at + 1]
        symbols, ends = symbols[keep], ends[keep]
        rules.append(np.column_stack([(found[chosen] >> width).astype(np.uint32), (found[chosen] & ((np.uint64(1) << width) - np.uint64(1))).astype(np.uint32)]))
        count += len(chosen)
    table = np.concatenate(rules) if rules else np.zeros((0, 2), np.uint32)
    lengths = np.ones(len(table), np.uint32)
    done = 0
    for part in rules:  # a rule uses symbols of earlier rounds only
        span = slice(done, done + len(part))
        lengths[span] = _lengths(part[:, 0], lengths, base) + _lengths(part[:, 1], lengths, base)
        done += len(part)
    return symbols, table, lengths, base


def _ranked(left: np.ndarray, right: np.ndarray, top: int) -> tuple[np.ndarray, np.ndarray, np.uint64]:
    """(order, pairs in it, bits of a pair's right half) of symbols up to ``top``; equal pairs in any order.

    Pairs that leave room for their place in 64 bits are sorted with it, which is faster than ``argsort``.
    """
    bits, room = top.bit_length(), len(left).bit_length()
    width = np.uint64(bits if 2 * bits + room <= 64 else 32)
    pair = left.astype(np.uint64) << width | right
    if width == 32:
        order = np.argsort(pair)
        return order, pair.take(order), width
    pair = pair << np.uint64(room) | np.arange(len(pair), dtype=np.uint64)
    pair.sort()
    return (pair & np.uint64((1 << room) - 1)).astype(np.intp), pair >> np.uint64(room), width


def _lengths(symbols: np.ndarray, lengths: np.ndarray, base: int) -> np.ndarray:
    ruled = symbols >= base
    result = np.ones(len(symbols), np.uint32)
    result[ruled] = lengths[symbols[ruled].astype(np.int64) - base]
    return result


def expand(symbols: np.ndarray, rules: np.ndarray, base: int) -> np.ndarray:
    """The ids that a row of symbols stands for."""
    out = symbols
    while (ruled := out >= base).any():
        width = np.where(ruled, 2, 1)
        at = np.cumsum(width) - width
        wide = np.empty(int(width.sum()), np.uint32)
        wide[at] = out
        pair = rules[out[ruled].astype(np.int64) - base]
        wide[at[ruled]], wide[at[ruled] + 1] = pair[:, 0], pair[:, 1]
        out = wide
    return out


def bit_width(values: np.ndarray) -> int:
    return max(1, int(values.max()).bit_length() if values.size else 1)


def pack_bits(values: np.ndarray, width: int) -> bytes:
    """``width`` bits of each number, lowest first, one number after the other."""
    bits = np.unpackbits(values.astype("<u4").reshape(-1, 1).view(np.uint8), axis=1, bitorder="little")[:, :width]
    return np.packbits(bits, bitorder="little").tobytes()


def unpack_bits(data: bytes, width: int, count: int) -> np.ndarray:
    groups = -(-count // 8)  # eight numbers fill ``width`` bytes
    padded = data + bytes(groups * width - len(data) + 40)
    out = np.empty((groups, 8), np.uint32)
    for i in range(8):
        windows = np.ndarray(groups, "<u8", padded, i * width >> 3, (width,))
        out[:, i] = windows >> np.uint64(i * width & 7) & np.uint64((1 << width) - 1)
    return out.reshape(-1)[:count]


class ShardReader:
    """Random access to one shard's ids."""

    def __init__(self, symbols: bytes, rules: bytes, lengths: bytes, base: int):
        self.symbols = np.frombuffer(symbols, "<u4")
        self.rules = np.frombuffer(rules, "<u4").reshape(-1, 2)
        self.lengths, self.base = np.frombuffer(lengths, "<u4"), base
        self.ends = np.cumsum(_lengths(self.symbols, self.lengths, base).astype(np.int64))

    def read(self, start: int, stop: int) -> np.ndarray:
        """Ids ``start`` to ``stop`` of the shard; only the symbols over them are expanded."""
        if stop <= start:
            return np.zeros(0, np.uint32)
        first = int(np.searchsorted(self.ends, start, side="right"))
        last = int(np.searchsorted(self.ends, stop, side="left"))
        before = int(self.ends[first - 1]) if first else 0
        return expand(self.symbols[first : last + 1], self.rules, self.base)[start - before : stop - before]

    def all(self) -> np.ndarray:
        """Every id: the rules are expanded once, then copied to where they stand."""
        widths = _lengths(self.symbols, self.lengths, self.base).astype(np.int64)
        names = np.arange(self.base, self.base + len(self.rules), dtype=np.uint32)
        table = np.concatenate([expand(names, self.rules, self.base), self.symbols])
        rule_start = np.cumsum(self.lengths.astype(np.int64)) - self.lengths
        offset = int(self.lengths.sum()) + np.arange(len(self.symbols))
        ruled = self.symbols >= self.base
        offset[ruled] = rule_start[self.symbols[ruled].astype(np.int64) - self.base]
        at = np.repeat(offset - (np.cumsum(widths) - widths), widths) + np.arange(int(widths.sum()))
        return table[at]


def _reader(row: dict) -> ShardReader:
    """The reader of a shard's row."""
    symbols = unpack_bits(row["symbols"], row["width"], row["n_symbols"])
    rules = unpack_bits(row["rules"], row["width"], 2 * row["n_rules"])
    lengths = unpack_bits(row["lengths"], row["length_width"], row["n_rules"])
    return ShardReader(symbols.tobytes(), rules.tobytes(), lengths.tobytes(), row["base"])


def write_shards(
    docs: DataFrame, path: str, key: str = "doc_id", text: str = "text", end: int = 1, shard_tokens: int = SHARD_TOKENS
) -> DataFrame:
    """Encode and write all rows; ``path`` is the tokenizer's file. Returns the shards as read back."""
    key_type = docs.schema[key].dataType
    source = docs.select(F.col(key).alias("key"), text_bytes(F.col(text)).alias("bytes"))
    parts = block_count(source, "bytes", 32 << 20)
    tie = F.xxhash64("bytes")
    ordered = source.withColumn("tie", tie).repartitionByRange(parts, "key", "tie").sortWithinPartitions("key", "tie")
    schema = T.StructType(
        [
            T.StructField("part", T.IntegerType()),
            T.StructField("shard", T.IntegerType()),
            T.StructField("keys", T.ArrayType(key_type)),
            T.StructField("sizes", T.ArrayType(T.LongType())),
            T.StructField("first", T.LongType()),
            T.StructField("base", T.LongType()),
            T.StructField("width", T.IntegerType()),
            T.StructField("length_width", T.IntegerType()),
            T.StructField("n_symbols", T.LongType()),
            T.StructField("n_rules", T.LongType()),
            T.StructField("rules", T.BinaryType()),
            T.StructField("lengths", T.BinaryType()),
            T.StructField("symbols", T.BinaryType()),
        ]
    )

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        part, encoder = TaskContext.get().partitionId(), process_encoder(path)
        shard = position = 0
        held: list[tuple[pa.Array, np.ndarray, np.ndarray]] = []

        def flush() -> pa.RecordBatch:
            nonlocal shard, position
            keys = pa.concat_arrays([k for k, _, _ in held])
            ids, sizes = np.concatenate([i for _, i, _ in held]), np.concatenate([s for _, _, s in held])
            symbols, rules, lengths, base = repair(ids, sizes)
            width = max(bit_width(symbols), bit_width(rules))
            packed = pack_bits(rules, width), pack_bits(lengths, bit_width(lengths)), pack_bits(symbols, width)
            row = [
                pa.array([part], pa.int32()),
                pa.array([shard], pa.int32()),
                pa.ListArray.from_arrays(pa.array([0, len(keys)], pa.int32()), keys),
                pa.array([sizes.tolist()], pa.list_(pa.int64())),
                pa.array([position], pa.int64()),
                pa.array([base], pa.int64()),
                *[pa.array([n], pa.int32()) for n in (width, bit_width(lengths))],
                *[pa.array([len(a)], pa.int64()) for a in (symbols, rules)],
                *[pa.array([data], pa.binary()) for data in packed],
            ]
            shard, position = shard + 1, position + len(ids)
            held.clear()
            return pa.RecordBatch.from_arrays(row, names=schema.fieldNames())

        for batch in batches:
            texts = [v or b"" for v in batch.column("bytes").to_pylist()]
            for first, last in chunks(texts, 4 * shard_tokens):  # in many texts at once fewer words are looked up
                ids, sizes = encoder.encode(texts[first:last], end)
                ends, done = np.cumsum(sizes), 0
                while done < len(sizes):  # a shard ends with the document that fills it
                    begin = int(ends[done] - sizes[done])
                    room = shard_tokens - sum(len(i) for _, i, _ in held)
                    stop = min(len(sizes), int(np.searchsorted(ends, begin + room)) + 1)
                    held.append((batch.column("key").slice(first + done, stop - done), ids[begin : ends[stop - 1]], sizes[done:stop]))
                    done = stop
                    if sum(len(i) for _, i, _ in held) >= shard_tokens:
                        yield flush()
        if held:
            yield flush()

    return stage_table(ordered.select("key", "bytes").mapInArrow(run, schema))


def read_documents(shards: DataFrame) -> DataFrame:
    """key, start, n_tokens and ids_crc32 of every document, decoded from the shards."""
    key_type = shards.schema["keys"].dataType.elementType
    schema = T.StructType(
        [
            T.StructField("part", T.IntegerType()),
            T.StructField("key", key_type),
            T.StructField("at", T.LongType()),
            T.StructField("n_tokens", T.LongType()),
            T.StructField("ids_crc32", T.LongType()),
        ]
    )

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for i in range(batch.num_rows):
                row = {n: batch.column(n)[i] for n in batch.schema.names}
                reader = _reader({n: row[n].as_py() for n in ("base", "width", "length_width", "n_symbols", "n_rules", "symbols", "rules", "lengths")})
                data = memoryview(reader.all().astype("<u4").tobytes())
                sizes = np.array(row["sizes"].as_py(), np.int64)
                ends = np.cumsum(sizes)
                sums = [zlib.crc32(data[4 * (e - s) : 4 * e]) for s, e in zip(sizes.tolist(), ends.tolist())]
                yield pa.RecordBatch.from_arrays(
                    [
                        pa.array([row["part"].as_py()] * len(sizes), pa.int32()),
                        row["keys"].values,
                        pa.array(row["first"].as_py() + ends - sizes, pa.int64()),
                        pa.array(sizes, pa.int64()),
                        pa.array(sums, pa.int64()),
                    ],
                    names=schema.fieldNames(),
                )

    decoded = shards.mapInArrow(run, schema)
    sizes = F.aggregate("sizes", F.lit(0).cast("bigint"), lambda acc, x: acc + x)
    totals = shards.select("part", sizes.alias("n")).groupBy("part").agg(F.sum("n").alias("n"))
    # one row per part: a part is a task's worth of text, so this is a list of tasks
    before = Window.orderBy("part").rowsBetween(Window.unboundedPreceding, -1)
    offsets = totals.select("part", F.coalesce(F.sum("n").over(before), F.lit(0)).alias("before"))
    return decoded.join(offsets, "part").select(
        "key", (F.col("before") + F.col("at")).alias("start"), "n_tokens", "ids_crc32"
    )
