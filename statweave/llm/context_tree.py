"""Context-tree weighting: a language model over bytes, and a word-count base beside it.

A symbol (a byte, or the end of the text) is a path of binary decisions: first whether the
text ends, then the byte's bits. Every decision is predicted in every context of the last
0 … ``DEPTH`` bytes by a Krichevsky–Trofimov estimate over the training counts; the contexts
of all depths are mixed with the weights of context-tree weighting, so each node's share
follows from how well it codes the training texts. The mixture is a proper distribution:
a context or symbol never seen in training falls back to shorter contexts.

How it runs. Texts are dealt into blocks of about 16 MB by a hash. A block's task counts
its grams (symbol with its ``DEPTH`` bytes before) and words, and writes them as packed
arrays, one per shard of the gram and word space. A shard's task sums the blocks' arrays:
shards of the gram space hold whole subtrees (equal last two bytes), so all nodes of depth
two and more are computed there; the at most 65,280 nodes of depth one and the 255 of
depth zero are summed up for the driver and sent out again. Then each shard answers every
block with the code lengths and counts for exactly what that block sent, and the block's
task adds them up over its texts. Nothing is capped or sampled, and what is gathered grows
with the corpus: distinct grams and words, never rows. A shard's task holds one entry per
block and distinct key; the number of shards follows the number of blocks.

Text: A-Z lowered; null reads as empty. An empty text is its end alone. Words are runs of
characters other than space and the five ASCII line and tab characters, and one end per
text. Repeated rows count as often as they occur (rows
equal in every column that is kept share a block). Without training rows every decision is
even and no word is known. An empty table gives no rows.
"""

from __future__ import annotations

import math
from collections import Counter
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import xxhash
import zstandard
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from statweave.llm.base import Renamed, WordTable, ascii_lower, block_count, chunks, mix, per_text, shared, text_bytes
from statweave.plans.staging import stage_table

DEPTH = 5
END = 256  # the symbol after the last byte
END_WORD = b" "  # no word is white space
HALF = math.log(2)

# ---- grams of a block: symbol in the low nine bits, then the bytes before it, the last one first


def grams(texts: list[bytes]) -> tuple[np.ndarray, np.ndarray]:
    """The grams of all texts one after the other, and their number per text (bytes + 1)."""
    pad = b"\0" * DEPTH
    sizes = np.fromiter((len(t) + 1 for t in texts), np.int64, len(texts))
    data = np.frombuffer(b"".join(pad + t + b"\0" for t in texts), np.uint8).astype(np.int64)
    ends = np.cumsum(sizes + DEPTH) - 1
    at = np.repeat(ends + 1 - sizes - (np.cumsum(sizes) - sizes), sizes) + np.arange(int(sizes.sum()))
    key = data[at]
    key[np.cumsum(sizes) - 1] = END
    for back in range(1, DEPTH + 1):
        key |= data[at - back] << (1 + 8 * back)
    return key, sizes


def shard_of_grams(key: np.ndarray, shards: int) -> np.ndarray:
    return (mix(((key >> 9) & 0xFFFF).astype(np.uint64)) % np.uint64(shards)).astype(np.int64)


def shard_of_words(words: list[bytes], shards: int) -> np.ndarray:
    return np.fromiter((xxhash.xxh3_64_intdigest(w) % shards for w in words), np.int64, len(words))


def counted(texts: list[bytes], held_out: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Distinct grams of a block in rising order and how often training texts have them."""
    keys, times = np.zeros(0, np.int64), np.zeros(0, np.int64)
    for first, last in chunks(texts):
        key, sizes = grams(texts[first:last])
        key <<= 1
        key |= np.repeat(held_out[first:last], sizes)
        part, where = np.unique(key, return_counts=True)
        del key
        where = np.where(part & 1, 0, where)
        keys, times = summed([keys, part >> 1], [times, where])
    return keys, times


def summed(keys: list[np.ndarray], times: list[np.ndarray]) -> tuple[np.ndarray, np.ndarray]:
    key, where = np.unique(np.concatenate(keys), return_inverse=True)
    return key, np.bincount(where, weights=np.concatenate(times), minlength=len(key)).astype(np.int64)


# ---- nodes: a context and the decisions taken so far


def _log_gamma(x: np.ndarray) -> np.ndarray:
    """log Γ for x ≥ 0.5, by the recurrence up to 8 and Stirling's series."""
    shift = np.zeros_like(x)
    z = x.copy()
    for _ in range(8):
        low = z < 8
        shift = np.where(low, shift + np.log(np.where(low, z, 1.0)), shift)
        z = np.where(low, z + 1, z)
    inverse = 1 / z
    series = inverse / 12 - inverse**3 / 360 + inverse**5 / 1260 - inverse**7 / 1680
    return (z - 0.5) * np.log(z) - z + 0.5 * math.log(2 * math.pi) + series - shift


def log_kt(zeros: np.ndarray, ones: np.ndarray) -> np.ndarray:
    """Natural log of the Krichevsky–Trofimov probability of that many zeros and ones."""
    gamma = _log_gamma(zeros + 0.5) + _log_gamma(ones + 0.5) - _log_gamma(zeros + ones + 1.0)
    return gamma - math.log(math.pi)


def decisions(symbol: np.ndarray) -> Iterator[tuple[np.ndarray, np.ndarray, np.ndarray]]:
    """For each of the nine steps: which symbols take it, their node (0 … 255) and the bit."""
    byte = symbol < END
    yield np.arange(len(symbol)), np.zeros(len(symbol), np.int64), (~byte).astype(np.int64)
    rows = np.flatnonzero(byte)
    own = symbol[rows]
    for bit in range(8):
        yield rows, (1 << bit) | (own >> (8 - bit)), (own >> (7 - bit)) & 1


class Subtree:
    """All nodes of depth ``top`` … DEPTH over some distinct grams."""

    def __init__(self, key: np.ndarray, times: np.ndarray, top: int = 2):
        self.key, self.top = key, top
        steps = list(decisions(key & 511))
        self.gram = np.concatenate([rows for rows, _, _ in steps])
        node = np.concatenate([n for _, n, _ in steps])
        self.bit = np.concatenate([b for _, _, b in steps])
        context = (key >> 9)[self.gram]
        weight = times[self.gram].astype(np.float64)
        # deepest nodes first; each level's nodes point to the level above
        self.levels: list[dict] = []
        name, index = np.unique(context << 8 | node, return_inverse=True)
        self.index = index
        ones = np.bincount(index, weights=weight * self.bit, minlength=len(name))
        every = np.bincount(index, weights=weight, minlength=len(name))
        level = {"name": name, "ones": ones, "zeros": every - ones}
        level["log"] = log_kt(level["zeros"], level["ones"])
        self.levels.append(level)
        for depth in range(DEPTH - 1, top - 1, -1):
            below = self.levels[-1]
            shorter = (below["name"] >> 8) & ((1 << 8 * depth) - 1)
            name, up = np.unique(shorter << 8 | (below["name"] & 255), return_inverse=True)
            below["up"] = up
            sums = {c: np.bincount(up, weights=below[c], minlength=len(name)) for c in ("ones", "zeros", "log")}
            self.levels.append(weighted({"name": name, "ones": sums["ones"], "zeros": sums["zeros"]}, sums["log"]))

    def log_probability(self, outer) -> np.ndarray:
        """Natural log probability of each gram's symbol in its context; ``outer`` mixes in the top."""
        place, chain = np.arange(len(self.levels[0]["name"])), []
        for level in self.levels:
            chain.append(place)
            place = level["up"][place] if "up" in level else place
        deepest = self.levels[0]
        p = (deepest["ones"] + 0.5) / (deepest["ones"] + deepest["zeros"] + 1)
        for level, at in list(zip(self.levels, chain))[1:]:
            p = mixed(level, at, p)
        p = outer(self.levels[-1]["name"][chain[-1]], p)
        step = np.log(np.where(self.bit == 1, p[self.index], 1 - p[self.index]))
        return np.bincount(self.gram, weights=step, minlength=len(self.key))


def weighted(level: dict, below: np.ndarray) -> dict:
    """Log of half the node's own estimate plus half its children's product; the own part's share."""
    own = log_kt(level["zeros"], level["ones"])
    level["log"] = np.logaddexp(own, below) - HALF
    level["stay"] = np.exp(own - HALF - level["log"])
    return level


def mixed(level: dict, at: np.ndarray, deeper: np.ndarray) -> np.ndarray:
    own = (level["ones"] + 0.5) / (level["ones"] + level["zeros"] + 1)
    return level["stay"][at] * own[at] + (1 - level["stay"][at]) * deeper


class Top:
    """Nodes of depth one (last byte) and depth zero, from sums over the depth-two nodes."""

    def __init__(self, name: np.ndarray, ones: np.ndarray, zeros: np.ndarray, below: np.ndarray):
        order = np.argsort(name)
        self.one = weighted({"name": name[order], "ones": ones[order], "zeros": zeros[order]}, below[order])
        node, up = np.unique(self.one["name"] & 255, return_inverse=True)
        self.up = up
        sums = [np.bincount(up, weights=self.one[c], minlength=len(node)) for c in ("ones", "zeros", "log")]
        self.zero = weighted({"name": node, "ones": sums[0], "zeros": sums[1]}, sums[2])

    def __call__(self, name: np.ndarray, deeper: np.ndarray) -> np.ndarray:
        """``name`` are depth-two nodes."""
        at = np.searchsorted(self.one["name"], ((name >> 8) & 255) << 8 | (name & 255))
        return mixed(self.zero, self.up[at], mixed(self.one, at, deeper))


def top_sums(tree: Subtree) -> tuple[np.ndarray, ...]:
    level = tree.levels[-1]
    name, up = np.unique(((level["name"] >> 8) & 255) << 8 | (level["name"] & 255), return_inverse=True)
    return name, *[np.bincount(up, weights=level[c], minlength=len(name)) for c in ("ones", "zeros", "log")]


# ---- the distributed steps

PARTS = "block bigint, shard bigint, kind string, keys binary, times binary"


def squeeze(values: np.ndarray) -> bytes:
    """Eight-byte numbers, rising ones as their steps, with equal bytes side by side, compressed."""
    whole = values.dtype.kind == "i"
    steps = np.diff(values, prepend=0) if whole else values
    return zstandard.compress((b"i" if whole else b"f") + steps.astype("<i8" if whole else "<f8").view(np.uint8).reshape(-1, 8).T.tobytes(), 1)


def unsqueeze(data: bytes) -> np.ndarray:
    raw = zstandard.decompress(data)
    columns = np.frombuffer(raw, np.uint8, offset=1).reshape(8, -1)
    values = np.ascontiguousarray(columns.T).reshape(-1)
    return np.cumsum(values.view("<i8")) if raw[:1] == b"i" else values.view("<f8")


def _pack(kind: str, block: int, shard: np.ndarray, keys, times: np.ndarray) -> Iterator[dict]:
    order = np.argsort(shard, kind="stable")
    cut = np.flatnonzero(np.diff(shard[order], prepend=-1))
    for a, b in zip(cut, [*cut[1:], len(order)]):
        own = order[a:b]
        data = squeeze(keys[own]) if kind == "gram" else zstandard.compress(b"\n".join(keys[i] for i in own), 1)
        yield {"block": block, "shard": int(shard[own[0]]), "kind": kind, "keys": data, "times": squeeze(times[own])}


def _words(data: bytes) -> list[bytes]:
    return zstandard.decompress(data).split(b"\n")


def _table(rows, fields: list[tuple[str, pa.DataType]]) -> pa.Table:
    return pa.Table.from_pylist(list(rows), schema=pa.schema(fields))


_PART_FIELDS = [("block", pa.int64()), ("shard", pa.int64()), ("kind", pa.string()), ("keys", pa.binary()), ("times", pa.binary())]
_ANSWER_FIELDS = [("block", pa.int64()), ("kind", pa.string()), ("keys", pa.binary()), ("values", pa.binary())]


def _block_parts(shards: int):
    def run(table: pa.Table) -> pa.Table:
        block = table.column("block")[0].as_py()
        texts = table.column("lower").to_pylist()
        held = table.column("held_out").to_numpy(zero_copy_only=False).astype(bool)
        keys, times = counted(texts, held)
        rows = list(_pack("gram", block, shard_of_grams(keys, shards), keys, times))
        words: Counter = Counter()
        for text, out in zip(texts, held.tolist()):
            words.update(dict.fromkeys(text.split(), 0) if out else Counter(text.split()))
            words[END_WORD] += not out
        names = list(words)
        many = np.fromiter(words.values(), np.int64, len(names))
        rows.extend(_pack("word", block, shard_of_words(names, shards), names, many))
        return _table(rows, _PART_FIELDS)

    return run


def _sum_tree(table: pa.Table) -> tuple[np.ndarray, np.ndarray]:
    keys, times = (list(map(unsqueeze, table.column(c).to_pylist())) for c in ("keys", "times"))
    return summed(keys, times)


def _tree_top(table: pa.Table) -> pa.Table:
    name, ones, zeros, log = top_sums(Subtree(*_sum_tree(table)))
    return pa.table({"name": name, "ones": ones, "zeros": zeros, "log": log})


def _answers(top):
    """Code lengths of each block's grams."""

    def run(table: pa.Table) -> pa.Table:
        keys, times = _sum_tree(table)
        value = Subtree(keys, times).log_probability(top()) / math.log(10)
        rows = []
        for block, data in zip(table.column("block").to_pylist(), table.column("keys").to_pylist()):
            own = value[np.searchsorted(keys, unsqueeze(data))]
            rows.append({"block": block, "kind": "gram", "keys": data, "values": squeeze(own)})
        return _table(rows, _ANSWER_FIELDS)

    return run


def _word_answers(table: pa.Table) -> pa.Table:
    """Training counts of each block's words; block -1 has the sum and the number of known words."""
    rows = table.select(["block", "keys", "times"]).to_pylist()
    total: dict[bytes, int] = {}
    for row in rows:
        for word, times in zip(_words(row["keys"]), unsqueeze(row["times"]).tolist()):
            total[word] = total.get(word, 0) + times
    answers = [
        {
            "block": row["block"],
            "kind": "word",
            "keys": row["keys"],
            "values": squeeze(np.array([total[w] for w in _words(row["keys"])], np.int64)),
        }
        for row in rows
    ]
    known = np.array([sum(total.values()), sum(1 for v in total.values() if v)], "<i8")
    return _table([*answers, {"block": -1, "kind": "total", "keys": b"", "values": squeeze(known)}], _ANSWER_FIELDS)


class Lookup:
    """Values of sorted 64-bit keys by a two-table hash, searched only where both slots are taken."""

    def __init__(self, keys: np.ndarray, values: np.ndarray):
        order = np.argsort(keys)
        self.keys, self.values = keys[order], values[order]
        self.bits = np.uint64(64 - max(4, int(np.ceil(np.log2(4 * len(keys) + 1)))))
        self.slots = np.zeros((2, 1 << (64 - int(self.bits))), np.int64)
        for table, factor in zip(self.slots, self._factors):
            table[self._slot(self.keys, factor)] = np.arange(len(keys))

    _factors = (np.uint64(0x9E3779B97F4A7C15), np.uint64(0xC2B2AE3D27D4EB4F))

    def _slot(self, keys: np.ndarray, factor: np.uint64) -> np.ndarray:
        return ((keys.astype(np.uint64) * factor) >> self.bits).astype(np.int64)

    def __call__(self, keys: np.ndarray) -> np.ndarray:
        """Every key must be one of the table's."""
        at = self.slots[0][self._slot(keys, self._factors[0])]
        missed = np.flatnonzero(self.keys[at] != keys)
        at[missed] = self.slots[1][self._slot(keys[missed], self._factors[1])]
        missed = missed[self.keys[at[missed]] != keys[missed]]
        at[missed] = np.searchsorted(self.keys, keys[missed])
        return self.values[at]


def _block_scores(schema, others: list[str], train_tokens: int, vocabulary: int):
    base = math.log10(train_tokens + vocabulary + 1) if train_tokens + vocabulary else 0.0

    def run(left: pa.Table, right: pa.Table) -> pa.Table:
        texts = left.column("lower").to_pylist()
        answers = right.select(["kind", "keys", "values"]).to_pylist()
        pairs = [(unsqueeze(r["keys"]), unsqueeze(r["values"])) for r in answers if r["kind"] == "gram"]
        find = Lookup(np.concatenate([k for k, _ in pairs]), np.concatenate([v for _, v in pairs])) if pairs else None
        known: dict[bytes, int] = {}
        for r in answers:
            if r["kind"] == "word":
                known.update(zip(_words(r["keys"]), unsqueeze(r["values"]).tolist()))
        score, tokens, seen, logs = [], [], [], []
        for first, last in chunks(texts):
            key, sizes = grams(texts[first:last])
            score.append(per_text(find(key), sizes))
            table = WordTable(limit=1 << 60)
            numbers, many = table.number([[*t.split(), END_WORD] for t in texts[first:last]])
            times = np.array([known[w] for w in table], np.int64)
            tokens.append(many)
            seen.append(per_text((times > 0).astype(np.int64)[numbers], many))
            logs.append(per_text(np.log10(times + 1.0)[numbers], many) - many * base)
        columns = [left.column(c) for c in others]
        numbers = [np.concatenate(x) if x else np.zeros(0) for x in (tokens, seen, logs, score)]
        return pa.table([*columns, *map(pa.array, numbers)], names=[f.name for f in schema])

    return run


def score_texts(docs: DataFrame, held_out: Column, text: str = "text") -> tuple[DataFrame, int]:
    """``docs`` without ``text``, with _tokens, _known, _base and _score, and the number of training tokens.

    Rows where ``held_out`` is true (not null) are left out of the training counts. Callers'
    columns may have any name but the four of the result.
    """
    kept = [c for c in docs.columns if c != text]
    own = Renamed(docs.withColumn("held_out_", F.coalesce(held_out, F.lit(False))))
    others, docs = [own.name(c) for c in kept], own.df
    lower = F.coalesce(text_bytes(ascii_lower(F.col(own.name(text)).cast("string"))), F.lit(b""))
    source = docs.select(*others, F.col(own.name("held_out_")).alias("held_out_"), lower.alias("lower"))
    blocks = block_count(source, "lower")
    salted = source.withColumn("block", F.pmod(F.xxhash64("lower", *others), F.lit(blocks)))
    inputs = salted.select("block", "lower", F.col("held_out_").alias("held_out"))
    parts = stage_table(inputs.groupBy("block").applyInArrow(_block_parts(min(blocks, 65_536)), PARTS))
    gram_parts, word_parts = (parts.where(F.col("kind") == kind) for kind in ("gram", "word"))
    tops = gram_parts.groupBy("shard").applyInArrow(_tree_top, "name bigint, ones double, zeros double, log double")
    rows = tops.groupBy("name").agg(*[F.sum(c).alias(c) for c in ("ones", "zeros", "log")]).collect()  # ≤ 65,536 nodes
    top = Top(*[np.array([r[c] for r in rows], np.int64 if c == "name" else float) for c in ("name", "ones", "zeros", "log")])
    answer_schema = "block bigint, kind string, keys binary, values binary"
    words = stage_table(word_parts.groupBy("shard").applyInArrow(_word_answers, answer_schema))
    totals = np.zeros(2, np.int64)
    for row in words.where("kind = 'total'").select("values").toLocalIterator():  # two numbers per shard
        totals += unsqueeze(bytes(row[0]))
    answers = gram_parts.groupBy("shard").applyInArrow(_answers(shared(docs, top)), answer_schema).unionByName(words.where("kind = 'word'"))
    zero, real = F.lit(0).cast("bigint"), F.lit(0.0)
    schema = docs.select(
        *others, zero.alias("_tokens"), zero.alias("_known"), real.alias("_base"), real.alias("_score")
    ).schema
    texts = salted.select("block", "lower", *others)
    scored = texts.groupBy("block").cogroup(answers.groupBy("block")).applyInArrow(
        _block_scores(schema, others, int(totals[0]), int(totals[1])), schema
    )
    return scored.toDF(*kept, "_tokens", "_known", "_base", "_score"), int(totals[0])


def score_report(docs: DataFrame, held_out: Column, key: str = "doc_id", text: str = "text") -> DataFrame:
    rows = docs.select(key, text).withColumn("_held", F.coalesce(held_out, F.lit(False)))
    scored, train_tokens = score_texts(rows, F.col("_held"), text)
    return scored.select(
        key,
        F.col("_held").alias("held_out"),
        F.col("_tokens").alias("n_tokens"),
        F.col("_known").alias("n_known"),
        F.lit(train_tokens).cast("bigint").alias("train_tokens"),
        F.col("_base").alias("base_score"),
        F.col("_score").alias("score"),
    )
