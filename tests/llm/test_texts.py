"""Operators over texts against brute force, with nulls, empty and long texts, ties and repeats."""

import collections
import hashlib
import itertools
import math
import re
import zlib

import numpy as np
import public_tokenizers
import pytest
from pyspark import TaskContext
from pyspark.sql import functions as F
from tokenizers import Tokenizer

from oracle_check import compare, duck
from statweave.llm import catalog, context_tree, decontaminate, near_dedup, packing, quality, token_files, tokens, toxicity
from statweave.llm.base import WordTable
from statweave.sources.tables import table

WORD = re.compile(r"[^\x20\x09-\x0D]+")
LOWER = {c: c + 32 for c in range(65, 91)}
DOCS = "doc_id bigint, text string, _score double, _n string, _text string"
BPE = public_tokenizers.path("word_bpe_49k.json")


def frame(spark, texts, ids=None):
    rows = [(i if ids is None else ids[k], t, 0.5, "n", "w") for k, (i, t) in enumerate(enumerate(texts))]
    return spark.createDataFrame(rows, DOCS).repartition(3)


def words(text):
    return WORD.findall((text or "").translate(LOWER))


@pytest.mark.parametrize("name", sorted(catalog.ORACLES))
def test_query_equals_sql(spark, sf, name):
    verdict, _ = compare(spark, duck(sf), sf, catalog.QUERIES[name], catalog.ORACLES[name])
    assert verdict == "ok"


# ---- quality rules


def brute_quality(text):
    own = WORD.findall(text or "")
    where = collections.defaultdict(list)
    for i in range(len(own) - 7):
        where[tuple(own[i : i + 8])].append(i)
    hit = {i + j for places in where.values() if len(places) > 1 for i in places for j in range(8)}
    return len(own), len(hit)


def test_quality_measures_and_cascade(spark):
    good = " ".join(f"word{i}" for i in range(50))
    texts = [good, None, "", "  \n\t ", "a b c d e f g h " * 40, good + "\nline one two\nline one two\n", "# $ % & " * 30, good, "ü " * 25]
    texts.append(" ".join(f"w{i % 5000}" for i in range(30_000)))
    rows = {r.doc_id: r for r in quality.quality_report(frame(spark, texts)).collect()}
    for i, text in enumerate(texts):
        assert (rows[i].n_words, rows[i].n_repeat_words) == brute_quality(text)
    assert rows[0].kept and rows[7].kept and not any(rows[i].kept for i in (1, 2, 3, 4, 6, 8, 9))
    assert rows[5].n_dup_lines == 1 and rows[6].n_symbols == 120 and rows[8].word_chars == 25
    kept = quality.cascade(frame(spark, texts))
    assert kept.columns == DOCS.replace(",", "").split()[::2] and {r.doc_id for r in kept.collect()} >= {0, 7}
    assert quality.cascade(frame(spark, texts).limit(0)).count() == 0


def test_rule_order_is_rejection_per_cost_and_never_changes_verdicts():
    import time

    def slow(texts):
        time.sleep(0.02)
        return np.array([b"x" in t for t in texts])

    rules = (quality.QualityRule("slow", slow), quality.QualityRule("quick", lambda t: np.array([b"y" in x for x in t])))
    texts = [b"x", b"y", b"xy", b"z"]
    assert [r.name for r in quality.rule_order(texts, rules)] == ["quick", "slow"]
    for order in itertools.permutations(rules):
        assert quality.passes(texts, list(order)).tolist() == [False, False, False, True]


# ---- benchmark decontamination

ITEM = re.compile(r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+")


def brute_leaks(texts, items, size=10):
    windows = collections.defaultdict(set)
    for name, text in items:
        own = ITEM.findall((text or "").translate(LOWER))
        for i in range(max(1, len(own) - size + 1)):
            if own:
                windows[tuple(own[i : i + size])].add(str(name))
    result = []
    for text in texts:
        own = ITEM.findall((text or "").translate(LOWER))
        hit, found = set(), set()
        for n in {len(w) for w in windows}:
            for i in range(len(own) - n + 1):
                if names := windows.get(tuple(own[i : i + n])):
                    found |= names
                    hit |= set(range(i, i + n))
        result.append((len(own), len(hit), len(found), hashlib.sha256(",".join(sorted(found)).encode()).hexdigest(), bool(hit)))
    return result


@pytest.mark.parametrize("block_words", [1_000_000, 15])
def test_decontamination(spark, block_words):
    item = " ".join(f"b{i}" for i in range(30))
    items = [(1, item), (2, "Short item here"), (10, item[10:]), (3, None), (4, "--"), (2, "short item here"), (None, "x y")]
    texts = [
        "pre " + item + " post", "only b3 b4 b5 b6 b7 b8 b9 b10 b11 b12 stop", "b3 b4 b5", None, "", "!!",
        "SHORT, item-here; and short item here", "b0 b1 " * 500, item + " " + item, " ".join(f"z{i}" for i in range(20_000)) + " " + item,
    ]
    texts.append(texts[0])
    bench = spark.createDataFrame([(i, t, 1) for i, t in items], "item_id bigint, text string, score int")
    report = decontaminate.contamination_report(frame(spark, texts), bench, block_words=block_words)
    got = {r.doc_id: tuple(r)[1:] for r in report.collect()}
    assert [got[i] for i in range(len(texts))] == brute_leaks(texts, items[:-1])
    kept = decontaminate.decontaminate(frame(spark, texts), bench, block_words=block_words)
    assert kept.columns == frame(spark, texts).columns and {r.doc_id for r in kept.collect()} == {2, 3, 4, 5, 7}
    assert decontaminate.decontaminate(frame(spark, texts), bench.limit(0)).count() == len(texts)
    assert decontaminate.decontaminate(frame(spark, texts).limit(0), bench).count() == 0


@pytest.mark.parametrize("block_words", [1_000_000, 3])
def test_decontamination_by_items_without_an_id(spark, block_words):
    bench = spark.createDataFrame([(None, "x y z"), (None, "p q r"), (4, "m n o")], "item_id bigint, text string")
    df = frame(spark, ["an x y z here", "p q r x y z", "m n o p q r", "nothing"])
    rows = {r.doc_id: r for r in decontaminate.contamination_report(df, bench, block_words=block_words).collect()}
    sha = lambda ids: hashlib.sha256(ids.encode()).hexdigest()
    assert [(rows[i].n_hit, rows[i].n_items, rows[i].items_sha256) for i in range(4)] == [
        (3, 1, sha("")), (6, 1, sha("")), (6, 2, sha("4")), (0, 0, sha("")),
    ]
    assert [r.doc_id for r in decontaminate.decontaminate(df, bench, block_words=block_words).collect()] == [3]


def test_longest_matches(spark):
    item = " ".join(f"b{i}" for i in range(30))
    bench = spark.createDataFrame([(1, item)], "item_id bigint, text string")
    texts = ["x y " + " ".join(item.split()[2:20]), " ".join(item.split()[4:18]), "none"]
    rows = {r.item_start: r for r in decontaminate.longest_matches(frame(spark, texts), bench).collect()}
    assert (rows[2].length, rows[2].doc, rows[2].doc_start) == (18, 0, 2)
    assert (rows[4].length, rows[4].doc, rows[4].doc_start) == (16, 0, 4)
    assert 0 not in rows and 11 not in rows and rows[10].length == 10


def test_suffix_array_is_sorted():
    rng = np.random.default_rng(1)
    for _ in range(20):
        sequence = rng.integers(0, 4, 200).astype(np.int32)
        sequence[-1] = 0
        run = np.zeros(200, np.int64)
        for i in range(198, -1, -1):
            run[i] = run[i + 1] + 1 if sequence[i] else 0
        places = np.flatnonzero(run >= 2)
        array = decontaminate.suffix_array(sequence, places, run)
        suffixes = [tuple(sequence[p : p + run[p]]) for p in array]
        assert suffixes == sorted(suffixes) and sorted(array) == places.tolist()


def test_suffix_array_of_fewer_words_than_the_vocabulary():
    rng = np.random.default_rng(2)
    for _ in range(50):
        sequence = rng.integers(1, 5000, 60).astype(np.int32)
        sequence[rng.integers(0, 60, 3)] = sequence[-1] = 0
        sequence[20:30] = sequence[:10]
        run = np.zeros(60, np.int64)
        for i in range(58, -1, -1):
            run[i] = run[i + 1] + 1 if sequence[i] else 0
        array = decontaminate.suffix_array(sequence, np.flatnonzero(run), run)
        suffixes = [tuple(sequence[p : p + run[p]]) for p in array]
        assert suffixes == sorted(suffixes)


def test_decontamination_of_shards_shorter_than_the_vocabulary(spark):
    rng = np.random.default_rng(3)
    items = [(i, " ".join(f"v{w}" for w in rng.integers(0, 4000, 40))) for i in range(150)]
    texts = []
    for _ in range(60):
        picked = [items[i][1].split()[8:22] for i in rng.integers(0, 150, 3)]
        texts.append(" stop ".join(" ".join(p) for p in picked))
    bench = spark.createDataFrame(items, "item_id bigint, text string")
    report = decontaminate.contamination_report(frame(spark, texts).repartition(30), bench)
    got = {r.doc_id: tuple(r)[1:] for r in report.collect()}
    assert [got[i] for i in range(len(texts))] == brute_leaks(texts, items)


# ---- near duplicates


def brute_classes(texts, k, percent):
    sets = []
    for text in texts:
        own = words(text)
        sets.append({tuple(own[i : i + k]) for i in range(max(1, len(own) - k + 1))} if own else set())
    parent = list(range(len(texts)))

    def find(x):
        while parent[x] != x:
            x = parent[x]
        return x

    for a, b in itertools.combinations(range(len(texts)), 2):
        if sets[a] and sets[b]:
            both = len(sets[a] & sets[b])
            if 100 * both >= percent * (len(sets[a]) + len(sets[b]) - both):
                ra, rb = find(a), find(b)
                parent[max(ra, rb)] = min(ra, rb)
    return [(len(s), find(i)) for i, s in enumerate(sets)]


def edited(rng, base, edits):
    own = list(base)
    for at in rng.integers(0, len(own), edits):
        own[at] = f"e{rng.integers(0, 10**9)}"
    return " ".join(own)


@pytest.mark.parametrize("k,percent,group", [(3, 85, 3_000_000), (5, 80, 400)])
def test_near_duplicates_equal_brute_force(spark, k, percent, group):
    rng = np.random.default_rng(3)
    base = [f"w{i}" for i in range(120)]
    texts = [edited(rng, base, int(e)) for e in rng.integers(0, 12, 60)]
    texts += [" ".join(f"q{rng.integers(0, 10**6)}" for _ in range(60)) for _ in range(20)]
    texts += [texts[3], texts[3].upper(), "a b", "A  B", "a", None, "", " \n", None, "long " * 20_000, "x " + "long " * 20_000]
    got = {r.doc_id: r for r in near_dedup.class_report(frame(spark, texts), words=k, percent=percent, group_shingles=group).collect()}
    want = brute_classes(texts, k, percent)
    assert [(got[i].n_shingles, got[i].component_id) for i in range(len(texts))] == want
    kept = near_dedup.near_dedup(frame(spark, texts), words=k, percent=percent, group_shingles=group)
    assert kept.columns == frame(spark, texts).columns
    assert sorted(r.doc_id for r in kept.collect()) == sorted({c for _, c in want})


def test_near_duplicates_with_repeated_and_null_keys(spark):
    text = "one two three four five six seven"
    df = frame(spark, [text, text, text, "other words are in this text here", None, None], [5, 5, None, None, None, 7])
    kept = near_dedup.near_dedup(df).collect()
    assert sorted((str(r.doc_id), r.text is None) for r in kept) == [("5", False), ("7", True), ("None", False), ("None", True)]
    assert near_dedup.near_dedup(df.limit(0)).count() == 0


def test_a_text_travels_to_python_once_and_is_lowered_there(spark, monkeypatch):
    df = frame(spark, ["One TWO three Ä", "one two THREE Ä", "one two three ä", None]).select("doc_id", "text", F.lit(17).alias("number"))
    monkeypatch.setattr(near_dedup, "stage_table", lambda staged: staged)
    for column, sent in (("text", [*df.columns, "_row"]), ("number", [*df.columns, "_row", "_string"])):
        rows = near_dedup.signed(df, column, 2, near_dedup.SLOTS, near_dedup.BANDS)
        plan = rows._jdf.queryExecution().analyzed().children().head()
        assert [plan.output().apply(i).name() for i in range(plan.output().size())] == sent
    prints = {r.doc_id: r["_fp"] for r in near_dedup.signed(df, "text", 2, near_dedup.SLOTS, near_dedup.BANDS).collect()}
    assert prints[0] == prints[1] != prints[2] and prints[3] is None
    assert {r["_n"] for r in rows.collect()} == {1}


def test_super_minhash_estimates_similarity():
    rng = np.random.default_rng(2)
    for shared in (0, 300, 450, 500):
        pool = rng.integers(0, 2**63, 1000 - shared).astype(np.uint64)
        a, b = np.unique(pool[:500]), np.unique(pool[500 - shared :])
        one, two = near_dedup.super_minhash([a, b], 1024)
        exact = len(np.intersect1d(a, b)) / len(np.union1d(a, b))
        assert abs((one == two).mean() - exact) < 0.05
    long = rng.integers(0, 2**63, 3 * near_dedup.ELEMENTS).astype(np.uint64)
    alone = near_dedup.super_minhash([long])[0]
    assert (alone == near_dedup.super_minhash([long[::-1].copy()])[0]).all()


# ---- toxicity


def toxic_rows(seed=0, count=240):
    rng = np.random.default_rng(seed)
    clean, bad = [f"{a}{b}" for a in ("ta", "lo", "mi", "ne") for b in ("ron", "sel", "dak", "pim", "vor")], "grumblat snerfing plonkish".split()
    texts, labels = [], []
    for i in range(count):
        own = rng.choice(clean, int(rng.integers(20, 120))).tolist()
        labels.append(int(i % 4 == 0))
        if labels[-1]:
            own[int(rng.integers(0, len(own)))] = str(rng.choice(bad))
        texts.append(" ".join(own))
    return texts, labels


def test_toxicity_finds_unseen_spellings_and_short_or_odd_texts(spark):
    texts, labels = toxic_rows()
    table = spark.createDataFrame(list(enumerate(labels)), "doc_id bigint, toxic int")
    model = toxicity.train(frame(spark, texts), table, usable=F.col("doc_id") % 3 != 0)
    fresh, truth = toxic_rows(9, 80)
    fresh += ["milton tasel snerfling " + fresh[1], "", None, fresh[1] * 200, "grumblat"]
    rows = {r.doc_id: r for r in toxicity.scored(frame(spark, fresh).select("doc_id", "text"), model).collect()}
    right = sum((rows[i]._score >= 0.3) == bool(t) for i, t in enumerate(truth))
    assert right >= 76 and rows[84]._score >= 0.3
    assert rows[80]._score > 20 * rows[1]._score
    assert rows[81]._score == rows[82]._score < 0.3 and rows[83]._score < 0.3
    kept = toxicity.remove_toxic(frame(spark, fresh), model)
    assert kept.columns == frame(spark, fresh).columns and {81, 82} <= {r.doc_id for r in kept.collect()}
    assert toxicity.remove_toxic(frame(spark, fresh).limit(0), model).count() == 0


def test_toxicity_is_fitted_in_a_task(spark, monkeypatch):
    texts, labels = toxic_rows(count=60)
    known, fit = spark.createDataFrame(list(enumerate(labels)), "doc_id bigint, toxic int"), toxicity.fit

    def inside(*args, **options):
        assert TaskContext.get() is not None, "the driver holds the texts"
        return fit(*args, **options)

    monkeypatch.setattr(toxicity, "fit", inside)
    assert len(toxicity.train(frame(spark, texts), known).projected) == toxicity.BUCKETS


def test_toxicity_without_both_labels(spark):
    texts, _ = toxic_rows(count=8)
    none = spark.createDataFrame([], "doc_id bigint, toxic int")
    scores = {r._score for r in toxicity.scored(frame(spark, texts).select("doc_id", "text"), toxicity.train(frame(spark, texts), none)).collect()}
    assert len(scores) == 1 and scores.pop() < 0.01


# ---- tokens, shards, packing


def expected_ids(texts):
    tokenizer = Tokenizer.from_file(BPE)
    return [[*e.ids, 1] for e in tokenizer.encode_batch([t or "" for t in texts], add_special_tokens=False)]


ODD = ["Hello  World\n\tit's 42x", None, "", "ÀÉ ñandú e\u0301 'S <|endoftext|> x<|startoftext|>y", "日本 語\u00a0x\u2003y\x1cz", "a" * 5000, "tok " * 3000]


def test_shards_round_trip(spark):
    texts = ODD + [f"doc {i} " * (i % 40) for i in range(200)]
    ids = [None if i == 3 else 1000 - 4 * (i // 2) for i in range(len(texts))]
    shards = token_files.write_shards(frame(spark, texts, ids), BPE, shard_tokens=700)
    assert shards.count() > 3
    rows = token_files.read_documents(shards).collect()
    want = collections.Counter((k, len(e), zlib.crc32(np.array(e, "<u4").tobytes())) for k, e in zip(ids, expected_ids(texts)))
    assert collections.Counter((r.key, r.n_tokens, r.ids_crc32) for r in rows) == want
    rows.sort(key=lambda r: r.start)
    assert [r.start for r in rows] == np.cumsum([0, *[r.n_tokens for r in rows]])[:-1].tolist()
    keys = [-1 if r.key is None else r.key for r in rows]
    assert keys == sorted(keys)
    assert token_files.read_documents(token_files.write_shards(frame(spark, texts).limit(0), BPE)).count() == 0


def test_repair_is_lossless_with_random_access():
    rng = np.random.default_rng(4)
    for low, n in ((2, 5000), (40, 20_000), (1, 3000), (3, 1), (3, 2)):
        ids = rng.integers(0, low, n).astype(np.uint32)
        sizes = np.array([n // 3, 0, n - n // 3])
        symbols, rules, lengths, base = token_files.repair(ids, sizes)
        reader = token_files.ShardReader(symbols.tobytes(), rules.tobytes(), lengths.tobytes(), base)
        assert (reader.all() == ids).all() and len(symbols) <= n
        for start, stop in ((0, n), (n // 3, n), (n // 2, n // 2), (n - 1, n), (n // 5, n // 4)):
            assert (reader.read(start, stop) == ids[start:stop]).all()
        if low == 2:
            assert len(symbols) < n / 3


def brute_padding(lengths, counts, buckets):
    best = math.inf
    for k in range(1, min(buckets, len(lengths)) + 1):
        for cut in itertools.combinations(range(len(lengths) - 1), k - 1):
            ends = [*cut, len(lengths) - 1]
            total, start = 0, 0
            for e in ends:
                total += lengths[e] * sum(counts[start : e + 1])
                start = e + 1
            best = min(best, total)
    return best


def test_bucket_bounds_are_optimal():
    rng = np.random.default_rng(5)
    for _ in range(20):
        lengths = np.unique(rng.integers(1, 60, 9))
        counts = rng.integers(1, 50, len(lengths))
        bounds = packing.optimal_bounds(lengths, counts, 3)
        padded = sum(int(c) * min(b for b in bounds if b >= n) for n, c in zip(lengths, counts))
        assert padded == brute_padding(lengths.tolist(), counts.tolist(), 3)
    assert packing.optimal_bounds(np.zeros(0), np.zeros(0), 4) == []


def test_packing_keeps_every_token_and_the_budget(spark):
    texts = ODD + [f"word{i} " * (i % 90) for i in range(300)] + ["same text"] * 3
    lengths = packing.token_lengths(frame(spark, texts), BPE)
    assert {r.doc_id: r._tokens for r in lengths.collect()} == {i: len(e) for i, e in enumerate(expected_ids(texts))}
    rows = packing.packed(lengths, max_tokens=100, buckets=4, budget=1000).collect()
    spans = collections.defaultdict(list)
    batches = collections.Counter()
    for r in rows:
        spans[r.doc_id].append((r.start, r.length))
        assert 0 < r.length <= r.bucket_length <= 100
        batches[r.bucket_length, r.batch] += r.bucket_length
    assert max(batches.values()) <= 1000
    for i, ids in enumerate(expected_ids(texts)):
        own = sorted(spans[i])
        assert sum(n for _, n in own) == len(ids) and own[0][0] == 0 and all(a + n == b for (a, n), (b, _) in zip(own, own[1:]))
    for bound in {b for b, _ in batches}:
        full = [v for (b, _), v in batches.items() if b == bound]
        assert sum(v < bound * max(1, 1000 // bound) for v in full) <= 1
    assert packing.packed(packing.token_lengths(frame(spark, texts).limit(0), BPE)).count() == 0


def test_word_encoder_forgets_without_changing_ids():
    encoder = tokens.WordEncoder(BPE)
    encoder.words.limit = 3
    for text in ODD:
        ids, _ = encoder.encode([(text or "").encode()], 1)
        assert ids.tolist() == expected_ids([text])[0]


# ---- language model


class PlainTree:
    """Context-tree weighting written out plainly, node by node."""

    def __init__(self, texts, depth=context_tree.DEPTH):
        self.depth, self.count = depth, collections.defaultdict(lambda: [0, 0])
        self.children, self.memo = collections.defaultdict(set), {}
        for text in texts:
            for context, node, bit in self.steps(text):
                for d in range(depth + 1):
                    self.count[context[:d], node][bit] += 1
                    if d:
                        self.children[context[: d - 1], node].add(context[:d])

    def steps(self, text):
        data = b"\0" * self.depth + text
        for i in range(self.depth, len(data) + 1):
            context = tuple(data[i - self.depth : i][::-1])
            yield context, 0, int(i == len(data))
            if i < len(data):
                for bit in range(8):
                    yield context, (1 << bit) | (data[i] >> (8 - bit)), (data[i] >> (7 - bit)) & 1

    def own(self, key):
        a, b = self.count[key]
        return math.lgamma(a + 0.5) + math.lgamma(b + 0.5) - math.lgamma(a + b + 1) - math.log(math.pi)

    def weight(self, key):
        if key not in self.memo:
            context, node = key
            if len(context) == self.depth:
                self.memo[key] = self.own(key)
            else:
                below = sum(self.weight((c, node)) for c in self.children[key])
                self.memo[key] = np.logaddexp(self.own(key), below) - math.log(2)
        return self.memo[key]

    def probability(self, context, node, bit, d=0):
        key = context[:d], node
        a, b = self.count[key] if key in self.count else (0, 0)
        mine = ((b if bit else a) + 0.5) / (a + b + 1)
        if d == self.depth:
            return mine
        stay = math.exp(self.own(key) - math.log(2) - self.weight(key)) if key in self.count else 0.5
        return stay * mine + (1 - stay) * self.probability(context, node, bit, d + 1)

    def score(self, text):
        return sum(math.log10(self.probability(c, n, b)) for c, n, b in self.steps(text))


def test_language_model_equals_the_plain_tree(spark, monkeypatch):
    texts = ["the cat sat on the mat", "The dog sat", None, "", "ünï\x00code the", "zzz new bytes ~~", "the the the " * 40, "the dog sat"]
    held = {1, 5, 3}
    df = frame(spark, texts)
    rows = {r.doc_id: r for r in context_tree.score_report(df, F.col("doc_id").isin(*held)).collect()}
    raw = [(t or "").translate(LOWER) for t in texts]
    tree = PlainTree([t.encode() for i, t in enumerate(raw) if i not in held])
    count = collections.Counter(w for i, t in enumerate(raw) if i not in held for w in [*words(t), None])
    total, distinct = sum(count.values()), len(count)
    for i, text in enumerate(raw):
        own = [*words(text), None]
        assert (rows[i].held_out, rows[i].n_tokens, rows[i].train_tokens) == (i in held, len(own), total)
        assert rows[i].n_known == sum(count[w] > 0 for w in own)
        assert rows[i].base_score == pytest.approx(sum(math.log10((count[w] + 1) / (total + distinct + 1)) for w in own))
        assert rows[i].score == pytest.approx(tree.score(text.encode()), rel=1e-9)
    blocks = context_tree.block_count
    monkeypatch.setattr(context_tree, "block_count", lambda *a: max(5, blocks(*a)))
    again = {r.doc_id: r.score for r in context_tree.score_report(df, F.col("doc_id").isin(*held)).collect()}
    assert all(again[i] == pytest.approx(rows[i].score, rel=1e-9) for i in again)


def test_language_model_is_a_distribution(spark):
    tree = context_tree.Subtree(*context_tree.counted([b"abcabcabd", b"abe"], np.array([False, False])))
    every = np.array([*range(256), context_tree.END], np.int64)
    key = every | (ord("b") << 9) | (ord("a") << 17)
    merged = context_tree.summed([tree.key, key], [np.ones(len(tree.key)), np.zeros(len(key))])
    whole = context_tree.Subtree(*merged)
    top = context_tree.Top(*context_tree.top_sums(whole))
    log = whole.log_probability(top)[np.searchsorted(whole.key, key)]
    assert np.exp(log).sum() == pytest.approx(1)


def test_language_model_edges(spark):
    df = frame(spark, ["abc", "", None])
    unseen = {r.doc_id: r for r in context_tree.score_report(df, F.lit(True)).collect()}
    assert unseen[0].train_tokens == 0 and unseen[0].n_known == 0
    assert unseen[0].score == pytest.approx(-(3 * 9 + 1) * math.log10(2)) and unseen[1].score == unseen[2].score
    assert context_tree.score_report(df.limit(0), F.lit(False)).count() == 0


def test_packed_numbers_round_trip():
    rng = np.random.default_rng(2)
    for width in (1, 7, 16, 17, 32):
        values = rng.integers(0, 2**width, 333, dtype=np.uint64).astype(np.uint32)
        data = token_files.pack_bits(values, width)
        assert len(data) == -(-333 * width // 8) and (token_files.unpack_bits(data, width, 333) == values).all()
    assert len(token_files.unpack_bits(b"", 3, 0)) == 0


def test_encoder_memo_drops_rare_words_only():
    rng = np.random.default_rng(6)
    encoder, fresh = tokens.WordEncoder(BPE, limit=300), tokens.WordEncoder(BPE)
    for _ in range(40):
        texts = [" ".join(f"w{n}," for n in np.concatenate([rng.integers(0, 50, 60), rng.integers(0, 100_000, 20)])).encode() for _ in range(5)]
        got, want = encoder.encode(texts, 1), fresh.encode(texts, 1)
        assert (got[0] == want[0]).all() and (got[1] == want[1]).all()
    assert len(encoder.words) <= 300 + 200 and sum(f"w{n},".encode() in encoder.words for n in range(50)) > 40


def test_shards_are_smaller_than_two_byte_ids(spark, sf):
    shards = token_files.write_shards(table(spark, sf, "documents"), BPE)
    size = shards.agg(F.sum(F.octet_length("symbols") + F.octet_length("rules") + F.octet_length("lengths"))).first()[0]
    assert size < 2 * sum(r.n_tokens for r in token_files.read_documents(shards).collect())


def test_words_are_cut_where_the_tokenizer_cuts():
    rng = np.random.default_rng(12)
    pieces = ["word", "Straße", "ÉTÉ", "naïve", "don't", "'s", "…", "x", "!", "?!", "<|", "|>", "<|endoftext|>", ".", ",", "é", "e\u0301", "ﬁ", "İ", "7", "42.5", "×", "÷", "ñ", "日本", "###", "&&", " ", "\n", "\u00a0", "\x85", "’s", "_a", "-", "(", "\x1c"]
    texts = ["".join(rng.choice(pieces, rng.integers(1, 14))) for _ in range(4000)]
    whole = Tokenizer.from_file(BPE)
    ids, sizes = tokens.WordEncoder(BPE).encode([t.encode() for t in texts], 1)
    at = np.cumsum(sizes) - sizes
    for t, a, n in zip(texts, at.tolist(), sizes.tolist()):
        assert ids[a : a + n].tolist() == [*whole.encode(t, add_special_tokens=False).ids, 1], repr(t)


def test_clashing_column_names(spark):
    rows = [(i, f"word{i % 3} again and again {i}", 1, 2, 3.0, "l") for i in range(12)] + [(50, None, 1, 2, 3.0, None)]
    df = spark.createDataFrame(rows, "doc_id long, text string, block int, _tokens int, _score double, lower string")
    scored, _ = context_tree.score_texts(df.withColumnRenamed("_tokens", "_row").withColumnRenamed("_score", "shard"), F.col("doc_id") % 2 == 0)
    assert scored.columns == ["doc_id", "block", "_row", "shard", "lower", "_tokens", "_known", "_base", "_score"] and scored.count() == 13
    toxic = toxicity.scored(df, toxicity.Model(np.zeros(toxicity.BUCKETS), 0.0))
    assert toxic.columns == ["doc_id", "block", "_tokens", "lower", "_score"] and {r._score for r in toxic.collect()} == {0.5}
    lengths = spark.createDataFrame([(i, 10 * i + 1) for i in range(30)], "length long, piece long")
    out = packing.packed(lengths, key="length", tokens="piece", max_tokens=64)
    assert out.columns[0] == "length" and out.count() == sum(-(-(10 * i + 1) // 64) for i in range(30))


def test_words_are_cut_alike_one_by_one_and_together():
    latin = rb"\xc3[\x80-\x96\x98-\xb6\xb8-\xbf]"
    ending = re.compile(rb"([!-&(-/:-@\[-`{-~])(?:(?<=[A-Za-z].)|(?<=" + latin + rb".))")
    draw = np.random.default_rng(3)
    letters = list("aZ.,'!~ é×÷ÿÀ_9\n@[`{ăß日<|")
    texts = ["".join(draw.choice(letters, draw.integers(0, 14))).encode() for _ in range(4000)]
    expected = [t.split() if b"<|" in t else ending.sub(rb" \1", t).split() for t in texts]
    assert tokens.cut_all(texts) == expected == [tokens.cut(t) for t in texts]
    assert tokens.cut_all([]) == []


@pytest.mark.parametrize("top", [40, 1 << 20, (1 << 32) - 1])
def test_pairs_are_ranked_with_and_without_their_place(top):
    draw = np.random.default_rng(5)
    left, right = (draw.choice(np.array([0, 1, 2, top - 1], np.uint32), 700) for _ in range(2))
    order, ranked, width = token_files._ranked(left, right, top)
    got = [(int(p) >> int(width), int(p) & ((1 << int(width)) - 1)) for p in ranked]
    assert got == sorted(zip(left.tolist(), right.tolist()))
    assert got == list(zip(left[order].tolist(), right[order].tolist())) and sorted(order.tolist()) == list(range(700))
    order, ranked, _ = token_files._ranked(left[:0], right[:0], top)
    assert len(order) == len(ranked) == 0


def test_a_shard_reads_back_whole():
    draw = np.random.default_rng(6)
    ids = np.tile(draw.integers(2, 40, 300), 9).astype(np.uint32)
    for values, sizes in ((ids, [len(ids)]), (ids[:0], []), (np.full(5000, 7, np.uint32), [4000, 1000])):
        symbols, rules, lengths, base = token_files.repair(values, np.array(sizes, np.int64))
        reader = token_files.ShardReader(symbols.astype("<u4").tobytes(), rules.astype("<u4").tobytes(), lengths.astype("<u4").tobytes(), base)
        assert np.array_equal(reader.all(), values)


@pytest.mark.parametrize("width", [1, 2, 7, 8, 9, 17, 25, 31, 32])
def test_packed_numbers_read_back(width):
    for count in (0, 1, 7, 8, 9, 1001):
        values = np.random.default_rng(count).integers(0, 1 << width, count).astype(np.uint32)
        got = token_files.unpack_bits(token_files.pack_bits(values, width), width, count)
        assert got.dtype == np.uint32 and np.array_equal(got, values)


def test_each_distinct_word_of_a_chunk_is_looked_up_once():
    looked = []

    class Counting(WordTable):
        def __getitem__(self, word):
            looked.append(word)
            return super().__getitem__(word)

    texts = [b"to be or not to be", b"", b"be that as it may", b"caf\xc3\xa9, to\tbe"]
    table, plain = Counting(), WordTable()
    words, many = tokens.cut_words(texts)
    numbers = table.number_array(words)
    expected, sizes = plain.number([tokens.cut(t) for t in texts])
    assert numbers.tolist() == expected.tolist() and many.tolist() == sizes.tolist()
    assert table.take_fresh() == plain.take_fresh() and len(looked) == len(set(looked)) == len(plain)
    assert len(table.number_array(tokens.cut_words([])[0])) == 0


def test_a_shard_ends_with_the_document_that_fills_it(spark):
    texts = [f"word{i} " * (1 + i % 9) for i in range(300)]
    shards = collections.defaultdict(list)
    for r in token_files.write_shards(frame(spark, texts), BPE, shard_tokens=100).orderBy("part", "shard").collect():
        shards[r.part].append(r)
    for rows in shards.values():
        assert [r.first for r in rows] == np.cumsum([0, *[sum(r.sizes) for r in rows]])[:-1].tolist()
        assert all(sum(r.sizes[:-1]) < 100 <= sum(r.sizes) for r in rows[:-1])
