"""Level-wise patterns, bounded recommendation search, batch windows and pooled isotonic fits."""

import json
import os
import random
import zlib
from collections import Counter
from datetime import datetime, timedelta

import numpy as np
import pytest
from pyspark.ml.fpm import PrefixSpan
from pyspark.sql import functions as F

from statweave.operators import (
    clustering,
    descriptive,
    mining,
    pooled_isotonic,
    recommendation,
    sequence_growth,
    supervised,
    topic_blocks,
)
from statweave.operators.hypothesis import welch_test
from statweave.operators.kernel_table import error_bound, kernel_density_table
from statweave.operators.power_iteration import power_iteration_steps
from statweave.operators.sequence_growth import grow_patterns
from statweave.operators.tall_skinny import left_vectors, singular_vectors
from statweave.operators.topic_tables import fit_topic_tables
from statweave.queries import models
from statweave.streaming import batch_windows


def as_sets(df):
    return {tuple(tuple(sorted(e)) for e in r.sequence): r.freq for r in df.collect()}


@pytest.mark.parametrize("support, length", [(0.5, 5), (0.2, 3), (0.9, 4)])
def test_grown_patterns_equal_prefixspan(spark, support, length):
    rng = random.Random(length)
    days = lambda n: [sorted(rng.sample("abcd", rng.randrange(1, 4))) for _ in range(n)]
    rows = [(days(rng.randrange(1, 6)),) for _ in range(12)] + [(days(150),), ([["a"]] * 61 + [["b"]] * 3 + [["c"]],)]
    df = spark.createDataFrame(rows, "sequence array<array<string>>").repartition(3)
    found = as_sets(grow_patterns(df, support, length))
    assert found == as_sets(mining.sequential_patterns(df, support, length)) and len(found) >= (4 if support < 0.9 else 1)


@pytest.mark.parametrize("support, length", [(0.5, 5), (0.15, 4)])
def test_patterns_of_blocks_equal_the_library(spark, support, length, monkeypatch):
    for name, value in {"BLOCK": 7, "BLOCKS": 1, "CHUNK": 60, "PASS": 1}.items():
        monkeypatch.setattr(sequence_growth, name, value)
    rng = random.Random(length)
    days = lambda n: [sorted(rng.sample("abcd", rng.randrange(1, 4))) for _ in range(n)]
    rows = [(days(rng.randrange(1, 6)),) for _ in range(40)] + [(days(70),), (None,)]
    df = spark.createDataFrame(rows, "sequence array<array<string>>").repartition(3)
    library = PrefixSpan(minSupport=support, maxPatternLength=length).findFrequentSequentialPatterns(df)
    found = as_sets(mining.sequential_patterns(df, support, length))
    assert found == as_sets(library) and len(found) > 10


def test_grown_patterns_of_odd_rows(spark):
    rows = [([[1, 1, None], None, [2]],), (None,), ([],), ([[1], [2]],)]
    df = spark.createDataFrame(rows, "sequence array<array<int>>")
    assert as_sets(grow_patterns(df, 0.5, 3)) == {((1,),): 2, ((2,),): 2, ((1,), (2,)): 2}
    assert grow_patterns(df.limit(0), 0.5, 3).count() == 0
    assert grow_patterns(df, 0.9, 3).count() == 0


def test_bounded_search_equals_the_full_product(spark):
    rng = np.random.default_rng(4)
    users, items = rng.normal(size=(90, 6)), rng.normal(size=(2500, 6)) * rng.gamma(1.0, 1.0, (2500, 1))
    items[100:140] = items[100]  # ties
    users[7] = 0
    table = lambda m: spark.createDataFrame([(i, v.tolist()) for i, v in enumerate(m)], "id int, features array<double>").repartition(3)
    found = recommendation.search_top_items(table(users), table(items), 10, segment_cells=6 * 600).collect()
    product = users @ items.T
    for r in found:
        order = np.lexsort((np.arange(2500), -product[r.user].round(12)))[:10]
        assert r["items"] == order.tolist(), r.user
        assert np.allclose(r.ratings, product[r.user][order])
    scored = sum(r.pairs for r in found)
    assert len(found) == 90 and scored < 0.8 * 90 * 2500
    flat = recommendation.top_items(table(users), table(items[:4]), 10)
    assert flat.count() == 360 and flat.agg(F.max("rank")).first()[0] == 4
    assert recommendation.top_items(table(users).limit(0), table(items)).count() == 0
    assert recommendation.top_items(table(users), table(items).limit(0)).count() == 0


def test_bounded_recommendation_equals_all_pairs(spark):
    rows = [(u, i, float((u * 7 + i * 3) % 11)) for u in range(40) for i in range(60) if (u + i) % 3 == 0]
    model = recommendation.fit_als(spark.createDataFrame(rows, "user int, item int, rating double"), rank=4, iterations=3)
    mine = {(r.user, r["rank"]): r.rating for r in recommendation.recommend_by_bound(model, 5).collect()}
    theirs = {(r.user, r["rank"]): r.rating for r in recommendation.recommend(model, 5).collect()}
    assert mine.keys() == theirs.keys() and all(abs(mine[k] - theirs[k]) < 1e-4 for k in mine)


def brute_isotonic(points):
    """Max-min formula over (x, w, y); value per x."""
    xs = sorted(points)
    total = lambda a, b: sum(points[x][1] for x in xs[a : b + 1]) / sum(points[x][0] for x in xs[a : b + 1])
    return {xs[q]: max(min(total(i, j) for j in range(q, len(xs))) for i in range(q + 1)) for q in range(len(xs))}


@pytest.mark.parametrize("chunk", [2, 7, 1000])
@pytest.mark.parametrize("trend", [-1.0, 0.0, 0.3])
def test_pooled_blocks_equal_the_max_min_formula(spark, chunk, trend):
    rng = random.Random(chunk)
    rows = [(float(rng.randrange(30)), rng.choice([0.5, 1.0, 2.0])) for _ in range(90)]
    rows = [(x, trend * x + rng.gauss(0, 3), w) for x, w in rows] + [(None, 1.0, 1.0), (3.0, None, 1.0), (4.0, 99.0, 0.0)]
    df = spark.createDataFrame(rows, "x double, y double, w double").repartition(4)
    points = {}
    for x, y, w in rows[:90]:
        old = points.get(x, (0.0, 0.0))
        points[x] = (old[0] + w, old[1] + w * y)
    blocks = pooled_isotonic.isotonic_blocks(df, "y", "x", "w", chunk=chunk).orderBy("low").collect()
    known = brute_isotonic(points)
    assert {x: next(b.prediction for b in blocks if b.low <= x <= b.high) for x in known} == pytest.approx(known)
    assert all(a.prediction < b.prediction and a.high < b.low for a, b in zip(blocks, blocks[1:]))
    falling = pooled_isotonic.isotonic_blocks(df.withColumn("y", -F.col("y")), "y", "x", "w", increasing=False, chunk=chunk)
    assert sorted(-b.prediction for b in falling.collect()) == pytest.approx([b.prediction for b in blocks])


def test_pooled_blocks_equal_the_library_model(spark):
    df = spark.range(400).select((F.col("id") % 97).cast("double").alias("x"), (F.sin("id") + F.col("id") % 97 / 50).alias("y"))
    points = supervised.isotonic_input(df, "y", "x")
    known = {round(r.boundary, 9): r.prediction for r in supervised.isotonic_points(supervised.fit_isotonic(points), df).collect()}
    found = pooled_isotonic.block_boundaries(pooled_isotonic.isotonic_blocks(df, "y", "x", chunk=16))
    assert {round(r.boundary, 9): r.prediction for r in found.collect()} == pytest.approx(known)
    assert pooled_isotonic.isotonic_blocks(df.limit(0), "y", "x").count() == 0


def feed(folder, batches, first=0):
    for i, rows in enumerate(batches, first):
        path = folder / f"batch{i}.json"
        path.write_text("".join(json.dumps({"t": t, "v": v, "ts": ts}) + "\n" for t, v, ts in rows))
        os.utime(path, (1_700_000_000 + i, 1_700_000_000 + i))


def sample_batches():
    rng = random.Random(8)
    start = datetime(2024, 1, 1)
    at = lambda hour: (start + timedelta(hours=hour)).isoformat()
    batches = [[(rng.random() < 0.5, rng.gauss(5, 2), at(10 * b + rng.randrange(10))) for _ in range(30)] for b in range(7)]
    batches[3] += [(True, 1e6, at(4)), (False, -1e6, at(0)), (True, 5.0, None)]  # two are late
    batches[5] += [(True, 1e6, at(9))] * 3
    return batches


def window_sums(batches, last, n, peace=0):
    rows = [r for b in range(max(last - n + 1, peace), last + 1) for r in batches[b] if abs(r[1]) < 1e5]
    control, treated = ([v for t, v, _ in rows if t == side] for side in (False, True))
    return len(control), len(treated), np.mean(control) if control else None, np.mean(treated) if treated else None


@pytest.mark.parametrize("n, peace", [(3, 0), (3, 2), (0, 0), (1, 0)])
def test_windows_of_batches_survive_a_restart(spark, tmp_path, n, peace):
    source, out, state = tmp_path / "in", str(tmp_path / "out"), str(tmp_path / "state")
    source.mkdir()
    batches = sample_batches()
    stream = lambda: spark.readStream.schema("t boolean, v double, ts timestamp").option("maxFilesPerTrigger", 1).json(str(source))
    for first, last in ((0, 4), (4, 7)):  # the second run goes on from the first one's checkpoint
        feed(source, batches[first:last], first)
        query = batch_windows.write_batch_windows(stream(), F.col("t"), "v", out, state, n, peace, "ts", 20 * 3600)
        query.awaitTermination()
        assert query.exception() is None
    got = batch_windows.read_batch_windows(spark, out).orderBy("batch_id").collect()
    assert [r.batch_id for r in got] == list(range(7))
    assert [r.late_rows for r in got] == [0, 0, 0, 2, 0, 3, 0] and [r.late_total for r in got] == [0, 0, 0, 2, 2, 5, 5]
    for r in got:
        control, treated, mc, mt = window_sums(batches, r.batch_id, n or 99, peace)
        assert (r.n_control, r.n_treatment) == (control, treated)
        if control and treated:
            assert (r.mean_control, r.mean_treatment) == pytest.approx((mc, mt))
    assert len(os.listdir(tmp_path / "out" / "ledger")) <= max(n, 1) + 2
    rows = [r for b in range(max(7 - (n or 99), peace), 7) for r in batches[b] if abs(r[1]) < 1e5]
    known = welch_test(spark.createDataFrame([(t, v) for t, v, _ in rows], "t boolean, v double"), F.col("t"), "v").first()
    assert (got[-1].statistic, got[-1].dof, got[-1].p_value) == pytest.approx((known.statistic, known.dof, known.p_value))


def test_progress_stops_a_significant_stream(spark, tmp_path):
    source = tmp_path / "in"
    source.mkdir()
    quiet = [[(i % 2 == 0, float(i % 5), None) for i in range(20)] for _ in range(6)]
    quiet[2] = [(i % 2 == 0, float(i % 5) + 50 * (i % 2), None) for i in range(20)]
    feed(source, quiet)
    stream = spark.readStream.schema("t boolean, v double, ts timestamp").option("maxFilesPerTrigger", 1).json(str(source))
    start = lambda out: batch_windows.write_batch_windows(stream, F.col("t"), "v", out, f"{out}-state", 1, processing_time="0 seconds")
    seen = batch_windows.stop_when_significant(start(str(tmp_path / "a")), str(tmp_path / "a"), 1e-6, idle_seconds=60)
    assert seen == {"batches": 3, "significant": True, "batch_id": 2}
    seen = batch_windows.stop_when_significant(start(str(tmp_path / "b")), str(tmp_path / "b"), 1e-6, max_batches=2, idle_seconds=60)
    assert seen == {"batches": 2, "significant": False, "batch_id": 1} and not spark.streams.active


def test_density_of_a_table_of_points(spark):
    rng = np.random.default_rng(3)
    values = np.concatenate([rng.normal(0, 3, 3000), rng.gamma(2, 20, 2000), np.full(2000, 7.0)])
    points = np.concatenate([rng.uniform(-40, 300, 400), [7.0, 7.0, 1e6]])
    samples = spark.createDataFrame([(float(v),) for v in values] + [(None,)], "x double").repartition(5)
    asked = spark.createDataFrame([(i, float(y), 1) for i, y in enumerate(points)] + [(9999, None, 1)], "id int, y double, _cell int")
    found = {r.id: r.density for r in kernel_density_table(samples, "x", asked, "y", 2.5).collect()}
    exact = np.exp(-((points[:, None] - values) ** 2) / (2 * 2.5**2)).mean(axis=1) / (2.5 * np.sqrt(2 * np.pi))
    assert found.pop(9999) is None and len(found) == len(points)
    worst = max(abs(found[i] - exact[i]) for i in found)
    assert worst <= 1.01 * error_bound() / (2.5 * np.sqrt(2 * np.pi)) + 1e-15
    rough = {r.id: r.density for r in kernel_density_table(samples, "x", asked, "y", 2.5, order=4, reach=3.0).collect()}
    assert max(abs(rough[i] - exact[i]) for i in found) <= error_bound(reach=3.0, order=4) / (2.5 * np.sqrt(2 * np.pi))
    none = kernel_density_table(samples.limit(0), "x", asked.where("id < 3"), "y")
    assert [r.density for r in none.collect()] == [None] * 3
    assert kernel_density_table(samples, "x", asked.limit(0), "y").count() == 0


@pytest.mark.parametrize("split", [2, 1000])
def test_power_iteration_equals_the_matrix_product(spark, split):
    rng = random.Random(2)
    edges = [(0, j, 1.0 + j % 3) for j in range(1, 40)] + [(rng.randrange(40), rng.randrange(40), rng.random()) for _ in range(60)]
    edges += [(None, 3, 1.0), (5, 5, 9.0), (6, 7, None), (8, 9, -1.0)]
    df = spark.createDataFrame(edges, "src long, dst long, weight double").repartition(3)
    matrix = np.zeros((40, 40))
    for a, b, w in edges:
        if None not in (a, b, w) and a != b and w > 0:
            matrix[a, b] += w
            matrix[b, a] += w
    degree = matrix.sum(axis=1)
    vector, rows = degree / degree.sum(), power_iteration_steps(df, 4, split=split).collect()
    for step in range(5):
        own = sorted((r.id, r.value, r.change) for r in rows if r.iteration == step)
        assert [v for _, v, _ in own] == pytest.approx(vector.tolist())
        after = matrix @ vector / degree
        after /= after.sum()
        if step < 4:
            change = {r.change for r in rows if r.iteration == step + 1}
            assert len(change) == 1 and change.pop() == pytest.approx(np.abs(after - vector).sum())
        vector = after
    assert power_iteration_steps(df, 50, tolerance=1e-3).agg(F.max("iteration")).first()[0] < 50
    assert power_iteration_steps(df.limit(0)).count() == 0


def test_rank_matrix_in_one_ranking(spark):
    rng = random.Random(1)
    rows = [(rng.randrange(9), rng.random(), float(rng.randrange(3)), rng.choice([None, 1, 2])) for _ in range(300)]
    df = spark.createDataFrame(rows, "a int, b double, c double, d int").repartition(4)
    names = ["a", "b", "c", "d"]
    together = descriptive.rank_rows(df, names).agg(*[F.sum(F.col(f"_rank_{i}") * F.col(f"_rank_{j}")) for i in names for j in names]).first()
    apart = descriptive.average_ranks(df, names).agg(*[F.sum(F.col(f"_rank_{i}") * F.col(f"_rank_{j}")) for i in names for j in names]).first()
    assert tuple(together) == pytest.approx(tuple(apart))
    exchanges = lambda n: descriptive.rank_rows(df, names[:n])._jdf.queryExecution().executedPlan().toString().count("Exchange")
    assert exchanges(2) == exchanges(4)


@pytest.mark.parametrize("centred", [False, True])
def test_components_by_a_tree_of_triangles(spark, centred):
    rng = np.random.default_rng(9)
    matrix = rng.normal(size=(700, 5)) @ np.diag([9, 4, 2, 1, 1e-4]) @ rng.normal(size=(5, 5)) + 3
    rows = [(i, v.tolist()) for i, v in enumerate(matrix)] + [(999, None)]
    df = spark.createDataFrame(rows, "id int, features array<double>").repartition(40)
    found = singular_vectors(df, 3, centred=centred)
    v = np.zeros((3, 5))
    s = {}
    for r in found.collect():
        v[r.component, r.j], s[r.component] = r.v, r.s
    base = matrix - matrix.mean(axis=0) if centred else matrix
    _, known, right = np.linalg.svd(base, full_matrices=False)
    assert [s[c] for c in range(3)] == pytest.approx(known[:3].tolist())
    assert np.linalg.svd(v @ right[:3].T)[1] == pytest.approx(np.ones(3))  # cosines of the angles between the subspaces
    assert np.abs(v @ v.T - np.eye(3)).max() < 1e-12 and all(row[np.abs(row).argmax()] > 0 for row in v)
    if not centred:
        left = left_vectors(df, found, "id")
        u = {(r.id, r.component): r.u for r in left.collect()}
        back = np.array([[u[i, c] * s[c] for c in range(3)] for i in range(700)]) @ v
        assert np.abs(back - base).max() == pytest.approx(np.abs((base @ right[:3].T) @ right[:3] - base).max())
    assert singular_vectors(df, 9, centred=centred).select("component").distinct().count() == 5
    assert singular_vectors(df.where("id < 0"), 2, centred=centred).count() == 0
    assert singular_vectors(df.where("id = 3"), 2).select("component").distinct().count() == 1


def brute_topics(cells, k, iterations, alpha, eta):
    docs, terms = sorted({d for d, _, _ in cells}), sorted({t for _, t, _ in cells})
    favour = lambda d, t: (len(t) + zlib.crc32(str(d).encode())) % k
    n_d, n_w = {d: np.zeros(k) for d in docs}, {t: np.zeros(k) for t in terms}
    shares = [np.array([(2.0 if favour(d, t) == j else 1.0) / (k + 1) for j in range(k)]) for d, t, _ in cells]
    for turn in range(iterations + 1):
        if turn:
            total = sum(n_w.values())
            shares = [(n_d[d] + alpha - 1) * (n_w[t] + eta - 1) / (total + len(terms) * (eta - 1)) for d, t, _ in cells]
            shares = [p / p.sum() for p in shares]
        n_d, n_w = {d: np.zeros(k) for d in docs}, {t: np.zeros(k) for t in terms}
        for (d, t, n), p in zip(cells, shares):
            n_d[d] += n * p
            n_w[t] += n * p
    total = sum(n_w.values()) + len(terms) * (eta - 1)
    return {t: (n_w[t] + eta - 1) / total for t in terms}, {d: (n_d[d] + alpha - 1) / (n_d[d] + alpha - 1).sum() for d in docs}


@pytest.mark.parametrize("split", [3, 1000])
def test_topic_tables_equal_plain_updates(spark, split):
    rng = random.Random(6)
    cells = [(d, t, float(rng.randrange(1, 5))) for d in range(12) for t in ("a", "bb", "ccc", "dd", "e", "ffff") if rng.random() < 0.7]
    df = spark.createDataFrame([*cells, (None, "a", 1.0), (1, None, 1.0), (2, "a", 0.0)], "doc int, term string, n double").repartition(3)
    topics, docs = fit_topic_tables(df, 2, 3, 1.5, 1.1, split=split)
    known_topics, known_docs = brute_topics(cells, 2, 3, 1.5, 1.1)
    found = {(r.term, r.topic): r.weight for r in topics.collect()}
    assert found == pytest.approx({(t, j): v[j] for t, v in known_topics.items() for j in range(2)})
    mixed = {r.doc: r.topics for r in docs.collect()}
    assert mixed.keys() == known_docs.keys() and all(mixed[d] == pytest.approx(v.tolist()) for d, v in known_docs.items())
    assert topics.groupBy("topic").agg(F.sum("weight").alias("w")).where("abs(w - 1) > 1e-9").count() == 0
    none = fit_topic_tables(df.where("doc IS NULL"), 2, 1)
    assert none[0].count() == none[1].count() == 0


def drawn_topics(counts, k, iterations, alpha, eta, seed):
    """The model over all pairs at once, from the numbers that are drawn for each row of a block."""
    index = {(r.block, r.place): r.term_index for r in counts.places.collect()}
    docs, terms, times, shares = [], [], [], []
    for r in counts.blocks.orderBy("block", "part").collect():
        sizes, places, n = (topic_blocks.unpacked(x) for x in (r.sizes, r.terms, r.times))
        for size in sizes:
            docs += [docs[-1] + 1 if docs else 0] * size
        terms += [index[r.block, p] for p in places]
        times += n.tolist()
        shares.append(np.random.default_rng([seed, r.block, r.part]).random((len(places), k)))
    docs, terms, times, shares = np.array(docs), np.array(terms), np.array(times), np.concatenate(shares)
    for turn in range(iterations + 1):
        if turn:
            shares = (n_d[docs] + alpha - 1) * (n_w[terms] + eta - 1) / (n_w.sum(axis=0) + len(n_w) * (eta - 1))
        shares = shares / shares.sum(axis=1, keepdims=True) * times[:, None]
        n_d, n_w = np.zeros((docs.max() + 1, k)), np.zeros((terms.max() + 1, k))
        np.add.at(n_d, docs, shares)
        np.add.at(n_w, terms, shares)
    return docs, n_w / n_w.sum(axis=0)


@pytest.mark.parametrize("part, block, places", [(7, 40, 10), (1 << 19, 4_000_000, 500_000)])
def test_topic_blocks_equal_plain_updates(spark, part, block, places, monkeypatch):
    for name, value in {"PART": part, "BLOCK": block, "PLACES": places}.items():
        monkeypatch.setattr(topic_blocks, name, value)
    rng = random.Random(8)
    texts = [[rng.choice("abcdefghijkl") * rng.randrange(1, 4) for _ in range(rng.randrange(30))] for _ in range(40)] + [["a"] * 300, ["b"] * 70_000]
    df = spark.createDataFrame([*[(t,) for t in texts], (None,), ([],)], "words array<string>").repartition(3)
    counts = topic_blocks.term_blocks(df)
    known = Counter(w for t in texts for w in t)
    assert [(r.term, r.term_index, r.n) for r in counts.terms.orderBy("term_index").collect()] == [
        (w, i, n) for i, (w, n) in enumerate(sorted(known.items(), key=lambda x: (-x[1], x[0])))
    ]
    docs, weights = drawn_topics(counts, 3, 4, 1.5, 1.1, 5)
    assert docs.max() + 1 == sum(1 for t in texts if t) and (counts.blocks.select("block").distinct().count() > 4) == (part == 7)
    model = topic_blocks.fit_topic_blocks(counts, 3, 4, 5, 1.5, 1.1)
    rows = model.terms.collect()
    found = {(r.topic, r.term_index): r.weight for r in rows}
    assert len(rows) == len(found) == 3 * len(known)
    assert found == pytest.approx({(j, t): w[j] for t, w in enumerate(weights) for j in range(3)})
    best = {(r.topic, r.term_index) for r in clustering.topic_terms(model, 2).collect()}
    assert best == {(j, int(t)) for j in range(3) for t in np.argsort(-weights[:, j])[:2]}


def test_topic_blocks_fit_as_well_as_the_library(spark):
    """Two kinds of documents are told apart by both, in the same shares."""
    rng, places = random.Random(3), {w: i for i, w in enumerate("abcdefgh")}
    texts = [[rng.choice("abcd" if i % 2 else "efgh") for _ in range(300)] for i in range(30)]
    own = clustering.fit_lda(topic_blocks.term_blocks(spark.createDataFrame([(t,) for t in texts], "words array<string>")), 2, 15)
    vectors = spark.createDataFrame([([float(t.count(w)) for w in places],) for t in texts], "features array<double>")
    library = clustering.topic_terms(clustering.fit_lda(vectors, 2, 15)).collect()
    names = {r.term_index: r.term for r in topic_blocks.term_blocks(spark.createDataFrame([(t,) for t in texts], "words array<string>")).terms.collect()}
    by_topic = lambda rows: sorted([sorted((w, round(x, 2)) for t, w, x in rows if t == j) for j in range(2)])
    assert by_topic([(r.topic, names[r.term_index], r.weight) for r in clustering.topic_terms(own).collect()]) == by_topic(
        [(r.topic, "abcdefgh"[r.term_index], r.weight) for r in library]
    )


def test_topics_of_documents_gather_no_vocabulary(spark, tmp_path):
    """Null and empty texts have no words; the settings of the session stay as they were; no vocabulary is collected."""
    texts = ["one two two", "Two three", None, "", "one four, FOUR four 5", "7 8"]
    spark.createDataFrame([(i, t) for i, t in enumerate(texts)], "doc_id int, text string").write.parquet(f"{tmp_path}/documents.parquet")
    before = spark.conf.get(topic_blocks.CLEANUP, None)
    rows = models.lda_topics(spark, str(tmp_path)).collect()
    assert sorted((r.topic, r.term_index) for r in rows) == [(j, t) for j in range(3) for t in range(4)]
    assert all(sum(r.weight for r in rows if r.topic == j) == pytest.approx(1.0) for j in range(3))
    again = {(r.topic, r.term_index): r.weight for r in models.lda_topics(spark, str(tmp_path)).collect()}
    assert again == pytest.approx({(r.topic, r.term_index): r.weight for r in rows})
    assert spark.conf.get(topic_blocks.CLEANUP, None) == before
    counts = models.counted(spark.read.parquet(f"{tmp_path}/documents.parquet"))
    assert [tuple(r) for r in counts.terms.orderBy("term_index").collect()] == [("four", 0, 3), ("two", 1, 3), ("one", 2, 2), ("three", 3, 1)]
    none = spark.createDataFrame([(None,)], "words array<string>")
    assert clustering.fit_lda(topic_blocks.term_blocks(none), 2, 1).terms.count() == 0


def test_rules_mine_the_baskets_once(spark):
    seen = spark.sparkContext.accumulator(0)

    def mark(items):
        seen.add(1)
        return items

    baskets = spark.createDataFrame([(["a", "b"],)] * 6 + [(["a"],)] * 4, "items array<string>")
    baskets = baskets.select(F.udf(mark, "array<string>")("items").alias("items"))
    found = mining.rules_from_itemsets(mining.frequent_itemsets(mining.fit_fp_growth(baskets, 0.2)), 0.5).collect()
    assert {(r.antecedent[0], r.confidence) for r in found} == {("a", 0.6), ("b", 1.0)} and seen.value == 10


def test_density_never_broadcasts_the_points(spark, tmp_path):
    spark.range(300).select("id", (F.col("id") / 10).alias("y")).write.parquet(str(tmp_path / "points"))
    spark.range(20_000).select((F.col("id") % 97 / 3).alias("x"), F.uuid().alias("other")).write.parquet(str(tmp_path / "samples"))
    read = lambda name: spark.read.parquet(str(tmp_path / name))
    found = kernel_density_table(read("samples"), "x", read("points"), "y", 2.0)
    assert "BuildLeft" not in found._jdf.queryExecution().executedPlan().toString()
    assert found.count() == 300


def test_rank_matrix_of_few_values_moves_no_row(spark):
    df = spark.range(500).select((F.col("id") % 7).alias("a"), (F.col("id") % 5 * 2.5).alias("b"), (F.col("id") % 3).alias("c"))
    matrix = descriptive.correlation_matrix(df, ["a", "b", "c"], "spearman")
    plan = matrix._jdf.queryExecution().executedPlan().toString()
    assert "SortMergeJoin" not in plan and "hashpartitioning" not in plan
    assert {(r.i, r.j): r.r for r in matrix.collect()}["a", "a"] == 1.0


def test_recommendation_equals_the_library(spark):
    rng = np.random.default_rng(3)
    rows = [(int(u), int(i), float((u * 7 + i * 3) % 11)) for u in range(60) for i in range(900) if rng.random() < 0.2]
    model = recommendation.fit_als(spark.createDataFrame(rows, "user int, item int, rating double"), rank=4, iterations=3)
    theirs = {r.user: [x.rating for x in r.recommendations] for r in model.recommendForAllUsers(5).collect()}
    mine = recommendation.recommend(model, 5)
    assert [t for _, t in mine.dtypes] == ["int", "int", "int", "double"]
    assert mine.count() == 5 * len(theirs)
    got = {(r.user, r["rank"]): r.rating for r in mine.collect()}
    assert all(abs(got[u, p + 1] - x) < 1e-4 for u, xs in theirs.items() for p, x in enumerate(xs))


def test_items_of_other_directions_are_left_out(spark):
    """Equal norms leave the norms nothing to cut; centres and radii of blocks do."""
    rng = np.random.default_rng(5)
    angle = rng.uniform(0, 2 * np.pi, 6000)
    items = np.column_stack([np.cos(angle), np.sin(angle)])
    table = lambda m: spark.createDataFrame([(i, v.tolist()) for i, v in enumerate(m)], "id int, features array<double>")
    found = recommendation.search_top_items(table(items[:40]), table(items), 5).collect()
    product = items[:40] @ items.T
    assert all(np.allclose(r.ratings, np.sort(product[r.user])[::-1][:5]) for r in found) and len(found) == 40
    assert sum(r.pairs for r in found) < 0.8 * 40 * 6000


def test_fewer_item_blocks_give_the_same_factors(spark, monkeypatch):
    rows = [(u, i, float((u * 7 + i * 3) % 11)) for u in range(40) for i in range(60) if (u + i) % 3 == 0]
    df = spark.createDataFrame(rows, "user int, item int, rating double")
    assert recommendation.ITEM_BLOCKS < 10
    few = {r.id: r.features for r in recommendation.user_factors(recommendation.fit_als(df, 4, 3)).collect()}
    monkeypatch.setattr(recommendation, "ITEM_BLOCKS", 10)
    many = {r.id: r.features for r in recommendation.user_factors(recommendation.fit_als(df, 4, 3)).collect()}
    assert few.keys() == many.keys() and all(np.allclose(few[k], many[k], atol=1e-3) for k in few)


@pytest.mark.parametrize("few", [0, 1_000])
def test_few_new_ratings_are_sorted_like_all(few, monkeypatch):
    monkeypatch.setattr(recommendation, "FEW", few)
    draw = np.random.default_rng(4)
    best, owner = -np.sort(-draw.integers(0, 9, (50, 5)).astype(float), axis=1), np.arange(250).reshape(50, 5)
    best[:3], owner[:3] = -np.inf, np.iinfo(np.int64).max
    product, ids = draw.integers(0, 12, (50, 30)).astype(float), draw.permutation(30) + 1_000
    rating, item = recommendation._bettered(best, owner, product, ids, best.min(axis=1))
    for row in range(50):
        every = sorted(zip((-best[row]).tolist() + (-product[row]).tolist(), owner[row].tolist() + ids.tolist()))
        assert sorted(zip((-rating[row]).tolist(), item[row].tolist())) == every[:5]


def test_users_are_dealt_over_tasks_by_their_pairs(spark, monkeypatch):
    draw = np.random.default_rng(5)
    users, items = draw.normal(size=(60, 3)), draw.normal(size=(80, 3))
    tables = [spark.createDataFrame([(i, v.tolist()) for i, v in enumerate(m)], "id int, features array<double>").coalesce(1) for m in (users, items)]
    expected = {u: np.lexsort((np.arange(80), -(items @ users[u])))[:4].tolist() for u in range(60)}
    search, tasks = recommendation._search, []
    monkeypatch.setattr(recommendation, "TASK_PAIRS", 1_000)
    monkeypatch.setattr(recommendation, "_search", lambda state, *rest: tasks.append(state.rdd.getNumPartitions()) or search(state, *rest))
    rows = recommendation.search_top_items(*tables, k=4).collect()
    assert tasks == [5] and {r.user: list(r["items"]) for r in rows} == expected
