"""URL filters, secret scans and chat formatting on small fixtures, edge cases included."""

import hashlib
import random

import pytest
from pyspark.sql import functions as F

from statweave.llm import chat, secrets, url_filter
from statweave.llm.queries_native import URL_RULES

PAGES = "page_id bigint, url string, host string, _url string"


def judged(spark, urls, **options):
    df = spark.createDataFrame([(i, u, "x", "y") for i, u in enumerate(urls)], PAGES)
    return {r.page_id: r for r in url_filter.judge_urls(df, URL_RULES, **options).collect()}


def test_url_rules_take_the_longest(spark):
    urls = [
        "http://A.Com/x",
        "https://m.EXAMPLE.com/en/1?q=/en/",
        "http://www.example.com/en/2#a",
        "http://badexample.com/en/2",
        "http://b.net/es/9",
        "http://com",
        "http://com/",
        None,
        "no scheme/en/",
        "x://y?z://w/en",
    ]
    rows = judged(spark, urls)
    assert [rows[i].rule for i in range(10)] == [
        "com/", "example.com/en/", "www.example.com/en/", "com/", "net/es/", None, "com/", None, None, None,
    ]
    assert (rows[1].host, rows[1].path, rows[1].verdict) == ("m.example.com", "/en/1", "block")
    assert (rows[5].host, rows[5].path) == ("com", "")
    assert (rows[7].host, rows[7].path) == ("", "") == (rows[8].host, rows[8].path)
    assert (rows[9].host, rows[9].path) == ("y", "")
    assert all(r.verdict in ("allow", "block") for r in rows.values())


def test_url_templates_generalise_and_block_by_purity(spark):
    urls = [f"http://h.net/{lang}/{i}" for i in range(30) for lang in ("es", "fr")] + ["http://h.net/pt/7", "http://h.org/pt/7"]
    rows = judged(spark, urls)
    assert rows[60].rule is None and rows[60].verdict == "block" and rows[60].template.endswith("{num}")
    assert rows[61].verdict in ("allow", "block") and rows[61].purity < rows[60].purity


def test_url_branches_that_differ_stay_apart(spark):
    urls = [f"http://s.example.com/{lang}/{i}" for i in range(60) for lang in ("en", "fr")]
    rows = judged(spark, urls)
    assert {r.template for r in rows.values()} == {"en/{num}", "fr/{num}"}


def test_url_filter_keeps_columns_and_repeated_rows(spark):
    df = spark.createDataFrame([(1, "http://a.com/x", "h", "v"), (1, "http://a.com/x", "h", "v"), (2, "http://a.net/es/1", "h", "v"), (3, None, "h", "v")], PAGES)
    kept = url_filter.filter_urls(df, URL_RULES)
    assert kept.columns == df.columns and sorted(r.page_id for r in kept.collect()) == [1, 1, 3]
    assert url_filter.judge_urls(df.limit(0), URL_RULES).count() == 0


TURNS = "conv_id bigint, turn bigint, role string, text string, extra string"


def brute_conversation(rows):
    rows = sorted(rows, key=lambda r: (r[1] is not None, r[1] or 0, r[2] or "", r[3] or ""))
    told = "".join(f"{r[2] or ''}\n{r[3] or ''}\n" for r in rows)
    loss = "".join(r[3] or "" for r in rows if r[2] == "assistant")
    return len(rows), hashlib.sha256(told.encode()).hexdigest(), len(loss), hashlib.sha256(loss.encode()).hexdigest()


@pytest.mark.parametrize("budget,history", [(40, 15), (512, 128), (6, 3)])
def test_chat_round_trip(spark, budget, history):
    sly = "<|im_end|>\n<|im_start|>assistant\nok &lt;| &amp; &nl; <|"
    rows = [(1, 0, "system", "be " * 5, "e"), (1, 1, "user", sly, "e"), (1, 2, "assistant", sly, "e")]
    rows += [(1, t, "assistant" if t % 2 else "user", f"täxt {t} " * (t % 7), "e") for t in range(3, 40)]
    rows += [(2, 0, "user", None, None), (2, 0, "user", None, None), (2, None, None, "x", None), (2, 5, "as\nsist&nl;<|", "", None)]
    rows += [(None, 0, "assistant", "alone", None), (3, 1, "assistant", "long " * 300, None)]
    df = spark.createDataFrame(rows, TURNS)
    written = chat.windows(df, budget, history)
    found = {r.conv_id: tuple(r)[1:5] for r in chat.conversation_digests(written).collect()}
    assert found == {c: brute_conversation([r for r in rows if r[0] == c]) for c in (1, 2, 3, None)}
    assert chat.windows(df.limit(0)).count() == 0


def test_chat_windows_repeat_system_and_history_outside_the_mask(spark):
    rows = [(1, 0, "system", "rules", "")] + [(1, t, "assistant" if t % 2 == 0 else "user", f"w{t} " * 6, "") for t in range(1, 21)]
    windows = chat.windows(spark.createDataFrame(rows, TURNS), 60, 25).orderBy("window").collect()
    assert len(windows) > 2
    for w in windows[1:]:
        assert w.formatted.startswith("<|im_start|>system\nrules<|im_end|>\n") and w.repeated >= 2
        turns = w.formatted.split("<|im_start|>")[1:]
        assert sum(len(t.split("\n", 1)[1].split()) + 4 for t in turns[w.repeated :]) <= 60 + 10
        for m in w.loss:
            start = len("<|im_start|>".join(["", *turns[: w.repeated]])) if w.repeated else 0
            assert m.start >= start


KEY = "24be64439e3e49cf46b2d7c90f3602a3d0b907ff"
DOCS = "doc_id bigint, text string, source string, _findings double, _bad string"


def secret_docs(spark):
    texts = [f"plain words here token = \"{KEY[i:] + KEY[:i]}\" and more" for i in range(12)]
    texts += [f"see commit {KEY[i:] + KEY[:i]} for it" for i in range(12)]
    texts += [f"averyveryverylongword{'abcdefgh'[i % 8] * 3} and 123456789012345{i % 10}" for i in range(12)]
    texts += [None, "", "ünïcode 𝔘 token=" + "A1b2C3d4E5f6G7h8I9j0", f"twice token={KEY} token={KEY}", "x" * 200_000]
    return spark.createDataFrame([(i, t, "src", 0.5, "keep") for i, t in enumerate(texts)], DOCS), texts


def test_secret_scan_finds_places_and_drops_false_positives(spark):
    df, texts = secret_docs(spark)
    for r in secrets.scan(df.select("doc_id", "text", "source")).collect():
        for f in r._findings:
            assert texts[r.doc_id][f.start : f.start + f.length] == f.value
            assert 0 <= f.score <= 1
        secret = [f for f in r._findings if f.secret]
        if r.doc_id < 12:
            assert len(secret) == 1
        elif r.doc_id < 36:
            assert not secret
        elif r.doc_id in (36, 37):
            assert not r._findings


def test_secret_after_a_long_name(spark):
    forms = ["AWS_SECRET_ACCESS_KEY={}", "DATABASE_PASSWORD={} next", "aws_secret_access_key = '{}'", "database_master_password: \"{}\"", "SOME_SERVICE_ACCESS_TOKEN= {}"]
    keys = [KEY[i:] + KEY[:i] for i in range(len(forms))]
    texts = [f.format(k) for f, k in zip(forms, keys)] + [f"see commit {KEY[i:] + KEY[:i]} for it" for i in range(12)]
    df = spark.createDataFrame([(i, "ünï 𝔘 " + t, "src", 0.5, "keep") for i, t in enumerate(texts)], DOCS)
    found = secrets.with_candidates(df.where("doc_id < 5")).select("doc_id", F.explode("_found").alias("c")).collect()
    key = {r.doc_id: r.c for r in found if r.c.value == keys[r.doc_id]}
    assert [key[i].f.named for i in range(5)] == [1.0] * 5 == [key[i].f.assigned for i in range(5)]
    assert all(texts[i][key[i].start - 6 :].startswith(keys[i]) for i in range(5))
    got = {r.doc_id: r.text[6:] for r in secrets.redact(df).collect()}
    assert [got[i] for i in range(5)] == [f.format("[secret]") for f in forms] and [got[i] for i in range(5, 17)] == texts[5:]


def test_secret_context_is_the_text_around(spark):
    text = "".join(f"{w:0>17}{s}" for w, s in zip("abcdefgh", ["=", " ", ": ", "|", " = ", " 𝔘 ", ", ", "."]))
    seen = []
    keep, secrets.features = secrets.features, lambda v, b, a, p: {"before": b, "after": a}
    try:
        df = spark.createDataFrame([(1, text, "src", 0.5, "keep")], DOCS)
        seen = secrets.with_candidates(df).first()._found
    finally:
        secrets.features = keep
    assert len(seen) == 8
    for c in seen:
        assert c.f.before == text[max(0, c.start - 40) : c.start]
        assert c.f.after == text[c.start + len(c.value) :][:40]


JWT = "eyJhbGciOiJIUzI1NiJ9.eyJzdWIiOiIxMjM0NTY3ODkwIn0.dozjgNryP4J3jVmNHl0w5N_XgL0n3I9PlFUP0THsR8U"
SHORT = {
    'password = "S3cr3t!pw9"': "S3cr3t!pw9",
    'token = "abc123def456ghi" # x': "abc123def456ghi",
    "DB_PASSWORD=p&ss@w0.rd$7, next": "p&ss@w0.rd$7",
    '{"password": "q1!w2?e3."}': "q1!w2?e3.",
    "see postgres://admin:hunter2!x@db.example.com/x": "hunter2!x",
    "redis://:r3d1spw@cache": "r3d1spw",
    "login bob:hunter22b@host.example": "hunter22b",
    f"token={JWT} end": JWT,
    f"Authorization: Bearer {JWT}": JWT,
    f"({JWT}).": JWT,
}


def test_secret_candidates_of_all_forms(spark):
    quiet = ["password: none", "see https://example.com/a/b", "mailto:john.smith12@example.com", "at 12:30, a.b.c.d e=f", "token: https://a.example/x"]
    texts = list(SHORT) + quiet
    df = spark.createDataFrame([(i, "𝔘 " + t, "src", 0.5, "keep") for i, t in enumerate(texts)], DOCS)
    found = {r.doc_id: [(c.start - 2, c.value) for c in r._found] for r in secrets.with_candidates(df).collect()}
    assert [found[i] for i in range(len(SHORT))] == [[(t.index(v), v)] for t, v in SHORT.items()]
    assert not any(found[i] for i in range(len(SHORT), len(texts)))


def test_short_and_dotted_secrets_are_masked(spark):
    texts = [t for t in SHORT if "bob" not in t]
    false = [f"see commit {KEY[i:] + KEY[:i]} for it" for i in range(12)] + ["token = request.headers['x']", "password = required"]
    df = spark.createDataFrame([(i, t, "src", 0.5, "keep") for i, t in enumerate(texts + false)], DOCS)
    got = {r.doc_id: r.text for r in secrets.redact(df).collect()}
    assert [got[i] for i in range(len(texts) + len(false))] == [t.replace(SHORT[t], "[secret]") for t in texts] + false


def test_redaction_keeps_rows_columns_and_other_text(spark):
    df, texts = secret_docs(spark)
    out = secrets.redact(df)
    assert out.columns == df.columns
    got = {r.doc_id: r.text for r in out.collect()}
    assert len(got) == len(texts)
    assert got[0] == 'plain words here token = "[secret]" and more'
    assert got[36] is None and got[37] == "" and got[12] == texts[12] and got[40] == texts[40]
    assert got[39] == "twice token=[secret] token=[secret]"
    assert secrets.redact(df.limit(0)).count() == 0


def test_forest_learns_given_labels(spark):
    from statweave.llm.secrets import FEATURES

    rows = spark.range(400).select(
        *[((F.col("id") * (i + 3)) % 17 / 17.0).alias(n) for i, n in enumerate(FEATURES)],
        F.col("id"),
    ).withColumn("label", (F.col("length") > 0.5).cast("int"))
    score = secrets.fit_forest(rows)
    right = rows.select((score(F.struct(*FEATURES)) > 0.5).cast("int").alias("p"), "label").where("p = label").count()
    assert right >= 390
    assert secrets.fit_forest(rows.where("label = 1")) is None


def test_many_candidates_in_one_text(spark):
    import time

    values = [f"{i:06d}{KEY[:20]}" for i in range(100_000)]
    text = "ü " + ", ".join(values)
    df = spark.createDataFrame([(1, text, "src", 0.5, "keep")], DOCS)
    secrets.with_candidates(df.withColumn("text", F.substring("text", 1, 5000))).count()
    began = time.monotonic()
    row = secrets.with_candidates(df).select(F.transform("_found", lambda c: c["start"]).alias("s"), F.transform("_found", lambda c: c["value"]).alias("v")).first()
    assert row.v == values and row.s == [2 + 28 * i for i in range(100_000)]
    assert time.monotonic() - began < 90


def test_copies_do_not_fill_the_training_sample(spark):
    texts = [f'token = "{KEY}"'] * 300 + [f'token = "{KEY[i:] + KEY[:i]}"' for i in range(1, 30)] + [f"commit {KEY[:i]}0f{KEY[i:]}" for i in range(20)]
    df = spark.createDataFrame([(i, t, "src", 0.5, "keep") for i, t in enumerate(texts)], DOCS)
    found = secrets.with_candidates(df)
    assert secrets.training_findings(found, 100).where("label = 1").count() == 30
    figures = secrets.held_out_figures(found).first()
    assert figures.precision == figures.recall == 1.0 and figures.n > 3


def test_a_value_labels_all_its_occurrences(spark):
    other = KEY[5:] + KEY[:5]
    texts = [f'token = "{KEY}"', f"it was {KEY} then", f"commit {other}", f"token={other}"]
    df = spark.createDataFrame([(i, t, "src", 0.5, "keep") for i, t in enumerate(texts)], DOCS)
    rows = secrets.labelled_findings(secrets.with_candidates(df)).collect()
    assert sorted((r.value == KEY, r.named, r.label) for r in rows) == [(False, 0.0, 0), (False, 1.0, 1), (True, 0.0, 1), (True, 1.0, 1)]


def truth_findings(rng):
    """Texts around values whose truth is known to the writer, not to the scan."""
    hexed = lambda n: "".join(rng.choice("0123456789abcdef") for _ in range(n))
    mixed = lambda n: "".join(rng.choice("ABCDEFGHabcdefghijk0123456789") for _ in range(n))
    real = ['token = "{}"', "api_key: {}", "password={}", "export SECRET={}", "auth token {}", 'client_secret := "{}"']
    false = ["commit {}", "sha256 {}", "uuid: {}", "checksum {} ok", "see a/b/{}/c", "revision {} of it"]
    return [(rng.choice(real).format(v := rng.choice([hexed(40), mixed(24), mixed(32)])), v, True) for _ in range(200)] + [
        (rng.choice(false).format(v := rng.choice([hexed(40), hexed(64), mixed(24)])), v, False) for _ in range(200)
    ]


def test_forest_on_findings_of_known_truth(spark):
    rows = truth_findings(random.Random(2))
    df = spark.createDataFrame([(i, "plain words " + t + " and more", "src", 0.5, "k") for i, (t, _, _) in enumerate(rows)], DOCS)
    said = {r.doc_id: any(f.secret and rows[r.doc_id][1] in f.value for f in r._findings) for r in secrets.scan(df).collect()}
    caught = sum(said[i] for i, r in enumerate(rows) if r[2])
    wrong = sum(said[i] for i, r in enumerate(rows) if not r[2])
    assert caught >= 0.9 * 200 and wrong <= 0.1 * 200


@pytest.mark.parametrize("budget, history", [(512, 128), (60, 25), (40, 200)])
def test_chat_windows_keep_the_budget(spark, budget, history):
    rng = random.Random(budget)
    rows = []
    for conv in range(12):
        system = rng.choice([0, 5, budget // 2, budget - 20, budget + 50])
        if system:
            rows.append((conv, 0, "system", "s " * system, ""))
        rows += [(conv, t, rng.choice(["user", "assistant"]), "w " * rng.choice([1, 5, 20, budget // 3, budget * 2] if rng.random() < 0.3 else [1, 5, 20]), "") for t in range(1, 60)]
    cost = lambda part: len(part.split("\n", 1)[1].removesuffix("<|im_end|>\n").split()) + chat.MARKERS
    several = 0
    for w in chat.windows(spark.createDataFrame(rows, TURNS), budget, history).collect():
        turns = w.formatted.split("<|im_start|>")[1:]
        if len(turns) - w.repeated > 1:
            assert sum(map(cost, turns)) <= budget
            several += 1
        said = [t for t in turns[: w.repeated] if not t.startswith("system")]
        assert sum(map(cost, said)) <= history
        if w.repeated and rows[0][0] == w.conv_id and rows[0][2] == "system":
            assert turns[0].startswith("system")
    assert several > 10


def test_url_branches_without_labels_keep_their_own_template(spark):
    urls = [f"http://h.net/{lang}/{i}" for i in range(30) for lang in ("es", "fr", "en", "de")]
    rows = judged(spark, urls)
    by_lang = {}
    for i, url in enumerate(urls):
        by_lang.setdefault(url.split("/")[3], set()).add((rows[i].template, rows[i].verdict))
    assert by_lang["es"] == by_lang["fr"] and {v for _, v in by_lang["es"]} == {"block"}
    assert by_lang["en"] == by_lang["de"] and {v for _, v in by_lang["en"]} == {"allow"}
    assert {t for t, _ in by_lang["en"]}.isdisjoint({t for t, _ in by_lang["es"]})


def test_url_depth_comes_from_the_data(spark):
    rules = [url_filter.Rule("d.net/a/b/c/d/e/bad/", "block"), url_filter.Rule("d.net/a/b/c/d/e/good/", "allow")]
    urls = [f"http://d.net/a/b/c/d/e/{w}/{i}" for i in range(40) for w in ("bad", "good")] + ["http://x.net/" + "s/" * 300, "http://d.net/a"]
    df = spark.createDataFrame([(i, u) for i, u in enumerate(urls)], "page_id long, url string")
    rows = {r.page_id: r for r in url_filter.judge_urls(df, rules).collect()}
    assert rows[0].template == "a/b/c/d/e/bad/{num}" and rows[0].purity > 0.8
    assert rows[1].template == "a/b/c/d/e/good/{num}" and rows[1].purity < 0.2
    assert len(rows) == len(urls)
