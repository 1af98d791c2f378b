"""Secret scan: candidate strings, a random forest that drops false positives, redaction.

Native: candidates, features and the fitted forest are column expressions over arrays in
the document's own row, so a scan needs no shuffle, join or row key of texts. Texts are
searched once: rows that hold a candidate are cut at them, and candidates with their features
are staged; training, scoring and redaction read what is staged. The work is linear in a
text's length and its number of candidates (start positions are sums over two levels of
blocks). The forest is fitted by Spark's estimator and then written out as conditional
expressions.

Candidates: runs of letters, digits and + / _ - with at least 16 in one of the parts that
single dots join (a JWT is one candidate); six or more characters without blanks and quotes
that are assigned to a secret name (= : := => ==, on one line); six or more before the @ of
``user:password@host``. Nothing shorter, no pass phrase beyond its first blank, and no name
outside ``SECRET_WORDS`` is looked at.

Features of a candidate: length, changes of character class, digit, upper-case, vowel and
distinct-character shares, share covered by dictionary words (the corpus's frequent words and
some words of identifiers), hex only, part of a path, words before it that name a secret or
that name a harmless identifier, assignment, quotes, and a path column that looks like tests
or examples.

Labelled findings are an argument (the feature columns and ``label``). Without them labels
come from values, not from rows: occurrences that are clear by rule (assigned to a name such as
``token`` or a known key form: real; letters only, digits only, calls and placeholders, parts
of a path, named as a commit or checksum: false) vote for their value, and a value whose
votes agree labels all its occurrences, also those whose own neighbours say nothing (where
they differ, an occurrence has its own vote or no label). The
training sample takes distinct pairs of value and features, so a value that fills the corpus
counts once for each of its contexts; equal hashes are ordered by the features.

Null text gives no findings; repeated rows are scanned alike; an empty table gives no rows.
A table without candidates of both labels has no forest: then the seed rule alone decides.
``scan`` adds the column ``_findings`` (a caller's column of that name is replaced); all other
columns pass through under whatever name.
"""

from __future__ import annotations

from pyspark.ml.classification import RandomForestClassifier
from pyspark.ml.functions import array_to_vector
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from statweave.llm.base import Renamed
from statweave.plans.staging import stage_table

SECRET_WORDS = "token secret password passwd pwd passphrase apikey api_key access_key private_key auth credential bearer"
HARMLESS_WORDS = "commit sha sha1 sha256 md5 hash checksum digest uuid guid revision etag integrity example sample dummy test"
# Common words of identifiers and of text, for dictionary coverage.
DICTIONARY = (
    "about access account action address admin after all and any api app application are array auth base before "
    "buffer build button call case change char check class client code column command common config connection "
    "content context control count create current data date default delete description detail device document "
    "domain down each element end entry error event example field file filter first for format from function get "
    "group handler hash have header height html http image index info init input insert interface item key label "
    "language last length license line link list load local log main manager map message method mode model module "
    "name network new node not null number object open option order output package page parent param parse path "
    "point position process project property public query read record remove render report request reset resource "
    "response result return root row save schema script search section select send server service session set "
    "sheet size source start state status string style system table tag target task template test text that the "
    "this time title token tree type update url user utils value version view web width window with word write you"
)
FEATURES = (
    "length changes digits upper vowels distinct covered hex in_path named harmless assigned quoted test_path"
).split()


def _among(words: str) -> str:
    return "|".join(sorted(words.split(), key=lambda w: (-len(w), w)))


_RUN = r"A-Za-z0-9+/_\-"
_SET = rf"""(?:{_among(SECRET_WORDS)})["'`\]]{{0,2}}[ \t]{{0,8}}(?::=|=>|==|=|:)[ \t]{{0,8}}["'`]?"""
# Assigned to a secret name: up to a blank or quote; without a quote at the end, closing punctuation stays out.
ASSIGNED = (
    rf"""(?<=[=:> \t"'`])(?<=[=:>][ \t]{{0,8}}["'`]?)(?![=:>])(?=[^\s"'`]{{6}})(?<=(?i:{_SET}))(?![A-Za-z][A-Za-z0-9+.\-]{{0,20}}://)"""
    r"""(?:[^\s"'`]{6,}+(?=["'`])|[^\s"'`]{5,}[^\s"'`.,;)}\]]|[^\s"'`]{6,})"""
)
# user:password@host, with or without a scheme; a password ends at the last @ before the host.
USERINFO = (
    r"""(?<=:)(?<=(?:\A|[\s"'`/=])[A-Za-z0-9_.%+\-]{1,64}:|//:)(?<!(?i:mailto):)"""
    r"""[^\s"'`/]{6,}(?=@[A-Za-z0-9\[])"""
)
# Runs joined by single dots are one candidate when one of them has 16 characters; up to two = are padding unless a value follows.
TOKEN = (
    rf"(?<![{_RUN}])(?<![{_RUN}]\.)(?=(?:[{_RUN}]++\.)*?[{_RUN}]{{16}})[{_RUN}]++(?:\.[{_RUN}]++)*+"
    r"""(?:={1,2}+(?![^\s"'`,;)}\]]))?"""
)
CANDIDATE = f"{ASSIGNED}|{USERINFO}|{TOKEN}"


def _share(text: Column, kept: str) -> Column:
    """Share of characters outside the class ``kept`` removed."""
    return F.length(F.regexp_replace(text, kept, "")) / F.length(text)


def coverage(value: Column, dictionary: str) -> Column:
    """Share of characters inside words of the dictionary."""
    return 1 - F.length(F.regexp_replace(F.lower(value), _among(dictionary), "")) / F.length(value)


def frequent_words(docs: DataFrame, text: str = "text", most: int = 200, least: int = 50) -> str:
    """The corpus's most frequent words of four to twelve ASCII letters, counted over all texts, with at least ``least`` occurrences."""
    words = docs.select(F.explode(F.split(F.lower(F.col(text).cast("string")), "[^a-z]+")).alias("word"))
    counted = words.where(F.length("word").between(4, 12)).groupBy("word").count()
    counted = counted.where(F.col("count") >= least)
    return " ".join(r["word"] for r in counted.orderBy(F.desc("count"), "word").limit(most).collect())


def features(value: Column, before: Column, after: Column, path: Column) -> dict[str, Column]:
    classes = F.regexp_replace(
        F.regexp_replace(F.regexp_replace(F.regexp_replace(value, "[a-z]+", "l"), "[A-Z]+", "U"), "[0-9]+", "d"),
        r"[+/_\-=]+",
        "s",
    )
    near = F.lower(before)
    yes = lambda c: F.coalesce(c.cast("double"), F.lit(0.0))
    return {
        "length": F.length(value).cast("double"),
        "changes": F.length(classes) / F.length(value),
        "digits": _share(value, "[^0-9]"),
        "upper": _share(value, "[^A-Z]"),
        "vowels": _share(value, "[^aeiouAEIOU]"),
        "distinct": F.size(F.array_distinct(F.split(value, ""))) / F.length(value),
        "covered": coverage(value, DICTIONARY),
        "hex": yes(value.rlike("^[0-9a-fA-F]+$")),
        "in_path": yes(before.rlike(r"[/\\.:]$") | after.rlike(r"^[/\\.]?[A-Za-z0-9]") | value.contains("/") | value.rlike(r"^[A-Za-z_\-]{1,15}\.|\.[A-Za-z_\-]{1,15}(\.|$)")),
        "named": yes(
            near.rlike(rf"(({_among(SECRET_WORDS)})\W{{0,8}}|{_SET}|//[^\s:/@]*:)$")
            | F.lower(value).rlike(rf"({_among(SECRET_WORDS)})\.[^.]+$")
        ),
        "harmless": yes(near.rlike(rf"\b({_among(HARMLESS_WORDS)})\W{{0,8}}$")),
        "assigned": yes(before.rlike(r"""[=:]\s*["'`]?$""")),
        "quoted": yes(before.rlike(r"""["'`]$""") & after.rlike(r"""^["'`]""")),
        "test_path": yes(path.rlike("(?i)test|example|sample|mock|fixture")),
    }


FEW = 30
SPAN = 128  # entries of a block of the running sum of lengths
LEAST = 6  # characters of the shortest candidate


def with_candidates(
    docs: DataFrame, text: str = "text", path: str | None = "source", context: int = 40, dictionary: str | None = None
) -> DataFrame:
    """Add ``_found``: an array of (start, value, features); start counts code points from 0.

    The ``context`` characters before and after a candidate may hold other candidates. Every
    array is built in one go over its entries: the text's pieces (between, value, between, …),
    their ends of ``context`` characters, and running sums of their lengths by blocks.
    """
    whole = F.coalesce(F.col(text).cast("string"), F.lit(""))
    place = F.coalesce(F.col(path).cast("string"), F.lit("")) if path else F.lit("")
    none = F.array().cast("array<string>")
    df = docs.withColumn("_place", place)
    df = df.withColumn("_values", F.when(whole.rlike(CANDIDATE), F.regexp_extract_all(whole, F.lit(CANDIDATE), F.lit(0))).otherwise(none))
    some = F.size("_values") > 0
    df = df.withColumn("_between", F.when(some, F.split(whole, CANDIDATE, -1)).otherwise(none))
    pairs = F.transform("_values", lambda v, i: F.array(F.get("_between", i), v))
    df = df.withColumn("_pieces", F.when(some, F.concat(F.flatten(pairs), F.array(F.element_at("_between", -1)))).otherwise(none))
    df = df.withColumns(
        {
            "_tails": F.transform("_pieces", lambda p: F.substring(p, -context, context)),
            "_heads": F.transform("_pieces", lambda p: F.substring(p, 1, context)),
            "_sizes": F.transform("_pieces", lambda p: F.length(p).cast("bigint")),
        }
    )
    total = lambda array: F.aggregate(array, F.lit(0).cast("bigint"), lambda acc, x: acc + x)
    blocks = F.sequence(F.lit(0), F.floor((F.size("_sizes") - 1) / SPAN).cast("int"))
    sums = F.transform(blocks, lambda b: total(F.slice("_sizes", b * SPAN + 1, F.lit(SPAN))))
    # columns that a lambda reads are named twice, so that they are not computed again inside it
    df = df.withColumn("_sums", F.when(F.size("_sizes") > 0, sums).otherwise(F.array().cast("array<bigint>")))
    before_block = F.transform("_sums", lambda s, b: total(F.slice("_sums", F.lit(1), b)))
    df = df.withColumn("_starts", F.when(F.size("_sums") > 0, before_block).otherwise(F.array().cast("array<bigint>")))
    reach = 2 * (context // LEAST + 1)

    def found(value: Column, i: Column) -> Column:
        at = 2 * i + 1  # the value's place among the pieces, from 0; the text before it is one place earlier
        block = F.floor(at / SPAN).cast("int")
        first = F.greatest(at - reach, F.lit(1))
        return F.struct(
            (F.get("_starts", block) + total(F.slice("_sizes", block * SPAN + 1, at - block * SPAN))).alias("start"),
            value.alias("value"),
            F.substring(F.array_join(F.slice("_tails", first, at - first + 1), ""), -context, context).alias("before"),
            F.substring(F.array_join(F.slice("_heads", at + 2, F.lit(reach + 1)), ""), 1, context).alias("after"),
        )

    empty = F.array().cast("array<struct<start:bigint,value:string,before:string,after:string>>")
    ready = some & (F.size("_starts") > 0) & (F.size("_sizes") > 0) & (F.size("_tails") > 0) & (F.size("_heads") > 0)
    df = df.withColumn("_raw", F.when(ready, F.transform("_values", found)).otherwise(empty))

    def featured(c: Column) -> Column:
        named = features(c["value"], c["before"], c["after"], F.col("_place"))
        if dictionary:
            named["covered"] = coverage(c["value"], dictionary)
        return F.struct(
            c["start"].alias("start"), c["value"].alias("value"), F.struct(*[x.alias(n) for n, x in named.items()]).alias("f")
        )

    return df.withColumn("_found", F.transform("_raw", featured)).drop(
        "_values", "_between", "_place", "_pieces", "_tails", "_heads", "_sizes", "_sums", "_starts", "_raw"
    )


def seed_labels(value: Column, f: Column) -> Column:
    """1, 0 or null by rule."""
    plain = value.rlike(r"^[A-Za-z_.\-]+=*$") | value.rlike(r"^[0-9_.\-]+=*$")
    filled_in = value.rlike(r"^(\$\{|\$\(|\{\{|<|%[({])|^[A-Za-z_][A-Za-z0-9_.]*[(\[]")
    return (
        F.when((f["harmless"] == 1) | plain | filled_in | (f["covered"] > 0.5), 0)
        .when((f["named"] == 1) & (f["digits"] > 0), 1)
        .when(value.rlike("^(AKIA|ASIA)[A-Z0-9]{16}$|^gh[pousr]_[A-Za-z0-9]{30,}$|^xox[abp]-|^sk_live_|^eyJ[A-Za-z0-9_-]+[.][A-Za-z0-9_-]+[.]"), 1)
        .when((f["in_path"] == 1) & (f["covered"] > 0.2), 0)
    )


def fit_forest(labelled: DataFrame, trees: int = 15, depth: int = 5, seed: int = 7):
    """A function from a feature struct to the mean leaf probability; None with one label only.

    ``labelled`` has the columns of FEATURES and ``label``. Both labels weigh the same, so
    that a few distinct secrets are not outvoted by many kinds of false findings. With fewer
    than ``FEW`` findings of a label the trees differ by their features only, since resampled
    rows would leave many trees without that label.
    """
    data = labelled.select(
        array_to_vector(F.array(*[F.col(n).cast("double") for n in FEATURES])).alias("_v"),
        F.col("label").cast("double").alias("_l"),
    )
    many = {r["_l"]: r["count"] for r in data.groupBy("_l").count().collect()}
    if len(many) < 2:
        return None
    weight = F.when(F.col("_l") == 1, sum(many.values()) / (2 * many.get(1.0, 1))).otherwise(sum(many.values()) / (2 * many.get(0.0, 1)))
    estimator = RandomForestClassifier(featuresCol="_v", labelCol="_l", weightCol="_w", numTrees=trees, maxDepth=depth, seed=seed, bootstrap=min(many.values()) >= FEW)
    model = estimator.fit(data.withColumn("_w", weight))

    def read(node) -> tuple:
        if node.numDescendants() == 0:
            stats = list(node.impurityStats().stats())
            return (stats[1] / max(sum(stats), 1e-12),)
        split = node.split()
        return FEATURES[split.featureIndex()], split.threshold(), read(node.leftChild()), read(node.rightChild())

    forest = [read(tree.rootNode()) for tree in model._java_obj.trees()]

    def column(node: tuple, f: Column) -> Column:
        if len(node) == 1:
            return F.lit(float(node[0]))
        name, threshold, left, right = node
        return F.when(f[name] <= threshold, column(left, f)).otherwise(column(right, f))

    def score(f: Column) -> Column:
        total = column(forest[0], f)
        for tree in forest[1:]:
            total = total + column(tree, f)
        return total / len(forest)

    return score


def labelled_findings(found: DataFrame) -> DataFrame:
    """Distinct (value, features) with ``label``: that of the value, or the own vote where a value's votes differ."""
    each = found.select(F.explode("_found").alias("c")).select("c.value", "c.f.*", seed_labels(F.col("c.value"), F.col("c.f")).alias("vote"))
    contexts = stage_table(each.distinct())
    votes = contexts.where("vote IS NOT NULL").groupBy("value").agg(F.min("vote").alias("_low"), F.max("vote").alias("_high"))
    label = F.when(F.col("_low") == F.col("_high"), F.col("_low")).otherwise(F.col("vote"))
    return contexts.join(votes, "value").withColumn("label", label).where("label IS NOT NULL").drop("vote", "_low", "_high")


def training_findings(found: DataFrame, per_label: int = 5000) -> DataFrame:
    """At most ``per_label`` labelled findings of each label, chosen by the hash of their value."""
    each = labelled_findings(found)
    parts = [
        each.where(F.col("label") == label).orderBy(F.xxhash64("value"), "value", *FEATURES).limit(per_label) for label in (0, 1)
    ]
    return parts[0].unionByName(parts[1]).drop("value")


def held_out_figures(found: DataFrame, per_label: int = 5000, threshold: float = 0.5) -> DataFrame:
    """One row n, positive, precision, recall: a forest fitted on four fifths of the values, judged on the others."""
    found = stage_table(found.select("_found"))
    each = stage_table(labelled_findings(found).withColumn("_fold", F.pmod(F.xxhash64("value", F.lit(11)), F.lit(5))))
    parts = [each.where((F.col("_fold") > 0) & (F.col("label") == label)).orderBy(F.xxhash64("value"), "value", *FEATURES).limit(per_label) for label in (0, 1)]
    forest = fit_forest(parts[0].unionByName(parts[1]))
    score = forest(F.struct(*FEATURES)) if forest else F.lit(0.0)
    said, real = score >= threshold, F.col("label") == 1
    return each.where("_fold = 0").agg(
        F.count("*").alias("n"),
        F.count_if(real).alias("positive"),
        F.try_divide(F.count_if(said & real), F.count_if(said)).alias("precision"),
        F.try_divide(F.count_if(said & real), F.count_if(real)).alias("recall"),
    )


def _judged(docs: DataFrame, text: str, path: str | None, kept: list[str], labelled: DataFrame | None, threshold: float) -> DataFrame:
    """The columns ``kept`` of ``docs``, staged, with ``_findings``."""
    found = stage_table(with_candidates(docs, text, path, dictionary=f"{DICTIONARY} {frequent_words(docs, text)}").select(*kept, "_found"))
    forest = fit_forest(labelled if labelled is not None else stage_table(training_findings(found)))
    by_rule = lambda value, f: F.coalesce(seed_labels(value, f), F.lit(0)).cast("double")

    def finding(c: Column) -> Column:
        score = forest(c["f"]) if forest else by_rule(c["value"], c["f"])
        return F.struct(
            c["start"].alias("start"), F.length(c["value"]).alias("length"), c["value"].alias("value"), score.alias("score")
        )

    judged = found.withColumn("_findings", F.transform("_found", finding)).drop("_found")
    return judged.withColumn("_findings", F.transform("_findings", lambda x: x.withField("secret", x["score"] >= threshold)))


def scan(
    docs: DataFrame,
    text: str = "text",
    path: str | None = "source",
    labelled: DataFrame | None = None,
    threshold: float = 0.5,
    keep_text: bool = True,
) -> DataFrame:
    """``docs`` (without ``text`` if it is not to be kept) with ``_findings``: an array of (start, length, value, score, secret)."""
    own = Renamed(docs)
    names = [n for n in own.names if n != "_findings" and (keep_text or n != text)]
    judged = _judged(own.df, own.name(text), own.name(path) if path else None, [own.name(n) for n in names], labelled, threshold)
    return judged.toDF(*names, "_findings")


def redact(
    docs: DataFrame,
    text: str = "text",
    path: str | None = "source",
    mark: str = "[secret]",
    labelled: DataFrame | None = None,
    threshold: float = 0.5,
) -> DataFrame:
    """``docs`` with every secret replaced by ``mark``; the same columns, all rows kept."""
    own = Renamed(docs)
    place = own.name(path) if path in docs.columns else None
    judged = _judged(own.df, own.name(text), place, own.safe, labelled, threshold)
    whole = F.col(own.name(text))
    # only a text with a secret is cut again: its pieces between candidates and, in turn, the mark or the value
    some = F.exists("_findings", lambda x: x["secret"])
    cut = judged.withColumn("_between", F.when(some, F.split(whole, CANDIDATE, -1)))
    told = F.transform("_findings", lambda x, i: F.concat(F.get("_between", i), F.when(x["secret"], F.lit(mark)).otherwise(x["value"])))
    rebuilt = F.concat(F.array_join(told, ""), F.element_at("_between", -1))
    return own.back(cut.withColumn(own.name(text), F.when(F.col("_between").isNotNull(), rebuilt).otherwise(whole)))
