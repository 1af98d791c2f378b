"""Chat formatting: turn-aligned windows within a token budget, with a loss mask.

Native: only DataFrame expressions, windows and aggregations.

The budget holds for a whole window: the repeated system turn, the repeated history and the
window's own turns. A conversation's room is what the system turn and the history leave of the
budget (a system turn that leaves little halves the history first). Prefix sums of the turns' tokens choose the spans: a turn
of more than half the room is a span of its own; between such turns, those that end in the
same multiple of the room less the longest other turn form one span, which so fits into the
room. Only a window with a single turn of its own can exceed the budget. Every later window
repeats the system turn and the turns before it that start within the history; repeated
turns are outside the loss mask, so each assistant text is under the mask once.

Template: ``<|im_start|>role``, line break, text, ``<|im_end|>``, line break. In roles and
texts ``&`` is written ``&amp;`` and ``<|`` is written ``&lt;|``, and a line break in a role
``&nl;``, so a control string never comes from a text and everything reads back exactly.

Turns are ordered by turn, role, text. Null role or text reads as empty; a null
conversation id is a conversation of its own; repeated rows are turns of their own. An
empty table gives no rows. Only the four named columns are read.

One conversation is ordered in one (spilling) sort; its windows are independent rows.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

START, END = "<|im_start|>", "<|im_end|>"
MARKERS = 4  # tokens counted for the markers of a turn


def escaped(text: Column) -> Column:
    return F.replace(F.replace(text, F.lit("&"), F.lit("&amp;")), F.lit("<|"), F.lit("&lt;|"))


def unescaped(text: Column) -> Column:
    return F.replace(F.replace(text, F.lit("&lt;|"), F.lit("<|")), F.lit("&amp;"), F.lit("&"))


def escaped_role(role: Column) -> Column:
    return F.replace(escaped(role), F.lit("\n"), F.lit("&nl;"))


def unescaped_role(role: Column) -> Column:
    return unescaped(F.replace(role, F.lit("&nl;"), F.lit("\n")))


def turn_tokens(text: Column) -> Column:
    """Words of the text and its markers."""
    return F.regexp_count(text, F.lit(r"[^\x20\x09-\x0D]+")).cast("bigint") + MARKERS


def windows(conversations: DataFrame, budget: int = 512, history: int = 128) -> DataFrame:
    """One row per window: conv_id, window, repeated (turns outside the mask), formatted, loss.

    ``loss`` lists (start, length) in code points of ``formatted``: the escaped assistant
    texts of the window's own turns.
    """
    role, text = F.coalesce("role", F.lit("")), F.coalesce("text", F.lit(""))
    turns = conversations.select("conv_id", "turn", role.alias("role"), text.alias("text"))
    order = Window.partitionBy("conv_id").orderBy("turn", "role", "text")
    upto = order.rowsBetween(Window.unboundedPreceding, Window.currentRow)
    said = F.struct(escaped_role(F.col("role")).alias("role"), escaped(F.col("text")).alias("text"))
    counted = (
        turns.withColumn("tokens", turn_tokens(F.col("text")))
        .withColumns({"ends": F.sum("tokens").over(upto), "pos": F.row_number().over(order).cast("bigint")})
        .withColumn("starts", F.col("ends") - F.col("tokens"))
        .withColumn("said", said)
    )
    whole = order.rowsBetween(Window.unboundedPreceding, Window.unboundedFollowing)
    system_tokens = F.first(F.when(F.col("role") == "system", F.col("tokens")), ignorenulls=True).over(whole)
    sized = counted.withColumn("left", F.greatest(budget - F.coalesce(system_tokens, F.lit(0)), F.lit(0)))
    sized = sized.withColumn("history", F.least(F.lit(history).cast("bigint"), F.floor(F.col("left") / 2)))
    sized = sized.withColumn("room", F.greatest(F.col("left") - F.col("history"), F.lit(1)))
    sized = sized.withColumn("long", 2 * F.col("tokens") > F.col("room"))
    longest = F.max(F.when(~F.col("long"), F.col("tokens"))).over(whole)
    sized = sized.withColumns(
        {
            "longs": F.sum(F.col("long").cast("bigint")).over(upto),
            "cell": F.floor((F.col("ends") - 1) / (F.col("room") - F.coalesce(longest, F.lit(0)))),
        }
    )
    by_place = Window.partitionBy("conv_id").orderBy("starts")
    group = F.struct("longs", "long", "cell")
    opens = F.coalesce(F.lag(group).over(by_place) != group, F.lit(True))
    counted = sized.withColumn("opens", opens).withColumn(
        "span", F.sum(F.col("opens").cast("bigint")).over(by_place.rowsBetween(Window.unboundedPreceding, Window.currentRow))
    )
    before = by_place.rangeBetween(-history, -1)
    earlier = by_place.rangeBetween(Window.unboundedPreceding, -1)
    recent = F.collect_list(F.struct("pos", "said", "starts")).over(before)
    placed = counted.withColumns(
        {
            "system": F.first(F.when(F.col("role") == "system", F.struct("pos", "said")), ignorenulls=True).over(earlier),
            "near": F.when(F.col("opens"), recent),
        }
    )
    near = F.filter("near", lambda t: t["starts"] >= F.col("starts") - F.col("history"))
    placed = placed.withColumn("recent", F.transform(near, lambda t: F.struct(t["pos"].alias("pos"), t["said"].alias("said"))))
    none = F.array().cast(placed.schema["recent"].dataType)
    own_system = F.when(
        F.col("system").isNotNull() & ~F.exists("recent", lambda t: t["pos"] == F.col("system")["pos"]),
        F.array("system"),
    ).otherwise(none)
    context = F.when(F.col("opens"), F.concat(own_system, F.col("recent")))
    spans = (
        placed.withColumn("context", context)
        .groupBy("conv_id", "span")
        .agg(
            F.max("context").alias("context"),
            F.array_sort(F.collect_list(F.struct("pos", "said"))).alias("own"),
        )
    )
    lead = len(START) + 1
    written = lambda t: F.concat(F.lit(START), t["said"]["role"], F.lit("\n"), t["said"]["text"], F.lit(END + "\n"))
    full = spans.withColumn("turns", F.concat("context", "own")).withColumns(
        {"repeated": F.size("context"), "parts": F.transform("turns", written)}
    )
    # where each turn begins: a running sum of the lengths of the parts
    begins = F.aggregate(
        "parts",
        F.array(F.lit(0).cast("bigint")),
        lambda acc, p: F.concat(acc, F.array(F.element_at(acc, -1) + F.length(p))),
    )
    masks = F.transform(
        F.sequence(F.col("repeated"), F.size("turns") - 1),
        lambda i: F.when(
            F.get("turns", i)["said"]["role"] == "assistant",
            F.struct(
                (F.get("begins", i) + lead + F.length(F.get("turns", i)["said"]["role"])).alias("start"),
                F.length(F.get("turns", i)["said"]["text"]).alias("length"),
            ),
        ),
    )
    return full.withColumn("begins", begins).select(
        "conv_id",
        F.col("span").alias("window"),
        "repeated",
        F.concat_ws("", "parts").alias("formatted"),
        F.filter(masks, lambda m: m.isNotNull()).alias("loss"),
    )


def read_turns(written: DataFrame) -> DataFrame:
    """Back from the windows: conv_id, window, own turns (role, text), masked text, code points."""
    parts = F.slice(F.split("formatted", r"<\|im_start\|>"), 2, F.size(F.split("formatted", r"<\|im_start\|>")))
    own = F.slice(parts, F.col("repeated") + 1, F.size(parts))
    turn = lambda p: F.struct(
        unescaped_role(F.substring_index(p, "\n", 1)).alias("role"),
        unescaped(F.regexp_extract(p, r"(?s)^[^\n]*+\n(.*)<\|im_end\|>\n$", 1)).alias("text"),
    )
    masked = F.transform("loss", lambda m: unescaped(F.substring(F.col("formatted"), m["start"] + 1, m["length"])))
    return written.select(
        "conv_id",
        "window",
        F.transform(own, turn).alias("turns"),
        F.concat_ws("", masked).alias("masked"),
        F.length("formatted").cast("bigint").alias("chars"),
    )


def conversation_digests(written: DataFrame) -> DataFrame:
    """Digests per conversation of what the windows hold; a digest needs the whole text in one row."""
    told = lambda t: F.concat(t["role"], F.lit("\n"), t["text"], F.lit("\n"))
    piece = F.struct("window", F.concat_ws("", F.transform("turns", told)).alias("told"), "masked")
    grouped = (
        read_turns(written)
        .groupBy("conv_id")
        .agg(
            F.sum(F.size("turns")).cast("bigint").alias("n_turns"),
            F.array_sort(F.collect_list(piece)).alias("pieces"),
            F.sum("chars").alias("formatted_chars"),
        )
    )
    masked = F.concat_ws("", F.col("pieces.masked"))
    return grouped.select(
        "conv_id",
        "n_turns",
        F.sha2(F.concat_ws("", F.col("pieces.told")), 256).alias("turns_sha256"),
        F.length(masked).cast("bigint").alias("loss_chars"),
        F.sha2(masked, 256).alias("loss_sha256"),
        "formatted_chars",
    )
