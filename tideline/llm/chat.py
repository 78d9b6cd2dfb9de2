"""Chat formatting (operator 8): conversations to budgeted training windows with a loss mask, in SQL functions only.

A rendered turn is ``<|role|>\\n`` + text + ``<|end|>\\n``. Role and text are escaped: a backslash is put after every
backslash and after the first character of every control string, so no control string survives inside a text and
taking each backslash away again gives the text back.

Prefix sums of the turns' tokens cut a conversation into windows of whole turns. Every window repeats the system turn
and the last few turns before it, as far as they fit into the history budget; repeated turns are context and never
under the loss mask, so that each assistant text is a target exactly once.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from tideline.llm.registry import query, table

END = "<|end|>\n"
# First characters of control strings of this and other common templates, and the backslash itself.
_ESCAPE = r"(\\|<(?=\||/?s>)|\|(?=>)|\[(?=/?INST\]))"


def escape(text: Column) -> Column:
    return F.regexp_replace(text, _ESCAPE, r"$1\\")


def unescape(text: Column) -> Column:
    return F.regexp_replace(text, r"(?s)\\(.)", "$1")


def byte_tokens(piece: Column) -> Column:
    """Tokens of a rendered turn, taken as one for every four UTF-8 bytes, rounded up."""
    return F.ceil(F.octet_length(piece) / 4).cast("bigint")


def chat_windows(
    turns: DataFrame, budget: int = 1024, history_tokens: int = 256, history_turns: int = 2, tokens=byte_tokens
) -> DataFrame:
    """One row per window: conv_id, window (from 0), n_turns, n_context, text, loss_spans, n_tokens, over_budget.

    ``turns`` has conv_id, turn, role, text; other columns are ignored. Turns go by ``turn`` (null first), then role
    and text. Null role or text: empty. A null conv_id is a conversation of its own. Repeated rows are turns like any
    other. No rows: no windows. The system turn is the first turn if its role is ``system``; it is a new turn in window
    0 and context in all others. With S its tokens and C = budget - S - history_tokens (at least budget / 4), the
    window of a turn is the slot of C / 2 tokens that its first token falls into; a turn of over C / 2 tokens has a
    window to itself, which is marked ``over_budget`` if it doesn't fit. Turns are never cut. ``loss_spans`` are (start,
    length) in code points of ``text``, one for every new assistant turn, over its escaped text.
    """
    conv = Window.partitionBy("conv_id").orderBy("turn", "role", "text")
    before = conv.rowsBetween(Window.unboundedPreceding, -1)
    so_far = conv.rowsBetween(Window.unboundedPreceding, 0)
    head = F.concat(F.lit("<|"), escape(F.col("role")), F.lit("|>\n"))
    rows = (
        turns.select("conv_id", "turn", *[F.coalesce(F.col(c), F.lit("")).alias(c) for c in ("role", "text")])
        .withColumn("pos", F.row_number().over(conv))
        .withColumn("_head", head)
        .withColumn("_body", escape(F.col("text")))
        .withColumn("piece", F.concat("_head", "_body", F.lit(END)))
        .withColumn("tokens", tokens(F.col("piece")))
        .withColumn("head_chars", F.length("_head"))
        .withColumn("body_chars", F.length("_body"))
        .withColumn("is_system", (F.col("pos") == 1) & (F.col("role") == "system"))
        .withColumn("system", F.first(F.when(F.col("is_system"), F.struct("piece", "tokens"))).over(so_far))
    )
    system_tokens = F.coalesce(F.col("system.tokens"), F.lit(0))
    room = F.greatest(F.lit(budget - history_tokens) - system_tokens, F.lit(max(4, budget // 4)))
    half = F.floor(room / 2)
    moved = F.when(F.col("is_system"), 0).otherwise(F.col("tokens"))
    rows = (
        rows.withColumn("half", half)
        .withColumn("start", F.coalesce(F.sum(moved).over(before), F.lit(0)))
        .withColumn("large", ~F.col("is_system") & (F.col("tokens") > F.col("half")))
        .withColumn("larges", F.sum(F.col("large").cast("int")).over(so_far))
        .withColumn("slot", F.struct(F.floor(F.col("start") / F.col("half")).alias("at"), "larges", "large"))
        .withColumn("chars_before", F.coalesce(F.sum(F.length("piece")).over(before), F.lit(0)))
    )
    changed = F.coalesce(F.lag("slot").over(conv) != F.col("slot"), F.lit(False))
    # The system turn has its slot with the turn after it.
    changed = changed & ~F.coalesce(F.lag("is_system").over(conv), F.lit(False))
    rows = rows.withColumn("first", changed).withColumn("window", F.sum(F.col("first").cast("int")).over(so_far))
    no_turns = F.array().cast("array<struct<piece:string,tokens:bigint>>")
    said = F.when(~F.col("is_system"), F.struct("piece", "tokens"))
    past = F.array(*[F.lag(said, k).over(conv) for k in range(1, history_turns + 1)]) if history_turns else no_turns
    rows = rows.withColumn("past", F.when(F.col("first"), past))
    turn = F.struct("pos", "piece", "head_chars", "body_chars", "chars_before", (F.col("role") == "assistant").alias("target"), "tokens")
    grouped = rows.groupBy("conv_id", "window").agg(
        F.sort_array(F.collect_list(turn)).alias("turns"),
        F.first("past", ignorenulls=True).alias("past"),
        F.first("system").alias("system"),
    )
    # Nearest first, as long as all nearer ones fit too; then in their own order.
    used, fits, kept = F.lit(0).cast("bigint"), F.lit(True), []
    for k in range(history_turns):
        item = F.get(F.col("past"), F.lit(k))
        used = used + item["tokens"]
        fits = fits & F.coalesce(used <= history_tokens, F.lit(False))
        kept.append(F.when(fits, item))
    system = F.when((F.col("window") > 0) & F.col("system").isNotNull(), F.array("system")).otherwise(no_turns)
    context = F.concat(system, F.reverse(F.array_compact(F.array(*kept)))) if kept else system
    pieces = lambda xs: F.array_join(F.transform(xs, lambda x: x["piece"]), "")
    total = lambda xs: F.aggregate(xs, F.lit(0).cast("bigint"), lambda a, x: a + x["tokens"])
    out = (
        grouped.withColumn("context", context)
        .withColumn("context_text", pieces(F.col("context")))
        .withColumn("base", F.length("context_text") - F.get("turns", F.lit(0))["chars_before"])
        .withColumn("n_tokens", total(F.col("context")) + total(F.col("turns")))
    )
    spans = F.transform(
        F.filter("turns", lambda t: t["target"]),
        lambda t: F.struct((F.col("base") + t["chars_before"] + t["head_chars"]).cast("bigint").alias("start"), t["body_chars"].cast("bigint").alias("length")),
    )
    return out.select(
        "conv_id",
        F.col("window").cast("bigint").alias("window"),
        F.size("turns").cast("bigint").alias("n_turns"),
        F.size("context").cast("bigint").alias("n_context"),
        F.concat("context_text", pieces(F.col("turns"))).alias("text"),
        spans.alias("loss_spans"),
        "n_tokens",
        (F.col("n_tokens") > budget).alias("over_budget"),
    )


def read_turns(windows: DataFrame) -> DataFrame:
    """Windows back to what they hold: their new turns (role, text) and the text under the loss mask, unescaped."""
    parts = F.split("text", r"<\|end\|>\n")
    new = F.slice(parts, F.col("n_context") + 1, F.size(parts) - 1 - F.col("n_context"))

    def turn(part: Column) -> Column:
        head = F.substring_index(part, "|>\n", 1)
        return F.struct(
            unescape(F.substr(head, F.lit(3))).alias("role"), unescape(F.substr(part, F.length(head) + 4)).alias("text")
        )

    loss = F.transform("loss_spans", lambda s: unescape(F.substr(F.col("text"), (s["start"] + 1).cast("int"), s["length"].cast("int"))))
    return windows.select(
        "conv_id", "window", F.transform(new, turn).alias("turns"), loss.alias("loss"), F.length("text").alias("chars")
    )


def chat_digest(windows: DataFrame) -> DataFrame:
    """Per conversation, read back from its windows: n_turns, turns_sha256, loss_chars, loss_sha256, formatted_chars."""
    line = lambda t: F.concat(t["role"], F.lit("\n"), t["text"], F.lit("\n"))
    read = read_turns(windows).select(
        "conv_id", "chars", F.size("turns").alias("n"),
        F.struct(
            "window", F.array_join(F.transform("turns", line), "").alias("turns"), F.array_join("loss", "").alias("loss")
        ).alias("part"),
    )
    whole = read.groupBy("conv_id").agg(
        F.sum("n").cast("bigint").alias("n_turns"), F.sum("chars").cast("bigint").alias("formatted_chars"),
        F.sort_array(F.collect_list("part")).alias("parts"),
    )
    joined = lambda name: F.array_join(F.transform("parts", lambda p: p[name]), "")
    return whole.select(
        "conv_id", "n_turns", F.sha2(joined("turns"), 256).alias("turns_sha256"),
        F.length(joined("loss")).cast("bigint").alias("loss_chars"), F.sha2(joined("loss"), 256).alias("loss_sha256"),
        "formatted_chars",
    )


@query("op8_chat_format")
def op8_chat_format(spark: SparkSession, sf_dir: str) -> DataFrame:
    said = "</s>[INST] ok [/INST]"
    probe = spark.range(2).select(
        F.lit(-1).cast("bigint").alias("conv_id"), F.col("id").alias("turn"),
        F.when(F.col("id") == 0, "user").otherwise("assistant").alias("role"), F.lit(said).alias("text"),
    )
    turns = table(spark, sf_dir, "conversations").select("conv_id", "turn", "role", "text").unionByName(probe)
    return chat_digest(chat_windows(turns))
