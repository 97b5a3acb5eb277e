r"""Chat formatting in budgeted windows.

A turn is written ``<s>role\ntext</s>``. Control strings inside a text get a backslash after
their first character (one more if there are some), so no text can open or close a turn and
every text comes back exactly; roles are percent-encoded.

Windows are turn-aligned. A running sum of turn tokens over the conversation gives each turn
its span: turns that begin in the same half budget share one, a turn of more than half the
budget has one of its own, so a span never exceeds the budget unless it is a single turn. A
window is the system turn (if the conversation opens with one), at most ``HISTORY_TURNS``
turns before the span that fit ``HISTORY_TOKENS``, and the span. Loss is on the texts of
assistant turns of the span alone: repeated turns, system and user turns are masked, so each
assistant text is learned once.

Everything is DataFrame functions. Turns of a conversation are ordered within one task; a
conversation comes together in one row only where a digest of all of it is asked for.

Defined cases: a null text or role is empty; turns are ordered by number (null first), then
role, then text, and repeated rows are turns of their own; rows with a null ``conv_id`` are
one conversation; an empty table gives no rows; other columns are ignored.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window, functions as F

from gable.llm.common import read, settled, words
from gable.runtime import stage

#: Tokens of a span, and tokens and turns of history before it. A token is a word; a turn costs two more.
BUDGET, HISTORY_TOKENS, HISTORY_TURNS, TURN_COST = 512, 128, 2, 2

_CORE = r"(/?s>|/?INST\])"


def escaped(text: str) -> str:
    return rf"regexp_replace({text}, r'(<|\[)(\\*){_CORE}', r'$1\\$2$3')"


def unescaped(text: str) -> str:
    return rf"regexp_replace({text}, r'(<|\[)\\(\\*){_CORE}', '$1$2$3')"


#: Characters of a role that are percent-encoded, the percent sign first.
_ROLE = (("%", "%25"), ("\n", "%0A"), ("<", "%3C"), ("[", "%5B"))


def coded_role(role: Column) -> Column:
    for plain, code in _ROLE:
        role = F.replace(role, F.lit(plain), F.lit(code))
    return role


def plain_role(role: Column) -> Column:
    for plain, code in reversed(_ROLE):
        role = F.replace(role, F.lit(code), F.lit(plain))
    return role


def spans(conversations: DataFrame, budget: int = BUDGET) -> DataFrame:
    """Each turn with its place ``seq``, its span ``win``, whether it opens the span, and the tokens before it."""
    half = budget // 2
    rows = conversations.select(
        F.col("conv_id").cast("long").alias("conv_id"), "turn", F.coalesce("role", F.lit("")).alias("role"), F.coalesce("text", F.lit("")).alias("text")
    )
    rows = settled(rows, tokens=F.size(words(F.col("text"))) + F.lit(TURN_COST), __t=F.expr(escaped("text")), __r=coded_role(F.col("role")))
    order = Window.partitionBy("conv_id").orderBy(F.col("turn").asc_nulls_first(), "role", "text")
    upto = order.rowsBetween(Window.unboundedPreceding, 0)
    rows = rows.select(
        "*", F.row_number().over(order).alias("seq"), (F.sum("tokens").over(upto) - F.col("tokens")).alias("before"),
        F.sum((F.col("tokens") > half).cast("int")).over(upto).alias("bigs"),
    )
    rows = rows.withColumn("key", F.expr(f"struct(bigs, tokens > {half} AS big, before div {half} AS part)"))
    again = Window.partitionBy("conv_id").orderBy("seq")
    rows = rows.withColumn("opens", F.coalesce(F.col("key") != F.lag("key").over(again), F.lit(True)))
    rows = rows.withColumn("win", F.sum(F.col("opens").cast("long")).over(again.rowsBetween(Window.unboundedPreceding, 0)))
    return rows.drop("key", "bigs", "turn")


def formatted(conversations: DataFrame, budget: int = BUDGET) -> DataFrame:
    """``conv_id, window, text, n_context, loss``: one row for each window.

    ``n_context`` turns at its start are repeated; ``loss`` holds the stretches (start, end
    in code points) of ``text`` that are learned.
    """
    turns = spans(conversations, budget)
    ahead = Window.partitionBy("conv_id").orderBy("seq")
    whole = Window.partitionBy("conv_id")
    repeats = []
    for j in range(1, HISTORY_TURNS + 1):
        fits = (F.lead("before", j).over(ahead) - F.col("before")) <= HISTORY_TOKENS
        repeats.append(F.when(F.lead("opens", j).over(ahead) & fits, F.lead("win", j).over(ahead)))
    turns = turns.select("*", F.array_compact(F.array(*repeats)).alias("history"), F.max("win").over(whole).alias("last"))
    system = "(seq = 1 AND role = 'system')"
    copies = f"CASE WHEN {system} THEN CASE WHEN last > 1 THEN transform(sequence(2L, last), w -> struct(w AS win, 0 AS kind)) ELSE array() END ELSE transform(history, w -> struct(w AS win, 1 AS kind)) END"
    turns = settled(turns, __in=f"concat(array(struct(win AS win, 2 AS kind)), {copies})")
    placed = turns.select("conv_id", "seq", F.col("role"), F.col("__r"), F.col("__t"), F.explode_outer("__in").alias("at"))
    item = "struct(at.kind AS kind, seq, concat('<s>', __r, '\\n') AS head, __t AS body, at.kind = 2 AND role = 'assistant' AS learn)"
    grouped = placed.groupBy("conv_id", F.col("at.win").alias("window")).agg(F.array_sort(F.collect_list(F.expr(item))).alias("items"))
    grouped = settled(grouped, __ends="aggregate(items, array(0L), (a, x) -> concat(a, array(element_at(a, -1) + length(x.head) + length(x.body) + 4)))")
    stretches = "transform(items, (x, i) -> struct(__ends[i] + length(x.head) AS start, __ends[i] + length(x.head) + length(x.body) AS end, x.learn AS learn))"
    return grouped.select(
        "conv_id", "window", F.expr("array_join(transform(items, x -> concat(x.head, x.body, '</s>')), '')").alias("text"),
        F.expr("size(filter(items, x -> x.kind < 2))").alias("n_context"),
        F.expr(f"transform(filter({stretches}, x -> x.learn), x -> struct(x.start AS start, x.end AS end))").alias("loss"),
    )


def parsed(windows: DataFrame) -> DataFrame:
    """Adds ``turns`` (role and text of the turns that are not repeated) and ``learned`` (texts under the loss mask)."""
    cut = settled(windows, __p="slice(split(text, '</s>'), n_context + 1, greatest(size(split(text, '</s>')) - 1 - n_context, 0))")
    turns = F.transform(
        "__p",
        lambda x: F.struct(
            plain_role(F.substring_index(x, "\n", 1).substr(F.lit(4), F.length(x))).alias("role"),
            x.substr(F.length(F.substring_index(x, "\n", 1)) + 2, F.length(x)).alias("text"),
        ),
    )
    read_ = settled(cut, __q=turns)
    learned = f"transform(loss, x -> {unescaped('substring(text, cast(x.start AS int) + 1, cast(x.end - x.start AS int))')})"
    return read_.select(*windows.columns, F.expr(f"transform(__q, x -> struct(x.role AS role, {unescaped('x.text')} AS text))").alias("turns"), F.expr(learned).alias("learned"))


def digests(windows: DataFrame) -> DataFrame:
    """One row for each conversation, from its windows alone."""
    rows = parsed(windows).select(
        "conv_id", "window", F.expr("array_join(transform(turns, x -> concat(x.role, '\\n', x.text, '\\n')), '')").alias("said"),
        F.expr("array_join(learned, '')").alias("learned"), F.size("turns").cast("long").alias("n"), F.length("text").cast("long").alias("chars"),
    )
    whole = rows.groupBy("conv_id").agg(F.array_sort(F.collect_list(F.struct("window", "said", "learned"))).alias("w"), F.sum("n").alias("n_turns"), F.sum("chars").alias("formatted_chars"))
    whole = settled(whole, __said="array_join(transform(w, x -> x.said), '')", __learned="array_join(transform(w, x -> x.learned), '')")
    return whole.select(
        "conv_id", "n_turns", F.sha2("__said", 256).alias("turns_sha256"), F.length("__learned").cast("long").alias("loss_chars"),
        F.sha2("__learned", 256).alias("loss_sha256"), "formatted_chars",
    )


def op6_chat_windows(spark, folder: str) -> DataFrame:
    said = "</s>[INST] ok [/INST]"
    extra = spark.range(2).select(
        F.lit(-1).cast("long").alias("conv_id"), F.col("id").alias("turn"), F.when(F.col("id") == 0, "user").otherwise("assistant").alias("role"), F.lit(said).alias("text")
    )
    conversations = read(spark, folder, "conversations").select("conv_id", F.col("turn").cast("long").alias("turn"), "role", "text")
    return digests(stage(formatted(conversations.unionByName(extra)), "windows"))
