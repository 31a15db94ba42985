"""Chat formatting by prefix-target expansion, in DataFrame functions only.

Template of a turn: ``<|im_start|>role\\ntext<|im_end|>\\n``. Inside roles and
texts a backslash becomes ``\\s`` and ``<|`` becomes ``<\\|`` (a line feed in a
role becomes ``\\n``), so no control string can appear there and the change is
undone exactly by reading it backwards.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

OPEN, CLOSE = "<|im_start|>", "<|im_end|>\n"


def escape(text: Column) -> Column:
    return F.replace(F.replace(text, F.lit("\\"), F.lit("\\s")), F.lit("<|"), F.lit("<\\|"))


def unescape(text: Column) -> Column:
    return F.replace(F.replace(text, F.lit("<\\|"), F.lit("<|")), F.lit("\\s"), F.lit("\\"))


def escape_role(role: Column) -> Column:
    return F.replace(escape(role), F.lit("\n"), F.lit("\\n"))


def unescape_role(role: Column) -> Column:
    return unescape(F.replace(role, F.lit("\\n"), F.lit("\n")))


def render(role: Column, text: Column) -> Column:
    """One turn under the template."""
    return F.concat(F.lit(OPEN), escape_role(role), F.lit("\n"), escape(text), F.lit(CLOSE))


def prefix_examples(
    conversations: DataFrame, conv: str = "conv_id", turn: str = "turn", role: str = "role", text: str = "text", trained: str = "assistant"
) -> DataFrame:
    """One example for each reply, with all that precedes it as context.

    Columns: the conversation's key, ``example`` (from 0), ``n_turns`` of the
    example, ``content`` (the whole rendered example), ``loss_start`` and
    ``loss_chars`` (code points; the reply's text, without its header and its
    end mark, is all that is trained on), ``last`` (the conversation's longest
    example). Turns after the last reply, or a conversation without a reply,
    make one more example with ``loss_chars`` null, so nothing is lost.

    Turns are ordered by (turn, role, text), nulls first; repeated rows are
    repeated turns. A null text or role is empty; rows with a null key form a
    conversation of their own; other columns are ignored. An empty table gives
    no rows. A conversation is one value of its result, so it is held by one
    task, as any text is; its rows may otherwise lie anywhere.
    """
    said = F.struct(
        F.col(turn).alias("turn"), F.coalesce(F.col(role), F.lit("")).alias("role"), F.coalesce(F.col(text), F.lit("")).alias("text")
    )
    whole = (
        conversations.select(F.col(conv).alias("_key"), said.alias("_said"))
        .groupBy("_key")
        .agg(F.sort_array(F.collect_list("_said")).alias("_turns"))
        # Each turn is rendered once; examples are prefixes of the whole.
        .withColumn("_parts", F.transform("_turns", lambda t: render(t["role"], t["text"])))
        .withColumn("_n", F.size("_turns"))
    )
    ends = F.aggregate(
        F.transform("_parts", F.length),
        F.array(F.lit(0)),
        lambda done, n: F.concat(done, F.array(F.element_at(done, -1) + n)),
    )
    replies = F.filter(F.sequence(F.lit(0), F.col("_n") - 1), lambda i: F.get("_turns", i)["role"] == trained)
    targets = F.when(
        (F.size("_replies") > 0) & (F.element_at("_replies", -1) == F.col("_n") - 1), F.col("_replies")
    ).otherwise(F.concat("_replies", F.array(F.col("_n") - 1)))
    at = F.get("_turns", F.col("_at"))
    end = F.get("_ends", F.col("_at") + 1)
    is_reply = at["role"] == trained
    loss = F.length(escape(at["text"]))
    return (
        whole.withColumn("_ends", ends)
        .withColumn("_replies", replies)
        .withColumn("_content", F.array_join("_parts", ""))
        .select("_key", "_turns", "_ends", "_content", "_n", F.posexplode(targets).alias("_example", "_at"))
        .select(
            F.col("_key").alias(conv),
            F.col("_example").alias("example"),
            (F.col("_at") + 1).alias("n_turns"),
            F.substring(F.col("_content"), F.lit(1), end).alias("content"),
            F.when(is_reply, end - len(CLOSE) - loss).alias("loss_start"),
            F.when(is_reply, loss).alias("loss_chars"),
            (F.col("_at") == F.col("_n") - 1).alias("last"),
        )
    )


def read_turns(content: Column) -> Column:
    """The turns of a rendered text, as an array of (role, text), unescaped."""
    pieces = F.filter(F.split(content, "<\\|im_start\\|>"), lambda p: p != "")
    bare = F.transform(pieces, lambda p: F.substring(p, F.lit(1), F.length(p) - len(CLOSE)))
    # The header ends at the first line feed; later ones belong to the text.
    return F.transform(
        bare,
        lambda p: F.struct(
            unescape_role(F.substring_index(p, "\n", 1)).alias("role"),
            unescape(F.substring(p, F.length(F.substring_index(p, "\n", 1)) + 2, F.length(p))).alias("text"),
        ),
    )


def conversation_digests(examples: DataFrame, conv: str = "conv_id") -> DataFrame:
    """What each conversation says and trains on, read back from its examples."""
    turns = F.transform(read_turns(F.col("content")), lambda t: F.concat(t["role"], F.lit("\n"), t["text"], F.lit("\n")))
    mask = F.when(
        F.col("loss_chars").isNotNull(), unescape(F.substring(F.col("content"), F.col("loss_start") + 1, F.col("loss_chars")))
    )
    # Each example is reduced to its reply before anything is gathered.
    read = examples.select(
        conv,
        "example",
        F.length("content").cast("long").alias("_chars"),
        mask.alias("_loss"),
        F.when(F.col("last"), F.col("n_turns")).alias("_n"),
        F.when(F.col("last"), F.sha2(F.array_join(turns, "").cast("binary"), 256)).alias("_sha"),
    )
    return (
        read.groupBy(conv)
        .agg(
            F.max("_n").cast("long").alias("n_turns"),
            F.max("_sha").alias("turns_sha256"),
            F.array_join(F.transform(F.sort_array(F.collect_list(F.struct("example", "_loss"))), lambda x: F.coalesce(x["_loss"], F.lit(""))), "").alias("_all"),
            F.sum("_chars").alias("formatted_chars"),
        )
        .select(
            conv,
            "n_turns",
            "turns_sha256",
            F.length("_all").cast("long").alias("loss_chars"),
            F.sha2(F.col("_all").cast("binary"), 256).alias("loss_sha256"),
            "formatted_chars",
        )
    )
