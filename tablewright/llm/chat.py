"""Chat formatting by prefix-target expansion, in DataFrame functions only.

Every assistant turn becomes an example of its own: the turns before it are context, and only its text lies
under the loss mask. Turns after the last assistant turn (or a conversation without one) make one more
example with an empty mask, so that no turn is lost.

A turn is written `### role: text</turn>` and a line feed. In texts a backslash is doubled, `##` becomes
`#\\#` and `</turn>` becomes `<\\/turn>`, so neither `###` nor `</turn>` is left in them; roles are percent-encoded.
Dropping each backslash and keeping the character behind it restores a text.

Turns are ordered by number, then role, then text; null comes first. A null role or text is empty. Repeated
rows are repeated turns. Rows whose conversation is null form one conversation. Other columns are ignored.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

HEAD, BETWEEN, TAIL = "### ", ": ", "</turn>\n"


def escape(text: Column) -> Column:
    text = F.replace(text, F.lit("\\"), F.lit("\\\\"))
    text = F.replace(text, F.lit("##"), F.lit("#\\#"))
    return F.replace(text, F.lit("</turn>"), F.lit("<\\/turn>"))


def unescape(text: Column) -> Column:
    return F.regexp_replace(text, r"(?s)\\(.)", "$1")


def expand(conversations: DataFrame, trained_role: str = "assistant") -> DataFrame:
    """conv_id, example (from 1), formatted, loss_start, loss_length (code points of `formatted`), is_last."""
    turn = F.struct("turn", F.coalesce("role", F.lit("")).alias("role"), F.coalesce("text", F.lit("")).alias("text"))
    turns = conversations.groupBy("conv_id").agg(F.sort_array(F.collect_list(turn)).alias("turns"))
    # Each turn is escaped once; the examples are put together from the written turns.
    written = F.transform(
        "turns",
        lambda t: F.struct(
            F.concat(F.lit(HEAD), F.url_encode(t["role"]), F.lit(BETWEEN)).alias("head"),
            escape(t["text"]).alias("body"),
            (t["role"] == trained_role).alias("trained"),
        ),
    )
    numbered = turns.select("conv_id", written.alias("turns")).withColumn(
        "ends", F.filter(F.sequence(F.lit(1), F.size("turns")), lambda i: F.element_at("turns", i)["trained"] | (i == F.size("turns")))
    )
    example = numbered.select("conv_id", "turns", F.size("ends").alias("n"), F.posexplode("ends").alias("pos", "end"))
    whole = F.transform(F.slice("turns", F.lit(1), F.col("end")), lambda t: F.concat(t["head"], t["body"], F.lit(TAIL)))
    last = F.element_at("turns", F.col("end"))
    example = example.select(
        "conv_id",
        (F.col("pos") + 1).alias("example"),
        F.array_join(whole, "").alias("formatted"),
        last["body"].alias("body"),
        last["trained"].alias("trained"),
        (F.col("pos") + 1 == F.col("n")).alias("is_last"),
    )
    length = F.char_length("body")
    return example.select(
        "conv_id",
        "example",
        "formatted",
        (F.char_length("formatted") - len(TAIL) - length).alias("loss_start"),
        F.when(F.col("trained"), length).otherwise(0).alias("loss_length"),
        "is_last",
    )


def turns_of(formatted: Column) -> Column:
    """The (role, text) pairs that a formatted text holds."""
    parts = F.slice(F.split(formatted, TAIL), F.lit(1), F.size(F.split(formatted, TAIL)) - 1)

    def pair(part: Column) -> Column:
        colon = F.locate(BETWEEN, part)
        return F.struct(
            F.url_decode(F.substring(part, F.lit(len(HEAD) + 1), colon - len(HEAD) - 1)).alias("role"),
            unescape(F.substring(part, colon + len(BETWEEN), F.char_length(part))).alias("text"),
        )

    return F.transform(parts, pair)


def read_back(examples: DataFrame) -> DataFrame:
    """Per conversation what its examples hold: turns (of the longest), loss text in order, characters."""
    loss = unescape(F.substring(F.col("formatted"), F.col("loss_start") + 1, F.col("loss_length")))
    read = examples.select(
        "conv_id",
        "example",
        loss.alias("loss"),
        F.when(F.col("is_last"), turns_of(F.col("formatted"))).alias("turns"),
        F.char_length("formatted").cast("long").alias("chars"),
    )
    by = read.groupBy("conv_id").agg(
        F.max("turns").alias("turns"),
        F.sort_array(F.collect_list(F.struct("example", "loss"))).alias("losses"),
        F.sum("chars").alias("formatted_chars"),
    )
    return by.select("conv_id", "turns", F.array_join(F.transform("losses", lambda x: x["loss"]), "").alias("loss"), "formatted_chars")


def digests(conversations: DataFrame) -> DataFrame:
    """Number and digests of turns and loss text per conversation, read back from the formatted examples."""
    back = read_back(expand(conversations))
    lines = F.transform("turns", lambda t: F.concat(t["role"], F.lit("\n"), t["text"], F.lit("\n")))
    return back.select(
        "conv_id",
        F.size("turns").cast("long").alias("n_turns"),
        F.sha2(F.array_join(lines, ""), 256).alias("turns_sha256"),
        F.char_length("loss").cast("long").alias("loss_chars"),
        F.sha2("loss", 256).alias("loss_sha256"),
        "formatted_chars",
    )
