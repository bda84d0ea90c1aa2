r"""Chat formatting (operator 1), with Spark expressions only.

The turns of a conversation are collected as structs and sorted, neighbouring
turns of one role are merged into a block, and blocks are joined:

    <s> <|role|>\n text <|turn|> text </s>\n <|role|>\n ...      (no spaces between)

``<|turn|>`` parts merged turns, so none is lost.  Control strings inside a text
or role get a backslash after their first character (one more if they have some
already); that is undone exactly when reading back.  A conversation is one output
row, so it must fit in one string (2 GB); its turns meet in one task for that.

Defined results: a null role or text counts as empty; rows are ordered by (turn,
role, text), null turns first; repeated rows are repeated turns; rows with a null
conv_id make one conversation; an empty table gives an empty result; columns
other than the four are ignored.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

# The template's control strings and the pattern of all that are escaped.
BOS, OPEN, CLOSE, TURN, END = "<s>", "<|", "|>\n", "<|turn|>", "</s>\n"
CONTROL = r"([<\[])(\\*)(/?s>|\||/?INST\])"
ESCAPED = r"([<\[])\\(\\*)(/?s>|\||/?INST\])"


def escape(c: Column) -> Column:
    return F.regexp_replace(c, CONTROL, r"$1\\$2$3")


def unescape(c: Column) -> Column:
    return F.regexp_replace(c, ESCAPED, "$1$2$3")


def escape_role(c: Column) -> Column:
    """In a role, what would close its header is escaped too."""
    return F.regexp_replace(escape(c), r"(\|)(\\*)(>)", r"$1\\$2$3")


def unescape_role(c: Column) -> Column:
    return unescape(F.regexp_replace(c, r"(\|)\\(\\*)(>)", "$1$2$3"))


def format_chats(rows: DataFrame, loss_roles: tuple[str, ...] = ("assistant",)) -> DataFrame:
    """One row per conversation: conv_id, formatted (string) and segments, the
    pieces of ``formatted`` in order as structs (piece, loss); the loss mask
    covers the pieces with loss = true, each the text of one turn."""
    turn = F.struct("turn", F.coalesce("role", F.lit("")).alias("role"), F.coalesce("text", F.lit("")).alias("text"))
    df = (rows.select("conv_id", turn.alias("turn")).groupBy("conv_id")
          .agg(F.sort_array(F.collect_list("turn")).alias("turns")))
    # where a block starts: its first turn's place
    df = df.withColumn("starts", F.filter(
        F.sequence(F.lit(0), F.size("turns") - 1),
        lambda i: (i == 0) | (F.get("turns", i)["role"] != F.get("turns", i - 1)["role"])))
    df = df.withColumn("blocks", F.transform("starts", lambda s, k: F.struct(
        F.get("turns", s)["role"].alias("role"),
        F.transform(F.slice("turns", s + 1, F.coalesce(F.get("starts", k + 1), F.size("turns")) - s),
                    lambda t: t["text"]).alias("texts"))))

    def piece(c: Column, loss: Column | bool = False) -> Column:
        return F.struct(c.alias("piece"), (loss if isinstance(loss, Column) else F.lit(loss)).alias("loss"))

    def block(b: Column) -> Column:
        loss = b["role"].isin(*loss_roles)
        return F.concat(
            F.array(piece(F.concat(F.lit(OPEN), escape_role(b["role"]), F.lit(CLOSE)))),
            F.flatten(F.transform(b["texts"], lambda t, i: F.concat(
                F.when(i > 0, F.array(piece(F.lit(TURN)))).otherwise(F.array().cast("array<struct<piece:string,loss:boolean>>")),
                F.array(piece(escape(t), loss))))),
            F.array(piece(F.lit(END))))

    df = df.withColumn("segments", F.concat(F.array(piece(F.lit(BOS))), F.flatten(F.transform("blocks", block))))
    return df.select("conv_id", F.array_join(F.transform("segments", lambda s: s["piece"]), "").alias("formatted"), "segments")


def read_turns(formatted: Column) -> Column:
    """The turns (role, text) back from a formatted conversation."""
    body = F.substr(formatted, F.lit(len(BOS) + 1))
    parts = F.split(body, END)

    def turns(b: Column) -> Column:
        head = F.substring_index(b, CLOSE, 1)
        return F.transform(F.split(F.substr(b, F.length(head) + len(CLOSE) + 1), r"<\|turn\|>"), lambda t: F.struct(
            unescape_role(F.substr(head, F.lit(len(OPEN) + 1))).alias("role"), unescape(t).alias("text")))

    return F.flatten(F.transform(F.slice(parts, 1, F.size(parts) - 1), turns))


def loss_text(segments: Column) -> Column:
    """All text under the loss mask, unescaped, with nothing between."""
    return F.array_join(F.transform(F.filter(segments, lambda s: s["loss"]), lambda s: unescape(s["piece"])), "")


def digests(chats: DataFrame) -> DataFrame:
    """What op1 reports, read back from ``format_chats``'s output."""
    df = chats.select("conv_id", read_turns(F.col("formatted")).alias("turns"), loss_text(F.col("segments")).alias("loss"),
                      F.length("formatted").cast("long").alias("formatted_chars"))
    whole = F.array_join(F.transform("turns", lambda t: F.concat(t["role"], F.lit("\n"), t["text"], F.lit("\n"))), "")
    return df.select("conv_id", F.size("turns").cast("long").alias("n_turns"), F.sha2(whole, 256).alias("turns_sha256"),
                     F.length("loss").cast("long").alias("loss_chars"), F.sha2("loss", 256).alias("loss_sha256"),
                     "formatted_chars")
