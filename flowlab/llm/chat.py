"""Chat formatting with Spark expressions only.

Turns are collected per conversation, sorted, merged where neighbours share a role, and joined:

    <s>role\\n  first text  \\n<part>\\n  next text of the same role  \\n</s>\\n

Control strings inside texts get one backslash more than they had, so none can be taken for a mark and
``read_back`` restores every text.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

# Marks of this template and of templates that it may be mixed with.
CONTROL = r"</?s>|<part>|\[/?INST\]"
OPEN, NEXT, CLOSE = "<s>", "\n<part>\n", "\n</s>\n"


def escape(text: Column) -> Column:
    return F.regexp_replace(text, rf"(\\*)({CONTROL})", r"\\$1$2")


def unescape(text: Column) -> Column:
    return F.regexp_replace(text, rf"\\(\\*)({CONTROL})", "$1$2")


def format_conversations(turns: DataFrame, key: str = "conv_id", turn: str = "turn", role: str = "role",
                         text: str = "text", learn: str = "assistant") -> DataFrame:
    """One row per conversation: key, formatted, mask.

    ``mask`` tells in runs which code points of ``formatted`` count for the loss: structs (chars, loss) in
    order, loss true for texts of the role ``learn``, their escapes included, and for nothing between them.
    Null texts and roles are empty ones; a null key is a conversation of its own; turns with equal numbers (or
    none, these first) are ordered by role and text; repeated rows stay; an empty table gives no row; other
    columns are not read. A conversation is one value in the result, so its turns meet in one task.
    """
    one = F.struct(F.col(turn).alias("turn"), F.coalesce(F.col(role), F.lit("")).alias("role"),
                   F.coalesce(F.col(text), F.lit("")).alias("text"))
    sorted_turns = turns.groupBy(F.col(key).alias(key)).agg(F.sort_array(F.collect_list(one)).alias("_turns"))
    size = F.size("_turns")
    # Where a run of one role starts; sorting is done, so runs are slices between two starts.
    firsts = sorted_turns.withColumn("_first", F.filter(
        F.sequence(F.lit(0), size - 1),
        lambda i: (i == 0) | (F.get("_turns", i)["role"] != F.get("_turns", i - 1)["role"])))
    blocks = firsts.withColumn("_blocks", F.transform("_first", lambda at, j: F.struct(
        F.get("_turns", at)["role"].alias("role"),
        F.transform(F.slice("_turns", at + 1, F.coalesce(F.get("_first", j + 1), size) - at),
                    lambda t: escape(t["text"])).alias("parts"))))

    def head(b: Column) -> Column:
        return F.concat(F.lit(OPEN), F.url_encode(b["role"]), F.lit("\n"))

    formatted = F.array_join(F.transform("_blocks", lambda b: F.concat(
        head(b), F.array_join(b["parts"], NEXT), F.lit(CLOSE))), "")

    def run(chars: Column, loss: Column) -> Column:
        return F.struct(chars.cast("bigint").alias("chars"), loss.alias("loss"))

    mask = F.flatten(F.transform("_blocks", lambda b: F.concat(
        F.array(run(F.char_length(head(b)), F.lit(False))),
        F.flatten(F.transform(b["parts"], lambda p, i: F.array(
            run(F.char_length(p), b["role"] == learn),
            run(F.when(i + 1 == F.size(b["parts"]), len(CLOSE)).otherwise(len(NEXT)), F.lit(False))))))))
    return blocks.select(key, formatted.alias("formatted"), mask.alias("mask"))


def read_back(formatted: DataFrame) -> DataFrame:
    """Adds turns (array of role and text) and loss_text to what ``format_conversations`` returned.

    The loss text is what stands under the runs of the mask that count, whatever the role there. The runs are laid along
    the text: each must be as long as the mark or text at its place, so a run that starts or ends elsewhere, one that
    counts a mark, and one too many or too few are errors.
    """
    bodies = F.split("formatted", CLOSE, -1)
    # What follows the last mark is empty.
    parsed = formatted.withColumn("_bodies", F.slice(bodies, 1, F.size(bodies) - 1))

    def turns_of(body: Column) -> Column:
        end = F.locate("\n", body)
        role = F.url_decode(F.substr(body, F.lit(len(OPEN) + 1), end - len(OPEN) - 1))
        parts = F.split(F.substr(body, end + 1), NEXT, -1)
        return F.transform(parts, lambda p, i: F.struct(
            role.alias("role"), p.alias("escaped"), unescape(p).alias("text"),
            F.when(i == 0, end).otherwise(0).alias("head"), F.when(i + 1 == F.size(parts), len(CLOSE)).otherwise(len(NEXT)).alias("tail")))

    def piece(chars: Column, text: Column) -> Column:
        return F.struct(chars.cast("bigint").alias("chars"), text.cast("string").alias("text"))

    no_text = F.lit(None)
    parsed = parsed.withColumn("_all", F.flatten(F.transform("_bodies", turns_of)))
    parsed = parsed.withColumn("_pieces", F.flatten(F.transform("_all", lambda t: F.concat(
        F.when(t["head"] > 0, F.array(piece(t["head"], no_text))).otherwise(F.array().cast("array<struct<chars:bigint,text:string>>")),
        F.array(piece(F.char_length(t["escaped"]), t["text"]), piece(t["tail"], no_text))))))
    laid = parsed.withColumn("_laid", F.arrays_zip(F.col("mask"), F.col("_pieces")))
    fits = (F.size("mask") == F.size("_pieces")) & F.forall("_laid", lambda z: (
        (z["mask"]["chars"] == z["_pieces"]["chars"]) & (~z["mask"]["loss"] | z["_pieces"]["text"].isNotNull())))
    under = F.array_join(F.transform(F.filter("_laid", lambda z: z["mask"]["loss"]), lambda z: z["_pieces"]["text"]), "")
    loss = F.when(fits, under).otherwise(F.raise_error(F.lit("the mask does not fit the text")).cast("string"))
    turns = F.transform("_all", lambda t: F.struct(t["role"].alias("role"), t["text"].alias("text")))
    return laid.select(*formatted.columns, turns.alias("turns"), loss.alias("loss_text"))
