"""Chat formatting by Spark expressions only.

The turns of a conversation are collected as structs and sorted; adjacent turns of one role are merged into a
block; blocks are concatenated. A block is

    <|im_start|>role NEWLINE text [<|im_sep|> text ...] <|im_end|> NEWLINE

so that a merged block still shows where each turn ended. Control strings inside texts and roles (also those of a common
other template) are escaped by a backslash after their first character, one more if some stand there
already, which can be undone exactly.

The result is an array of segments with a loss flag, whose concatenation is the formatted text: only
the texts of assistant turns are under the loss mask. Every step is linear in the turns: blocks are slices
between the places where the role changes, not repeated appends.

Null roles and texts count as empty; a null conversation is a conversation of its own. Turns with equal numbers (also
repeated rows) stay, in order of role and text; null turn numbers come first. A conversation is one output row,
so its whole text must fit in one row; its turns are gathered after escaping, and no task holds more than one such row at a time
beyond its aggregation buffers.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

START, SEPARATOR, END = "<|im_start|>", "<|im_sep|>", "<|im_end|>"
# The first character of a control string, and what follows it.
_TAIL = r"(\|im_start\|>|\|im_sep\|>|\|im_end\|>|s>|/s>|INST\]|/INST\])"
ESCAPED = (r"([<\[])(\\*)" + _TAIL, r"$1$2\\$3")
UNESCAPED = (r"([<\[])\\(\\*)" + _TAIL, r"$1$2$3")
# A role ends at the first new line, so its own are written otherwise.
ROLE_CODES = (("%", "%25"), ("\n", "%0A"))
ASSISTANT = "assistant"


def escape(text: Column) -> Column:
    return F.regexp_replace(text, *ESCAPED)


def unescape(text: Column) -> Column:
    return F.regexp_replace(text, *UNESCAPED)


def escape_role(role: Column) -> Column:
    for plain, code in ROLE_CODES:
        role = F.replace(role, F.lit(plain), F.lit(code))
    return escape(role)


def unescape_role(role: Column) -> Column:
    role = unescape(role)
    for plain, code in reversed(ROLE_CODES):
        role = F.replace(role, F.lit(code), F.lit(plain))
    return role


def _segment(text: Column, loss: Column | bool) -> Column:
    return F.struct(text.alias("text"), (F.lit(loss) if isinstance(loss, bool) else loss).alias("loss"))


def format_chats(
    turns: DataFrame, conversation: str = "conv_id", turn: str = "turn", role: str = "role", text: str = "text"
) -> DataFrame:
    """One row per conversation: its key, ``segments`` (text, loss) and ``formatted``."""
    empty = F.lit("")
    ordered = turns.groupBy(F.col(conversation).alias("_key")).agg(
        F.array_sort(
            F.collect_list(
                F.struct(
                    F.col(turn).isNotNull().alias("known"),
                    F.coalesce(F.col(turn), F.lit(0)).alias("turn"),
                    escape_role(F.coalesce(F.col(role), empty)).alias("role"),
                    escape(F.coalesce(F.col(text), empty)).alias("text"),
                )
            )
        ).alias("turns")
    )
    # Pair each turn with its neighbours by shifting the array, so nothing is looked up by index.
    nobody = F.lit(None).cast("string")
    roles = F.transform("turns", lambda t: t["role"])
    before = F.concat(F.array(nobody), F.slice(roles, 1, F.greatest(F.size("turns") - 1, F.lit(0))))
    after = F.concat(F.slice(roles, 2, F.size("turns")), F.array(nobody))
    marked = ordered.withColumn("around", F.arrays_zip(F.col("turns"), before.alias("before"), after.alias("after")))

    def pieces(x: Column) -> Column:
        t = x["turns"]
        opens = ~t["role"].eqNullSafe(x["before"])
        closes = ~t["role"].eqNullSafe(x["after"])
        head = F.when(opens, F.concat(F.lit(START), t["role"], F.lit("\n"))).otherwise(F.lit(SEPARATOR))
        tail = F.when(closes, F.lit(END + "\n")).otherwise(empty)
        return F.array(
            _segment(head, False), _segment(t["text"], t["role"] == F.lit(ASSISTANT)), _segment(tail, False)
        )

    rows = marked.select("_key", F.flatten(F.transform("around", pieces)).alias("segments"))
    joined = F.array_join(F.transform("segments", lambda s: s["text"]), "")
    return rows.select(F.col("_key").alias(conversation), "segments", joined.alias("formatted"))


def read_turns(formatted: Column) -> Column:
    """The turns back from a formatted text: array of (role, text), unescaped."""
    blocks = F.filter(F.split(formatted, _literal(START)), lambda b, i: i > 0)

    def turns_of(block: Column) -> Column:
        body = F.substring_index(block, END + "\n", 1)
        role = F.substring_index(body, "\n", 1)
        texts = F.split(F.substr(body, F.length(role) + 2), _literal(SEPARATOR))
        return F.transform(texts, lambda t: F.struct(unescape_role(role).alias("role"), unescape(t).alias("text")))

    return F.flatten(F.transform(blocks, turns_of))


def loss_text(segments: Column) -> Column:
    """Everything under the loss mask, unescaped piece by piece."""
    under = F.filter(segments, lambda s: s["loss"])
    return F.array_join(F.transform(under, lambda s: unescape(s["text"])), "")


def _literal(mark: str) -> str:
    return mark.replace("|", r"\|")
