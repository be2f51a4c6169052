"""Chat formatting of typed content parts into one marked-up string, a loss mask and attachment references.

Every turn becomes one chunk ``<|im_start|>role\\nbody<|im_end|>\\n``.  A visitor goes over the turn's parts in
order: text is escaped, an image, audio or document part leaves a placeholder such as ``<|image|>`` and an
attachment record.  Escaping puts a backslash before the bar of ``<|``, before every backslash, and before a
bar that begins a part which isn't the first: the part before it may end with ``<``.  So no text, role or cut
of a text into parts can form a control string, and it can be undone exactly.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

START, END = "<|im_start|>", "<|im_end|>"
#: Tokens that one unit of an attachment (image tile, audio second, document page) expands to.
TOKENS_PER_UNIT = {"image": 256, "audio": 25, "document": 600}
PARTS = "array<struct<type:string,text:string,ref:string,units:bigint>>"


def escape(text: Column) -> Column:
    return F.replace(F.replace(text, F.lit("\\"), F.lit("\\\\")), F.lit("<|"), F.lit("<\\|"))


def unescape(text: Column) -> Column:
    return F.regexp_replace(text, r"(?s)\\(.)", "$1")


def _escape_role(role: Column) -> Column:
    """As :func:`escape`, with line breaks as backslash-n, since a line break ends the role."""
    return F.replace(escape(role), F.lit("\n"), F.lit("\\n"))


def _unescape_role(role: Column) -> Column:
    return unescape(F.regexp_replace(role, r"(?<!\\)((?:\\\\)*)\\n", "$1\n"))


def text_parts(text: Column) -> Column:
    """A single text part of a plain message."""
    null = F.lit(None)
    one = F.struct(F.lit("text").alias("type"), text.alias("text"), null.cast("string").alias("ref"), null.cast("bigint").alias("units"))
    return F.array(one)


def _visit(part: Column, place: Column) -> Column:
    """What a part leaves in the body: escaped text (null: nothing), or its type's placeholder."""
    known = part["type"].isin(*TOKENS_PER_UNIT)
    text = escape(F.coalesce(part["text"], F.lit("")))
    inside = F.when((place > 0) & text.startswith("|"), F.concat(F.lit("\\"), text)).otherwise(text)
    return F.when(known, F.concat(F.lit("<|"), part["type"], F.lit("|>"))).otherwise(inside)


def _attachment(part: Column) -> Column:
    per_unit = F.coalesce(*[F.when(part["type"] == k, F.lit(n)) for k, n in TOKENS_PER_UNIT.items()])
    tokens = F.greatest(F.coalesce(part["units"], F.lit(1)), F.lit(0)) * per_unit
    return F.struct(part["type"].alias("type"), part["ref"].alias("ref"), tokens.cast("bigint").alias("tokens"))


def format_conversations(turns: DataFrame, id_col: str = "conv_id", turn: str = "turn", role: str = "role", parts: str = "parts", loss_roles: tuple[str, ...] = ("assistant",)) -> DataFrame:
    """One row per conversation: id, ``n_turns``, ``formatted``, ``loss_mask``, ``attachments``, ``attachment_tokens``.

    ``parts`` is a column of type ``PARTS``; types other than text and those of ``TOKENS_PER_UNIT`` count as
    text.  loss_mask has an entry per turn, in order: null, or start and length, in code points from the
    turn's beginning, of what is learnt.  attachments are in the order of their placeholders.

    Turns are in order of their number; null numbers come first, and equal ones go by role, then body.  A
    null role counts as empty, null or empty parts leave an empty body, null ids are one conversation,
    repeated rows are repeated turns, an empty table gives none, and other columns are ignored.  Bodies are
    made before the shuffle; a conversation ends as one row, which Spark limits to 2 GB.
    """
    of = F.coalesce(F.col(f"`{parts}`"), F.array().cast(PARTS))
    who = F.coalesce(F.col(f"`{role}`"), F.lit(""))
    body = F.array_join(F.transform(of, _visit), "")
    made = turns.select(
        F.col(f"`{id_col}`").alias("id"),
        F.col(f"`{turn}`").alias("turn"),
        who.alias("role"),
        body.alias("body"),
        F.transform(F.filter(of, lambda p: p["type"].isin(*TOKENS_PER_UNIT)), _attachment).alias("attached"),
    )
    gathered = made.groupBy("id").agg(F.sort_array(F.collect_list(F.struct("turn", "role", "body", "attached"))).alias("t"))
    head = lambda t: F.concat(F.lit(START), _escape_role(t["role"]), F.lit("\n"))
    mask = lambda t: F.when(t["role"].isin(*loss_roles), F.struct(F.char_length(head(t)).alias("start"), F.char_length(t["body"]).alias("length")))
    attachments = F.flatten(F.transform("t", lambda t: t["attached"]))
    return gathered.select(
        F.col("id").alias(id_col),
        F.size("t").cast("bigint").alias("n_turns"),
        F.array_join(F.transform("t", lambda t: F.concat(head(t), t["body"], F.lit(END + "\n"))), "").alias("formatted"),
        F.transform("t", mask).alias("loss_mask"),
        attachments.alias("attachments"),
        F.aggregate(attachments, F.lit(0).cast("bigint"), lambda n, a: n + a["tokens"]).alias("attachment_tokens"),
    )


def _chunks(formatted: Column) -> Column:
    """The turns' chunks of a formatted string, without their end marks."""
    every = F.split(formatted, r"<\|im_end\|>\n", -1)
    return F.slice(every, 1, F.greatest(F.size(every) - 1, F.lit(0)))


def read_turns(formatted: Column) -> Column:
    """Array of (role, text) parsed from a formatted string; placeholders stay in the text."""

    def one(chunk):
        named = F.substring_index(chunk, "\n", 1)
        return F.struct(
            _unescape_role(F.substr(named, F.lit(len(START) + 1))).alias("role"),
            unescape(F.substr(chunk, F.char_length(named) + 2)).alias("text"),
        )

    return F.transform(_chunks(formatted), one)


def read_loss(formatted: Column, loss_mask: Column) -> Column:
    """Array of the unescaped texts under the loss mask, in order."""
    under = F.zip_with(_chunks(formatted), loss_mask, lambda c, m: F.when(m.isNotNull(), unescape(F.substr(c, m["start"] + 1, m["length"]))))
    return F.filter(under, lambda x: x.isNotNull())


def digest(formatted: DataFrame, id_col: str = "conv_id") -> DataFrame:
    """Digests of the turns and of the learnt text, both read back from the formatted string."""
    turns = F.array_join(F.transform(read_turns(F.col("formatted")), lambda t: F.concat(t["role"], F.lit("\n"), t["text"], F.lit("\n"))), "")
    learnt = F.array_join(read_loss(F.col("formatted"), F.col("loss_mask")), "")
    return formatted.select(
        id_col,
        F.size(_chunks(F.col("formatted"))).cast("bigint").alias("n_turns"),
        F.sha2(turns, 256).alias("turns_sha256"),
        F.char_length(learnt).cast("bigint").alias("loss_chars"),
        F.sha2(learnt, 256).alias("loss_sha256"),
        F.char_length("formatted").cast("bigint").alias("formatted_chars"),
    )
