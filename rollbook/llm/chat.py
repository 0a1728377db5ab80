r"""Chat formatting with typed content parts, in DataFrame functions only.

A turn is ``<turn ROLE>CONTENT</turn>`` and a line end. A visitor flattens the parts of a content in their
order: text is escaped, an image, a sound or a document becomes a placeholder. The escape takes away every
``<`` of a text (``\`` is written ``\s`` and ``<`` is written ``\l``; in roles also ``>`` as ``\g``), so what
looks like a control string in the output is one, and reading back restores each text exactly.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from rollbook.llm.shared import let

#: A part of a content; numbers that a kind doesn't need are null.
PART = "struct<kind:string,text:string,ref:string,width:int,height:int,seconds:double,pages:int>"
KINDS = ("image", "audio", "document")
_END = "</turn>\n"


def escape(text: Column) -> Column:
    return F.replace(F.replace(text, F.lit("\\"), F.lit("\\s")), F.lit("<"), F.lit("\\l"))


def unescape(text: Column) -> Column:
    """The inverse: every backslash of an escaped text stands before s or l, so one after the other is right."""
    return F.replace(F.replace(text, F.lit("\\l"), F.lit("<")), F.lit("\\s"), F.lit("\\"))


def escape_role(role: Column) -> Column:
    return F.replace(escape(role), F.lit(">"), F.lit("\\g"))


def unescape_role(role: Column) -> Column:
    return unescape(F.replace(role, F.lit("\\g"), F.lit(">")))


def text_parts(text: Column) -> Column:
    """A content that is one text."""
    return F.array(F.from_json(F.lit("{}"), PART).withField("kind", F.lit("text")).withField("text", text))


def tokens_of(part: Column, patch: int, audio_rate: float, page_tokens: int) -> Column:
    """Tokens that stand for an attachment: image patches, steps of sound, pages; at least one."""
    patches = F.ceil(part["width"] / patch) * F.ceil(part["height"] / patch)
    count = (
        F.when(part["kind"] == "image", patches)
        .when(part["kind"] == "audio", F.ceil(part["seconds"] * audio_rate))
        .when(part["kind"] == "document", part["pages"] * page_tokens)
    )
    return F.greatest(F.coalesce(count, F.lit(1)), F.lit(1)).cast("long")


def _visit(part: Column) -> Column:
    """A part as it stands in the output. Unknown kinds and null kinds are texts."""
    out = escape(F.coalesce(part["text"], F.lit("")))
    for kind in KINDS:
        out = F.when(part["kind"] == kind, F.lit(f"<{kind}/>")).otherwise(out)
    return out


def format_chats(
    turns: DataFrame, conv: str = "conv_id", turn: str = "turn", role: str = "role", parts: str = "parts",
    learn: tuple[str, ...] = ("assistant",), patch: int = 28, audio_rate: float = 12.5, page_tokens: int = 256,
) -> DataFrame:
    """One row per conversation: ``formatted``, ``loss`` (byte spans of what is learned), ``attachments``, ``n_turns``, ``n_tokens_media``.

    ``parts`` is an array of ``PART``; null arrays, null parts and null texts are empty. Turns stand in the
    order of ``turn``, equal numbers by role and then content, and nulls first; rows that repeat are turns of
    their own. Rows with a null id are one conversation. ``loss`` has (start, length) in bytes of the UTF-8
    output for each turn of a role in ``learn``. ``attachments`` has (turn, part, kind, ref, tokens), numbers
    from 0, in the order of the placeholders.

    A conversation is one value of the result and so is built in one task; rows are gathered after a partial
    aggregation in each task.
    """
    shown = F.filter(F.coalesce(F.col(parts), F.array().cast(f"array<{PART}>")), lambda p: p.isNotNull())
    row = turns.select(
        F.col(conv).alias("conv"),
        F.struct(
            F.col(turn).alias("turn"), F.coalesce(F.col(role), F.lit("")).alias("role"),
            F.array_join(F.transform(shown, _visit), "").alias("content"),
            F.transform(
                F.filter(F.transform(shown, lambda p, i: F.struct(p.alias("p"), i.alias("i"))), lambda x: x["p"]["kind"].isin(*KINDS)),
                lambda x: F.struct(
                    x["i"].alias("part"), x["p"]["kind"].alias("kind"), x["p"]["ref"].alias("ref"),
                    tokens_of(x["p"], patch, audio_rate, page_tokens).alias("tokens"),
                ),
            ).alias("media"),
        ).alias("t"),
    )
    head = lambda t: F.concat(F.lit("<turn "), escape_role(t["role"]), F.lit(">"))
    chats = row.groupBy("conv").agg(F.sort_array(F.collect_list("t")).alias("turns"))
    lengths = F.transform("turns", lambda t: F.octet_length(F.concat(head(t), t["content"])).cast("long") + len(_END))
    ends = F.aggregate(lengths, F.array(F.lit(0).cast("long")), lambda a, n: F.concat(a, F.array(F.element_at(a, -1) + n)))

    def spans(at: Column) -> Column:
        own = F.transform(
            "turns",
            lambda t, i: F.struct(
                (F.get(at, i) + F.octet_length(head(t))).cast("int").alias("start"), F.octet_length(t["content"]).cast("int").alias("length"),
                t["role"].isin(*learn).alias("learn"),
            ),
        )
        return F.transform(F.filter(own, lambda s: s["learn"]), lambda s: F.struct(s["start"], s["length"]))

    media = F.flatten(
        F.transform("turns", lambda t, i: F.transform(t["media"], lambda m: F.struct(i.alias("turn"), m["part"], m["kind"], m["ref"], m["tokens"])))
    )
    return chats.select(
        F.col("conv").alias(conv),
        F.array_join(F.transform("turns", lambda t: F.concat(head(t), t["content"], F.lit(_END))), "").alias("formatted"),
        let(ends, spans).alias("loss"),
        media.alias("attachments"),
        F.size("turns").cast("long").alias("n_turns"),
    ).withColumn("n_tokens_media", F.aggregate("attachments", F.lit(0).cast("long"), lambda a, m: a + m["tokens"]))


def read_back(formatted: Column) -> Column:
    """array<struct<role, texts>> of an output; ``texts`` are the stretches between placeholders."""
    pieces = F.filter(F.split(formatted, _END), lambda x: x != "")

    def parse(piece: Column) -> Column:
        head = F.substring_index(piece, ">", 1)
        content = piece.substr(F.length(head) + 2, F.length(piece))
        return F.struct(
            unescape_role(head.substr(F.lit(len("<turn ") + 1), F.length(head))).alias("role"),
            F.transform(F.split(content, "<(?:image|audio|document)/>"), unescape).alias("texts"),
        )

    return F.transform(pieces, parse)


def learned(formatted: Column, loss: Column) -> Column:
    """The unescaped text under the loss mask, in order, nothing between."""
    return let(
        F.encode(formatted, "UTF-8"),
        lambda raw: F.array_join(
            F.transform(loss, lambda s: unescape(F.decode(F.substring(raw, s["start"] + 1, s["length"]), "UTF-8"))), ""
        ),
    )
