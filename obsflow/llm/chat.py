"""Chat transcripts as text. DataFrame operations only.

A turn is a list of typed parts: text, image, audio or document. A visitor, one rule per type, flattens them in order:
text is escaped, any other part becomes one placeholder, its reference is recorded with its place, and the
number of tokens it will expand to is counted. Turns are framed by marks, and the characters that count for the loss, the texts of
assistant turns, are recorded as spans of the formatted text.

Escaping is reversible: a backslash is doubled and ``<|`` gets one in between, so that no mark can be read out of a text.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from obsflow.llm.pii import running_sums

TURN, TURN_END = "<|im_start|>", "<|im_end|>\n"
PLACEHOLDERS = {"image": "<|image|>", "audio": "<|audio|>", "document": "<|document|>"}
PATCH, AUDIO_RATE, PAGE_TOKENS = 14, 25, 1024
#: Turns that are joined before whole conversations are, so that a long one is put together by many tasks.
RUN = 256

PART = "struct<type:string,text:string,ref:string,width:bigint,height:bigint,seconds:double,pages:bigint>"


def text_part(text: Column) -> Column:
    """A list of one text part; a null text is empty."""
    return F.array(
        F.struct(
            F.lit("text").alias("type"),
            F.coalesce(text, F.lit("")).alias("text"),
            *[F.lit(None).cast(kind).alias(name) for name, kind in (("ref", "string"), ("width", "bigint"), ("height", "bigint"), ("seconds", "double"), ("pages", "bigint"))],
        )
    )


def escaped(text: Column) -> Column:
    return F.replace(F.replace(text, F.lit("\\"), F.lit("\\\\")), F.lit("<|"), F.lit("<\\|"))


def unescaped(text: Column) -> Column:
    return F.when(text.contains("\\"), F.regexp_replace(text, r"(?s)\\(.)", "$1")).otherwise(text)


def _header(role: Column) -> Column:
    """A role on one line: its line breaks are escaped too."""
    return F.replace(escaped(F.coalesce(role, F.lit(""))), F.lit("\n"), F.lit("\\\n"))


def _tokens(part: Column) -> Column:
    """Tokens that a placeholder expands to; unknown sizes count as one unit."""
    side = lambda n: F.ceil(F.greatest(F.coalesce(n, F.lit(1)), F.lit(1)) / PATCH)
    return (
        F.when(part["type"] == "image", side(part["width"]) * side(part["height"]))
        .when(part["type"] == "audio", F.ceil(F.greatest(F.coalesce(part["seconds"], F.lit(0.0)), F.lit(0.0)) * AUDIO_RATE))
        .when(part["type"] == "document", F.coalesce(part["pages"], F.lit(1)) * PAGE_TOKENS)
        .otherwise(F.lit(0))
        .cast("long")
    )


def _written(part: Column) -> Column:
    out = escaped(F.coalesce(part["text"], F.lit("")))
    for kind, mark in PLACEHOLDERS.items():
        out = F.when(part["type"] == kind, F.lit(mark)).otherwise(out)
    return out


def _is_attachment(part: Column) -> Column:
    return F.coalesce(part["type"].isin(*PLACEHOLDERS), F.lit(False))


def visited(turns: DataFrame, parts: str = "parts") -> DataFrame:
    """Adds body (flattened text) and attachments (type, ref, tokens; in order) to each turn."""
    listed = F.filter(F.coalesce(F.col(parts), F.expr(f"CAST(array() AS array<{PART}>)")), lambda p: p.isNotNull())
    return turns.withColumn("_parts", listed).withColumns(
        {
            "body": F.array_join(F.transform("_parts", _written), ""),
            "attachments": F.transform(
                F.filter("_parts", _is_attachment),
                lambda p: F.struct(p["type"].alias("type"), p["ref"].alias("ref"), _tokens(p).alias("tokens")),
            ),
        }
    ).drop("_parts")


def format_conversations(turns: DataFrame, parts: str = "parts") -> DataFrame:
    """conv_id, formatted, loss_spans (start, end in code points for each turn; null if it doesn't count), attachments (turn place, type, ref, tokens), n_turns, expanded_tokens.

    ``turns`` has conv_id, turn, role and a list of PART. Turns are ordered by turn, nulls first, and where that is equal by
    role and text. A null role or list is empty; a part of unknown type is text; rows without conv_id are one conversation. Repeated rows are repeated turns.
    Other columns are ignored; an empty table gives an empty result.
    """
    seen = visited(turns.select("conv_id", "turn", "role", parts), parts)
    head = F.concat(F.lit(TURN), _header(F.col("role")), F.lit("\n"))
    loss = F.coalesce(F.col("role") == "assistant", F.lit(False))
    rows = seen.select(
        "conv_id",
        F.floor(F.coalesce("turn", F.lit(-1)) / RUN).alias("run"),
        F.struct(
            "turn",
            F.col("role"),
            F.concat(head, "body", F.lit(TURN_END)).alias("whole"),
            F.length(head).alias("head"),
            F.when(loss, F.length("body")).otherwise(F.lit(-1)).alias("loss"),
            "attachments",
        ).alias("t"),
    )
    # Runs of turns first; each is short text and short lists.
    sorted_turns = F.array_sort(F.collect_list("t"))
    runs = rows.groupBy("conv_id", "run").agg(sorted_turns.alias("t")).select(
        "conv_id",
        F.struct(
            "run",
            F.array_join(F.transform("t", lambda t: t["whole"]), "").alias("text"),
            F.transform("t", lambda t: F.struct(F.length(t["whole"]).alias("size"), t["head"].alias("head"), t["loss"].alias("loss"))).alias("sizes"),
            F.transform("t", lambda t: t["attachments"]).alias("attachments"),
        ).alias("r"),
    )
    whole = runs.groupBy("conv_id").agg(F.array_sort(F.collect_list("r"), lambda a, b: F.when(a["run"] < b["run"], -1).when(a["run"] > b["run"], 1).otherwise(0)).alias("r"))
    joined = whole.select(
        "conv_id",
        F.array_join(F.transform("r", lambda r: r["text"]), "").alias("formatted"),
        F.flatten(F.transform("r", lambda r: r["sizes"])).alias("sizes"),
        F.flatten(F.transform("r", lambda r: r["attachments"])).alias("by_turn"),
    )
    placed = joined.withColumn("ends", running_sums(F.transform("sizes", lambda s: s["size"])))
    span = lambda s, i: F.when(
        s["loss"] >= 0,
        F.struct(
            (F.get("ends", i) - s["size"] + s["head"]).alias("start"),
            (F.get("ends", i) - s["size"] + s["head"] + s["loss"]).alias("end"),
        ),
    )
    attachments = F.flatten(F.transform("by_turn", lambda a, i: F.transform(a, lambda x: F.struct(i.alias("place"), x["type"].alias("type"), x["ref"].alias("ref"), x["tokens"].alias("tokens")))))
    return placed.select(
        "conv_id",
        "formatted",
        F.transform("sizes", span).alias("loss_spans"),
        attachments.alias("attachments"),
        F.size("sizes").cast("long").alias("n_turns"),
    ).withColumn("expanded_tokens", F.aggregate("attachments", F.lit(0).cast("long"), lambda n, a: n + a["tokens"]))


def parsed(formatted: Column) -> Column:
    """The turns (role, text) read back from formatted text; placeholders stay where they are."""
    framed = F.filter(F.split(formatted, r"<\|im_start\|>", -1), lambda _, i: i > 0)
    header = r"(?s)^((?:[^\\\n]|\\.)*+)\n"
    return F.transform(
        framed,
        lambda t: F.struct(
            unescaped(F.regexp_extract(t, header, 1)).alias("role"),
            unescaped(F.regexp_replace(F.regexp_replace(t, header, ""), r"<\|im_end\|>\n$", "")).alias("text"),
        ),
    )


def under_loss(formatted: Column, spans: Column) -> Column:
    """The unescaped texts under the loss mask, cut turn by turn; an empty text for a turn without loss."""
    framed = F.transform(F.filter(F.split(formatted, r"<\|im_start\|>", -1), lambda _, i: i > 0), lambda t: F.concat(F.lit(TURN), t))
    ends = running_sums(F.transform(framed, F.length))
    return F.transform(
        F.arrays_zip(framed.alias("turn"), ends.alias("end"), spans.alias("span")),
        lambda z: F.when(
            z["span"].isNotNull(),
            unescaped(F.substring(z["turn"], z["span"]["start"] - z["end"] + F.length(z["turn"]) + 1, z["span"]["end"] - z["span"]["start"])),
        ).otherwise(F.lit("")),
    )


def read_back(chats: DataFrame) -> DataFrame:
    """conv_id, n_turns, turns_sha256, loss_chars, loss_sha256, formatted_chars, n_attachments, expanded_tokens from formatted text."""
    read = chats.withColumns({"_turns": parsed(F.col("formatted")), "_loss": F.array_join(under_loss(F.col("formatted"), F.col("loss_spans")), "")})
    return read.select(
        "conv_id",
        F.size("_turns").cast("long").alias("n_turns"),
        F.sha2(F.array_join(F.transform("_turns", lambda t: F.concat(t["role"], F.lit("\n"), t["text"], F.lit("\n"))), ""), 256).alias("turns_sha256"),
        F.length("_loss").cast("long").alias("loss_chars"),
        F.sha2("_loss", 256).alias("loss_sha256"),
        F.length("formatted").cast("long").alias("formatted_chars"),
        F.size("attachments").cast("long").alias("n_attachments"),
        "expanded_tokens",
    )
