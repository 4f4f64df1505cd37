"""Chat formatting with a grammar round trip, on DataFrames alone.

A conversation is rendered as one text by this grammar; ``mark`` is what surrounds a turn's text:

    conversation  =  turn *
    turn          =  "[INST] " text " [/INST]"                 user
                  |  " " text "</s>"                           assistant
                  |  "[SYS] " text " [/SYS]"                   system
                  |  "[ROLE] " role "[:]" text "[/ROLE]"       any other role

The parser is deterministic: a turn reaches to the first closing string, and its opening string says
whose it is; a control string inside a text is refused. A rendered conversation is parsed again and the turns are compared with the source.
Where they differ, the texts that don't survive by themselves are escaped, and if the whole still
differs, all texts are; the round trip is repeated until both are identical.

A control string is escaped by a tilde behind its first character, and one that has tildes there
gets one more: ``[INST]`` becomes ``[~INST]``, ``[~INST]`` becomes ``[~~INST]``. The parser takes one tilde
away, so that every text has exactly one reading.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

# A control string, or what an escaped one looks like.
_OPEN, _REST = r"([\[<])", r"(/?(?:INST|SYS|ROLE)\]|:\]|/?s>)"
_CLOSING = r"\[/INST\]|\[/SYS\]|\[/ROLE\]|</s>"
_CONTROL = r"\[/?(?:INST|SYS|ROLE)\]|\[:\]|</?s>"
_PIECE = f"(?s).*?(?:{_CLOSING})"


def escape(text: Column) -> Column:
    """The text with one more tilde in each control string; other texts stay as they are."""
    return F.regexp_replace(text, f"{_OPEN}(~*){_REST}", "$1~$2$3")


def unescape(text: Column) -> Column:
    """What ``escape`` was given."""
    return F.regexp_replace(text, f"{_OPEN}~(~*){_REST}", "$1$2$3")


def _between(piece: Column, lead: int, tail: int) -> Column:
    return F.substring(piece, F.lit(lead + 1), F.greatest(F.length(piece) - lead - tail, F.lit(0)))


def _marks(role: Column, shown_role: Column) -> tuple[Column, Column]:
    """What stands before and behind a turn's text."""
    before = F.when(role == "user", "[INST] ").when(role == "assistant", " ").when(role == "system", "[SYS] ")
    behind = F.when(role == "user", " [/INST]").when(role == "assistant", "</s>").when(role == "system", " [/SYS]")
    return before.otherwise(F.concat(F.lit("[ROLE] "), shown_role, F.lit("[:]"))), behind.otherwise("[/ROLE]")


def _rendered(role: Column, text: Column, escaped: Column) -> Column:
    """One turn as text; ``escaped`` says whether its role and text are escaped."""
    shown = lambda value: F.when(escaped, escape(value)).otherwise(value)
    before, behind = _marks(role, shown(role))
    return F.concat(before, shown(text), behind)


def _parsed(piece: Column) -> Column:
    """Role and text of one turn, from its opening string; null where a bare control string stands inside."""
    named = _between(piece, len("[ROLE] "), len("[/ROLE]"))
    colon = F.instr(named, "[:]")
    cases = [
        ("[INST] ", F.lit("user"), _between(piece, 7, 8)),
        ("[SYS] ", F.lit("system"), _between(piece, 6, 7)),
        ("[ROLE] ", F.substring(named, F.lit(1), colon - 1), F.substring(named, colon + 3, F.length(named))),
    ]
    role, text = F.lit("assistant"), _between(piece, 1, 4)
    for opening, own_role, own_text in reversed(cases):
        here = F.startswith(piece, F.lit(opening))
        role, text = F.when(here, own_role).otherwise(role), F.when(here, own_text).otherwise(text)
    bare = lambda value: F.when(~value.rlike(_CONTROL), unescape(value))
    return F.struct(bare(role).alias("role"), bare(text).alias("text"))


def parse(formatted: Column) -> Column:
    """The turns of a rendered conversation: an array of (role, text)."""
    return F.transform(F.regexp_extract_all(formatted, F.lit(_PIECE), F.lit(0)), _parsed)


def _whole(formatted: Column) -> Column:
    """Number of characters that belong to some turn."""
    pieces = F.regexp_extract_all(formatted, F.lit(_PIECE), F.lit(0))
    return F.aggregate(pieces, F.lit(0), lambda n, piece: n + F.length(piece))


def format_conversations(conversations: DataFrame) -> DataFrame:
    """Columns ``conv_id``, ``formatted``, ``loss_mask``, ``rounds``; a row for each ``conv_id``.

    Turns go by ``turn`` (null first), equal ones by role and text; a repeated row is a turn of its own. A null
    role or text is empty; rows with a null ``conv_id`` are one conversation. ``loss_mask`` holds for each
    turn three lengths in characters of ``formatted``: ``lead`` and ``tail`` are not trained on, ``loss`` is, and is
    above 0 for assistant turns with text only. ``rounds`` counts the renderings that were made: 1 for
    conversations in which nothing had to be escaped. Texts are whole, of any length; a conversation is
    one row, which Spark bounds at 2 GB. Other columns are not read.
    """
    role, text = F.coalesce("role", F.lit("")), F.coalesce("text", F.lit(""))
    turns = conversations.select("conv_id", "turn", role.alias("role"), text.alias("text"))
    # Turns that do not come back when they stand alone; nearly all do.
    alone = parse(_rendered(F.col("role"), F.col("text"), F.lit(False)))
    own = F.array(F.struct("role", "text"))
    suspicious = F.col("text").rlike(f"{_OPEN}~*{_REST}") | F.col("role").rlike(f"{_OPEN}~*{_REST}")
    turns = turns.withColumn("conflict", F.when(suspicious, alone != own).otherwise(False))
    place = F.struct(F.col("turn").isNotNull().alias("placed"), F.coalesce("turn", F.lit(0)).alias("turn"), "role", "text", "conflict")
    whole = turns.groupBy("conv_id").agg(F.array_sort(F.collect_list(place)).alias("turns"))
    source = F.transform("turns", lambda t: F.struct(t["role"].alias("role"), t["text"].alias("text")))
    out = whole.select("conv_id", "turns", source.alias("source"))

    def rendering(escaped) -> Column:
        return F.array_join(F.transform("turns", lambda t: _rendered(t["role"], t["text"], escaped(t))), "")

    rules = [lambda t: F.lit(False), lambda t: t["conflict"], lambda t: F.lit(True)]
    out = out.withColumns({"formatted": rendering(rules[0]), "rounds": F.lit(1)})
    identical = (parse(F.col("formatted")) == F.col("source")) & (_whole(F.col("formatted")) == F.length("formatted"))
    for number, rule in enumerate(rules[1:], 2):
        out = out.withColumn("same", identical)
        out = out.withColumns({
            "formatted": F.when(F.col("same"), F.col("formatted")).otherwise(rendering(rule)),
            "rounds": F.when(F.col("same"), F.col("rounds")).otherwise(number),
        })
    out = out.withColumn("same", identical)
    failure = F.raise_error(F.concat(F.lit("no rendering of a conversation reads back as it was: "), F.coalesce(F.col("conv_id").cast("string"), F.lit("null"))))
    pieces = F.regexp_extract_all("formatted", F.lit(_PIECE), F.lit(0))

    def mask(piece: Column, turn: Column) -> Column:
        trained = turn["role"] == "assistant"
        loss = F.when(trained, F.length(piece) - 5).otherwise(0)
        lead = F.when(trained, 1).otherwise(F.length(piece))
        return F.struct(lead.alias("lead"), loss.alias("loss"), F.when(trained, 4).otherwise(0).alias("tail"))

    return out.select(
        "conv_id",
        F.when(F.col("same"), F.col("formatted")).otherwise(failure).alias("formatted"),
        F.zip_with(pieces, "source", mask).alias("loss_mask"),
        "rounds",
    )


def read_back(formatted: DataFrame) -> DataFrame:
    """Adds ``turns`` (array of role and text) and ``loss_texts``, read from ``formatted`` and ``loss_mask`` alone.

    ``loss_texts`` are the texts under the mask, unescaped, in order: one for each turn that is trained on.
    """
    pieces = F.regexp_extract_all("formatted", F.lit(_PIECE), F.lit(0))
    masked = F.zip_with(pieces, "loss_mask", lambda piece, m: F.when(m["loss"] + m["tail"] > 0, unescape(F.substring(piece, m["lead"] + 1, m["loss"]))))
    return formatted.withColumns({"turns": parse(F.col("formatted")), "loss_texts": F.filter(masked, lambda text: text.isNotNull())})


def digests(conversations: DataFrame) -> DataFrame:
    """What the formatted conversations say when they are read back, as numbers and hashes."""
    back = read_back(format_conversations(conversations))
    lines = F.transform("turns", lambda t: F.concat(t["role"], F.lit("\n"), t["text"], F.lit("\n")))
    loss = F.array_join("loss_texts", "")
    return back.select(
        "conv_id",
        F.size("turns").cast("long").alias("n_turns"),
        F.sha2(F.array_join(lines, "").cast("binary"), 256).alias("turns_sha256"),
        F.length(loss).cast("long").alias("loss_chars"),
        F.sha2(loss.cast("binary"), 256).alias("loss_sha256"),
        F.length("formatted").cast("long").alias("formatted_chars"),
    )
