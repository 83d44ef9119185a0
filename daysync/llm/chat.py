"""Preference pairs as training texts, in DataFrame functions only.

Of a chosen and a rejected conversation the longest common prefix of turns is rendered once
as the prompt; what follows in each is a completion, with the spans that count for the loss.
A conversation is one training example and is one row here; nothing larger is gathered.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

# How a turn is written.
OPEN, AFTER_ROLE, CLOSE, AFTER_TURN = "<|", "|>\n", "<|end|>", "\n"
ASSISTANT = "assistant"

# What a turn holds is written so that no marker can arise in it: every ``<|`` gets a further bar.
HELD, WRITTEN = "<|", "<||"

TURNS = "array<struct<role:string,text:string>>"


def conversations(turns: DataFrame, id_column: str = "conv_id", turn_column: str = "turn", role_column: str = "role", text_column: str = "text") -> DataFrame:
    """``id, turns``: the turns of each conversation in order, as ``array<struct<role,text>>``.

    Rows alike in all four columns count once. Turns of one number go by role and text, those
    without number come first. A null role is ``unknown``, a null text empty. Rows without id
    belong to no conversation and are left out. Other columns are not read.
    """
    rows = turns.select(
        F.col(id_column).alias("id"), F.col(turn_column).alias("turn"),
        F.coalesce(F.col(role_column).cast("string"), F.lit("unknown")).alias("role"),
        F.coalesce(F.col(text_column).cast("string"), F.lit("")).alias("text"),
    )
    rows = rows.where(F.col("id").isNotNull()).groupBy("id").agg(F.collect_list(F.struct("turn", "role", "text")).alias("turns"))
    # Sorting puts nulls last; the flag puts turns without number first.
    keyed = F.transform(F.array_distinct("turns"), lambda t: F.struct(t["turn"].isNotNull().alias("a"), t["turn"].alias("b"), t["role"].alias("role"), t["text"].alias("text")))
    return rows.select("id", F.transform(F.array_sort(keyed), lambda t: F.struct(t["role"].alias("role"), t["text"].alias("text"))).alias("turns"))


def _written(turns: Column) -> Column:
    """The turns as they are put between markers; ``<||`` read as ``<|`` gives them back."""
    held = lambda c: F.replace(c, F.lit(HELD), F.lit(WRITTEN))
    return F.transform(turns, lambda t: F.struct(held(t["role"]).alias("role"), held(t["text"]).alias("text")))


def _rendered(turn: Column) -> Column:
    return F.concat(F.lit(OPEN), turn["role"], F.lit(AFTER_ROLE), turn["text"], F.lit(CLOSE + AFTER_TURN))


def rendered(turns: Column) -> Column:
    """The text of an array of turns; a null array has none."""
    return F.coalesce(_text(_written(turns)), F.lit(""))


def _text(turns: Column) -> Column:
    return F.array_join(F.transform(turns, _rendered), "")


def _mask(turns: Column) -> Column:
    """Spans (code points) of a rendered text that count: what the assistant wrote, with its end."""

    def step(done: Column, turn: Column) -> Column:
        first = done["at"] + len(OPEN + AFTER_ROLE) + F.char_length(turn["role"])
        end = first + F.char_length(turn["text"]) + len(CLOSE)
        span = F.struct(first.alias("start"), end.alias("end"))
        spans = F.when(turn["role"] == ASSISTANT, F.concat(done["spans"], F.array(span))).otherwise(done["spans"])
        return F.struct((end + len(AFTER_TURN)).alias("at"), spans.alias("spans"))

    start = F.struct(F.lit(0).alias("at"), F.array().cast("array<struct<start:int,end:int>>").alias("spans"))
    return F.aggregate(turns, start, step)["spans"]


def _common(chosen: Column, rejected: Column) -> Column:
    """How many turns both begin with."""
    most = F.least(F.size(chosen), F.size(rejected))
    places = F.when(most > 0, F.sequence(F.lit(1), most)).otherwise(F.array().cast("array<int>"))
    differ = F.filter(places, lambda k: F.element_at(chosen, k) != F.element_at(rejected, k))
    return F.coalesce(F.get(differ, 0) - 1, most)


def format_preferences(pairs: DataFrame, chosen_column: str = "chosen", rejected_column: str = "rejected") -> DataFrame:
    """``pairs`` with two arrays of turns replaced by texts and masks.

    ``n_common`` turns make ``prompt``. ``chosen`` and ``rejected`` are the texts that follow,
    ``chosen_mask`` and ``rejected_mask`` the spans of them that count for the loss: the
    assistant's turns. All other columns are kept; those named as a result are replaced. A
    null array is an empty conversation; of equal conversations all is prompt. An empty table
    gives an empty result. A role or text that holds a marker cannot make a turn of its own: each
    ``<|`` of it is written ``<||``, and masks count what is written. Roles are taken to be names:
    one that begins with a bar or ends with ``<`` may be read wrongly, but adds no turn of the assistant.
    """
    made = ["n_common", "prompt", "chosen", "chosen_mask", "rejected", "rejected_mask"]
    others = [c for c in pairs.columns if c.lower() not in {*made, chosen_column.lower(), rejected_column.lower()}]
    empty = F.array().cast(TURNS)
    given = pairs.select(*others, F.coalesce(F.col(chosen_column), empty).alias("chosen"), F.coalesce(F.col(rejected_column), empty).alias("rejected"))
    given = given.withColumn("n_common", _common(F.col("chosen"), F.col("rejected")))
    given = given.withColumns({c: _written(F.col(c)) for c in ("chosen", "rejected")})
    rest = {c: F.slice(c, F.col("n_common") + 1, F.size(c)) for c in ("chosen", "rejected")}
    return given.select(
        *others, "n_common", _text(F.slice("chosen", F.lit(1), F.col("n_common"))).alias("prompt"),
        _text(rest["chosen"]).alias("chosen"), _mask(rest["chosen"]).alias("chosen_mask"),
        _text(rest["rejected"]).alias("rejected"), _mask(rest["rejected"]).alias("rejected_mask"),
    )


def stale_replies(conversation: DataFrame) -> DataFrame:
    """Preference pairs out of ``id, turns``: the last reply against the one before it, repeated.

    ``chosen`` is the conversation up to the assistant's last turn, ``rejected`` the same with
    that turn's text replaced by the text of the assistant's turn before, or by nothing if
    there is none. Without a turn of the assistant both are the whole conversation.
    ``after`` has the turns that follow the assistant's last, which are in neither.
    """
    turns = F.col("turns")
    places = F.filter(F.sequence(F.lit(1), F.size(turns)), lambda k: F.element_at(turns, k)["role"] == ASSISTANT)
    given = conversation.where(F.size("turns") > 0).withColumn("places", places)
    last = F.element_at("places", -1)
    before = F.when(F.size("places") > 1, F.element_at(turns, F.element_at("places", -2))["text"]).otherwise("")
    reply = F.struct(F.lit(ASSISTANT).alias("role"), before.alias("text"))
    some = F.size("places") > 0
    return given.select(
        "id",
        F.when(some, F.slice(turns, F.lit(1), last)).otherwise(turns).alias("chosen"),
        F.when(some, F.concat(F.slice(turns, F.lit(1), last - 1), F.array(reply).cast(TURNS))).otherwise(turns).alias("rejected"),
        F.when(some, F.slice(turns, last + 1, F.size(turns))).otherwise(F.array().cast(TURNS)).alias("after"),
    )
