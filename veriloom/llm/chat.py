"""Chat formatting by a declarative template, on DataFrame functions alone.

A template names the marks around a turn and the legal role transitions; Column expressions turn its
rows into segments with loss flags, join them into one text, and read that text back.

Escaping: in a role or text every backslash is doubled and every "<|" becomes "<\\|" (in a role also a
line feed becomes "\\n"); so no escaped string holds "<|", and undoing the steps in reverse order
restores it exactly: runs of backslashes of the original are of even length after the first step.
"""

from __future__ import annotations

from dataclasses import dataclass, field

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from veriloom.functions.text import let, running


@dataclass(frozen=True)
class Template:
    """Marks of a turn (each must begin with "<|"), roles whose text bears loss, and the machine over roles."""

    open: str = "<|im_start|>"
    close: str = "<|im_end|>"
    loss_roles: tuple[str, ...] = ("assistant",)
    start: str = "begin"
    #: state -> role -> state; a missing entry is an illegal turn.
    moves: dict[str, dict[str, str]] = field(
        default_factory=lambda: {
            "begin": {"system": "instructed", "user": "asked"},
            "instructed": {"user": "asked"},
            "asked": {"assistant": "answered"},
            "answered": {"user": "asked", "tool": "asked"},
        }
    )
    #: States in which a conversation may end.
    ends: tuple[str, ...] = ("asked", "answered")


CHATML = Template()


def escape(c: Column) -> Column:
    return F.replace(F.replace(c, F.lit("\\"), F.lit("\\\\")), F.lit("<|"), F.lit("<\\|"))


def unescape(c: Column) -> Column:
    return F.replace(F.replace(c, F.lit("<\\|"), F.lit("<|")), F.lit("\\\\"), F.lit("\\"))


def escape_role(c: Column) -> Column:
    return F.replace(escape(c), F.lit("\n"), F.lit("\\n"))


def unescape_role(c: Column) -> Column:
    """Undo escape_role: double backslashes are set aside as "<|", which no escaped role holds, before "\\n" is read."""
    lines = F.replace(F.replace(c, F.lit("\\\\"), F.lit("<|")), F.lit("\\n"), F.lit("\n"))
    kept = F.split(lines, "<\\\\\\|")  # at what is left of an escaped "<|"
    return F.array_join(F.transform(kept, lambda x: F.replace(x, F.lit("<|"), F.lit("\\"))), "<|")


def segments(conversations: DataFrame, template: Template = CHATML) -> DataFrame:
    """conversations(conv_id, turn, role, text) -> (conv_id, valid, bad_turn, final_state, segments).

    segments: array<struct<text string, loss boolean>>, in order; joined they are the formatted text.
    valid: the machine accepts the roles and may end there; bad_turn: the position, from 0, of the first
    illegal turn, else null; final_state: the machine's last state, "illegal" from such a turn on. Rows go by turn (null first), ties by role and text, so that the result
    doesn't depend on input order; repeated rows are turns of their own. Null texts and roles are
    empty; rows with a null conv_id are one conversation; other columns are ignored. An invalid
    conversation is formatted like any other, so that no row is lost: filter on valid to drop it.
    A conversation is one output row, so its turns meet in one task; its size is the only bound.
    """
    text, role = F.coalesce(F.col("text").cast("string"), F.lit("")), F.coalesce(F.col("role").cast("string"), F.lit(""))
    turns = (
        conversations.select("conv_id", F.struct(F.col("turn").cast("long").alias("turn"), role.alias("role"), text.alias("text")).alias("t"))
        .groupBy("conv_id")
        .agg(F.array_sort(F.collect_list("t")).alias("turns"))
    )
    loss = lambda t: t["role"].isin(*template.loss_roles)
    seg = lambda x, on: F.struct(x.alias("text"), on.alias("loss"))
    pieces = F.flatten(
        F.transform(
            "turns",
            lambda t: F.array(
                seg(F.concat(F.lit(template.open), escape_role(t["role"]), F.lit("\n")), F.lit(False)),
                seg(escape(t["text"]), loss(t)),
                seg(F.lit(template.close + "\n"), F.lit(False)),
            ),
        )
    )
    table = F.create_map(*[F.lit(x) for state, moves in template.moves.items() for role_, to in moves.items() for x in (f"{state}\n{role_}", to)])
    after = lambda a, t: F.coalesce(F.try_element_at(table, F.concat(a["state"], F.lit("\n"), t["role"])), F.lit("illegal"))
    machine = F.aggregate(
        "turns",
        F.struct(F.lit(template.start).alias("state"), F.lit(0).alias("n"), F.lit(-1).alias("bad")),
        lambda a, t: F.struct(
            after(a, t).alias("state"),
            (a["n"] + 1).alias("n"),
            F.when((a["bad"] < 0) & (after(a, t) == "illegal"), a["n"]).otherwise(a["bad"]).alias("bad"),
        ),
    )
    return turns.withColumn("m", machine).select(
        "conv_id",
        ((F.col("m.bad") < 0) & F.col("m.state").isin(*template.ends)).alias("valid"),
        F.when(F.col("m.bad") >= 0, F.col("m.bad")).alias("bad_turn"),
        F.col("m.state").alias("final_state"),
        pieces.alias("segments"),
    )


def render(formatted: DataFrame) -> DataFrame:
    """Add formatted (the segments' texts joined) and loss_spans (array<struct<start, end>>, code points, end exclusive)."""
    span = lambda s, at: F.when(s["loss"], F.struct(at.cast("long").alias("start"), (at + F.length(s["text"])).cast("long").alias("end")))
    spans = let(running(F.transform("segments", lambda s: F.length(s["text"]))), lambda at: F.filter(F.zip_with("segments", at, span), lambda x: x.isNotNull()))
    return formatted.withColumn("formatted", F.array_join(F.transform("segments", lambda s: s["text"]), "")).withColumn("loss_spans", spans)


def read_back(rendered: DataFrame, template: Template = CHATML) -> DataFrame:
    """(conv_id, turns array<struct<role, text>>, loss_text) read from formatted and loss_spans alone.

    A span of the mask is a turn's text: places of texts and spans are sorted together, so that each text finds its span beside it. Work
    grows with the text and with n log n of n turns.
    """
    cut = F.slice(F.split("formatted", "\\Q" + template.open + "\\E"), 2, 1 << 30)
    role = lambda p: F.substring_index(p, "\n", 1)
    said = lambda p: F.substring(p, F.instr(p, "\n") + 1, F.length(p) - F.instr(p, "\n") - len(template.close) - 1)
    turns = F.transform(cut, lambda p: F.struct(unescape_role(role(p)).alias("role"), unescape(said(p)).alias("text")))

    # A turn begins with its mark, so that the first one's text is at the mark's and its role's length and a line end.
    place = lambda p, at: F.struct((at + len(template.open) + F.length(role(p)) + 1).cast("long").alias("start"), F.lit(1).alias("kind"), F.lit(None).cast("long").alias("end"), said(p).alias("text"))
    sizes = lambda v: running(F.transform(v, lambda p: F.length(p) + len(template.open)))
    texts = let(cut, lambda v: let(sizes(v), lambda at: F.zip_with(v, at, place)))
    spans = F.transform("loss_spans", lambda s: F.struct(s["start"].alias("start"), F.lit(0).alias("kind"), s["end"].alias("end"), F.lit(None).cast("string").alias("text")))
    covers = lambda s, x: (s["kind"] == 0) & (s["start"] == x["start"]) & (s["end"] == x["start"] + F.length(x["text"]))
    under = lambda v: F.transform(v, lambda x, i: F.when((x["kind"] == 1) & (i > 0) & covers(F.get(v, i - 1), x), unescape(x["text"])))
    loss = let(F.array_sort(F.concat(spans, texts)), lambda v: F.array_join(under(v), ""))
    return rendered.select("conv_id", "valid", "bad_turn", "formatted", turns.alias("turns"), loss.alias("loss_text"))
