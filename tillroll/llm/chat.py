"""Chat formatting by expressions alone: collected turns are sorted, merged by role and concatenated.

A conversation becomes blocks ``<|im_start|>role``, a line end, the texts, ``<|im_end|>``, a line end. Adjacent turns of
one role share a block; their texts are set apart by ``<|im_sep|>``, so that the turns can be read back. Control strings
inside a text get a backslash behind their first character, and backslashes are doubled, which ``unescaped`` undoes; a
line end inside a role is written as a control string of its own.

``loss_spans`` are the assistant's texts, in code points of the formatted string, the end exclusive. A null text or role is
an empty one. Turns are ordered by number, nulls first, then by role and text; repeated rows are turns of their own, and
rows with a null id are one conversation. Only the four columns are read. A conversation becomes one string, so it must
fit into a row; conversations are the groups, and no other grouping takes place.
"""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, DataFrame, functions as F

from tillroll.llm.expressions import let

START, SEP, END = "<|im_start|>", "<|im_sep|>", "<|im_end|>"
# control strings of this and other public templates: fixed values
CONTROLS = (START, SEP, END, "<|endoftext|>", "<s>", "</s>", "[INST]", "[/INST]", "<<SYS>>", "<</SYS>>")
_LINE = "[\\NL]"
ASSISTANT = "assistant"


def _replace(text: Column, pairs: list[tuple[str, str]]) -> Column:
    return reduce(lambda t, pair: F.replace(t, F.lit(pair[0]), F.lit(pair[1])), pairs, text)


def _broken(control: str) -> str:
    return f"{control[0]}\\{control[1:]}"


def escaped(text: Column) -> Column:
    return _replace(text, [("\\", "\\\\"), *((c, _broken(c)) for c in CONTROLS)])


def unescaped(text: Column) -> Column:
    return _replace(text, [*((_broken(c), c) for c in CONTROLS), ("\\\\", "\\")])


def _role_escaped(role: Column) -> Column:
    return F.replace(escaped(role), F.lit("\n"), F.lit(_LINE))


def _role_unescaped(role: Column) -> Column:
    return unescaped(F.replace(role, F.lit(_LINE), F.lit("\n")))


def _blocks(turns: Column) -> Column:
    """Sorted turns as blocks (role, texts)."""
    last = F.size(turns) - 1
    opens = lambda i: (i == 0) | (F.get(turns, i)["role"] != F.get(turns, i - 1)["role"])

    def merged(starts: Column, texts: Column) -> Column:
        def block(at: Column, number: Column) -> Column:
            until = F.coalesce(F.get(starts, number + 1), last + 1)
            return F.struct(F.get(turns, at)["role"].alias("role"), F.slice(texts, at + 1, until - at).alias("texts"))

        return F.transform(starts, block)

    starts = F.filter(F.sequence(F.lit(0), last), opens)
    texts = F.transform(turns, lambda t: t["text"])
    return let(starts, lambda s: let(texts, lambda t: merged(s, t)))


def _rendered(block: Column) -> Column:
    return F.concat(F.lit(START), block["role"], F.lit("\n"), F.array_join(block["texts"], SEP), F.lit(f"{END}\n"))


def _spans(blocks: Column) -> Column:
    """The assistant's texts as (start, end), by one fold over the blocks and one over the texts of each."""
    span = "array<struct<start:long,end:long>>"
    state = lambda at, spans: F.struct(at.cast("long").alias("at"), spans.cast(span).alias("spans"))

    def add_text(state_: Column, text: Column) -> Column:
        end = state_["at"] + F.length(text)
        here = F.array(F.struct(state_["at"].alias("start"), end.alias("end"))).cast(span)
        return state(end + len(SEP), F.concat(state_["spans"], here))

    def add_block(state_: Column, block: Column) -> Column:
        body = state_["at"] + len(START) + F.length(block["role"]) + 1
        with_texts = F.aggregate(block["texts"], state(body, state_["spans"]), add_text)["spans"]
        spans = F.when(block["role"] == ASSISTANT, with_texts).otherwise(state_["spans"])
        return state(state_["at"] + F.length(_rendered(block)), spans)

    return F.aggregate(blocks, state(F.lit(0), F.array()), add_block)["spans"]


def formatted(
    conversations: DataFrame, id_col: str = "conv_id", turn_col: str = "turn", role_col: str = "role", text_col: str = "text"
) -> DataFrame:
    """One row per conversation: the id, ``formatted`` and ``loss_spans``."""
    empty = F.lit("")
    turn = F.struct(
        F.col(turn_col).alias("turn"),
        F.coalesce(role_col, empty).alias("role"),
        F.coalesce(text_col, empty).alias("text"),
    )
    turns = conversations.select(F.col(id_col).alias("id"), turn.alias("t")).groupBy("id").agg(F.collect_list("t").alias("turns"))
    ready = F.transform(
        F.sort_array("turns"), lambda t: F.struct(_role_escaped(t["role"]).alias("role"), escaped(t["text"]).alias("text"))
    )
    rows = turns.select("id", let(ready, _blocks).alias("blocks"))
    text = F.array_join(F.transform("blocks", _rendered), "")
    return rows.select(F.col("id").alias(id_col), text.alias("formatted"), _spans(F.col("blocks")).alias("loss_spans"))


def parsed(text: Column) -> Column:
    """The turns (role, text) of a formatted conversation, as they were before."""
    blocks = F.filter(F.split(text, r"<\|im_end\|>\n"), lambda b: b != "")

    def turns(block: Column) -> Column:
        inner = F.substring(block, F.lit(len(START) + 1), F.length(block))
        role = F.substring_index(inner, "\n", 1)
        body = F.substring(inner, F.length(role) + 2, F.length(inner))
        return F.transform(
            F.split(body, r"<\|im_sep\|>"), lambda t: F.struct(_role_unescaped(role).alias("role"), unescaped(t).alias("text"))
        )

    return F.flatten(F.transform(blocks, turns))


def loss_text(text: Column, spans: Column) -> Column:
    """All text under the loss mask, unescaped."""
    one = lambda s: unescaped(F.substring(text, (s["start"] + 1).cast("int"), (s["end"] - s["start"]).cast("int")))
    return F.array_join(F.transform(spans, one), "")
