"""Chat formatting in budgeted windows of whole turns.

A conversation's turns are ordered by (turn, role, text), nulls first. Prefix sums of the turns'
token counts place each turn on a line; the line is cut into cells, and the turns that lie inside a
cell are one window's new turns, while a turn that crosses a cell's end is a window of its own (the
only one of its cell if it starts there). So the cut needs no scan along the conversation. A
conversation that fits the budget whole is one window.

A window holds, in order: the conversation's leading system turn, the turns just before the window
(whole turns within ``history`` tokens and within what the budget leaves beside system turn and new
turns), and its new turns. So a window outgrows its budget only if it has no history and its system turn
and one new turn, or its system turn alone, outgrow it. The loss mask covers the texts of new assistant turns only,
so every assistant text is a target once, however often it is repeated as history. The size of a cell
is what system turn and history leave, a quarter of the budget at least as far as the system turn allows.

Prefix sums are built from blocks of ``BLOCK`` turn numbers, so a conversation with a third of all
rows is spread over its blocks; history turns meet their windows by equal cell numbers of the line.

Template: ``<|turn|>role<|text|>text<|end|>``. Inside roles and texts a backslash is doubled, and a
control string (``<|``, ``<s>``, ``</s>``, ``[INST]``, ``[/INST]``) gets a backslash after its first
character; removing one backslash before any character restores the original.

Defined cases: null roles and texts count as empty, a null turn comes first, rows with a null
conversation id are one conversation, repeated rows are turns of their own, extra columns are not
read, and an empty table gives no windows.
"""

from __future__ import annotations

import hashlib
import re
from collections.abc import Iterator

import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

TURN, TEXT, END = "<|turn|>", "<|text|>", "<|end|>"
BLOCK = 64
_CONTROL = r"(<)(?=\||/?s>)|(\[)(?=/?INST\])"
_ESCAPED = re.compile(r"\\(.)", re.DOTALL)


def escape(c: Column) -> Column:
    """Text without control strings, reversible by ``unescape``."""
    return F.regexp_replace(F.replace(c, F.lit("\\"), F.lit("\\\\")), _CONTROL, r"$1$2\\")


def unescape(text: str) -> str:
    return _ESCAPED.sub(r"\1", text)


def token_count(tokenizer: str) -> Column:
    """Tokens of the formatted turn, by a tokenizer of the tokenizers library."""

    def run(texts: pa.Array) -> pa.Array:
        from handoff.llm.elias_fano import encoder

        enc = encoder(tokenizer, 0)
        return pa.array([len(x) // enc.width - 1 for x in enc.encode([t.as_py() for t in texts])], pa.int64())

    return F.arrow_udf(run, "long")(F.col("piece"))


def _lines(turns: DataFrame, tokens: Column, budget: int, history: int) -> DataFrame:
    """One row for each turn: its place on the conversation's line, its cell, and the system turn."""
    turns = turns.withColumn("piece", F.concat(F.lit(TURN), escape(F.col("role")), F.lit(TEXT), escape(F.col("text")), F.lit(END)))
    turns = turns.withColumn("n", F.greatest(tokens, F.lit(1)).cast("long")).withColumn("block", F.floor(F.col("turn") / BLOCK))
    order = ["turn", "role", "text"]
    inside = Window.partitionBy("conv", "block").orderBy(*order).rowsBetween(Window.unboundedPreceding, 0)
    turns = turns.withColumn("upto", F.sum("n").over(inside)).withColumn("no", F.row_number().over(Window.partitionBy("conv", "block").orderBy(*order)))
    blocks = turns.groupBy("conv", "block").agg(F.sum("n").alias("n"), F.min(F.when(F.col("no") == 1, F.struct("role", "piece", "n"))).alias("head"))
    along = Window.partitionBy("conv").orderBy("block")
    whole = Window.partitionBy("conv")
    blocks = blocks.select(F.col("conv").alias("_conv"), F.col("block").alias("_block"), F.sum("n").over(along).alias("_upto"), (F.col("n")).alias("_n"),
                           F.first("head").over(along).alias("_head"), F.sum("n").over(whole).alias("total"),
                           (F.row_number().over(along) == 1).alias("_first"))
    joined = turns.join(blocks, F.col("conv").eqNullSafe(F.col("_conv")) & F.col("block").eqNullSafe(F.col("_block")))
    system = F.col("_head.role") == "system"
    lead = F.when(system, F.col("_head.n")).otherwise(F.lit(0))
    quarter, left = F.lit(max(1, budget // 4)), F.lit(budget) - lead
    room = F.greatest(left - F.lit(history), F.when(left > 0, F.least(quarter, left)).otherwise(quarter))
    joined = joined.select(
        "conv", "role", "text", "piece", "n", "turn",
        F.when(system, F.col("_head.piece")).alias("system"), lead.alias("lead"), room.alias("room"),
        (F.col("total") > budget).alias("cut"), (system & F.col("_first") & (F.col("no") == 1)).alias("is_system"),
        (F.col("_upto") - F.col("_n") + F.col("upto") - F.col("n") - lead).alias("at"))  # the system turn lies before 0
    at = F.greatest("at", F.lit(0))
    cell = F.when(F.col("cut"), F.floor(at / F.col("room"))).otherwise(0).cast("long")
    over = (F.col("cut") & ~F.col("is_system") & (F.pmod(at, F.col("room")) > 0)
            & (F.floor((F.col("at") + F.col("n") - 1) / F.col("room")) > F.floor(at / F.col("room"))))
    return joined.withColumn("cell", cell).withColumn("over", over.cast("int"))


def windows(conversations: DataFrame, tokens: Column | None = None, budget: int = 1024, history: int = 256,
            conv_col: str = "conv_id", turn_col: str = "turn", role_col: str = "role", text_col: str = "text") -> DataFrame:
    """One row for each window: conv_id, cell and over (their order is the windows' order), text, n_tokens,
    n_repeated (leading turns that are repeated), loss_spans (start and end code points in text, end
    excluded, of escaped target texts) and over_budget.

    ``tokens`` counts the tokens of column ``piece``, the formatted turn; by default its UTF-8 bytes.
    """
    blank = F.lit("")
    turns = conversations.select(F.col(conv_col).alias("conv"), F.col(turn_col).cast("long").alias("turn"),
                                 F.coalesce(F.col(role_col).cast("string"), blank).alias("role"),
                                 F.coalesce(F.col(text_col).cast("string"), blank).alias("text"))
    lines = _lines(turns, F.octet_length("piece") if tokens is None else tokens, budget, history)
    keys = ["conv", "cell", "over"]
    new = lines.select(*keys, F.lit(2).alias("kind"), "at", "piece", "n", "role")
    heads = lines.where("cut and not is_system").groupBy(*keys).agg(
        F.min("at").alias("from"), F.sum("n").alias("new"), F.max(F.struct("system", "lead")).alias("s"))
    heads = heads.withColumn("limit", F.greatest(F.lit(0), F.least(F.lit(history), F.lit(budget) - F.col("s.lead") - F.col("new"))))
    # the first window holds the system turn itself
    later = heads.where(((F.col("cell") > 0) | (F.col("over") > 0)) & F.col("s.system").isNotNull())
    repeated = later.select(*keys, F.lit(0).alias("kind"), F.lit(-1).cast("long").alias("at"), F.col("s.system").alias("piece"),
                            F.col("s.lead").alias("n"), F.lit("system").alias("role"))
    parts = new.unionByName(repeated)
    if history > 0:
        reach = F.sequence(F.floor(F.greatest(F.col("from") - history, F.lit(0)) / history), F.floor((F.col("from") - 1) / history))
        wanted = heads.where("from > 0 and limit > 0").select(*keys, "from", "limit", F.explode(reach).alias("hcell"))
        past = lines.where("cut and not is_system").select(F.col("conv").alias("_conv"), F.floor(F.col("at") / history).alias("_hcell"), "at", "piece", "n", "role")
        met = wanted.join(past, F.col("conv").eqNullSafe(F.col("_conv")) & (F.col("hcell") == F.col("_hcell")))
        met = met.where((F.col("at") < F.col("from")) & (F.col("at") >= F.col("from") - F.col("limit")))
        parts = parts.unionByName(met.select(*keys, F.lit(1).alias("kind"), "at", "piece", "n", "role"))
    rows = parts.groupBy(*keys).agg(F.array_sort(F.collect_list(F.struct("kind", "at", "piece", "n", "role"))).alias("turns"))
    before = F.expr("transform(turns, (t, i) -> length(concat_ws('', slice(turns, 1, i).piece)))")
    rows = rows.withColumn("begin", before)
    span = ("filter(transform(turns, (t, i) -> if(t.kind = 2 and t.role = 'assistant', "
            f"named_struct('start', begin[i] + {len(TURN) + len(TEXT)} + length('assistant'), 'end', begin[i] + length(t.piece) - {len(END)}), null)), s -> s is not null)")
    return rows.select(F.col("conv").alias("conv_id"), "cell", "over", F.expr("concat_ws('', turns.piece)").alias("text"),
                       F.expr("aggregate(turns, 0L, (a, t) -> a + t.n)").alias("n_tokens"),
                       F.expr("size(filter(turns, t -> t.kind < 2))").alias("n_repeated"), F.expr(span).alias("loss_spans")
                       ).withColumn("over_budget", F.col("n_tokens") > budget)


def parse(text: str) -> list[tuple[str, str]]:
    """(role, text) of every turn of a formatted window."""
    out = []
    for turn in text.split(TURN)[1:]:
        role, _, body = turn.partition(TEXT)
        out.append((unescape(role), unescape(body.removesuffix(END))))
    return out


def digests(formatted: DataFrame) -> DataFrame:
    """What a reader of the windows finds, one row for each conversation: n_turns, turns_sha256,
    loss_chars, loss_sha256, formatted_chars, n_windows.

    Windows are sorted by conversation and hashed one after another, so memory is one window.
    """
    rows = formatted.select("conv_id", "cell", "over", "text", "n_repeated", "loss_spans").repartition("conv_id")
    rows = rows.sortWithinPartitions("conv_id", "cell", "over")
    names = ["conv_id", "n_turns", "turns_sha256", "loss_chars", "loss_sha256", "formatted_chars", "n_windows"]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        state: list | None = None

        def told(states: list) -> pa.RecordBatch:
            cols = list(zip(*[(s[0], s[1], s[2].hexdigest(), s[3], s[4].hexdigest(), s[5], s[6]) for s in states]))
            kinds = [pa.int64(), pa.int64(), pa.string(), pa.int64(), pa.string(), pa.int64(), pa.int64()]
            return pa.RecordBatch.from_arrays([pa.array(c, k) for c, k in zip(cols, kinds)], names=names)

        for batch in batches:
            done = []
            for r in batch.to_pylist():
                if state is None or state[0] != r["conv_id"]:
                    if state is not None:
                        done.append(state)
                    state = [r["conv_id"], 0, hashlib.sha256(), 0, hashlib.sha256(), 0, 0]
                for role, text in parse(r["text"])[r["n_repeated"]:]:
                    state[1] += 1
                    state[2].update(f"{role}\n{text}\n".encode("utf-8", "surrogatepass"))
                for span in r["loss_spans"]:
                    target = unescape(r["text"][span["start"]: span["end"]])
                    state[3] += len(target)
                    state[4].update(target.encode("utf-8", "surrogatepass"))
                state[5] += len(r["text"])
                state[6] += 1
            if done:
                yield told(done)
        if state is not None:
            yield told([state])

    return rows.mapInArrow(run, "conv_id long, n_turns long, turns_sha256 string, loss_chars long, loss_sha256 string, formatted_chars long, n_windows long")
