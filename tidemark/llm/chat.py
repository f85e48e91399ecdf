"""Chat formatting with minimum-cost role repair.

A conversation is legal if it has at most one system turn, at its start, and
then user and assistant turns in alternation, from a user to an assistant.
Turns are read by an automaton of four states. At each turn the repair may
take it as it is, give it another role, merge it into the message before it,
and put an empty turn in front; at the end it may add an empty turn. A dynamic
program finds the cheapest legal sequence, which is then rendered message by
message between ``<|im_start|>`` and ``<|im_end|>``.

Marks of the rendered form that stand in a text get a backslash, ``<\\|im_end|>``,
and one more if they have some already, so no text can forge a turn and the
text can be read back.

The cost of a run of turns, from each state to each state, is a matrix, and
matrices of neighbouring runs combine by (min, +). So a conversation is not
held in one task: rows are range-partitioned by conversation and turn, a
conversation that spans several slices is first reduced to one matrix per
slice, and the states at its seams are chosen from those. At most two
conversations per slice cross a seam, which bounds what the driver sees.

Every turn keeps its text; the rendered fragments of a conversation, in the
order of ``place``, make up the whole.

Defined cases: a null or unknown role must be relabelled or merged; role names
are compared in lower case without blanks around. Null text is empty. A null turn
number comes first; turns with equal numbers are ordered by role and a hash of the text.
Rows without a conversation id are one conversation. Repeated rows are turns
of their own, usually merged. Ties go to the action named first in
``_choices``. An empty table gives no rows; other columns are left out.
"""

from __future__ import annotations

import re

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tidemark.llm.common import partitions, table, whole, whole_groups
from tidemark.llm.registry import query
from tidemark.session import materialise

ROLES = ("system", "user", "assistant")
START, SYSTEM, USER, ASSISTANT = range(4)
OTHER = 3  # the kind of a turn without a known role
RELABEL, RELABEL_UNKNOWN, MERGE, INSERT = 3, 1, 1, 2
# Legal successors of each state, as states.
_NEXT = {START: (SYSTEM, USER), SYSTEM: (USER,), USER: (ASSISTANT,), ASSISTANT: (USER,)}
_FAR = 1 << 40
SLICE_ROWS, SLICE_BYTES = 100_000, 1 << 27  # of what one task repairs at a time, on average
_OUT = (
    "conv string, slice int, place bigint, turn bigint, no_turn boolean, action string, role string, "
    "cost bigint, new_message boolean, text string, rendered string"
)


def _choices() -> list[dict[tuple[int, int], tuple[int, str, int | None]]]:
    """For each kind of turn: (state before, state after) -> cheapest (cost, action, inserted state)."""
    out = []
    for kind in range(4):
        best: dict[tuple[int, int], tuple[int, str, int | None]] = {}

        def offer(s: int, t: int, cost: int, action: str, inserted: int | None, best=best) -> None:
            if (s, t) not in best or cost < best[s, t][0]:
                best[s, t] = (cost, action, inserted)

        for s in range(4):
            for t in (SYSTEM, USER, ASSISTANT):
                change = 0 if kind == t - 1 else RELABEL_UNKNOWN if kind == OTHER else RELABEL
                word = "keep" if not change else "relabel"
                if t in _NEXT[s]:
                    offer(s, t, change, word, None)
                if s == t:
                    offer(s, t, change + MERGE, "merge" if not change else "relabel, merge", None)
                for between in _NEXT[s]:
                    if t in _NEXT[between]:
                        offer(s, t, change + INSERT, word, between)
        out.append(best)
    return out


_BEST = _choices()
_STEP = np.full((4, 4, 4), _FAR, np.int64)
for _kind, _best in enumerate(_BEST):
    for (_s, _t), (_cost, _, _) in _best.items():
        _STEP[_kind, _s, _t] = _cost
# From each state to a legal end: nothing, or an empty turn or two.
_END = {START: (2 * INSERT, (USER, ASSISTANT)), SYSTEM: (2 * INSERT, (USER, ASSISTANT)), USER: (INSERT, (ASSISTANT,)), ASSISTANT: (0, ())}


def run_matrix(kinds: np.ndarray) -> np.ndarray:
    """Cheapest cost of a run of turns from each state to each state."""
    m = np.where(np.eye(4, dtype=bool), 0, _FAR)
    for k in kinds:
        m = (m[:, :, None] + _STEP[k][None, :, :]).min(axis=1)
    return m


def states(kinds: np.ndarray, start: int = START, end: int | None = None) -> list[int]:
    """The states after each turn on the cheapest way from ``start`` to ``end``, or to a legal end."""
    cost = [_FAR] * 4
    cost[start] = 0
    back = []
    for k in kinds:
        new, came = [_FAR] * 4, [0] * 4
        for (s, t), (c, _, _) in _BEST[k].items():
            if cost[s] + c < new[t]:
                new[t], came[t] = cost[s] + c, s
        cost = new
        back.append(came)
    s = min(range(4), key=lambda t: cost[t] + _END[t][0]) if end is None else end
    out = []
    for came in reversed(back):
        out.append(s)
        s = came[s]
    return out[::-1]


def _seams(segments: list) -> dict[tuple[str, int], tuple[int, int | None, int]]:
    """(conversation, slice) -> state at its start, at its end (None: the conversation's end), rows before it."""
    by_conv: dict[str, list] = {}
    for s in segments:
        by_conv.setdefault(s["conv"], []).append(s)
    out = {}
    for conv, runs in by_conv.items():
        runs.sort(key=lambda r: r["slice"])
        matrices = [np.array(r["matrix"], np.int64).reshape(4, 4) for r in runs]
        forward = [np.array([0, _FAR, _FAR, _FAR])]
        for m in matrices:
            forward.append((forward[-1][:, None] + m).min(axis=0))
        at = int(np.argmin(forward[-1] + np.array([_END[t][0] for t in range(4)])))
        ends = [at]
        for m, f in zip(matrices[::-1], forward[-2::-1]):
            at = int(np.argmin(f + m[:, at]))
            ends.append(at)
        ends.reverse()
        before = 0
        for i, r in enumerate(runs):
            out[conv, r["slice"]] = (ends[i], None if i == len(runs) - 1 else ends[i + 1], before)
            before += r["n"]
    return out


def _matrices(rows: pd.DataFrame, first: np.ndarray) -> pd.DataFrame:
    kinds, ends = rows["kind"].to_numpy(), [*first[1:], len(rows)]
    return pd.DataFrame(
        {
            "conv": rows["conv"].to_numpy()[first],
            "slice": rows["slice"].to_numpy()[first],
            "n": [int(b - a) for a, b in zip(first, ends)],
            "matrix": [run_matrix(kinds[a:b]).ravel().tolist() for a, b in zip(first, ends)],
        }
    )


def escaped(text: str) -> str:
    return re.sub(r"<(\\*)\|im_(start|end)\|>", r"<\\\1|im_\2|>", text)


def unescaped(text: str) -> str:
    return re.sub(r"<\\(\\*)\|im_(start|end)\|>", r"<\1|im_\2|>", text)


def _repaired(seams: dict):
    def run(rows: pd.DataFrame, first: np.ndarray) -> pd.DataFrame:
        conv, part, kinds, turn, no_turn, text = (rows[c].tolist() for c in ("conv", "slice", "kind", "turn", "no_turn", "text"))
        out = []

        def add(i: int, place: int, action: str, state: int, cost: int, new: bool, opened: bool, t: str, inserted: bool) -> None:
            head = ("<|im_end|>\n" if opened else "") + f"<|im_start|>{ROLES[state - 1]}\n" if new else "\n\n"
            out.append((conv[i], part[i], place, turn[i], no_turn[i] or inserted, action, ROLES[state - 1], cost, new, t, head + escaped(t)))

        for a, b in zip(first, [*first[1:], len(rows)]):
            s, end, before = seams.get((conv[a], part[a]), (START, None, 0))
            for i, t in zip(range(a, b), states(kinds[a:b], s, end)):
                cost, action, inserted = _BEST[kinds[i]][s, t]
                place = 3 * (before + i - a)
                if inserted is not None:
                    add(i, place, "insert", inserted, INSERT, True, s != START, "", True)
                    s, cost = inserted, cost - INSERT
                add(i, place + 1, action, t, cost, "merge" not in action, s != START, text[i], False)
                s = t
            if end is None:
                for k, t in enumerate(_END[s][1]):
                    add(b - 1, 3 * (before + b - a) + k, "insert", t, INSERT, True, True, "", True)
                out[-1] = (*out[-1][:-1], out[-1][-1] + "<|im_end|>\n")
        return pd.DataFrame(out, columns=[c.split()[0] for c in _OUT.split(", ")])

    return run


def repair(
    turns: DataFrame, id: str = "conv_id", turn: str = "turn", role: str = "role", text: str = "text"
) -> DataFrame:
    """One row per turn and per inserted turn: conv (the id as text), place, turn, action, role, cost, text, rendered."""
    spark = turns.sparkSession
    kind = F.lower(F.trim(F.col(f"`{role}`")))
    number = F.col(f"`{turn}`").cast("long")
    rows = turns.select(
        F.coalesce(F.concat(F.lit("="), F.col(f"`{id}`").cast("string")), F.lit("null")).alias("conv"),
        F.coalesce(number, F.lit(-(1 << 62)).cast("long")).alias("turn"),
        number.isNull().alias("no_turn"),
        F.when(kind == "system", 0).when(kind == "user", 1).when(kind == "assistant", 2).otherwise(OTHER).alias("kind"),
        whole(F.col(f"`{text}`")).alias("text"),
    )
    # The last one tells equal turns apart, so that they can be cut as well.
    order = ["turn", "kind", "tie", "row"]
    size = turns.agg(F.count(F.lit(1)).alias("n"), F.sum(F.octet_length(F.col(f"`{text}`"))).alias("bytes")).first()
    slices = max(partitions(spark), -(-size["n"] // SLICE_ROWS), -(-(size["bytes"] or 0) // SLICE_BYTES))
    tied = rows.withColumns({"tie": F.xxhash64("text"), "row": F.monotonically_increasing_id()})
    # The slice is stored: partitioning a second time may cut elsewhere.
    ranged = tied.repartitionByRange(slices, "conv", *order)
    sliced = materialise(ranged.withColumn("slice", F.spark_partition_id()), "slices")
    crossing = sliced.groupBy("conv").agg(F.count_distinct("slice").alias("slices")).filter("slices > 1").select("conv")
    runs = whole_groups(
        sliced.select("conv", "slice", *order).join(F.broadcast(crossing), "conv"),
        ["slice", "conv"], _matrices, "conv string, slice int, n bigint, matrix array<bigint>", order=order,
    )
    # At most two conversations of a slice go on in another one.
    seams = _seams(runs.collect())
    found = whole_groups(sliced, ["slice", "conv"], _repaired(seams), _OUT, order=order)
    return found.select(
        F.when(F.col("conv") != "null", F.substring("conv", 2, 1 << 30)).alias("conv"),
        "place", F.when(~F.col("no_turn"), F.col("turn")).alias("turn"), "action", "role", "cost", "new_message", "text", "rendered",
    )


@query()
def op1_chat_repair(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = repair(table(spark, sf_dir, "conversations"))
    return found.withColumn("conv", F.col("conv").cast("long")).withColumnRenamed("conv", "conv_id")
