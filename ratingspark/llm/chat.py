"""Chat formatting: a hidden Markov model recovers who speaks, then turns are rendered.

A transcript is a sequence of rows, each a sequence of lines.  The hidden
state of a line is a role and whether the line opens a turn.  What is seen of
a line: whether it opens a row, its speaker marker ("User:", "### Assistant:",
"Q:" ...), its length class, whether it asks, and, where it opens a row, the
row's length class.  Viterbi finds the likeliest states; each line that opens
a turn starts a canonical turn, without its marker.

The model is counted from labelled conversations, all of those that are not
held out, plus prior counts for markers.  Only its count table, of fixed size,
reaches the driver.

Conversations are cut into blocks of ``BLOCK`` turn numbers, so one that holds
many rows is many groups.  A block is summed up by the best score from each
state before it to each state at its end (max-plus algebra is associative, so
blocks of blocks combine in the same way, level by level).  Going back down
the levels, each block learns the state before it and the state at its end,
and finds its own states between them: exactly the path that one pass over
the whole conversation would find.
"""

from __future__ import annotations

import math
import re
from collections import Counter
from collections.abc import Iterator
from itertools import groupby

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from .common import saved

#: Roles, and the names that mark them.
ROLES = ("system", "user", "assistant")
MARKERS = {
    "system": ("system", "instruction", "instructions", "prompt"),
    "user": ("user", "human", "customer", "client", "question", "q", "me"),
    "assistant": ("assistant", "ai", "bot", "model", "agent", "answer", "a", "gpt"),
}
BLOCK = 256
FOLDS = 5
#: Prior counts: of any event, and of a marker at the opening line of its role.
SMOOTH, MARKED = 0.5, 20.0

STATES = 2 * len(ROLES)  # role r opens a turn: 2 r; goes on: 2 r + 1
_NAMES = {name: n for n, role in enumerate(ROLES) for name in MARKERS[role]}
_MARKER = re.compile(
    r"^[\s>]*(?:#{1,6}\s*|\*{1,2}|<\|?|\[)?(" + "|".join(sorted(_NAMES, key=len, reverse=True))
    + r")\s*(?:\|?>|\]|:\*{1,2}|\*{1,2}\s*:|:)\s*", re.IGNORECASE)
_LENGTHS = 16
_NEVER = -1e9


def marker(line: str) -> tuple[int, str]:
    """(role number of a speaker marker or -1, the line without it)."""
    found = _MARKER.match(line)
    return (_NAMES[found[1].lower()], line[found.end():]) if found else (-1, line)


def _length(n: int) -> int:
    return min(_LENGTHS - 1, int(2 * math.log2(n + 1)) // 2)


def observe(text: str | None) -> list[tuple[int, int, int, int, int]]:
    """What is seen of each line of a row: opens, marker, length, asks, row length (or -1)."""
    text = text or ""
    seen = []
    for n, line in enumerate(text.split("\n")):
        role, rest = marker(line)
        seen.append((int(n == 0), role, _length(len(rest)), int(rest.rstrip().endswith("?")),
                     _length(len(text)) if n == 0 else -1))
    return seen


class Model:
    """Log probabilities from counts of events: start, step and line features by state."""

    def __init__(self, counts: dict[tuple, float]):
        def table(name: str, rows: int, columns: int, prior: np.ndarray | None = None) -> np.ndarray:
            got = np.full((rows, columns), SMOOTH) if prior is None else prior.copy()
            for (kind, i, j), n in counts.items():
                if kind == name:
                    got[i, j] += n
            return np.log(got / got.sum(axis=1, keepdims=True))

        opens, goes = np.arange(0, STATES, 2), np.arange(1, STATES, 2)
        first = np.full((1, STATES), SMOOTH)
        first[:, goes] = 1e-300  # a conversation begins with a turn
        self.first = table("first", 1, STATES, first)[0]
        step = np.full((STATES, STATES), SMOOTH)
        for s in range(STATES):
            step[s, goes[goes != s // 2 * 2 + 1]] = 1e-300  # only the same role goes on
        self.step = table("step", STATES, STATES, step)
        marks = np.full((STATES, len(ROLES) + 1), 0.01)
        marks[:, 0] = SMOOTH
        marks[opens, np.arange(len(ROLES)) + 1] = MARKED
        marks[opens, 0] = MARKED
        marks[goes, 0] = MARKED
        self.marker = table("marker", STATES, len(ROLES) + 1, marks)
        self.length = table("length", STATES, _LENGTHS)
        self.asks = table("asks", STATES, 2)
        self.row = table("row", STATES, _LENGTHS)

    def scores(self, seen: list[tuple[int, int, int, int, int]]) -> np.ndarray:
        """Log likelihood of each line in each state; only a turn's opening line opens a row."""
        x = np.array(seen)
        out = self.marker[:, x[:, 1] + 1] + self.length[:, x[:, 2]] + self.asks[:, x[:, 3]]
        out = out + np.where(x[:, 4] >= 0, self.row[:, np.maximum(x[:, 4], 0)], 0.0)
        out[1::2, x[:, 0] == 1] = _NEVER
        return out.T


def block_matrix(model: Model, scores: np.ndarray) -> np.ndarray:
    """Best score from each state before a block (last row: the beginning) to each state at its end."""
    best = np.vstack([model.step, model.first[None, :]]) + scores[0]
    for s in scores[1:]:
        best = (best[:, :, None] + model.step[None, :, :]).max(axis=1) + s
    return best


def best_path(model: Model, scores: np.ndarray, before: int, end: int | None) -> list[int]:
    """The likeliest states of a block after state ``before`` (-1: none), ending in ``end`` if given."""
    best = (model.first if before < 0 else model.step[before]) + scores[0]
    back = []
    for s in scores[1:]:
        moves = best[:, None] + model.step
        back.append(moves.argmax(axis=0))
        best = moves.max(axis=0) + s
    state = int(best.argmax()) if end is None else end
    path = [state]
    for came in reversed(back):
        state = int(came[state])
        path.append(state)
    return path[::-1]


def _keyed(conversations: DataFrame) -> DataFrame:
    """Rows with their conversation ``_conv`` and ``_block``; a null id is a conversation of its own row."""
    conv = F.coalesce(F.col("conv_id").cast("string"), F.concat(
        F.lit("row "), F.xxhash64("turn", "role", "text").cast("string")))
    turn = F.coalesce(F.col("turn").cast("long"), F.lit(-1))
    return conversations.select(
        "conv_id", "turn", "role", "text", conv.alias("_conv"), turn.alias("_turn"),
        F.floor(turn / BLOCK).cast("long").alias("_block"),
        (F.crc32(F.col("conv_id").cast("string").cast("binary")) % FOLDS).alias("_fold"))


def _in_blocks(rows: DataFrame) -> DataFrame:
    """Rows dealt by block, in order within it."""
    return rows.repartition("_conv", "_block").sortWithinPartitions("_conv", "_block", "_turn", "role", "text")


def _groups(frames: Iterator[pd.DataFrame]) -> Iterator[tuple[tuple, list[tuple]]]:
    """((conversation, block), rows) of frames in order: one block at a time is held."""
    rows = (tuple(r) for f in frames for r in f.itertuples(index=False, name=None))
    for key, group in groupby(rows, key=lambda r: r[:2]):
        yield key, [r[2:] for r in group]


def learn(conversations: DataFrame) -> dict[tuple, float]:
    """Counts of events from all labelled rows of conversations that are not held out.

    A row's lines are taken as one turn of its role.  Rows without a known
    role, or without a conversation id, are not learned from.  Each block also
    gets the last row of the block before it, as a ``guest`` that only serves
    as its first row's predecessor.
    """
    def count(frames: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        seen: Counter = Counter()
        for _, rows in _groups(frames):
            last = None
            for n, (role, text, guest) in enumerate(rows):
                if role not in ROLES:
                    last = None
                    continue
                state = 2 * ROLES.index(role)
                if guest:
                    last = state + int("\n" in (text or ""))
                    continue
                if n == 0:
                    seen["first", 0, state] += 1
                for opens, mark, length, asks, row in observe(text):
                    now = state if opens else state + 1
                    if last is not None:
                        seen["step", last, now] += 1
                    seen["marker", now, mark + 1] += 1
                    seen["length", now, length] += 1
                    seen["asks", now, asks] += 1
                    if row >= 0:
                        seen["row", now, row] += 1
                    last = now
        yield pd.DataFrame([(k, i, j, float(n)) for (k, i, j), n in seen.items()], columns=["k", "i", "j", "n"])

    known = _keyed(conversations).where(F.col("_fold") != 0).select("_conv", "_block", "_turn", "role", "text")
    ends = known.groupBy("_conv", "_block").agg(F.max(F.struct("_turn", "role", "text")).alias("end"))
    after = F.lead("_block").over(Window.partitionBy("_conv").orderBy("_block"))
    guests = ends.select("_conv", after.alias("_block"), "end.*").where(F.col("_block").isNotNull())
    both = known.withColumn("guest", F.lit(False)).unionByName(guests.withColumn("guest", F.lit(True)))
    dealt = _in_blocks(both).select("_conv", "_block", "role", "text", "guest")
    counts = dealt.mapInPandas(count, "k string, i int, j int, n double").groupBy("k", "i", "j").agg(F.sum("n").alias("n"))
    return {(r["k"], r["i"], r["j"]): r["n"] for r in counts.collect()}  # events times states: a fixed size


def _combine(matrices: np.ndarray) -> np.ndarray:
    best = matrices[0]
    for m in matrices[1:]:
        best = (best[:, :, None] + m[None, :STATES, :]).max(axis=1)
    return best


def _matrix(column: pd.Series) -> np.ndarray:
    return np.stack([np.asarray(x) for x in column]).reshape(-1, STATES + 1, STATES)


def boundaries(matrices: DataFrame, block: int = BLOCK) -> DataFrame:
    """``(_conv, _block, before, end)`` of the likeliest path, of ``matrices(_conv, _block, best)``.

    Blocks of a conversation are grouped by ``block`` neighbours, level by
    level, until each conversation is one group; then states go back down.
    """
    group = F.floor(F.col("_block") / block).cast("long")

    def up(key: tuple, rows: pd.DataFrame) -> pd.DataFrame:
        best = _combine(_matrix(rows.sort_values("_block")["best"]))
        return pd.DataFrame({"_conv": [key[0]], "_block": [key[1]], "best": [best.ravel().tolist()]})

    def down(key: tuple, rows: pd.DataFrame) -> pd.DataFrame:
        rows = rows.sort_values("_block")
        best = _matrix(rows["best"])
        before = rows["before"].iloc[0]
        given = -1 if pd.isna(before) else int(before)
        end = rows["end"].iloc[0]
        score, back = best[0][given if given >= 0 else STATES], []
        for m in best[1:]:
            moves = score[:, None] + m[:STATES]
            back.append(moves.argmax(axis=0))
            score = moves.max(axis=0)
        ends = [int(score.argmax()) if pd.isna(end) else int(end)]
        for came in reversed(back):
            ends.append(int(came[ends[-1]]))
        ends.reverse()
        return pd.DataFrame({"_conv": rows["_conv"], "_block": rows["_block"],
                             "before": [given, *ends[:-1]], "end": ends})

    shape = "_conv string, _block long, before int, end int"
    several = matrices.groupBy("_conv").agg(F.min("_block").alias("lo"), F.max("_block").alias("hi")) \
        .where(F.floor(F.col("lo") / block) != F.floor(F.col("hi") / block))
    if several.isEmpty():
        blank = F.lit(None).cast("int")
        top = matrices.withColumns({"before": blank, "end": blank})
        return top.groupBy("_conv").applyInPandas(down, shape)
    upper = saved(matrices.groupBy("_conv", group.alias("_group")).applyInPandas(
        up, "_conv string, _block long, best array<double>"), "level")
    known = saved(boundaries(upper, block), "bounds").withColumnRenamed("_block", "_group")
    return matrices.withColumn("_group", group).join(known, ["_conv", "_group"]).groupBy(
        "_conv", "_group").applyInPandas(down, shape)


def render(turns: list[tuple[str, str]]) -> str:
    """Turns (role, text) in canonical form."""
    return "".join(f"<|im_start|>{role}\n{text}<|im_end|>\n" for role, text in turns)


def turns_of(text: str | None, states: list[int]) -> list[tuple[str, str]]:
    """Turns (role, text without markers) of a row whose lines have ``states``."""
    turns: list[tuple[str, list[str]]] = []
    for line, state in zip((text or "").split("\n"), states):
        if state % 2 == 0 or not turns:
            turns.append((ROLES[state // 2], [marker(line)[1]]))
        else:
            turns[-1][1].append(line)
    return [(role, "\n".join(lines).strip()) for role, lines in turns]


def format_chat(conversations: DataFrame, counts: dict[tuple, float]) -> DataFrame:
    """One row per row of ``conversations(conv_id, turn, role, text)``, with its recovered turns.

    Columns: conv_id, turn, held_out, role_pred (role of the row's first turn),
    n_turns (turns that the row holds) and rendered (canonical turns).  ``role``
    is not read, except to order rows with equal conv_id and turn (then text).
    Null texts are empty lines; null turns come first; each row without a
    conversation id is a conversation of its own; repeated rows are turns like
    others; an empty table gives no rows; other columns are ignored.
    """
    model = Model(counts)
    rows = _keyed(conversations.withColumn("role", F.lit("")))

    def score(frames: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        out = []
        for (conv, block), group in _groups(frames):
            best = block_matrix(model, model.scores([x for (text,) in group for x in observe(text)]))
            out.append((conv, block, best.ravel().tolist()))
        yield pd.DataFrame(out, columns=["_conv", "_block", "best"])

    def decode(frames: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for (_, _), group in _groups(frames):
            before, end = group[0][:2]
            seen = [observe(r[-1]) for r in group]
            path = best_path(model, model.scores([x for s in seen for x in s]),
                             -1 if pd.isna(before) else int(before), None if pd.isna(end) else int(end))
            out = []
            for (_, _, conv_id, turn, fold, text), own in zip(group, seen):
                states, path = path[:len(own)], path[len(own):]
                turns = turns_of(text, states)
                out.append((None if pd.isna(conv_id) else int(conv_id), None if pd.isna(turn) else int(turn),
                            bool(fold == 0), ROLES[states[0] // 2], len(turns), render(turns)))
            yield pd.DataFrame(out, columns=["conv_id", "turn", "held_out", "role_pred", "n_turns", "rendered"]).astype(
                {"conv_id": "Int64", "turn": "Int64"})

    # Only conversations of several blocks need to know more than their own rows.
    spans = rows.groupBy("_conv").agg(F.min("_block").alias("lo"), F.max("_block").alias("hi")).where("lo != hi")
    long = saved(spans.select("_conv"), "long")
    shape = "conv_id long, turn long, held_out boolean, role_pred string, n_turns int, rendered string"
    # Ids travel as strings: pandas would turn a column with nulls into floats.
    ids = [F.col(c).cast("long").cast("string").alias(c) for c in ("conv_id", "turn")]
    columns = ["_conv", "_block", "before", "end", *ids, "_fold", "text"]
    blank = F.lit(None).cast("int")
    if long.isEmpty():
        given = rows.withColumns({"before": blank, "end": blank})
    else:
        matrices = saved(_in_blocks(rows.join(long, "_conv", "left_semi")).select("_conv", "_block", "text").mapInPandas(
            score, "_conv string, _block long, best array<double>"), "matrices")
        given = rows.join(saved(boundaries(matrices), "bounds"), ["_conv", "_block"], "left")
    return _in_blocks(given).select(*columns).mapInPandas(decode, shape)
