"""Transcript parsing: roles of lines by a hidden Markov model, then canonical turns.

A transcript is a sequence of rows (conversation, turn, text); a row's text falls into blocks at lines that begin with a speaker marker.
Hidden states are roles.  Lines emit symbols: the first line of a block its marker and the block's shape (length, lines, closing question mark), other lines
their own shape.  Roles change between blocks by one matrix and hardly ever inside a block by another.  Probabilities are counted from rows
with a known role; where there are none, markers and an even chance decide.  Viterbi finds the likeliest roles, and each block is rendered below a header wherever
the role changes.

A conversation of any length spreads over tasks.  A step of Viterbi is a product of matrices in which maximum replaces sum, and such products are
associative: rows are range-sorted by conversation and turn, each partition reduces the pieces of its first and last conversation to one
matrix, and the matrices (two per partition) give every partition the scores before its first row and the role after its last.

Defined cases: null and empty texts are one empty line; rows without conversation form one conversation; rows repeated in conversation and turn are ordered
by their texts' hashes; rows without role teach nothing; no rows give no rows; extra columns are not read.
"""

from __future__ import annotations

import json
import re
from collections import Counter
from collections.abc import Iterator
from dataclasses import dataclass
from itertools import groupby

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame, functions as F

from stratamart.llm.common import fold, stored

#: Speakers at the beginning of a line, and the role that each names.
SPEAKERS = {
    "system": "system", "user": "user", "human": "user", "customer": "user", "question": "user", "q": "user", "prompter": "user",
    "assistant": "assistant", "ai": "assistant", "bot": "assistant", "agent": "assistant", "answer": "assistant", "a": "assistant", "model": "assistant",
}
ROLES = ("assistant", "system", "user")
_MARKER = re.compile(r"[\s#*<|\[\-]{0,6}(?:im_start\|>)?(" + "|".join(SPEAKERS) + r")[\]|>*]{0,3}\s*(?::|>|\n|$)[ *]*", re.IGNORECASE)
FOLDS, HELD_OUT = 5, 0
STAY = 0.999
HEADER = "<|{role}|>\n"


def blocks(text: str | None) -> list[tuple[str | None, list[str]]]:
    """(marker's role, lines without the marker) of each block of a text."""
    out: list[tuple[str | None, list[str]]] = []
    for line in (text or "").split("\n"):
        m = _MARKER.match(line)
        if m and (":" in m[0] or ">" in m[0] or "#" in m[0]):
            out.append((SPEAKERS[m[1].lower()], [line[m.end() :]]))
        elif out:
            out[-1][1].append(line)
        else:
            out.append((None, [line]))
    return out


def symbols(marker: str | None, lines: list[str]) -> list[str]:
    """What each line of a block emits."""
    whole = "\n".join(lines)
    size = min(12, int(np.log2(len(whole) + 1) * 1.5))
    first = f"{marker or '-'}|{size}|{min(3, len(lines) - 1)}|{'?' if whole.rstrip().endswith('?') else '.'}"
    shape = lambda x: "code" if x.startswith(("```", "    ", "\t")) else "list" if re.match(r"\s*([-*•]|\d+[.)])\s", x) else "empty" if not x.strip() else "text"
    return [first, *map(shape, lines[1:])]


#: Log-probability of what cannot be.
NEVER = -1e9


@dataclass(frozen=True)
class Model:
    """The last state, behind the roles, is the beginning of a conversation: nothing leads to it."""

    roles: tuple[str, ...]
    turn: np.ndarray
    emit: dict[str, np.ndarray]
    unseen: np.ndarray
    markers: dict[str, np.ndarray]

    def start(self) -> np.ndarray:
        return np.r_[np.full(len(self.roles), NEVER), 0.0]

    def emission(self, symbol: str) -> np.ndarray:
        known = self.emit.get(symbol)
        if known is not None:
            return known
        return self.markers.get(symbol.split("|")[0], self.unseen)

    def step(self, marker: str | None, lines: list[str]) -> np.ndarray:
        """A block as a matrix from the role before it to the role at its end, in logs: a turn, and then stays."""
        n = len(self.roles)
        inside = np.full((n + 1, n + 1), np.log((1 - STAY) / max(n - 1, 1)))
        np.fill_diagonal(inside, np.log(STAY))
        inside[n, :] = inside[:, n] = NEVER
        first, *rest = symbols(marker, lines)
        out = self.turn + self.emission(first)
        for s, run in groupby(rest):
            out = _product(out, _power(inside + self.emission(s), len(list(run))))
        return out


def _power(a: np.ndarray, k: int) -> np.ndarray:
    """The product of k equal matrices, by repeated squaring."""
    out = None
    while True:
        if k & 1:
            out = a if out is None else _product(out, a)
        k >>= 1
        if not k:
            return out
        a = _product(a, a)


def _product(a: np.ndarray, b: np.ndarray) -> np.ndarray:
    return (a[:, :, None] + b[None, :, :]).max(axis=1)


def _sorted(rows: DataFrame) -> DataFrame:
    """conv_id, turn, role and text in order, each with its partition."""
    rows = rows.select(
        F.coalesce(F.col("conv_id").cast("string"), F.lit("")).alias("conv"), F.col("conv_id").isNull().alias("no_conv"), "conv_id", "turn", "role", "text",
        F.xxhash64("text").alias("tie"),
    )
    keys = ["no_conv", "conv_id", "turn", "tie"]
    return stored(rows.repartitionByRange(*keys).sortWithinPartitions(*keys).withColumn("part", F.spark_partition_id()))


def train(ordered: DataFrame) -> Model:
    """Count beginnings, turns and emissions of rows with a role outside the held-out conversations.

    Whether a partition's first row begins a conversation is seen from the rows at the partitions' ends, one pair per partition.
    """

    def count(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        seen: Counter = Counter()
        first, last, role_before = None, None, None
        for b in batches:
            for part, conv, known, role, text in zip(b["part"], b["conv"], b["known"], b["role"], b["text"]):
                opens, first = first is None, first or [int(part), conv, bool(known), role]
                if known and role is not None:
                    if opens:
                        pass
                    elif conv != last:
                        seen["begin", role, ""] += 1
                    elif role_before is not None:
                        seen["turn", role_before, role] += 1
                    for marker, lines in blocks(text)[:1]:
                        for s in symbols(marker, lines):
                            seen["emit", role, s] += 1
                last, role_before = conv, role
        if first:
            seen["ends", json.dumps([*first, last, role_before]), ""] += 1
        yield pd.DataFrame([(*k, n) for k, n in seen.items()], columns=["kind", "a", "b", "n"])

    rows = ordered.select("part", "conv", (fold(F.col("conv_id"), FOLDS) != HELD_OUT).alias("known"), "role", "text")
    counts = rows.mapInPandas(count, "kind string, a string, b string, n bigint").groupBy("kind", "a", "b").agg(F.sum("n").alias("n")).collect()
    last, role_before = None, None
    borders = []
    for _, conv, known, role, *end in sorted((json.loads(r["a"]) for r in counts if r["kind"] == "ends"), key=lambda e: e[0]):
        if known and role is not None:
            if conv != last:
                borders.append({"kind": "begin", "a": role, "b": "", "n": 1})
            elif role_before is not None:
                borders.append({"kind": "turn", "a": role_before, "b": role, "n": 1})
        last, role_before = end
    counts = [r for r in counts if r["kind"] != "ends"] + borders
    roles = tuple(sorted({r["a"] for r in counts} | set(ROLES)))
    at = {r: i for i, r in enumerate(roles)}
    n = len(roles)
    turn = np.full((n + 1, n), 0.1)
    emit: dict[str, np.ndarray] = {}
    for r in counts:
        if r["kind"] == "begin":
            turn[n, at[r["a"]]] += r["n"]
        elif r["kind"] == "turn":
            turn[at[r["a"]], at[r["b"]]] += r["n"]
        else:
            emit.setdefault(r["b"], np.zeros(len(roles)))[at[r["a"]]] += r["n"]
    total = sum(emit.values(), np.zeros(len(roles))) + 0.5 * (len(emit) + 1)
    markers = {}
    for role in ROLES:
        chance = np.full(len(roles), 0.01)
        chance[at[role]] = 1.0
        markers[role] = np.log(chance)
    wide = lambda logs: np.r_[logs, NEVER]
    steps = np.hstack([np.log(turn / turn.sum(axis=1, keepdims=True)), np.full((n + 1, 1), NEVER)])
    return Model(roles, steps, {s: wide(np.log((k + 0.5) / total)) for s, k in emit.items()}, wide(np.log(0.5 / total)), {r: wide(v) for r, v in markers.items()})


def _ends(ordered: DataFrame, model: Model) -> dict[int, tuple]:
    """Per partition: its first and last conversation with their matrices, and whether they are one."""

    def reduce(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        part, first, now, matrix, head = None, None, None, None, None
        for b in batches:
            for part, conv, text in zip(b["part"], b["conv"], b["text"]):
                steps = [model.step(m, lines) for m, lines in blocks(text)]
                if conv != now:
                    if now is not None and head is None:
                        head = matrix
                    first, now, matrix = conv if now is None else first, conv, None
                for s in steps:
                    matrix = s if matrix is None else _product(matrix, s)
        if now is not None:
            one = head is None
            yield pd.DataFrame({"part": [part], "first": [first], "last": [now], "one": [one], "head": [(matrix if one else head).ravel().tolist()], "tail": [matrix.ravel().tolist()]})

    rows = ordered.select("part", "conv", "text").mapInPandas(reduce, "part int, first string, last string, one boolean, head array<double>, tail array<double>")
    n = len(model.roles) + 1
    return {r["part"]: (r["first"], r["last"], r["one"], np.array(r["head"]).reshape(n, n), np.array(r["tail"]).reshape(n, n)) for r in rows.collect()}


def _borders(ends: dict[int, tuple], model: Model) -> dict[int, tuple[np.ndarray, int | None]]:
    """Per partition: scores of the states before its first row, and the role after its last row where its conversation goes on."""
    parts = sorted(ends)
    before: dict[int, np.ndarray] = {}
    scores = model.start()
    for k, p in enumerate(parts):
        first, _, one, head, tail = ends[p]
        goes_on = k > 0 and ends[parts[k - 1]][1] == first
        before[p] = scores if goes_on else model.start()
        scores = ((before[p] if one else model.start())[:, None] + tail).max(axis=0)
    after: dict[int, int | None] = {}
    role: int | None = None  # the state before the first row of the next partition
    for k in range(len(parts) - 1, -1, -1):
        first, last, one, head, _ = ends[parts[k]]
        after[parts[k]] = role if k + 1 < len(parts) and ends[parts[k + 1]][0] == last else None
        end = after[parts[k]] if one else None
        path = before[parts[k]][:, None] + head
        role = int(path[:, int(path.max(axis=0).argmax()) if end is None else end].argmax())
    return {p: (before[p], after[p]) for p in parts}


def parse(rows: DataFrame, model: Model | None = None) -> DataFrame:
    """(conv_id, turn, block, role_given, role, new_turn, rendered) of every block of a transcript (conv_id, turn, role, text)."""
    ordered = _sorted(rows)
    model = model or train(ordered)
    borders = _borders(_ends(ordered, model), model)
    shared = ordered.sparkSession.sparkContext.broadcast(borders)
    size = 256

    def roles(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        out: list[tuple] = []

        def decode(held: list[tuple], before: np.ndarray, after: int | None) -> None:
            """Viterbi over the rows of one conversation in this partition."""
            steps = [(r, k, m, lines) for r in held for k, (m, lines) in enumerate(blocks(r[3]))]
            scores = [before]
            matrices = [model.step(m, lines) for _, _, m, lines in steps]
            for s in matrices:
                scores.append((scores[-1][:, None] + s).max(axis=0))
            role = after if after is not None else int(scores[-1].argmax())
            path = [role]
            for v, s in zip(scores[-2::-1], matrices[::-1]):
                path.append(int((v + s[:, path[-1]]).argmax()))
            path.reverse()  # path[0] is the role before the first row
            for i, (r, k, _, lines) in enumerate(steps):
                new = path[i + 1] != path[i]
                name = model.roles[path[i + 1]]
                out.append((r[0], r[1], k, r[2], name, bool(new), (HEADER.format(role=name) if new else "") + "\n".join(lines)))

        def full(least: int) -> Iterator[pd.DataFrame]:
            while len(out) > least:
                yield pd.DataFrame(out[:size], columns=["conv_id", "turn", "block", "role_given", "role", "new_turn", "rendered"])
                del out[:size]

        held: list[tuple] = []
        now, at_start, part = None, True, None
        for b in batches:
            for part, conv, *row in zip(b["part"], b["conv"], b["conv_id"].astype(object), b["turn"].astype(object), b["role"], b["text"]):
                row = [None if x is None or x != x else x for x in row]
                if conv != now and held:
                    decode(held, shared.value[part][0] if at_start else model.start(), None)
                    yield from full(size)
                    held, at_start = [], False
                now = conv
                held.append(tuple(row))
        if held:
            decode(held, shared.value[part][0] if at_start else model.start(), shared.value[part][1])
        yield from full(0)

    kinds = {f.name: f.dataType.simpleString() for f in ordered.schema}
    return ordered.select("part", "conv", "conv_id", "turn", "role", "text").mapInPandas(
        roles, f"conv_id {kinds['conv_id']}, turn {kinds['turn']}, block int, role_given string, role string, new_turn boolean, rendered string"
    )


def op4(conversations: DataFrame) -> DataFrame:
    return parse(conversations)
