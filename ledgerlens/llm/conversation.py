"""Conversation structure repair: cost DP, then path ranks by prefix doubling.

Rows are put in turn order by a range exchange, so that a conversation of any
length is spread over tasks, and cut into pieces: a conversation that a task
holds whole is one piece, a longer one has a piece per PIECE rows and task.
Inside a piece the roles kept so far are one of four states, and a row is a
4 x 4 matrix of least edit costs; suffix products of these by doubling give the
cost to go of every node (row, state).  An arc is optimal if it keeps that cost.

Optimal-arc nodes are ranked by their least audit of 1, 2, 4, ... edits: the
rank for twice the length orders the pairs (own rank, rank of the node that
many edits on), and the pointers to that node double along.  From one node an
audit letter leads to one node only, so these pointers are unique; the path is
read off them by the bits of the distance.

A piece of a longer conversation is first solved towards each state that it can
end in; its least costs, and the ranks that order equally cheap ends, are
chained over the pieces of the conversation, and fix where each piece begins
and ends.
"""

from __future__ import annotations

import functools
import hashlib
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.pandas.types import to_arrow_schema
from pyspark.sql.types import StructType

from .common import WS_CHARS, parts, written

#: Rows of a piece at most.  Changes the work, never the result.
PIECE = 4096
#: Edit costs.
REROLE, DELETE, INSERT, TRUNCATED = 1, 2, 5, 5
#: Audit letters in ASCII order, numbered from 1; 0 is the end of an audit.
LETTERS = "DIKR"
#: States: nothing kept yet, then the initial kept last (s, u, a).  The state after a user or assistant that the
#: order wants next, and the state after keeping an initial (0 s, 1 u, 2 a, 3 any other); -1: not in order.
NEXT = np.array([2, 2, 3, 2])
KEEP = np.array([[1, 2, -1, -1], [-1, 2, -1, -1], [-1, -1, 3, -1], [-1, 2, -1, -1]])
FAR = np.int64(1) << 60
#: Cost of ending a conversation in a state: nothing, and after an assistant, is in order.
ENDING = np.array([0, 2 * INSERT, INSERT, 0])
ROLE = {2: "user", 3: "assistant"}


def _least(a: np.ndarray, b: np.ndarray) -> np.ndarray:
    """Min-plus products of stacks of 4 x 4 matrices."""
    return np.minimum((a[:, :, :, None] + b[:, None, :, :]).min(axis=2), FAR)


@dataclass
class Graph:
    """Nodes are ``4 * place + state``; a piece has a place per row and one after its last."""

    first: np.ndarray       # place of each piece's first row
    cost: np.ndarray        # cost to go of each node
    letter: np.ndarray      # first audit letter of each node (0: end)
    rank: np.ndarray        # rank of each node's whole audit
    jumps: list             # pointers 1, 2, 4, ... edits on
    length: np.ndarray      # edits from each node to the end


def graph(initial: np.ndarray, forced: np.ndarray, cut_short: np.ndarray, copies: np.ndarray,
          sizes: np.ndarray, ends: np.ndarray) -> Graph:
    """Ranks and pointers of pieces laid one after the other.

    For each row: its role's initial (0 s, 1 u, 2 a, 3 other), whether it must
    go, whether it is truncated, and how many equal rows that must go it stands
    for; for each piece its ``sizes`` and the cost ``ends`` of each state at its end.
    """
    p = len(sizes)
    first = np.concatenate([[0], np.cumsum(sizes + 1)[:-1]]).astype(np.int64)
    last = first + sizes
    total = int((sizes + 1).sum())
    rows = np.ones(total, bool)
    rows[last] = False
    at = np.flatnonzero(rows)
    stop = np.repeat(last, sizes + 1)
    q = np.arange(4)

    keep_to = KEEP[:, initial].T                                             # rows x state
    extra = (cut_short * TRUNCATED)[:, None]
    gone = np.where(forced[:, None], FAR, 0)
    kept = np.where(keep_to >= 0, extra + gone, FAR)
    turned = np.broadcast_to(REROLE + extra + gone, (len(at), 4))
    dropped = DELETE * copies

    step = np.full((total, 4, 4), FAR)
    step[:, q, q] = 0
    own = np.full((len(at), 4, 4), FAR)
    own[:, q, q] = dropped[:, None]
    for s in range(4):
        own[:, s, NEXT[s]] = np.minimum(own[:, s, NEXT[s]], turned[:, s])
        for to in range(4):
            own[:, s, to] = np.where(keep_to[:, s] == to, np.minimum(own[:, s, to], kept[:, s]), own[:, s, to])
    inserts = np.full((1, 4, 4), FAR)
    inserts[0, q, q] = 0
    inserts[0, q, NEXT] = INSERT
    step[at] = _least(np.broadcast_to(_least(inserts, inserts), own.shape), own)
    reach = 1
    while reach < sizes.max(initial=0):
        step = _least(step, step[np.minimum(np.arange(total) + reach, stop)])
        reach *= 2
    ends_at = np.repeat(ends, sizes + 1, axis=0)
    cost = np.minimum((step + ends_at[:, None, :]).min(axis=2), FAR)
    cost[last] = ends

    # the first letter, in ASCII order, whose arc keeps the cost to go
    end = 4 * total
    letter, to = np.zeros((total, 4), np.int64), np.full((total, 4), end)
    for s in range(4):
        arcs = np.full((total, 4), FAR)
        target = np.zeros((total, 4), np.int64)
        arcs[at, 0], target[at, 0] = dropped + cost[at + 1, s], 4 * (at + 1) + s
        arcs[:, 1], target[:, 1] = INSERT + cost[:, NEXT[s]], 4 * np.arange(total) + NEXT[s]
        arcs[at, 2], target[at, 2] = kept[:, s] + cost[at + 1, np.maximum(keep_to[:, s], 0)], 4 * (at + 1) + np.maximum(keep_to[:, s], 0)
        arcs[at, 3], target[at, 3] = turned[:, s] + cost[at + 1, NEXT[s]], 4 * (at + 1) + NEXT[s]
        good = (arcs == cost[:, s, None]) & (cost[:, s, None] < FAR)
        good[last] &= (ends[:, s] > 0)[:, None]
        some = good.any(axis=1)
        pick = good.argmax(axis=1)
        letter[:, s] = np.where(some, pick + 1, 0)
        to[:, s] = np.where(some, target[np.arange(total), pick], end)
    letter = np.append(letter.ravel(), 0)
    to = np.append(to.ravel(), end)
    rank, length, jumps = letter.copy(), (letter > 0).astype(np.int64), [to]
    while (jumps[-1] != end).any():
        on = jumps[-1]
        rank = np.unique(rank * (rank.max() + 1) + rank[on], return_inverse=True)[1]
        length = length + length[on]
        jumps.append(on[on])
    return Graph(first, cost.ravel(), letter, rank, jumps, length)


def paths(g: Graph, starts: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """``(nodes, nodes after each, ends)`` of the least paths from ``starts``, one
    after the other, each read off the doubled pointers."""
    n = g.length[starts]
    ends = np.cumsum(n)
    far = np.arange(ends[-1] if len(ends) else 0) - np.repeat(ends - n, n)
    at = np.repeat(starts, n)
    for k, jump in enumerate(g.jumps):
        at = np.where(far >> k & 1, jump[at], at)
    return at, g.jumps[0][at], ends


# ---------------------------------------------------------------- rows and pieces
_ROW = "struct<turn:long, role:string, h1:long, h2:long, copies:long, forced:boolean, cut_short:boolean>"
_EDIT = "struct<edit:string, role:string, turn:long, row_role:string, h1:long, h2:long>"


def _parsed(rows: list[dict]) -> tuple[list, np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
    """Rows as :func:`graph` takes them; copies of a row that may stay are a row of their own."""
    out, initial, forced, cut, copies = [], [], [], [], []
    for r in rows:
        kind = {"s": 0, "u": 1, "a": 2}.get(r["role"][:1], 3)
        if r["forced"]:
            made = [(True, r["copies"])]
        else:
            made = [(False, 1), (True, r["copies"] - 1)] if r["copies"] > 1 else [(False, 1)]
        for must, n in made:
            out.append(r)
            initial.append(kind)
            forced.append(must)
            cut.append(r["cut_short"] and not must)
            copies.append(n)
    return out, np.array(initial, np.int64), np.array(forced, bool), np.array(cut, np.int64), np.array(copies, np.int64)


def _graph_of(pieces: list[list[dict]], ends: np.ndarray) -> tuple[Graph, list[list[dict]], np.ndarray]:
    parsed = [_parsed(p) for p in pieces]
    joined = [np.concatenate([x[i] for x in parsed]) for i in range(1, 5)]
    sizes = np.array([len(x[0]) for x in parsed], np.int64)
    return graph(*joined, sizes, ends), [x[0] for x in parsed], joined[3]


def solved(pieces: list[list[dict]], entry: np.ndarray, ends: np.ndarray) -> list[tuple[int, str, list[dict]]]:
    """``(cost, audit, rows kept or inserted)`` of each piece."""
    if not pieces:
        return []
    g, rows, copies = _graph_of(pieces, ends)
    starts = 4 * g.first + entry
    at, after, stops = paths(g, starts)
    flat = [r for p in rows for r in p]
    first_row = g.first - np.arange(len(pieces))
    out, a = [], 0
    for i, b in enumerate(stops):
        audit, kept = [], []
        for node, then in zip(at[a:b].tolist(), after[a:b].tolist()):
            letter = LETTERS[g.letter[node] - 1]
            row = node // 4 - int(g.first[i]) + int(first_row[i])
            audit.append(letter * int(copies[row]) if letter == "D" else letter)
            if letter == "I":
                kept.append({"edit": "I", "role": ROLE[then % 4], "turn": None, "row_role": None, "h1": None, "h2": None})
            elif letter != "D":
                r = flat[row]
                kept.append({"edit": letter, "role": r["role"] if letter == "K" else ROLE[then % 4], "turn": r["turn"],
                             "row_role": r["role"], "h1": r["h1"], "h2": r["h2"]})
        out.append((int(g.cost[starts[i]]), "".join(audit), kept))
        a = b
    return out


def _legal(a: str, b: str) -> bool:
    return a[:1] + b[:1] in ("su", "ua", "au")


def _illegal(rows: list[dict]) -> int:
    """Neighbours whose initials are out of order; copies are neighbours."""
    return sum(r["copies"] - 1 for r in rows) + sum(not _legal(a["role"], b["role"]) for a, b in zip(rows, rows[1:]))


def _piece_schema(conv: str) -> str:
    return (f"conv_id {conv}, part int, piece long, open boolean, illegal long, cost long, audit string, "
            f"kept array<{_EDIT}>, rows array<{_ROW}>")


def _cut(schema: pa.Schema):
    """A task's sorted rows to pieces; those of conversations that it holds whole are solved."""
    def emit(part: int, number: int, convs: list, groups: list[list[dict]], open_: list[bool]) -> pa.RecordBatch:
        whole = [g for g, o in zip(groups, open_) if not o]
        done = iter(solved(whole, np.zeros(len(whole), np.int64), np.tile(ENDING, (len(whole), 1))))
        rows = []
        for i, (c, g, o) in enumerate(zip(convs, groups, open_)):
            cost, audit, kept = (None, None, None) if o else next(done)
            rows.append({"conv_id": c, "part": part, "piece": number + i, "open": o, "illegal": _illegal(g), "cost": cost,
                         "audit": audit, "kept": kept, "rows": g if o else None})
        return pa.RecordBatch.from_pylist(rows, schema=schema)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        part, number = TaskContext.get().partitionId(), 0
        held: list[tuple[object, list[dict]]] = []       # conversations in order, the last one unfinished
        begun, count = True, 0                           # the first one held has begun elsewhere
        names = ("turn", "role", "h1", "h2", "copies", "forced", "cut_short")

        def flush(final: bool) -> Iterator[pa.RecordBatch]:
            nonlocal held, begun, count, number
            keep = [] if final or len(held[-1][1]) >= PIECE else [held[-1]]
            out = held[:len(held) - len(keep)]
            if out:
                flags = [i == 0 and begun or i == len(out) - 1 and not keep for i in range(len(out))]
                yield emit(part, number, [c for c, _ in out], [g for _, g in out], flags)
                number += len(out)
                begun = not keep
            held, count = keep, sum(len(g) for _, g in keep)

        gone: object = None                              # the conversation of the last piece, if it may go on
        for batch in batches:
            cols = [batch.column(n).to_pylist() for n in names]
            for c, *values in zip(batch.column("conv_id").to_pylist(), *cols):
                row = dict(zip(names, values))
                if held and held[-1][0] == c:
                    held[-1][1].append(row)
                else:
                    if not held and number and c != gone:
                        begun = False
                    held.append((c, [row]))
                count += 1
                if count >= PIECE:
                    gone = held[-1][0]
                    yield from flush(False)
        if held:
            yield from flush(True)

    return run


def _flat(values: np.ndarray) -> list[int]:
    return [int(v) for v in values]


def _summaries(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Of each open piece the least costs from state to state, and the ranks of those audits."""
    for batch in batches:
        for part, piece, conv, rows in zip(batch.column("part").to_pylist(), batch.column("piece").to_pylist(), batch.column("conv_id"),
                                           batch.column("rows").to_pylist()):
            ends = np.full((4, 4), FAR)
            ends[np.arange(4), np.arange(4)] = 0
            g, _, _ = _graph_of([rows] * 4, ends)
            nodes = 4 * g.first[None, :] + np.arange(4)[:, None]        # from state x to state
            yield pa.RecordBatch.from_arrays(
                [pa.array([conv], batch.schema.field("conv_id").type), pa.array([part], pa.int32()), pa.array([piece], pa.int64()),
                 pa.array([rows[0]["role"]], pa.string()), pa.array([rows[-1]["role"]], pa.string()),
                 pa.array([_flat(g.cost[nodes].ravel())], pa.list_(pa.int64())), pa.array([_flat(g.rank[nodes].ravel())], pa.list_(pa.int64()))],
                ["conv_id", "part", "piece", "first_role", "last_role", "costs", "ranks"])


def _chain(pieces: pd.DataFrame) -> pd.DataFrame:
    """Where each piece of one conversation begins and ends (-1: with the conversation)."""
    pieces = pieces.sort_values(["part", "piece"])
    costs = [np.array(c, np.int64).reshape(4, 4) for c in pieces["costs"]]
    ranks = [np.array(r, np.int64).reshape(4, 4) for r in pieces["ranks"]]
    to_go, choice = ENDING, []
    for cost, rank in zip(reversed(costs), reversed(ranks)):
        total = np.minimum(cost + to_go[None, :], FAR)
        to_go = total.min(axis=1)
        choice.append(np.where(total == to_go[:, None], rank, FAR).argmin(axis=1))
    state, entry, exit_ = 0, [], []
    for pick in reversed(choice):
        entry.append(state)
        state = int(pick[state])
        exit_.append(state)
    exit_[-1] = -1
    roles = list(zip(pieces["last_role"], pieces["first_role"].iloc[1:]))
    return pd.DataFrame({"part": pieces["part"], "piece": pieces["piece"], "entry": entry, "leave": exit_,
                         "joint": [0] + [int(not _legal(a, b)) for a, b in roles]})


def _finish(schema: pa.Schema):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            rows = batch.to_pylist()
            ends = np.full((len(rows), 4), FAR)
            for i, r in enumerate(rows):
                if r["leave"] < 0:
                    ends[i] = ENDING
                else:
                    ends[i, r["leave"]] = 0
            done = solved([r["rows"] for r in rows], np.array([r["entry"] for r in rows], np.int64), ends)
            yield pa.RecordBatch.from_pylist(
                [{"conv_id": r["conv_id"], "part": r["part"], "piece": r["piece"], "open": True, "illegal": r["illegal"] + r["joint"],
                  "cost": cost, "audit": audit, "kept": kept, "rows": None} for r, (cost, audit, kept) in zip(rows, done)], schema=schema)

    return run


# ---------------------------------------------------------------- the operator
def _digested(rows: DataFrame) -> DataFrame:
    text = F.coalesce(F.col("text"), F.lit(" "))
    return rows.select("conv_id", F.col("turn").cast("long").alias("turn"), F.coalesce("role", F.lit(" ")).alias("role"), text.alias("text"),
                       F.xxhash64(text).alias("h1"), F.xxhash64(F.lit("second"), text).alias("h2"))


def joined(a: DataFrame, b: DataFrame, names: list[str], how: str = "inner") -> DataFrame:
    """Join on equal ``names``, nulls equal; the result has them once, as ``a`` has them."""
    b = b.withColumnsRenamed({n: f"other_{n}" for n in names})
    on = functools.reduce(lambda x, y: x & y, [F.col(n).eqNullSafe(F.col(f"other_{n}")) for n in names])
    return a.join(b, on, how).drop(*[f"other_{n}" for n in names])


@dataclass
class Repair:
    """What :func:`repair` makes: ``summary`` a row per conversation, ``rows`` the repaired rows."""

    summary: DataFrame
    rows: DataFrame


def repair(table: DataFrame) -> Repair:
    """Repair conversations given as rows ``(conv_id, turn, role, text)``.

    Rows of a conversation are taken by turn (nulls first); equal turns by role,
    then by a hash of the text.  A row's first fault counts: blank, duplicate (a
    role and text seen earlier), truncated (its last visible character is not
    one of ``.!?``).  ``summary``: conv_id, gaps, blank, duplicate, truncated,
    illegal, cost, audit; ``rows``: conv_id, part, piece, n (their order), edit,
    role, text of the kept, reroled and inserted rows.

    Null roles and texts count as one space, a null conv_id is a conversation,
    null turns come first and count in no gap.  Repeated rows are duplicates and
    travel as counts.  An empty table gives two empty tables; extra columns
    are ignored.  ``turn`` is an integer.  Texts are told apart by 128 bits of hash.
    """
    spark = table.sparkSession
    n = parts(spark)
    conv = table.schema["conv_id"].dataType.simpleString()
    key = ["conv_id", "turn", "role", "h1", "h2"]
    texts = _digested(table)
    visible = F.btrim("text", F.lit(WS_CHARS))
    narrow = written(texts.select(*key, (visible == "").alias("blank"), (~F.substring(visible, -1, 1).isin(".", "!", "?")).alias("cut_short"))
                     .groupBy(*key, "blank", "cut_short").agg(F.count("*").alias("copies")), "conversation-rows")
    # the first turn of each role and text that occurs at several turns
    first = (narrow.filter("not blank").groupBy("conv_id", "role", "h1", "h2")
             .agg(F.min("turn").alias("least"), F.bool_or(F.col("turn").isNull()).alias("before"), F.count("*").alias("turns"))
             .filter("turns > 1").drop("turns"))
    later = F.when(F.col("before"), F.col("turn").isNotNull()).otherwise(F.col("turn") > F.col("least"))
    marked = joined(narrow, first, ["conv_id", "role", "h1", "h2"], "left").withColumn("again", F.coalesce(later, F.lit(False)))
    marked = written(marked.drop("least", "before").withColumn("forced", F.col("blank") | F.col("again")), "conversation-marked")

    schema = _piece_schema(conv)
    arrow = to_arrow_schema(StructType.fromDDL(schema))
    ordered = marked.repartitionByRange(n, *key).sortWithinPartitions(*key)
    pieces = written(ordered.select(*key, "copies", "forced", "cut_short").mapInArrow(_cut(arrow), schema), "conversation-pieces")

    open_ = pieces.filter("open")
    ends = open_.select("conv_id", "part", "piece", "rows").mapInArrow(
        _summaries, f"conv_id {conv}, part int, piece long, first_role string, last_role string, costs array<long>, ranks array<long>")
    links = ends.groupBy("conv_id").applyInPandas(_chain, "part int, piece long, entry int, leave int, joint int")
    finished = open_.join(links, ["part", "piece"]).select(*[c for c in pieces.columns], "entry", "leave", "joint").mapInArrow(_finish(arrow), schema)
    done = written(pieces.filter("not open").unionByName(finished).drop("rows", "open"), "conversation-solved")

    faults = (marked.groupBy("conv_id", "turn").agg(
        F.sum(F.when(F.col("blank"), F.col("copies")).otherwise(0)).alias("blank"),
        F.sum(F.when(F.col("blank"), 0).otherwise(F.col("copies") - 1 + F.col("again").cast("long"))).alias("duplicate"),
        F.sum((~F.col("forced") & F.col("cut_short")).cast("long")).alias("truncated"))
        .groupBy("conv_id").agg(
            F.coalesce(F.max("turn") - F.min("turn") + 1 - F.count("turn"), F.lit(0)).cast("long").alias("gaps"),
            *[F.sum(c).alias(c) for c in ("blank", "duplicate", "truncated")]))
    audits = done.groupBy("conv_id").agg(
        F.sum("illegal").alias("illegal"), F.sum("cost").alias("cost"),
        F.array_join(F.transform(F.array_sort(F.collect_list(F.struct("part", "piece", "audit"))), lambda x: x["audit"]), "").alias("audit"))
    summary = joined(faults, audits, ["conv_id"])

    kept = done.select("conv_id", "part", "piece", F.posexplode("kept").alias("n", "e")).select(
        "conv_id", "part", "piece", "n", "e.edit", F.col("e.role").alias("new_role"), "e.turn", F.col("e.row_role").alias("role"), "e.h1", "e.h2")
    once = texts.groupBy(*key).agg(F.any_value("text").alias("text"))
    told = joined(kept.filter("edit <> 'I'"), once, key)
    rows = told.select("conv_id", "part", "piece", "n", "edit", F.col("new_role").alias("role"), "text").unionByName(
        kept.filter("edit = 'I'").select("conv_id", "part", "piece", "n", "edit", F.col("new_role").alias("role"), F.lit("").alias("text")))
    return Repair(summary, rows)


def damaged(table: DataFrame) -> DataFrame:
    """Rows ``(conv_id, turn, role, text)`` with seeded faults: by the CRC-32 of
    ``conv_id:turn`` modulo 20, 0 drops the row, 1 empties its text, 2 removes the
    text's ``.!?``, 3 repeats the row, 4 makes its role ``user``.  Nulls are one space."""
    space = F.lit(" ")
    text, role = F.coalesce("text", space), F.coalesce("role", space)
    kind = F.crc32(F.encode(F.concat_ws(":", *[F.coalesce(F.col(c).cast("string"), space) for c in ("conv_id", "turn")]), "UTF-8")) % 20
    rows = table.select("conv_id", "turn", role.alias("role"), text.alias("text"), kind.alias("kind")).filter("kind <> 0")
    rows = rows.withColumn("copy", F.explode(F.when(F.col("kind") == 3, F.array(F.lit(0), F.lit(1))).otherwise(F.array(F.lit(0)))))
    return rows.select(
        "conv_id", "turn", F.when(F.col("kind") == 4, "user").otherwise(F.col("role")).alias("role"),
        F.when(F.col("kind") == 1, "").when(F.col("kind") == 2, F.translate("text", ".!?", "")).otherwise(F.col("text")).alias("text"))


def _streams(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Sorted rows to one digest a conversation, a row at a time."""
    held, digest, kind = [], None, None

    def out() -> pa.RecordBatch:
        return pa.RecordBatch.from_arrays([pa.array(held, kind), pa.array([digest.hexdigest()], pa.string())], ["conv_id", "repaired_sha256"])

    for batch in batches:
        kind = batch.schema.field("conv_id").type
        for c, role, text in zip(*(batch.column(x).to_pylist() for x in ("conv_id", "role", "text"))):
            if digest is not None and held[0] == c:
                digest.update(b"\n")
            else:
                if digest is not None:
                    yield out()
                held, digest = [c], hashlib.sha256()
            digest.update(f"{role}:{text}".encode())
    if digest is not None:
        yield out()


def digests(rows: DataFrame) -> DataFrame:
    """SHA-256 of each conversation's ``role:text`` rows, joined by newlines.  A digest is
    made in row order, so a conversation streams through one task, never held whole."""
    conv = rows.schema["conv_id"].dataType.simpleString()
    return (rows.repartition(parts(rows.sparkSession), "conv_id").sortWithinPartitions("conv_id", "part", "piece", "n")
            .select("conv_id", "role", "text").mapInArrow(_streams, f"conv_id {conv}, repaired_sha256 string"))
