"""Conversation structure repair: the cheapest edits that give a conversation the roles
(system)? (user assistant)+, the alphabetically least of them, and the repaired turns.

Each conversation is a graph of nodes (rows read, state of a small machine over roles).  The
arcs out of a node are the edits Delete, Insert, Keep and Rerole.  A cost pass from the end
gives every node the cost of the rest; the arcs that keep to it are the optimal ones.  The
nodes are then ranked by the least audit string that begins there: first by one letter, then
by 2, 4, 8 ... letters, each time from the ranks of a node and of the node that its doubled
pointer leads to.  The same pointers then place every letter of the chosen path.  All
conversations of a batch advance together in numpy arrays.

Two passes: one over what the costs need of a row (no text), which ends in the plans, and one
that streams the texts past them.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

# Costs of the edits, and what an undeleted truncated row adds.
KEEP, REROLE, DELETE, INSERT, TRUNCATED = 0, 1, 2, 5, 5
LETTERS = "DIKR"

START, TOLD, ASKED, ANSWERED = range(4)
SYSTEM, USER, ASSISTANT, OTHER = range(4)
_INITIALS = {"s": SYSTEM, "u": USER, "a": ASSISTANT}
#: The state after an inserted or reroled turn: the one turn that may come there.
_NEXT = np.array([ASKED, ASKED, ANSWERED, ASKED])
#: The state after a kept turn by (state, role), -1: not allowed there.
_KEPT = np.full((4, 4), -1)
_KEPT[START, SYSTEM] = TOLD
for _state in (START, TOLD, ANSWERED):
    _KEPT[_state, USER] = ASKED
_KEPT[ASKED, ASSISTANT] = ANSWERED
_FAR = 1 << 60

#: Rows that one numpy pass works on; a longer conversation is a pass of its own.
STEP_ROWS = 1 << 16

_BLANK = r"[^\x20\x09-\x0D]"
_SPACES = " \t\n\x0b\x0c\r"


def damage(conversations: DataFrame, conv_col: str = "conv_id", turn_col: str = "turn", role_col: str = "role", text_col: str = "text") -> DataFrame:
    """Rows (conv_id, turn, role, text, gone) with faults put in by crc32 of "conv_id:turn" mod
    20: 0 drops the row (gone is true: the row only says that the conversation exists), 1
    empties its text, 2 takes its [.!?] away, 3 repeats it, 4 makes its role user.  A null
    role or text, and a null id or turn inside the hashed string, is one space."""
    spaced = lambda c: F.coalesce(F.col(c).cast("string"), F.lit(" "))
    rows = conversations.select(
        F.col(conv_col).cast("long").alias("conv_id"), F.col(turn_col).cast("long").alias("turn"),
        spaced(role_col).alias("role"), spaced(text_col).alias("text"),
        (F.crc32(F.concat(spaced(conv_col), F.lit(":"), spaced(turn_col)).cast("binary")) % 20).alias("fault"),
    )
    text = F.when(F.col("fault") == 1, "").when(F.col("fault") == 2, F.translate("text", ".!?", "")).otherwise(F.col("text"))
    times = F.when(F.col("fault") == 3, F.array(F.lit(1), F.lit(2))).otherwise(F.array(F.lit(1)))
    return rows.select(
        "conv_id", "turn", F.when(F.col("fault") == 4, "user").otherwise(F.col("role")).alias("role"), text.alias("text"),
        (F.col("fault") == 0).alias("gone"), F.explode(times).alias("time"),
    ).drop("time")


# ------------------------------------------------------------------------------------------
# Costs, ranks and the least path of many conversations at once


def _costs(role: np.ndarray, must: np.ndarray, torn: np.ndarray, first: np.ndarray, count: np.ndarray) -> np.ndarray:
    """cost[node, state] of the cheapest edits from there to an end.  The rows of conversation
    c are count[c] from first[c]; its nodes are count[c] + 1 from first[c] + c."""
    nodes = first + np.arange(len(first))
    cost = np.empty((len(role) + len(first), 4), np.int64)
    cost[nodes + count] = [0, 2 * INSERT, INSERT, 0]
    order = np.argsort(-count, kind="stable")
    first, count, nodes = first[order], count[order], nodes[order]
    for back in range(1, int(count.max(initial=0)) + 1):
        live = int(np.searchsorted(-count, -back, "right"))
        at, row = nodes[:live] + count[:live] - back, first[:live] + count[:live] - back
        after = cost[at + 1]
        best = after + DELETE
        stay = np.where(torn[row], TRUNCATED, 0) + np.where(must[row], _FAR, 0)
        kept = _KEPT[:, role[row]].T
        np.minimum(best, np.where(kept >= 0, np.take_along_axis(after, np.maximum(kept, 0), 1) + KEEP, _FAR) + stay[:, None], out=best)
        np.minimum(best, after[:, _NEXT] + REROLE + stay[:, None], out=best)
        # Inserting reads no row: from one state to the next, twice round at most.
        for _ in range(3):
            np.minimum(best, best[:, _NEXT] + INSERT, out=best)
        cost[at] = best
    return cost


def _arcs(cost: np.ndarray, role: np.ndarray, must: np.ndarray, torn: np.ndarray, last: np.ndarray) -> np.ndarray:
    """target[node * 4 + state, letter] of the optimal arcs, -1 where there is none.
    ``last`` marks the nodes behind a conversation's last row."""
    n = len(cost)
    target = np.full((n, 4, 4), -1, np.int64)
    target[:, :, 1] = np.where(cost == cost[:, _NEXT] + INSERT, np.arange(n)[:, None] * 4 + _NEXT, -1)
    at = np.flatnonzero(~last)  # nodes before a row, in the order of the rows
    here, after, below = cost[at], cost[at + 1], (at + 1)[:, None] * 4
    stay = np.where(torn, TRUNCATED, 0) + np.where(must, _FAR, 0)
    kept = _KEPT[:, role].T
    target[at, :, 0] = np.where(here == after + DELETE, below + np.arange(4), -1)
    on = np.take_along_axis(after, np.maximum(kept, 0), 1) + KEEP + stay[:, None]
    target[at, :, 2] = np.where((kept >= 0) & (here == on), below + kept, -1)
    target[at, :, 3] = np.where(here == after[:, _NEXT] + REROLE + stay[:, None], below + _NEXT, -1)
    return target.reshape(n * 4, 4)


def _least_paths(target: np.ndarray, roots: np.ndarray) -> list[np.ndarray]:
    """The letters (0 to 3) of the least path from each root.

    Ranks of 2^k letters: a node's rank is the place of the pair (its rank, the rank of the
    node 2^k letters on) among all pairs of 2^(k-1) letters.  An edit leads from a node to
    one node only, so paths with equal letters never part and each node has one pointer."""
    n = len(target)
    end = n  # where every path ends; it ranks before all letters
    ends = (target < 0).all(axis=1)
    letter = np.where(ends, -1, np.argmax(target >= 0, axis=1))
    to = np.append(np.where(ends, end, target[np.arange(n), np.maximum(letter, 0)]), end).astype(np.int32)
    rank = np.append(letter, -1) + 1
    length = (rank > 0).astype(np.int64)
    doubled = [to]
    while (doubled[-1] != end).any():
        jump = doubled[-1]
        _, rank = np.unique(rank * np.int64(rank.max() + 1) + rank[jump], return_inverse=True)
        length = length + length[jump]
        doubled.append(jump[jump])
    # Of the optimal arcs the one with the least (letter, rank of its target).
    choice = np.where(target >= 0, np.arange(4) * np.int64(rank.max() + 1) + rank[target], _FAR).argmin(axis=1)
    chosen = np.where(ends, -1, choice)
    total = length[roots]
    begins = np.concatenate([[0], np.cumsum(total)])
    node = np.repeat(roots, total)
    place = np.arange(begins[-1]) - np.repeat(begins[:-1], total)
    for k, jump in enumerate(doubled):
        on = (place >> k) & 1 == 1
        node[on] = jump[node[on]]
    return np.split(chosen[node], begins[1:-1])


def least_repairs(role: np.ndarray, must: np.ndarray, torn: np.ndarray, count: np.ndarray) -> list[tuple[int, str]]:
    """(cost, audit) of each of many conversations; ``count`` has their numbers of rows, which
    stand one after another in the other arrays: role (0 system, 1 user, 2 assistant, 3 any
    other), must (has to be deleted), torn (costs more unless deleted)."""
    if not len(count):
        return []
    first = np.concatenate([[0], np.cumsum(count)[:-1]])
    cost = _costs(role, must, torn, first, count)
    roots = first + np.arange(len(first))
    last = np.zeros(len(cost), bool)
    last[roots + count] = True
    names = np.frombuffer(LETTERS.encode(), np.uint8)
    paths = _least_paths(_arcs(cost, role, must, torn, last), roots * 4 + START)
    return [(int(c), names[p].tobytes().decode()) for c, p in zip(cost[roots, START], paths)]


# ------------------------------------------------------------------------------------------
# Plans


PLAN = "conv_id long, gaps long, blank long, duplicate long, truncated long, illegal long, cost long, audit string"
_PLAN = pa.schema([("conv_id", pa.int64()), *[(c, pa.int64()) for c in ("gaps", "blank", "duplicate", "truncated", "illegal", "cost")], ("audit", pa.string())])


def _keyed(rows: DataFrame) -> DataFrame:
    """Adds ``digest``, 128 bits of a SHA-256 over role and text."""
    said = F.concat(F.length("role").cast("string"), F.lit(":"), F.col("role"), F.col("text"))
    return rows.withColumn("digest", F.substring(F.unhex(F.sha2(said.cast("binary"), 256)), 1, 16))


def _sums(values: np.ndarray, count: np.ndarray) -> np.ndarray:
    upto = np.concatenate([[0], np.cumsum(values)])
    ends = np.cumsum(count)
    return upto[ends] - upto[ends - count]


def _plan(conv: pa.Array, columns: dict[str, np.ndarray], count: np.ndarray) -> pa.RecordBatch:
    """Plans of whole conversations from their rows; a conversation may have none."""
    of = np.repeat(np.arange(len(count)), count)
    role, blank, torn, turn, known = (columns[c] for c in ("role", "blank", "torn", "turn", "known"))
    seen = np.empty(len(of), [("of", np.int64), ("a", np.int64), ("b", np.int64)])
    seen["of"], seen["a"], seen["b"] = of, columns["digest"][:, 0], columns["digest"][:, 1]
    again = np.ones(len(of), bool)
    again[np.unique(seen, return_index=True)[1]] = False
    duplicate = again & ~blank
    torn = torn & ~blank & ~duplicate
    same = of[1:] == of[:-1]
    pairs = role[:-1] * 4 + role[1:]
    legal = np.isin(pairs, [SYSTEM * 4 + USER, USER * 4 + ASSISTANT, ASSISTANT * 4 + USER])
    illegal = np.append(same & ~legal, np.zeros(min(1, len(of)), bool))
    # Turns are sorted with nulls first: a step between two known turns of a conversation
    # leaves out all but one of the numbers in between.
    step = np.zeros(len(of), np.int64)
    step[1:] = np.where(same & known[:-1] & known[1:], np.maximum(turn[1:] - turn[:-1] - 1, 0), 0) if len(of) else 0
    repairs = least_repairs(role, blank | duplicate, torn, count)
    return pa.RecordBatch.from_arrays([
        conv, *[pa.array(_sums(v, count), pa.int64()) for v in (step, blank, duplicate, torn, illegal)],
        pa.array([c for c, _ in repairs], pa.int64()), pa.array([a for _, a in repairs], pa.string()),
    ], schema=_PLAN)


def _begins(rows: pa.Table) -> np.ndarray:
    """Where a conversation begins in sorted rows."""
    conv = rows.column("conv_id").combine_chunks()
    ids, null = conv.fill_null(0).to_numpy(zero_copy_only=False), conv.is_null().to_numpy(zero_copy_only=False)
    return np.append([True], (ids[1:] != ids[:-1]) | (null[1:] != null[:-1]))


def _plans(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Sorted rows of whole conversations, some STEP_ROWS at a time."""
    held: list[pa.RecordBatch] = []
    waiting = 0

    def work(rows: pa.Table) -> pa.RecordBatch:
        fresh = _begins(rows)
        number = np.cumsum(fresh) - 1
        gone = rows.column("gone").to_numpy()
        live = pa.Table.filter(rows, pa.array(~gone))
        digests = live.column("digest").combine_chunks()
        raw = np.frombuffer(b"".join(digests.to_pylist()), np.int64).reshape(-1, 2)
        turn = live.column("turn").combine_chunks()
        columns = {
            "role": live.column("initial").to_numpy(), "blank": live.column("blank").to_numpy(), "torn": live.column("torn").to_numpy(),
            "turn": turn.fill_null(0).to_numpy(zero_copy_only=False), "known": turn.is_valid().to_numpy(zero_copy_only=False), "digest": raw,
        }
        return _plan(rows.column("conv_id").combine_chunks().take(pa.array(np.flatnonzero(fresh))), columns, np.bincount(number[~gone], minlength=number[-1] + 1))

    for batch in batches:
        if not batch.num_rows:
            continue
        held.append(batch)
        waiting += batch.num_rows
        if waiting < STEP_ROWS or held[0].column(0)[0] == batch.column(0)[-1]:
            continue
        # The last conversation may go on in the next batch.
        rows = pa.Table.from_batches(held)
        cut = int(np.flatnonzero(_begins(rows))[-1])
        yield work(rows.slice(0, cut))
        held = rows.slice(cut).combine_chunks().to_batches()
        waiting = rows.num_rows - cut
    if waiting:
        yield work(pa.Table.from_batches(held))


def plans(turns: DataFrame) -> DataFrame:
    """For each conversation of ``turns`` (conv_id, turn, role, text, gone): the numbers of
    gaps between its turns, of blank, repeated and truncated rows and of role pairs that may
    not follow each other, the cost of the cheapest repair, and its audit: the edits' initials.

    Defined cases: rows are taken by turn, then role, then a digest of both (nulls first); of
    repeated rows all but the first are duplicates.  Rows with gone true only make sure that
    their conversation has a plan; without other rows it is all zeros and an empty audit.
    Rows without an id make up one conversation.  An empty table gives no rows."""
    initial = F.when(F.col("role").startswith("s"), SYSTEM).when(F.col("role").startswith("u"), USER).when(F.col("role").startswith("a"), ASSISTANT).otherwise(OTHER)
    last = F.substring(F.rtrim(F.col("text"), F.lit(_SPACES)), -1, 1)
    rows = _keyed(turns).select(
        "conv_id", "turn", "role", "digest", "gone", initial.cast("long").alias("initial"),
        (~F.col("text").rlike(_BLANK)).alias("blank"), (~last.isin(".", "!", "?")).alias("torn"),
    )
    return rows.repartition("conv_id").sortWithinPartitions("conv_id", "turn", "role", "digest").mapInArrow(_plans, PLAN)


# ------------------------------------------------------------------------------------------
# The repaired turns


TURNS = "conv_id long, turn_no long, role string, text string, edit string"
_TURNS = pa.schema([("conv_id", pa.int64()), ("turn_no", pa.int64()), ("role", pa.string()), ("text", pa.string()), ("edit", pa.string())])
_SAYS = {ASKED: "user", ANSWERED: "assistant"}


def _applied(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    audit, at, state, number, conv = "", 0, START, 0, None
    out: list[tuple] = []

    def inserted():
        nonlocal at, state, number
        while at < len(audit) and audit[at] == "I":
            state = int(_NEXT[state])
            out.append((conv, number, _SAYS[state], "", "I"))
            at, number = at + 1, number + 1

    def flush():
        batch = pa.RecordBatch.from_arrays([pa.array(c, f.type) for c, f in zip(zip(*out), _TURNS)], schema=_TURNS)
        out.clear()
        return batch

    for batch in batches:
        for conv_id, is_row, role, text in zip(*[batch.column(batch.schema.get_field_index(c)).to_pylist() for c in ("conv_id", "is_row", "role", "text")]):
            if not is_row:
                audit, at, state, number, conv = text, 0, START, 0, conv_id
                inserted()
                continue
            edit = audit[at]
            at += 1
            if edit != "D":
                if edit == "R":
                    state = int(_NEXT[state])
                    role = _SAYS[state]
                else:
                    state = int(_KEPT[state, _INITIALS[role[0]]])
                out.append((conv, number, role, text, edit))
                number += 1
            inserted()
            if len(out) >= 1000:
                yield flush()
    if out:
        yield flush()


def repaired(turns: DataFrame, plan: DataFrame) -> DataFrame:
    """The turns (conv_id, turn_no, role, text, edit) that the plans leave, sorted within their
    partitions.  A conversation's texts are streamed past its audit."""
    rows = _keyed(turns.filter(~F.col("gone"))).select("conv_id", F.lit(True).alias("is_row"), "turn", "role", "digest", "text")
    audits = plan.select(
        "conv_id", F.lit(False).alias("is_row"), F.lit(None).cast("long").alias("turn"), F.lit(None).cast("string").alias("role"),
        F.lit(None).cast("binary").alias("digest"), F.col("audit").alias("text"),
    )
    both = audits.unionByName(rows).repartition("conv_id").sortWithinPartitions("conv_id", "is_row", "turn", "role", "digest")
    return both.select("conv_id", "is_row", "role", "text").mapInArrow(_applied, TURNS)


def _digests(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    schema = pa.schema([("conv_id", pa.int64()), ("repaired_sha256", pa.string()), ("n_repaired", pa.int64())])
    conv, digest, out = None, None, []
    turns = 0
    for batch in batches:
        for conv_id, number, role, text in zip(*[c.to_pylist() for c in batch.columns[:4]]):
            if number == 0:
                if digest is not None:
                    out.append((conv, digest.hexdigest(), turns))
                conv, digest, turns = conv_id, hashlib.sha256(), 0
            digest.update(f"{chr(10) if number else ''}{role}:{text}".encode("utf-8", "surrogatepass"))
            turns += 1
        if out:
            yield pa.RecordBatch.from_arrays([pa.array(c, f.type) for c, f in zip(zip(*out), schema)], schema=schema)
            out = []
    if digest is not None:
        yield pa.RecordBatch.from_arrays([pa.array([v], f.type) for v, f in zip((conv, digest.hexdigest(), turns), schema)], schema=schema)


def digests(turns: DataFrame) -> DataFrame:
    """SHA-256 of each repaired conversation, ``role:text`` joined by newlines.  Reads what
    repaired() gives as it stands, so it needs no shuffle."""
    return turns.mapInArrow(_digests, "conv_id long, repaired_sha256 string, n_repaired long")


def repair(turns: DataFrame, plan: DataFrame) -> DataFrame:
    """The plans with repaired_sha256 and n_repaired, the repaired turns' hash and number; a
    conversation of which nothing is left has the empty string's hash."""
    found = digests(repaired(turns, plan)).withColumnRenamed("conv_id", "of")
    return plan.join(found, plan["conv_id"].eqNullSafe(found["of"]), "left").select(
        *plan.columns,
        F.coalesce("repaired_sha256", F.lit(hashlib.sha256(b"").hexdigest())).alias("repaired_sha256"),
        F.coalesce("n_repaired", F.lit(0).cast("long")).alias("n_repaired"),
    )
