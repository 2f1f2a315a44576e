"""Structure repair of conversations by cheapest edits.

A conversation is well formed if the initials of its roles read
``(s?(ua)+)?``: a system turn or none, then user and assistant in turns.  The
edits that get there form a lattice: a node for each place between two rows and
each state (nothing yet, after system, after user, after assistant), an arc for
each edit, and integer costs.  ``auction`` finds the prices of its nodes, and
the cheapest edits whose initials come first in byte order are traced along
tight arcs.

A conversation is solved in chunks, the last one first: the prices a chunk
begins with are what leaving the one before it costs.  One of more than
``SEGMENT_ROWS`` rows is cut into segments, solved in tasks of their own: each
gives the costs from its four first states to its four last ones, an auction
over those costs (in blocks, where there are many) prices the cuts, each
segment is traced from every state, and the states at the cuts follow front to
back.  No task holds a conversation of unbounded length.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator
from itertools import groupby

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..functions.joins import lookup_join
from ..functions.ranking import global_row_number
from .auction import INF, TARGET, Arcs, auction, least_trace, start_prices
from .storage import staged, wide_rows

SEGMENT_ROWS = 1024
CHUNK_ROWS = 64
FAN = 256  # segments, or blocks of them, chained in one task

KEEP, REROLE, DELETE, INSERT = 0, 1, 2, 5
TRUNCATED = 5  # a truncated row that stays

# States by what stands before; the role that may follow and the state after.
NOTHING, SYSTEM, USER, ASSISTANT = range(4)
NEXT = {NOTHING: (USER, "user"), SYSTEM: (USER, "user"), USER: (ASSISTANT, "assistant"), ASSISTANT: (USER, "user")}
KEPT = {(NOTHING, "s"): SYSTEM, (NOTHING, "u"): USER, (SYSTEM, "u"): USER, (USER, "a"): ASSISTANT, (ASSISTANT, "u"): USER}
LEGAL_PAIRS = {"su", "ua", "au"}
SPACE = " \t\n\x0b\x0c\r"

#: What leaving costs at the end of a conversation; from the other states it
#: takes insertions first, which the last lattice has.
END = [0, INF, INF, 0]

# A row as the lattice sees it: (initial of its role, must it go, truncated).
Row = tuple[str, bool, bool]


def edit_lattice(rows: list[Row], leave: list[float], last: bool) -> Arcs:
    """Nodes 4 * place + state.  Between the last row and what follows there
    are insertions only in the ``last`` lattice; else the next one has them."""
    arcs: Arcs = []
    for i in range(len(rows) + 1):
        for state in range(4):
            after, _ = NEXT[state]
            out = []
            if i < len(rows):
                initial, must_go, cut = rows[i]
                out.append(("D", DELETE, 4 * (i + 1) + state))
                if not must_go:
                    more = TRUNCATED if cut else 0
                    if (state, initial) in KEPT:
                        out.append(("K", KEEP + more, 4 * (i + 1) + KEPT[state, initial]))
                    out.append(("R", REROLE + more, 4 * (i + 1) + after))
            elif leave[state] < INF:
                out.append(("", leave[state], TARGET))
            if i < len(rows) or last:
                out.append(("I", INSERT, 4 * i + after))
            arcs.append(out)
    return arcs


def _priced(rows: list[Row], leave: list[float], last: bool) -> list[tuple[Arcs, list[float]]]:
    """Lattice and prices of each chunk of the rows."""
    out = []
    for a in range((max(0, len(rows) - 1) // CHUNK_ROWS) * CHUNK_ROWS, -1, -CHUNK_ROWS):
        arcs = edit_lattice(rows[a : a + CHUNK_ROWS], leave, last)
        price = start_prices(arcs)
        for state in range(4):
            auction(arcs, price, state)
        out.append((arcs, price))
        leave, last = price[:4], False
    return out[::-1]


def entry_costs(rows: list[Row], leave: list[float], last: bool) -> list[float]:
    """Cost from each first state to leaving."""
    return _priced(rows, leave, last)[0][1][:4]


def traces(rows: list[Row], leave: list[float], last: bool, states: range | list[int]) -> dict[int, tuple[str, int, float]]:
    """First state to (edits, last state, cost), for those that can leave."""
    chunks = _priced(rows, leave, last)
    out = {}
    for first in states:
        cost = chunks[0][1][first]
        if cost == INF:
            continue
        state, edits = first, []
        for arcs, price in chunks:
            labels, node = least_trace(arcs, price, state)
            edits.append(labels)
            state = node % 4
        out[first] = ("".join(edits), state, cost)
    return out


def apply_edits(edits: str, state: int, turns: list[tuple[str, str]]) -> list[tuple[str, str]]:
    """(role, text) of the repaired conversation, or of a segment entered in ``state``."""
    out, at = [], 0
    for edit in edits:
        after, role = NEXT[state]
        if edit == "I":
            out.append((role, ""))
        else:
            own, text = turns[at]
            at += 1
            if edit == "D":
                continue
            if edit == "K":
                after, role = KEPT[state, own[:1]], own
            out.append((role, text))
        state = after
    return out


def faults(turns: list[tuple[str, str]], repeated: list[bool] | None = None) -> list[tuple[bool, bool, bool]]:
    """(blank, duplicate, truncated) of each row: the first of them that holds.
    ``repeated`` says which rows stood earlier; else all rows are here."""
    seen: set[tuple[str, str]] = set()
    out = []
    for i, (role, text) in enumerate(turns):
        body = text.strip(SPACE)
        again = repeated[i] if repeated is not None else (role, text) in seen
        if repeated is None:
            seen.add((role, text))
        out.append((not body, bool(body) and again, bool(body) and not again and body[-1] not in ".!?"))
    return out


def _lattice_rows(turns: list[tuple[str, str]], found: list[tuple[bool, bool, bool]]) -> list[Row]:
    return [(role[:1], blank or again, cut) for (role, _), (blank, again, cut) in zip(turns, found)]


_PART = (
    "key string, part long, n_rows long, blank long, duplicate long, truncated long, illegal long, cost long, audit string, "
    "turns array<struct<role:string,text:string>>"
)
_PART_TYPES = pa.schema(
    [("key", pa.string())]
    + [(c, pa.int64()) for c in ("part", "n_rows", "blank", "duplicate", "truncated", "illegal", "cost")]
    + [("audit", pa.string()), ("turns", pa.list_(pa.struct([("role", pa.string()), ("text", pa.string())])))]
)


def _part(key, part, turns, found, before, edits, state, cost) -> dict:
    pairs = [a + b for a, b in zip(([before] if before is not None else []) + [r[:1] for r, _ in turns], [r[:1] for r, _ in turns][before is None :])]
    done = apply_edits(edits, state, turns)
    return {
        "key": key,
        "part": part,
        "n_rows": len(turns),
        "blank": sum(f[0] for f in found),
        "duplicate": sum(f[1] for f in found),
        "truncated": sum(f[2] for f in found),
        "illegal": sum(p not in LEGAL_PAIRS for p in pairs),
        "cost": cost,
        "audit": edits,
        "turns": [{"role": r, "text": t} for r, t in done],
    }


def _whole(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Conversations that come whole, one after another, in order."""

    def rows():
        for b in batches:
            yield from zip(*(b.column(c).to_pylist() for c in ("key", "role", "text")))

    out, held = [], 0
    for key, group in groupby(rows(), key=lambda r: r[0]):
        turns = [(role, text) for _, role, text in group]
        found = faults(turns)
        edits, _, cost = traces(_lattice_rows(turns, found), END, True, [NOTHING])[NOTHING]
        out.append(_part(key, 0, turns, found, None, edits, NOTHING, int(cost)))
        held += sum(len(t) for _, t in turns) + 100
        if held > 1 << 20:
            yield pa.RecordBatch.from_pylist(out, _PART_TYPES)
            out, held = [], 0
    yield pa.RecordBatch.from_pylist(out, _PART_TYPES)


# --- long conversations ------------------------------------------------------

_CUT = 1 << 60  # an impossible way, as a number


def _numbers(costs) -> list[int]:
    return [_CUT if c == INF else int(c) for c in costs]


def _costs(numbers) -> list[float]:
    return [INF if c >= _CUT else int(c) for c in numbers]


def _segment_rows(table: pa.Table) -> tuple[list[tuple[str, str]], list[tuple[bool, bool, bool]], list[Row]]:
    t = table.sort_by("pos")
    turns = list(zip(t.column("role").to_pylist(), t.column("text").to_pylist()))
    found = faults(turns, t.column("again").to_pylist())
    return turns, found, _lattice_rows(turns, found)


def _matrix(table: pa.Table) -> pa.Table:
    """A segment's costs from first state to last state, row by row."""
    _, _, rows = _segment_rows(table)
    ways = [entry_costs(rows, [0 if s == out else INF for s in range(4)], False) for out in range(4)]
    flat = [c for first in range(4) for c in _numbers(ways[out][first] for out in range(4))]
    return pa.table({"key": table.column("key")[:1], "part": table.column("part")[:1], "ways": pa.array([flat], pa.list_(pa.int64()))})


def chain_lattice(ways: list[list[float]], leave: list[float]) -> Arcs:
    """Segments in a row: nodes 4 * cut + state, arcs by the segments' costs."""
    arcs: Arcs = []
    for i, way in enumerate(ways):
        arcs += [[(str(out), way[4 * s + out], 4 * (i + 1) + out) for out in range(4) if way[4 * s + out] < INF] for s in range(4)]
    return arcs + [[("", c, TARGET)] if c < INF else [] for c in leave]


def _chain_prices(ways: list[list[float]], leave: list[float]) -> list[list[float]]:
    """Cost of leaving each segment, in its four last states."""
    arcs = chain_lattice(ways, leave)
    price = start_prices(arcs)
    for origin in range(len(arcs) - 1, -1, -1):
        auction(arcs, price, origin)
    return [price[4 * i : 4 * i + 4] for i in range(1, len(ways) + 1)]


def _compose(pdf: pd.DataFrame) -> pd.DataFrame:
    ways = [_costs(w) for w in pdf.sort_values("part")["ways"]]
    flat = np.full((4, 4), _CUT, np.int64)
    for out in range(4):
        arcs = chain_lattice(ways, [0 if s == out else INF for s in range(4)])
        price = start_prices(arcs)
        for origin in range(len(arcs) - 1, -1, -1):
            auction(arcs, price, origin)
        flat[:, out] = _numbers(price[:4])
    return pd.DataFrame({"key": pdf["key"].iloc[:1], "part": pdf["block"].iloc[:1], "ways": [flat.ravel().tolist()]})


def _leaves(pdf: pd.DataFrame) -> pd.DataFrame:
    pdf = pdf.sort_values("part")
    found = _chain_prices([_costs(w) for w in pdf["ways"]], _costs(pdf["leave"].iloc[0]))
    return pd.DataFrame({"key": pdf["key"], "part": pdf["part"], "leave": [_numbers(x) for x in found]})


def _block(df: DataFrame, fan: int) -> DataFrame:
    return df.withColumn("block", F.floor(F.col("part") / F.lit(fan)).cast("long"))


def _leaving(ways: DataFrame, fan: int) -> DataFrame:
    """(key, part, leave): cost of the rest after each segment."""
    blocks = _block(ways, fan)
    if ways.agg(F.max("part")).first()[0] < fan:
        at_end = entry_costs([], END, True)
        upper = blocks.select("key", "block").distinct().withColumn("leave", F.array(*(F.lit(c).cast("long") for c in _numbers(at_end))))
    else:
        up = staged(blocks.groupBy("key", "block").applyInPandas(_compose, "key string, part long, ways array<long>"), "dialog-blocks")
        upper = _leaving(up, fan).withColumnRenamed("part", "block")
    return staged(blocks.join(upper, ["key", "block"]).groupBy("key", "block").applyInPandas(_leaves, "key string, part long, leave array<long>"), "dialog-leave")


def _walk(moves, state: int) -> list[int]:
    """State at the beginning of each segment."""
    out = []
    for move in moves:
        out.append(state)
        state = int(move[state])
    return out


def _entering(moves: DataFrame, fan: int) -> DataFrame:
    """(key, part, state): the state each segment is entered in, from its
    moves, the last state for each first one (-1: none)."""
    blocks = _block(moves, fan)
    if moves.agg(F.max("part")).first()[0] < fan:
        upper = blocks.select("key", "block").distinct().withColumn("state", F.lit(NOTHING).cast("long"))
    else:

        def compose(pdf: pd.DataFrame) -> pd.DataFrame:
            steps = list(pdf.sort_values("part")["moves"])
            ends = []
            for first in range(4):
                state = first
                for move in steps:
                    state = int(move[state]) if state >= 0 else -1
                ends.append(state)
            return pd.DataFrame({"key": pdf["key"].iloc[:1], "part": pdf["block"].iloc[:1], "moves": [ends]})

        up = staged(blocks.groupBy("key", "block").applyInPandas(compose, "key string, part long, moves array<long>"), "dialog-moves")
        upper = _entering(up, fan).withColumnRenamed("part", "block")

    def walk(pdf: pd.DataFrame) -> pd.DataFrame:
        pdf = pdf.sort_values("part")
        return pd.DataFrame({"key": pdf["key"], "part": pdf["part"], "state": _walk(pdf["moves"], int(pdf["state"].iloc[0]))})

    return staged(blocks.join(upper, ["key", "block"]).groupBy("key", "block").applyInPandas(walk, "key string, part long, state long"), "dialog-enter")


def _leave_of(table: pa.Table) -> tuple[list[float], bool]:
    """What leaving a segment costs, and whether it is the last one."""
    last = table.column("last")[0].as_py()
    return (END if last else _costs(table.column("leave")[0].as_py())), last


def _repaired_segment(table: pa.Table) -> pa.Table:
    turns, found, rows = _segment_rows(table)
    one = {c: table.column(c)[0].as_py() for c in ("key", "part", "state", "before")}
    edits = traces(rows, *_leave_of(table), [one["state"]])[one["state"]][0]
    # the price counts what follows, too; a segment's own cost does not
    own = sum({"D": DELETE, "I": INSERT, "K": KEEP, "R": REROLE}[e] for e in edits)
    at = [e for e in edits if e != "I"]
    own += sum(TRUNCATED for e, r in zip(at, rows) if e != "D" and r[2])
    return pa.Table.from_pylist([_part(one["key"], one["part"], turns, found, one["before"], edits, one["state"], own)], _PART_TYPES)


def _moves(table: pa.Table) -> pa.Table:
    _, _, rows = _segment_rows(table)
    found = traces(rows, *_leave_of(table), range(4))
    moves = [found[s][1] if s in found else -1 for s in range(4)]
    return pa.table({"key": table.column("key")[:1], "part": table.column("part")[:1], "moves": pa.array([moves], pa.list_(pa.int64()))})


def _order() -> list[Column]:
    return [F.asc_nulls_first("turn"), F.asc("role"), F.asc("text")]


def _segmented(rows: DataFrame, segment_rows: int, fan: int) -> DataFrame:
    """Parts of the conversations in ``rows``, segment by segment."""
    unique = rows.withColumn("uid", F.monotonically_increasing_id())
    numbered = staged(global_row_number(unique, [F.asc("key"), *_order(), F.asc("uid")], "at"), "dialog-rows")
    begins = numbered.groupBy("key").agg(F.min("at").alias("begin"), F.max("at").alias("end"))
    placed = lookup_join(numbered, begins, "key", "inner")
    placed = placed.select("key", "role", "text", (F.col("at") - F.col("begin")).alias("pos"), (F.col("end") - F.col("begin")).alias("end"))
    # a row stood earlier unless it is the first of its role and text
    firsts = placed.groupBy("key", "role", "text").agg(F.min("pos").alias("pos")).select("key", "pos", F.lit(False).alias("new"))
    part = F.floor(F.col("pos") / F.lit(segment_rows)).cast("long")
    placed = placed.join(firsts, ["key", "pos"], "left").select(
        "key", part.alias("part"), "pos", "role", "text", F.col("new").isNull().alias("again"), (part == F.floor(F.col("end") / F.lit(segment_rows))).alias("last")
    )
    placed = staged(placed, "dialog-segments")
    ways = staged(placed.groupBy("key", "part").applyInArrow(_matrix, "key string, part long, ways array<long>"), "dialog-ways")
    leave = _leaving(ways, fan)
    known = placed.join(leave, ["key", "part"])
    moves = staged(known.groupBy("key", "part").applyInArrow(_moves, "key string, part long, moves array<long>"), "dialog-traces")
    state = _entering(moves, fan)
    before = placed.where(F.pmod("pos", F.lit(segment_rows)) == segment_rows - 1).select(
        "key", (F.col("part") + 1).alias("part"), F.substring("role", 1, 1).alias("before")
    )
    full = known.join(state, ["key", "part"]).join(before, ["key", "part"], "left")
    return full.groupBy("key", "part").applyInArrow(_repaired_segment, _PART)


def _digests(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Parts in order to (key, audit, repaired_sha256), read once and not held."""
    key = digest = None
    audit: list[str] = []

    def done():
        return pa.RecordBatch.from_pylist([{"key": key, "audit": "".join(audit), "repaired_sha256": digest.hexdigest()}])

    for b in batches:
        for row in b.to_pylist():
            if row["key"] != key:
                if key is not None:
                    yield done()
                key, digest, audit, begun = row["key"], hashlib.sha256(), [], False
            audit.append(row["audit"])
            for turn in row["turns"]:
                digest.update(("\n" * begun + turn["role"] + ":" + turn["text"]).encode())
                begun = True
    if key is not None:
        yield done()


def _key(conv_id: Column) -> Column:
    """A text for every conversation, the one without an id included."""
    return F.when(conv_id.isNull(), F.lit("n")).otherwise(F.concat(F.lit("v"), conv_id.cast("string")))


def damage(conversations: DataFrame) -> DataFrame:
    """``conversations`` with faults put in by crc32 of ``conv_id:turn``, modulo
    20: 0 drops a row, 1 empties its text, 2 removes its sentence marks, 3
    repeats it, 4 makes the user its role.  A null counts as one space, in the
    sum as in role and text."""
    text = lambda c: F.coalesce(F.col(c).cast("string"), F.lit(" "))
    fault = F.crc32(F.concat_ws(":", text("conv_id"), text("turn"))) % 20
    rows = conversations.select("conv_id", "turn", text("role").alias("role"), text("text").alias("text"), fault.alias("fault"))
    rows = rows.where("fault <> 0").withColumn("copy", F.explode(F.when(F.col("fault") == 3, F.array(F.lit(1), F.lit(2))).otherwise(F.array(F.lit(1)))))
    changed = F.when(F.col("fault") == 1, F.lit("")).when(F.col("fault") == 2, F.regexp_replace("text", "[.!?]", "")).otherwise(F.col("text"))
    return rows.select("conv_id", "turn", F.when(F.col("fault") == 4, F.lit("user")).otherwise(F.col("role")).alias("role"), changed.alias("text"))


def _keyed(conversations: DataFrame) -> DataFrame:
    text = lambda c: F.coalesce(F.col(c).cast("string"), F.lit(" "))
    return wide_rows(conversations).select(_key(F.col("conv_id")).alias("key"), "turn", text("role").alias("role"), text("text").alias("text"))


def repair(conversations: DataFrame, segment_rows: int = SEGMENT_ROWS, fan: int = FAN) -> DataFrame:
    """The repaired conversations in parts: (key, part, n_rows, blank,
    duplicate, truncated, illegal, cost, audit, turns).

    ``key`` is "v" and the conv_id, "n" for the rows without one, which are one
    conversation.  Conversations of up to ``segment_rows`` rows are one part.
    Rows are taken by turn, nulls first, equal turns by role and text; a null
    role or text is one space.  ``turns`` has the repaired rows (role, text),
    ``audit`` the initials of the edits, ``cost`` their cost; blank, duplicate
    and truncated count the rows whose first fault that is, ``illegal`` the
    neighbours (also across parts) that must not follow each other.  An empty
    role fits nowhere.  An empty table gives no rows.  Only conv_id, turn, role
    and text are read.
    """
    rows = _keyed(conversations)
    sizes = rows.groupBy("key").count()
    long = staged(sizes.where(F.col("count") > segment_rows).select("key", F.lit(True).alias("long")), "dialog-long")
    short = rows
    if long.limit(1).count():
        marked = lookup_join(rows, long, "key")
        short = marked.where(F.col("long").isNull()).drop("long")
    parts = short.repartition("key").sortWithinPartitions("key", *_order()).select("key", "role", "text").mapInArrow(_whole, _PART)
    if short is not rows:
        parts = parts.unionByName(_segmented(marked.where("long").drop("long"), segment_rows, fan))
    return parts


def repaired_turns(parts: DataFrame) -> DataFrame:
    """(key, part, place, role, text): the rows of the repaired conversations."""
    rows = parts.select("key", "part", F.posexplode("turns").alias("place", "turn"))
    return rows.select("key", "part", "place", "turn.role", "turn.text")


def repair_report(conversations: DataFrame, ids: DataFrame | None = None, segment_rows: int = SEGMENT_ROWS, fan: int = FAN) -> DataFrame:
    """(conv_id, gaps, blank, duplicate, truncated, illegal, cost, audit,
    repaired_sha256) of every conversation in ``ids`` (by default of
    ``conversations``); see repair().

    ``gaps`` is the largest turn less the least, plus one, less the distinct
    ones; nulls do not count, and without others it is 0.  The digest is that
    of the repaired rows as ``role:text``, joined by line feeds.  Conversations
    without rows have zeros, an empty audit and the digest of nothing.  The
    digest of a long conversation is taken by one task, which reads its parts
    in order and holds one at a time.
    """
    turns = _keyed(conversations).groupBy("key").agg(
        F.coalesce(F.max("turn") - F.min("turn") + 1 - F.count_distinct("turn"), F.lit(0)).cast("long").alias("gaps")
    )
    parts = staged(repair(conversations, segment_rows, fan), "dialog-parts")
    counts = ["blank", "duplicate", "truncated", "illegal", "cost"]
    several = staged(parts.where("part > 0").select("key", F.lit(True).alias("several")).distinct(), "dialog-several")
    marked = lookup_join(parts, several, "key")
    line = F.transform("turns", lambda t: F.concat_ws(":", t["role"], t["text"]))
    found = marked.where(F.col("several").isNull()).select("key", *counts, "audit", F.sha2(F.array_join(line, "\n"), 256).alias("repaired_sha256"))
    if several.limit(1).count():
        rest = marked.where("several")
        sums = rest.groupBy("key").agg(*(F.sum(c).alias(c) for c in counts))
        digests = rest.select("key", "part", "audit", "turns").repartition("key").sortWithinPartitions("key", "part")
        found = found.unionByName(sums.join(digests.mapInArrow(_digests, "key string, audit string, repaired_sha256 string"), "key"))
    every = (ids if ids is not None else conversations).select("conv_id").distinct().withColumn("key", _key(F.col("conv_id")))
    out = every.join(turns, "key", "left").join(found, "key", "left")
    zeros = [F.coalesce(c, F.lit(0)).cast("long").alias(c) for c in ["gaps", *counts]]
    return out.select(
        "conv_id", *zeros, F.coalesce("audit", F.lit("")).alias("audit"), F.coalesce("repaired_sha256", F.sha2(F.lit(""), 256)).alias("repaired_sha256")
    )
