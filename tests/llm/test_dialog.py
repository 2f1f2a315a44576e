"""Conversation repair against exhaustive search, and long conversations."""

import hashlib
import itertools
import random
import re
import zlib

import pytest

from trustlens.llm import dialog
from trustlens.llm.auction import auction, least_trace, start_prices

SCHEMA = "conv_id long, turn long, role string, text string, key string, part int, pos int"
WELL_FORMED = re.compile(r"(s?(ua)+)?")


def search(rows):
    """All cheapest edits of a few (role, text) rows, by trying everything."""
    seen, best = set(), None
    flags = []
    for role, text in rows:
        body = re.sub("[ \t-\r]", "", text)
        gone = not body or (role, text) in seen
        seen.add((role, text))
        flags.append((gone, bool(body) and not gone and body[-1] not in ".!?"))
    edits = []
    for (role, text), (gone, cut) in zip(rows, flags):
        own = [("D", 2, [])]
        if not gone:
            more = 5 if cut else 0
            own += [("K", more, [(role, text)])] + [("R", 1 + more, [(r, text)]) for r in ("user", "assistant")]
        edits.append(own)
    gaps = [[("", 0, [])] + [("I" * k, 5 * k, [(r, "") for r in rs]) for k in (1, 2) for rs in itertools.product(("user", "assistant"), repeat=k)]]
    steps = gaps + [x for own in edits for x in (own, gaps[0])]
    for way in itertools.product(*steps):
        turns = [t for _, _, out in way for t in out]
        if any(not r for r, _ in turns) or not WELL_FORMED.fullmatch("".join(r[0] for r, _ in turns)):
            continue
        found = (sum(c for _, c, _ in way), "".join(e for e, _, _ in way), turns)
        best = found if best is None else min(best, found)
    return best


def lattice(rows):
    return dialog._lattice_rows(rows, dialog.faults(rows))


def test_cheapest_edits_are_those_of_exhaustive_search():
    rng = random.Random(5)
    for n in [0, 1, 1, 2, 2, 2, 2, 3, 3, 3, 3, 3, 3, 3, 3]:
        rows = [(rng.choice(["system", "user", "assistant", "tool", ""]), rng.choice(["Yes.", "no", " ", "Why?", "a. b"])) for _ in range(n)]
        cost, edits, turns = search(rows)
        got, _, price = dialog.traces(lattice(rows), dialog.END, True, [dialog.NOTHING])[dialog.NOTHING]
        assert (price, got) == (cost, edits), rows
        assert dialog.apply_edits(got, dialog.NOTHING, rows) == turns


def plain(rows):
    """The same by a step per row: state to the least (cost, edits)."""

    def inserted(best):
        out = dict(best)
        for _ in range(2):
            for s, (c, e) in list(out.items()):
                after = dialog.NEXT[s][0]
                out[after] = min(out.get(after, (c + 5, e + "I")), (c + 5, e + "I"))
        return out

    best = {dialog.NOTHING: (0, "")}
    for initial, gone, cut in rows:
        step = {}
        for s, (c, e) in inserted(best).items():
            ways = [(s, (c + 2, e + "D"))]
            if not gone:
                if (s, initial) in dialog.KEPT:
                    ways.append((dialog.KEPT[s, initial], (c + 5 * cut, e + "K")))
                ways.append((dialog.NEXT[s][0], (c + 1 + 5 * cut, e + "R")))
            for to, v in ways:
                step[to] = min(step.get(to, v), v)
        best = step
    best = inserted(best)
    return min(best[s] for s in (dialog.NOTHING, dialog.ASSISTANT) if s in best)


@pytest.mark.parametrize("chunk", [1, 2, 64])
def test_chunks_do_not_matter(monkeypatch, chunk):
    monkeypatch.setattr(dialog, "CHUNK_ROWS", chunk)
    rng = random.Random(chunk)
    for n in [0, 1, 2, 5, 9, 40, 130, 200]:
        rows = [(rng.choice("suauaux"), rng.random() < 0.2, rng.random() < 0.2) for _ in range(n)]
        edits, _, cost = dialog.traces(rows, dialog.END, True, [dialog.NOTHING])[dialog.NOTHING]
        assert (cost, edits) == plain(rows)


def test_prices_are_distances_and_tight_arcs_the_shortest_paths():
    arcs = [[("b", 1, 1), ("a", 3, 2)], [("c", 2, 2), ("x", 9, -1)], [("", 4, -1)], [("z", 1, 3)]]
    price = start_prices(arcs)
    assert price[3] == float("inf")  # nothing leads on from there
    auction(arcs, price, 0)
    assert price[:3] == [7, 6, 4]
    assert least_trace(arcs, price, 0) == ("a", 2)  # before "bc", of equal cost


def awkward(seed=2, n=400):
    rng = random.Random(seed)
    role = lambda: rng.choice(["system", "user", "assistant", "user", "assistant", "tool", "", None])
    text = lambda: rng.choice(["Yes.", "no", " ", "", None, "Why? ", "naïve – ok!", "x" * 3000 + ".", "a\nb."])
    rows = [(None if rng.random() < 0.4 else rng.randint(1, 40), rng.choice([None, *range(60)]), role(), text()) for _ in range(n)]
    rows += [(90, t, "user" if t % 2 == 0 else "assistant", f"Line {t}.") for t in range(30)]
    return rows + [rows[0], rows[0], (91, 7, "system", "s."), (92, 0, "user", None)]


def expected(rows, ids):
    """Report of damaged or plain rows, conversation by conversation."""
    out = {}
    for i in ids:
        own = sorted(((t is not None, t or 0), r, x) for c, t, r, x in ((c, t, r if r is not None else " ", x if x is not None else " ") for c, t, r, x in rows) if c == i)
        turns = [(r, x) for _, r, x in own]
        numbers = [t for (known, t), _, _ in own if known]
        found = dialog.faults(turns)
        cost, edits = plain(dialog._lattice_rows(turns, found))
        done = dialog.apply_edits(edits, dialog.NOTHING, turns)
        initials = [r[:1] for r, _ in turns]
        assert WELL_FORMED.fullmatch("".join(r[:1] for r, _ in done))
        out[i] = (
            max(numbers) - min(numbers) + 1 - len(set(numbers)) if numbers else 0,
            *(sum(f[k] for f in found) for k in range(3)),
            sum(a + b not in ("su", "ua", "au") for a, b in zip(initials, initials[1:])),
            cost,
            edits,
            hashlib.sha256("\n".join(f"{r}:{x}" for r, x in done).encode()).hexdigest(),
        )
    return out


def damaged(rows):
    out = []
    for c, t, r, x in rows:
        r, x = (" " if v is None else v for v in (r, x))
        fault = zlib.crc32(f"{' ' if c is None else c}:{' ' if t is None else t}".encode()) % 20
        if fault:
            x = "" if fault == 1 else re.sub("[.!?]", "", x) if fault == 2 else x
            out += [(c, t, "user" if fault == 4 else r, x)] * (2 if fault == 3 else 1)
    return out


def report(df):
    return {r[0]: tuple(r[1:]) for r in df.collect()}


@pytest.mark.parametrize("segment_rows,fan", [(1024, 256), (7, 3)])
def test_report_whatever_the_segments(spark, segment_rows, fan):
    rows = awkward()
    df = spark.createDataFrame([(*r, "k", 1, 2) for r in rows], SCHEMA)
    ids = {r[0] for r in rows}
    assert report(dialog.repair_report(df, segment_rows=segment_rows, fan=fan)) == expected(rows, ids)
    found = dialog.repair_report(dialog.damage(df), df, segment_rows, fan)
    assert found.columns == ["conv_id", "gaps", "blank", "duplicate", "truncated", "illegal", "cost", "audit", "repaired_sha256"]
    assert report(found) == expected(damaged(rows), ids)


def test_repaired_turns(spark):
    rows = awkward(3, 120)
    parts = dialog.repair(spark.createDataFrame([(*r, "k", 1, 2) for r in rows], SCHEMA), segment_rows=10, fan=4)
    by_key = {}
    for r in dialog.repaired_turns(parts).orderBy("key", "part", "place").collect():
        by_key.setdefault(r.key, []).append(f"{r.role}:{r.text}")
    want = expected(rows, {r[0] for r in rows})
    for i, row in want.items():
        lines = by_key.get("n" if i is None else f"v{i}", [])
        assert hashlib.sha256("\n".join(lines).encode()).hexdigest() == row[-1]


def test_empty_table(spark):
    df = spark.createDataFrame([], SCHEMA)
    assert dialog.repair_report(df).collect() == []
    assert dialog.repair_report(dialog.damage(df), df).collect() == []
