"""Conversation repair against SQL, and against a search over all edits in order of cost."""

import heapq
import random
import re
import zlib

import brute
import compare
import pytest
from pyspark.sql import functions as F

from starsift.llm import queries, turns

VISIBLE = re.compile("[^\x20\x09-\x0d]")
SCHEMA = "conv_id long, turn long, role string, text string"


def damage(rows):
    out = []
    for c, t, role, text in rows:
        role, text = (" " if x is None else x for x in (role, text))
        hit = zlib.crc32(f"{' ' if c is None else c}:{' ' if t is None else t}".encode()) % 20
        if hit:
            text = "" if hit == 1 else re.sub("[.!?]", "", text) if hit == 2 else text
            out += [(c, t, "user" if hit == 4 else role, text)] * (1 + (hit == 3))
    return out


def cheapest(symbols):
    """(cost, audit, roles) by best-first search over (rows done, roles so far); audits break ties of cost."""
    queue, done = [(0, "", 0, "")], set()
    while queue:
        cost, audit, at, last = heapq.heappop(queue)
        if at == len(symbols) and last in ("", "a"):
            return cost, audit
        if (at, last) in done:
            continue
        done.add((at, last))
        want = {"": "u", "s": "u", "u": "a", "a": "u"}[last]
        moves = [(5, "I", at, want)]
        if at < len(symbols):
            role, fault = symbols[at]
            moves.append((2, "D", at + 1, last))
            if fault not in ("blank", "duplicate"):
                extra = 5 * (fault == "truncated")
                moves.append((1 + extra, "R", at + 1, want))
                if role == want or (role == "s" and last == ""):
                    moves.append((extra, "K", at + 1, role))
        for c, e, to, state in moves:
            heapq.heappush(queue, (cost + c, audit + e, to, state))


def plain(rows, every):
    """All columns of the query by conversation."""
    out = {}
    for conv in set(every):
        mine = sorted((r for r in rows if r[0] == conv), key=lambda r: (r[1] is not None, r[1] or 0, r[2]))
        seen, symbols = set(), []
        for _, _, role, text in mine:
            found = VISIBLE.findall(text)
            fault = "blank" if not found else "duplicate" if (role, text) in seen else "truncated" if found[-1] not in ".!?" else ""
            seen.add((role, text))
            symbols.append((role[:1], fault))
        ids = {r[1] for r in mine} - {None}
        cost, audit = cheapest(symbols)
        lines, last, left = [], "", list(mine)
        for e in audit:
            row = left.pop(0) if e != "I" else None
            if e == "D":
                continue
            want = {"": "u", "s": "u", "u": "a", "a": "u"}[last]
            last = row[2][:1] if e == "K" else want
            lines.append(((row[2] if e == "K" else {"u": "user", "a": "assistant"}[want]), row[3] if row else ""))
        assert re.fullmatch("(s?(ua)+)?", "".join(r[:1] for r, _ in lines))
        faults = [f for _, f in symbols]
        illegal = sum(a[0] + b[0] not in ("su", "ua", "au") for a, b in zip(symbols, symbols[1:]))
        out[conv] = (max(ids) - min(ids) + 1 - len(ids) if ids else 0, *(faults.count(f) for f in ("blank", "duplicate", "truncated")), illegal, cost, audit, brute.sha("\n".join(f"{r}:{t}" for r, t in lines)), lines)
    return out


def result(df, keep):
    return {r[0]: (*tuple(r)[1:9], *([[(x.role, x.text) for x in r.repaired]] if keep else [])) for r in df.collect()}


@pytest.mark.parametrize("sf", ["/root/testdata/sf0.001", "/root/testdata/sf0.01"])
def test_query_equals_sql_and_plain_version(spark, sf):
    df = queries.QUERIES["op12_conversation_repair"](spark, sf)
    assert compare.difference(df, compare.connect(sf), queries.ORACLES["op12_conversation_repair"]) is None
    rows = [tuple(r) for r in spark.read.parquet(f"{sf}/conversations.parquet").select("conv_id", "turn", "role", "text").collect()]
    want = plain(damage(rows), [r[0] for r in rows])
    assert result(df, False) == {c: w[:8] for c, w in want.items()}


def test_awkward_conversations(spark):
    rng = random.Random(4)
    roles = ["system", "user", "assistant", "tool", "", None, "User", "agent", "s"]
    texts = ["Yes.", "No", "", None, " \n\t", "What?! ", "ok.\u0085", "end.  ", "x" * 3000 + ".", "日本語。", "Hi.\n\n" + " " * 200]
    rows = [(c, t, rng.choice(roles), rng.choice(texts)) for c in range(150) for t in rng.sample(range(-3, 12), rng.randrange(1, 9))]
    rows += [(None, 1, "user", "a."), (None, None, "assistant", "b."), (500, None, "user", "one."), (501, None, None, None), (502, 1, "user", "a."), (502, 3, "user", "a."), (502, 9, "assistant", "b.")]
    rows += [(600, t, "user" if t % 3 else "assistant", f"turn {t}" + "." * (t % 5 > 0)) for t in range(3000)]
    rows += [(700, t, "user", "same words.") for t in range(500)]
    rows += [(800 + c, t, ("user", "assistant")[t % 2], f"line {c} {t}.") for c in range(40) for t in range(4)]
    df = spark.createDataFrame(rows, SCHEMA).withColumns({c: F.lit(1) for c in ("id_", "turn_", "signature", "audit", "cost", "kind_", "hit_", "copy_")})
    got = result(turns.repair(turns.damaged(df), every=df), True)
    want = plain(damage(rows), [r[0] for r in rows])
    assert got == want
    gone = [c for c, t, *_ in rows if c in (500, 501) and zlib.crc32(f"{c}: ".encode()) % 20 == 0]
    assert all(got[c][5:7] == (0, "") for c in gone)
    none = spark.createDataFrame([], SCHEMA)
    assert turns.repair(none).count() == 0
    assert result(turns.repair(none, every=df.filter("conv_id = 502"), keep=False), False) == {502: (0, 0, 0, 0, 0, 0, "", brute.sha(""))}


def test_every_short_signature_is_solved_cheapest():
    """All signatures of up to four rows, walked in the order of their reversal and in disorder."""
    from itertools import product

    symbols = "-suaoSUAO"
    fault = {"-": "blank"}
    words = ["".join(w) for n in range(1, 5) for w in product(symbols, repeat=n)]
    rng = random.Random(2)
    words = rng.sample(words, 1200)
    ordered, mixed = turns.Automaton(), turns.Automaton()
    for w in sorted(words, key=lambda w: w[::-1]):
        want = cheapest([(x.lower(), fault.get(x, "truncated" if x.isupper() else "")) for x in w])
        assert ordered.walk(w[::-1]) == want, w
    rng.shuffle(words)
    assert all(mixed.walk(w[::-1]) == turns.Automaton().walk(w[::-1]) for w in words)
    assert len(ordered.costs) < 400
