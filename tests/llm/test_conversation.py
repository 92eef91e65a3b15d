"""Conversation repair against an exhaustive search and a plain fold, on hostile tables."""

import hashlib
import random
import re
import zlib

import pytest

from corpusforge.llm import conversation, queries

SCHEMA = "conv_id long, turn long, role string, text string, id string, pos int"
BLANK = "[\x20\x09-\x0d]"


def damaged(rows):
    out = []
    for conv, turn, role, text, *_ in rows:
        role, text = " " if role is None else role, " " if text is None else text
        fate = zlib.crc32(f"{' ' if conv is None else conv}:{' ' if turn is None else turn}".encode()) % 20
        if fate == 0:
            continue
        text = "" if fate == 1 else re.sub("[.!?]", "", text) if fate == 2 else text
        out += [(conv, turn, "user" if fate == 4 else role, text)] * (2 if fate == 3 else 1)
    return out


def faults(rows):
    seen, out = set(), []
    for _, _, role, text in rows:
        bare = re.sub(BLANK, "", text)
        out.append("blank" if not bare else "duplicate" if (role, text) in seen else None if bare[-1] in ".!?" else "truncated")
        seen.add((role, text))
    return out


def moves(state, role, fault):
    """(cost, letter, state after) of every edit of one row."""
    out, extra = [(2, "D", state)], 5 * (fault == "truncated")
    if fault not in ("blank", "duplicate"):
        to = {"": "su", "s": "u", "u": "a", "a": "u"}[state]
        out += [(extra, "K", role[:1])] * (role[:1] != "" and role[:1] in to)
        out += [(extra + 1, "R", x) for x in "ua" if x in to]
    return out


def search(rows, marks, all_=True):
    """The cheapest audit: over all sequences of edits with up to two inserts in each gap, or (all_ false) the least of each state only."""
    paths = {(0, "", "")}
    inserted = lambda ps: {(c + 5, a + "I", "a" if s == "u" else "u") for c, a, s in ps}
    for (_, _, role, _), fault in zip(rows, marks):
        once = inserted(paths)
        paths = {(c + k, a + letter, t) for c, a, s in paths | once | inserted(once) for k, letter, t in moves(s, role, fault) if c + k <= 2 * len(rows)}
        if not all_:
            paths = {min(p for p in paths if p[2] == s) for s in {p[2] for p in paths}}
    once = inserted(paths)
    return min((c, a) for c, a, s in paths | once | inserted(once) if s in ("", "a"))


def applied(rows, audit):
    out, rest, first = [], iter(rows), 0
    for letter in audit:
        row = None if letter == "I" else next(rest)
        if letter != "D":
            role = ["user", "assistant"][(len(out) - first) % 2]
            if letter == "K":
                role, first = row[2], first or row[2][:1] == "s"
            out.append((role, row[3] if row else ""))
    assert re.fullmatch("(s?(ua)+)?", "".join(r[:1] for r, _ in out))
    return out


def order(row):
    return (row[1] is not None, row[1] or 0, row[2].encode())


def expected(rows, ids, all_=True):
    out = {}
    for conv in ids:
        own = sorted((r for r in rows if r[0] == conv), key=order)
        marks, turns = faults(own), [r[1] for r in own if r[1] is not None]
        cost, audit = search(own, marks, all_)
        said = "\n".join(f"{r}:{t}" for r, t in applied(own, audit))
        illegal = sum(a[2][:1] + b[2][:1] not in ("su", "ua", "au") for a, b in zip(own, own[1:]))
        gaps = max(turns) - min(turns) + 1 - len(set(turns)) if turns else 0
        out[conv] = (gaps, *(marks.count(k) for k in ("blank", "duplicate", "truncated")), illegal, cost, audit, hashlib.sha256(said.encode()).hexdigest())
    return out


def found(df):
    rows = df.collect()
    assert len(rows) == len({r.conv_id for r in rows})
    return {r.conv_id: (r.gaps, r.blank, r.duplicate, r.truncated, r.illegal, r.cost, r.audit, r.repaired_sha256) for r in rows}


def table(seed, conversations=60):
    rng, rows = random.Random(seed), []
    texts = ["Yes.", "no", "Why?", "", " ", None, "a\nb!", "é. \t", " ", "x\x1f", "Done", "."]
    for conv in [None, *range(conversations)]:
        for turn in rng.sample([None, *range(9)], rng.randint(0, 6)):
            row = (conv, turn, rng.choice(["user", "assistant", "user", "assistant", "system", "tool", "", None, "User"]), rng.choice(texts), "x", 1)
            rows += [row] * rng.choice([1, 1, 1, 1, 2])
    return rows


@pytest.mark.parametrize(("seed", "block"), [(1, 256), (2, 2)])
def test_against_exhaustive_search(spark, seed, block):
    rows = table(seed)
    df = spark.createDataFrame(rows, SCHEMA)
    out = found(conversation.repair(conversation.damage(df), ids=df, digest=True, block=block))
    want = expected(damaged(rows), {r[0] for r in rows})
    assert out == want


def test_long_conversations_fold_in_blocks(spark):
    rng = random.Random(3)
    rows = [(c, t, rng.choice(["user", "assistant", "system"]), rng.choice(["Yes.", "no", f"{t}.", f"{t}!", f"{t}"])) for c, n in ((1, 700), (2, 90), (3, 1)) for t in range(n)]
    df = spark.createDataFrame(rows, "conv_id long, turn long, role string, text string")
    want = expected(rows, {1, 2, 3}, all_=False)
    for block in (4, 256):
        assert found(conversation.repair(df, digest=True, block=block)) == want
    turns = conversation.repair(df, block=64).orderBy("conv_id", "nth").collect()
    for conv in (1, 2, 3):
        assert hashlib.sha256("\n".join(f"{r.role}:{r.text}" for r in turns if r.conv_id == conv).encode()).hexdigest() == want[conv][-1]


def test_one_phrase_and_one_turn(spark):
    """Most rows are one conversation, one turn and one text: all but the first are duplicates."""
    rows = [(7, None, "user", "Again.")] * 600 + [(7, 1, "assistant", "Yes."), (8, 0, "user", "Hi."), (8, 1, "assistant", "Ho. " * 50_000)]
    df = spark.createDataFrame(rows, "conv_id long, turn long, role string, text string").repartition(4)
    out = found(conversation.repair(df, digest=True, block=16))
    assert out == expected(rows, {7, 8}, all_=False)
    assert out[7][-2] == "K" + "D" * 599 + "K"


def test_empty_and_vanished(spark):
    df = spark.createDataFrame([], SCHEMA)
    assert found(conversation.repair(df, digest=True)) == {}
    assert conversation.repair(df).columns == ["conv_id", "nth", "role", "text"]
    ids = spark.createDataFrame([(5,), (None,)], "conv_id long")
    nothing = (0, 0, 0, 0, 0, 0, "", hashlib.sha256(b"").hexdigest())
    assert found(conversation.repair(df, ids=ids, digest=True)) == {5: nothing, None: nothing}


def test_query(spark):
    folder = "/root/testdata/sf0.001"
    rows = [tuple(r) for r in spark.read.parquet(f"{folder}/conversations.parquet").select("conv_id", "turn", "role", "text").collect()]
    assert found(queries.op11_conversations(spark, folder)) == expected(damaged(rows), {r[0] for r in rows})
