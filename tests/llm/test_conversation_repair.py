"""Against a brute force over all edit scripts, written from the contract."""

import hashlib
import itertools
import random
import re
import zlib

import pytest

from haze.llm import conversation_repair as R

SCHEMA = "conv_id long, turn long, role string, text string"
EMPTY = hashlib.sha256(b"").hexdigest()


def _damaged(rows):
    out = []
    for conv, turn, role, text in rows:
        named = [" " if v is None else v for v in (conv, turn, role, text)]
        k = zlib.crc32(f"{named[0]}:{named[1]}".encode()) % 20
        role, text = named[2], "" if k == 1 else re.sub("[.!?]", "", named[3]) if k == 2 else named[3]
        out += [(conv, turn, "user" if k == 4 else role, text)] * (0 if k == 0 else 2 if k == 3 else 1)
    return out


def _faults(rows):
    seen, out = set(), []
    for role, text in rows:
        body = text.rstrip(" \t\n\x0b\x0c\r")
        out.append("blank" if not body else "duplicate" if (role, text) in seen else "truncated" if body[-1] not in ".!?" else "")
        seen.add((role, text))
    return out


def _search(rows, faults):
    """Least (cost, audit, repaired) over every edit script of bounded cost."""
    best = (3 * len(rows), "D" * len(rows), [])

    def go(i, cost, audit, made):
        nonlocal best
        if cost > best[0]:
            return
        initials = "".join(r[:1] or "-" for r, _ in made)
        if not re.fullmatch("s?(ua)*u?", initials):
            return
        if i == len(rows) and re.fullmatch("(s?(ua)+)?", initials):
            best = min(best, (cost, audit, made), key=lambda b: b[:2])
        for role in ("user", "assistant"):
            go(i, cost + 2, audit + "I", [*made, (role, "")])
        if i < len(rows):
            role, text = rows[i]
            go(i + 1, cost + 3, audit + "D", made)
            if faults[i] not in ("blank", "duplicate"):
                more = cost + (faults[i] == "truncated")
                go(i + 1, more, audit + "K", [*made, (role, text)])
                for other in ("user", "assistant"):
                    go(i + 1, more + 2, audit + "R", [*made, (other, text)])
    go(0, 0, "", [])
    return best


def _expected(conv, rows):
    """rows: damaged (turn, role, text)."""
    order = sorted(rows, key=lambda r: (r[0] is not None, r[0] or 0))
    pairs = [(role, text) for _, role, text in order]
    faults = _faults(pairs)
    cost, audit, made = _search(pairs, faults)
    turns = [t for t, _, _ in rows if t is not None]
    initials = [r[:1] for r, _ in pairs]
    return (conv, max(turns) - min(turns) + 1 - len(set(turns)) if turns else 0, *(faults.count(f) for f in ("blank", "duplicate", "truncated")),
            sum(a + b not in ("su", "ua", "au") for a, b in zip(initials, initials[1:])), cost, audit,
            hashlib.sha256("\n".join(f"{r}:{t}" for r, t in made).encode()).hexdigest())


def test_alignments_agree_with_brute_force_and_each_other():
    rng = random.Random(4)
    roles = {0: "tool", 1: "system", 2: "user", 3: "assistant"}
    for n in range(6):
        for _ in range(60):
            codes = bytes(rng.choice((0, 1, 2, 2, 3, 3)) * 4 + rng.choice((0, 0, 0, 1, 2, 3)) for _ in range(n))
            faults = [("", "blank", "duplicate", "truncated")[c & 3] for c in codes]
            want = _search([(roles[c >> 2], str(i)) for i, c in enumerate(codes)], faults)[:2]
            assert R._by_length(codes) == want == R._by_state(codes), codes
    for n in (9, 17, 40, 75):
        for _ in range(12):
            codes = bytes(rng.choice((0, 1, 2, 2, 3, 3)) * 4 + rng.choice((0, 0, 0, 0, 1, 2, 3)) for _ in range(n))
            assert R._by_length(codes) == R._by_state(codes), codes


@pytest.mark.parametrize("long", [0, R.LONG])
def test_whole_conversations_against_brute_force(spark, long):
    rng = random.Random(11)
    rows = []
    for conv in range(120):
        for turn in range(rng.randrange(1, 6)):
            role = rng.choice(["user", "assistant"]) if rng.random() < 0.3 else ["user", "assistant"][turn % 2]
            role = "system" if turn == 0 and rng.random() < 0.4 else role
            rows.append((conv, turn + (turn > 2) * rng.randrange(2), role, rng.choice(["Yes.", "No!", "Why?  \n", "cut of", " \t", "Ähm.é", "Yes."])))
    rows = list({(r[0], r[1]): r for r in rows}.values())  # one row for each turn: ties have a test of their own
    df = spark.createDataFrame(rows, SCHEMA)
    got = {r.conv_id: tuple(r)[:9] for r in R.repair(R.damage(df), df, long).collect()}
    left = {}
    for conv, *row in _damaged(rows):
        left.setdefault(conv, []).append(tuple(row))
    assert len(got) == 120
    for conv in range(120):
        assert got[conv] == _expected(conv, left.get(conv, [])), conv


def test_hand_made_cases(spark):
    long = "Word " * 200_000 + "end."
    dropped = next(i for i in itertools.count(1000) if zlib.crc32(f"{i}:0".encode()) % 20 == 0)
    plain = next(i for i in itertools.count(2000) if all(zlib.crc32(f"{i}:{t}".encode()) % 20 > 4 for t in (0, 1, " ")))
    nulls = [(None, None, None, None), (None, 0, "user", None)]
    rows = [(dropped, 0, "user", "Hi."), (plain, 0, "user", long), (plain, 1, "assistant", "Ok."), (plain, 1, "assistant", "Ok."),
            (plain, None, "system", "Be kind."), *nulls]
    df = spark.createDataFrame([(*r, "x", 1) for r in rows], SCHEMA + ", digest string, code long")
    got = {r.conv_id: r for r in R.repair(R.damage(df), df).collect()}
    assert tuple(got[dropped])[1:9] == (0, 0, 0, 0, 0, 0, "", EMPTY)
    assert got[plain].audit == "KKKD" and got[plain].duplicate == 1 and got[plain].cost == 3 and got[plain].gaps == 0
    assert got[plain].repaired_sha256 == hashlib.sha256(f"system:Be kind.\nuser:{long}\nassistant:Ok.".encode()).hexdigest()
    assert got[None].blank == len([r for r in _damaged(nulls)]) and set(got[None].audit) <= {"D"}
    assert R.repair(R.damage(df.limit(0)), df.limit(0)).count() == 0


def test_a_conversation_of_very_many_rows(spark):
    n = 60_000
    df = spark.range(n).selectExpr("7L AS conv_id", "id AS turn", "if(id % 2 = 0, 'user', 'assistant') AS role", "concat('Row ', id, '.') AS text")
    row = R.repair(R.damage(df), df).first()
    rows = _damaged((7, i, ("user", "assistant")[i % 2], f"Row {i}.") for i in range(n))
    assert row.n_rows == len(rows) and row.gaps == 0 + n - len({r[1] for r in rows})
    assert row.blank > 0 and row.duplicate > 0 and row.truncated > 0 and len(row.audit) >= len(rows)
