import hashlib
import random
import zlib
from collections import defaultdict
from itertools import product

import pytest

from tickloom.llm import repair as rp

SCHEMA = "conv_id bigint, turn bigint, role string, text string"
EXTRA = ", key string, mark int, block string, audit string, kind int, _at string"


def plain(codes, start=0, ends=(0, None, None, 0), tail=True):
    """Least cost and audit by a table over all messages and states."""
    best = {start: (0, "")}

    def put(table, state, label):
        if state not in table or label < table[state]:
            table[state] = label

    def insert(table):
        for _ in range(3):
            for s, (cost, audit) in list(table.items()):
                put(table, 2 if s != 2 else 3, (cost + 5, audit + "I"))

    for code in codes:
        insert(best)
        after = {}
        role = "suax"["1234".index(code)] if code in "1234" else code.lower()
        extra = 5 if code in "1234" else 0
        for s, (cost, audit) in best.items():
            put(after, s, (cost + 2, audit + "D"))
            if code.isupper():
                continue
            put(after, 2 if s != 2 else 3, (cost + 1 + extra, audit + "R"))
            if s == 0 and role == "s":
                put(after, 1, (cost + extra, audit + "K"))
            if s != 2 and role == "u":
                put(after, 2, (cost + extra, audit + "K"))
            if s == 2 and role == "a":
                put(after, 3, (cost + extra, audit + "K"))
        best = after
    if tail:
        insert(best)
    found = [(c + ends[s], a) for s, (c, a) in best.items() if ends[s] is not None]
    return min(found, default=None)


def test_cheapest_edits_of_all_short_conversations():
    for n in range(5):
        for letters in product("suaxSU12", repeat=n):
            codes = "".join(letters)
            assert rp.cheapest(codes)[:2] == plain(codes), codes


def test_cheapest_edits_of_long_conversations():
    rng = random.Random(1)
    for _ in range(60):
        codes = "".join(rng.choices("suaxSUAX1234", k=rng.randint(30, 300)))
        assert rp.cheapest(codes)[:2] == plain(codes)
    ends = (rp.NEVER, 3, rp.NEVER, 1)
    for _ in range(200):
        codes, start = "".join(rng.choices("suaxSUAX1234", k=rng.randint(1, 40))), rng.randrange(4)
        assert rp.cheapest(codes, start, ends, False)[:2] == plain(codes, start, (None, 3, None, 1), False)


def damage(rows):
    for conv, turn, role, text in rows:
        show = lambda x: " " if x is None else str(x)
        kind = zlib.crc32(f"{show(conv)}:{show(turn)}".encode()) % 20
        role, text = show(role), show(text)
        if kind == 0:
            continue
        text = "" if kind == 1 else text.translate({46: None, 33: None, 63: None}) if kind == 2 else text
        yield from [(conv, turn, "user" if kind == 4 else role, text)] * (2 if kind == 3 else 1)


def expected(rows):
    groups = defaultdict(list)
    for row in damage(rows):
        groups[row[0]].append(row)
    result = set()
    for conv in {r[0] for r in rows}:
        own = sorted(groups[conv], key=lambda r: (r[1] is not None, r[1] or 0, r[2], hashlib.md5(r[3].encode()).digest()))
        seen, codes, count = set(), "", defaultdict(int)
        for _, _, role, text in own:
            bare = text.rstrip(" \t\n\v\f\r")
            fault = "blank" if not bare.lstrip(" \t\n\v\f\r") else "duplicate" if (role, text) in seen else "" if bare[-1] in ".!?" else "truncated"
            seen.add((role, text))
            count[fault] += 1
            letter = role[:1] if role[:1] in ("s", "u", "a") else "x"
            codes += letter.upper() if fault in ("blank", "duplicate") else "1234"["suax".index(letter)] if fault else letter
        initials = [r[2][:1] for r in own]
        illegal = sum(a + b not in ("su", "ua", "au") for a, b in zip(initials, initials[1:]))
        turns = {r[1] for r in own if r[1] is not None}
        cost, audit = plain(codes)
        out, state, todo = [], 0, iter(own)
        for edit in audit:
            row = next(todo) if edit != "I" else None
            if edit == "D":
                continue
            due = "assistant" if state == 2 else "user"
            out.append(f"{row[2] if edit == 'K' else due}:{row[3] if row else ''}")
            state = 1 if edit == "K" and row[2][:1] == "s" else 3 if state == 2 else 2
        digest = hashlib.sha256("\n".join(out).encode()).hexdigest()
        gaps = max(turns) - min(turns) + 1 - len(turns) if turns else 0
        result.add((conv, gaps, count["blank"], count["duplicate"], count["truncated"], illegal, cost, audit, digest))
    return result


def conversations(seed, n=60, longest=30):
    rng = random.Random(seed)
    rows = []
    for conv in range(n):
        for turn in range(rng.randint(1, longest)):
            role = rng.choice(["system", "user", "assistant", "user", "assistant", "tool"])
            text = rng.choice(["Fine.", "What is it?", "No end", " \t\n", "", f"Number {turn}!", "Wait...  \n", "ümläut 漢字。"])
            rows.append((conv, turn * rng.choice([1, 1, 2]), role, text))
    odd = [(None, None, None, None), (None, 1, "user", "Hi."), (900, None, "user", "x."), (900, None, "assistant", None), (901, 5, "", "Empty role.")]
    rng.shuffle(rows)
    return rows + odd


def report(spark, rows, parts=4, **settings):
    frame = spark.createDataFrame(rows, SCHEMA).repartition(parts)
    return rp.repair_report(rp.damaged(frame), frame, **settings)


def test_report_equals_a_plain_recomputation(spark):
    rows = conversations(1)
    found = report(spark, rows)
    assert found.columns == ["conv_id", "gaps", "blank", "duplicate", "truncated", "illegal", "cost", "audit", "repaired_sha256"]
    assert {tuple(r) for r in found.collect()} == expected(rows)


@pytest.mark.parametrize("size, fan", [(7, 2), (3, 3)])
def test_long_conversations_in_segments(spark, size, fan):
    """Conversations of up to 300 messages over several levels of segments."""
    rows = conversations(2, n=5, longest=300) + conversations(3, n=10, longest=12)[: 60]
    assert {tuple(r) for r in report(spark, rows, size=size, fan=fan).collect()} == expected(rows)


def test_one_message_repeated_very_often(spark):
    rows = [(1, 7, "user", "Same.")] * 500 + [(1, 8, "assistant", "Yes.")]
    assert {tuple(r) for r in report(spark, rows, size=50, fan=4).collect()} == expected(rows)


def test_repaired_messages(spark):
    frame = spark.createDataFrame([(1, 0, "user", "Hi."), (1, 1, "user", "There."), (1, 2, "assistant", ""), (2, 0, "", "")], SCHEMA)
    rows = sorted(tuple(r) for r in rp.repaired_messages(frame).collect())
    assert rows == [("=1", 0, "K", "user", "Hi."), ("=1", 1, "R", "assistant", "There.")]


def test_empty_and_clashing_tables(spark):
    assert report(spark, []).collect() == []
    rows = conversations(4, n=8)
    wide = spark.createDataFrame([(*r, "x", 1, "y", "z", 2, "w") for r in rows], SCHEMA + EXTRA)
    assert {tuple(r) for r in rp.repair_report(rp.damaged(wide), wide).collect()} == expected(rows)
    # All messages gone: none left after the damage.
    gone = next(t for t in range(1000) if zlib.crc32(f"5:{t}".encode()) % 20 == 0)
    (row,) = report(spark, [(5, gone, "user", "Hi.")]).collect()
    assert row[1:8] == (0, 0, 0, 0, 0, 0, "") and row.repaired_sha256 == hashlib.sha256().hexdigest()


def test_a_very_long_text(spark):
    rows = [(1, 0, "user", "word " * 200_000 + "."), (1, 1, "assistant", "a" * 300_000 + "!")]
    assert {tuple(r) for r in report(spark, rows).collect()} == expected(rows)


def test_the_search_meets_in_the_middle():
    """From both ends the path is found in a part of the lattice."""
    codes = "s" + "ua" * 3000
    assert rp.cheapest(codes)[:2] == (0, "K" * len(codes))
