import random
import re
from collections import defaultdict

from pyspark.sql import functions as F

from tickloom.llm.quotations import RESULTS, reply_ordered, with_positions

SCHEMA = "conv_id bigint, turn int, role string, text string"


def level(line):
    marks = re.match(r"[ \t]*(?:>[ \t]?)+", line)
    return marks[0].count(">") if marks else 0


def bare(line):
    return re.sub(r"[\W_]+", " ", re.sub(r"^[ \t]*(?:>[ \t]?)+", "", line)).strip().lower()


def hashes(text, quoted):
    """Texts of runs and lines, by number of run."""
    runs, before = [], None
    for line in (text or "").split("\n"):
        kind = (level(line), level(line) == 0 and not bare(line))
        if kind != before:
            runs.append((level(line), []))
            before = kind
        if bare(line):
            runs[-1][1].append(bare(line))
    wanted = [(lv, lines) for lv, lines in runs if lines and (lv > 0) == quoted]
    return [(lv, {*lines, " ".join(lines)}) for lv, lines in wanted]


def plain_replies(rows):
    first = {}
    for conv, turn, _, text in rows:
        for _, found in hashes(text, False):
            for x in found:
                first[conv, x] = min(turn, first.get((conv, x), turn))
    said = defaultdict(lambda: defaultdict(int))
    for conv, turn, _, text in rows:
        for lv, found in hashes(text, True):
            votes = defaultdict(int)
            for x in found:
                if first.get((conv, x), turn) < turn:
                    votes[first[conv, x]] += len(x)
            if votes:
                n, origin = max((n, o) for o, n in votes.items())
                said[conv, turn][lv, origin] += n
    result = {}
    for key, votes in said.items():
        lv = min(lv for lv, _ in votes)
        result[key] = max((n, o) for (x, o), n in votes.items() if x == lv)[1]
    return result


def conversations(seed=1):
    rng, rows = random.Random(seed), []
    for conv in range(6):
        spoken = []
        for turn in range(12):
            lines = []
            if spoken and rng.random() < 0.7:
                quoted = rng.choice(spoken)
                part = quoted.split("\n")[: rng.randint(1, 3)]
                lines += [f">{' ' * rng.randint(0, 1)}{line}" for line in part]
            lines += [f"Line {rng.randint(0, 400)} of {conv}, {rng.choice(['yes', 'no', 'well'])}!" for _ in range(rng.randint(0, 3))]
            text = "\n".join(lines)
            spoken.append(text)
            rows.append((conv, turn, "user" if turn % 2 == 0 else "assistant", text))
    return rows


def test_replies_threads_and_order(spark):
    rows = conversations()
    got = reply_ordered(spark.createDataFrame(rows, SCHEMA).repartition(5)).collect()
    replies = plain_replies(rows)
    assert len(replies) > 20
    found = {(r.conv_id, r.turn): r for r in got}
    for (conv, turn), row in found.items():
        assert row.reply_to == replies.get((conv, turn))
        top = turn
        while (conv, top) in replies:
            top = replies[conv, top]
        assert row.thread == top
        assert not any(level(line) for line in row.reply_text.split("\n"))
    for conv in range(6):
        order = sorted((r for r in got if r.conv_id == conv), key=lambda r: r.position)
        assert [r.position for r in order] == list(range(12))
        assert [(r.thread, r.turn) for r in order] == sorted((r.thread, r.turn) for r in order)


def test_nested_levels_and_announcements(spark):
    rows = [
        (1, 0, "user", "How do I sort a list?"),
        (1, 1, "assistant", "Use sorted.\nIt returns a new list."),
        (1, 2, "user", "On Monday bob wrote:\n> Use  SORTED\n>> How do I sort a list?\nThanks!"),
        (1, 3, "user", "> nobody said this\n> > deeper\nfoo"),
    ]
    got = {r.turn: r for r in reply_ordered(spark.createDataFrame(rows, SCHEMA)).collect()}
    assert (got[2].reply_to, got[2].quote_depth, got[2].n_quoted, got[2].reply_text) == (1, 2, 2, "Thanks!")
    assert (got[3].reply_to, got[3].quote_depth, got[3].reply_text) == (None, 2, "foo")


def test_messy_messages(spark):
    rows = [
        (1, 0, "user", None), (1, 0, "user", ""), (1, 1, None, "> > >"), (None, 1, "x", "> hi"), (1, None, "x", "hi"),
        (2, 0, "u", "hi"), (2, 0, "u", "hi"), (2, 1, "u", "> hi\r\nthere"), (2, 2, "u", "long " * 30_000),
    ]
    df = spark.createDataFrame(rows, SCHEMA)
    for extra in (False, True):
        given = df.withColumns({n: F.lit("x") for n in (*RESULTS, "message")}) if extra else df
        got = reply_ordered(given).collect()
        assert len(got) == len(rows)
        by = defaultdict(list)
        for r in got:
            by[r.conv_id].append(r.position)
        assert all(sorted(p) == list(range(len(p))) for p in by.values())
        assert [(r.reply_to, r.reply_text) for r in got if r.conv_id == 2 and r.turn == 1] == [(0, "there")]
    assert reply_ordered(df.limit(0)).collect() == []


def test_positions_of_a_hot_group(spark):
    df = spark.range(3000).select(F.when(F.col("id") % 3 > 0, 0).otherwise(F.col("id")).alias("g"), (7 * F.col("id") % 3000).alias("o"))
    rows = with_positions(df.repartition(6), "g", ["o"]).collect()
    hot = sorted((r for r in rows if r.g == 0), key=lambda r: r.position)
    assert [r.position for r in hot] == list(range(2001)) and [r.o for r in hot] == sorted(r.o for r in hot)


def test_no_python_on_the_way(spark):
    df = spark.createDataFrame(conversations(), SCHEMA)
    plan = reply_ordered(df)._jdf.queryExecution().executedPlan().toString()
    assert "Python" not in plan and "Arrow" not in plan and "Pandas" not in plan
