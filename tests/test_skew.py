"""One key holds a third of the rows: results equal a plain recomputation."""

import random
from collections import Counter, defaultdict

import pytest
from helpers import TICK_SCHEMA, tick

from tickloom.functions import wide_key
from tickloom.operators import ridership as rid
from tickloom.operators.bars import daily_bars
from tickloom.operators.text import word_count

ROWS = 6000


@pytest.fixture(scope="module")
def ticks():
    generator = random.Random(11)
    return [
        tick(
            "HOT" if i % 3 == 0 else f"T{generator.randint(0, 30)}",
            f"2024-01-{generator.randint(1, 5):02d} {generator.randint(9, 16):02d}:00:00",
            float(generator.randint(1, 1000)),
            generator.randint(1, 9),
        )
        for i in range(ROWS)
    ]


def expected_bars(ticks):
    groups = defaultdict(list)
    for t in ticks:
        groups[t[0], t[2]].append(t)
    return sorted(
        (
            *key,
            min((t[1], t[3]) for t in group)[1],
            max(t[4] for t in group),
            min(t[5] for t in group),
            max((t[1], t[6]) for t in group)[1],
            sum(t[7] for t in group),
        )
        for key, group in groups.items()
    )


def test_bars_of_a_hot_ticker(spark, ticks):
    frame = spark.createDataFrame(ticks, TICK_SCHEMA).repartition(13)
    assert sorted(map(tuple, daily_bars(frame).collect())) == expected_bars(ticks)


def test_wide_key_orders_like_the_pair_it_is_made_of(spark, ticks):
    frame = spark.createDataFrame(ticks, TICK_SCHEMA)
    pairs = frame.selectExpr(
        "ticker", "date", "open", "high", "low", "close", "volume",
        "unix_micros(timestamp) AS moment", "cast(open AS bigint) AS cents",
    )
    keyed = pairs.withColumn("sequence", wide_key("moment", "cents"))
    bars = daily_bars(keyed, order_by=("sequence",), unique_order=True)
    assert sorted(map(tuple, bars.collect())) == expected_bars(ticks)
    big = spark.createDataFrame([(9 * 10**18, 9 * 10**18)], "a bigint, b bigint")
    assert int(big.select(wide_key("a", "b")).first()[0]) == 9 * 10**18 * (10**19 + 1)


def test_figures_of_a_hot_line_and_station(spark):
    generator = random.Random(12)
    rows = [
        ("L", "S", generator.randint(0, 9), generator.randint(0, 9))
        if i % 3 == 0
        else (f"l{i % 7}", f"s{i % 50}", generator.randint(0, 9), None if i % 11 == 0 else 1)
        for i in range(ROWS)
    ]
    names = [rid.LINE, rid.STATION, rid.BOARDING, rid.ALIGHTING]
    frame = spark.createDataFrame(rows, names).repartition(9)
    by_line, by_station = Counter(), Counter()
    for line, station, on, off in rows:
        by_line[line] += on + off if off is not None else 0
        by_station[station] += on + off if off is not None else 0
    lines = {r.name: r.total for r in rid.report_lines(rid.usage_by_line_and_station(frame)).collect()
             if r.section == "total_by_line"}
    assert lines == dict(by_line)
    top = [tuple(r) for r in rid.top_stations(frame).collect()]
    assert top == sorted(by_station.items(), key=lambda kv: (-kv[1], kv[0]))[:5]


def test_words_with_a_hot_word(spark):
    generator = random.Random(13)
    lines = [" ".join(generator.choice(["hot", "", f"w{generator.randint(0, 99)}"]) for _ in range(9))
             for _ in range(700)]
    frame = spark.createDataFrame([(line,) for line in lines], "line string").repartition(7)
    expected = Counter(word for line in lines for word in line.split(" "))
    assert {r.word: r["count"] for r in word_count(frame).collect()} == dict(expected)
