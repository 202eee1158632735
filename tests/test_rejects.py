"""Messages that cannot be decoded are kept with a reason and counted on the way."""

import pytest

from tickloom.functions import EmptyInputError
from tickloom.operators.rejects import decode_or_reject, reject_counts
from tickloom.schemas import KAFKA_RECORD, TICK_MESSAGE

GOOD = '{"ticker":"A","timestamp":"2024-01-02 09:00:00","open":1.0,"volume":3}'
CASES = [
    (GOOD, None),
    (None, "no value"),
    ("", "no value"),
    ("  ", "no value"),
    (GOOD[:-5], "broken JSON"),
    ("nonsense", "broken JSON"),
    ('{"ticker":"A","timestamp":"2024-01-02 09:00:00","volume":"many"}', "wrong type"),
    ("[1, 2]", "wrong type"),
    ('{"timestamp":"2024-01-02 09:00:00"}', "missing ticker"),
    ('{"ticker":"A","timestamp":"yesterday"}', "missing timestamp"),
    ('{"ticker":"A"}', "missing timestamp"),
    ('{"ticker":"A","timestamp":"2024-01-02 09:00:00","more":{"x":1}}', None),
]


def records(spark, values):
    rows = [(None, None if v is None else bytearray(v.encode()), "t", i % 2, i, None, 0) for i, v in enumerate(values)]
    return spark.createDataFrame(rows, KAFKA_RECORD).repartition(3)


def decoded(spark, values, path):
    return decode_or_reject(records(spark, values), TICK_MESSAGE, str(path), ["ticker"], ["offset"], ["timestamp"])


def test_each_reason(spark, tmp_path):
    found = decoded(spark, [v for v, _ in CASES], tmp_path / "d")
    reasons = {r.offset: (r.raw, r.reason) for r in found.rejects.collect()}
    expected = {i: (v, why) for i, (v, why) in enumerate(CASES) if why}
    assert reasons == expected
    assert {r.offset: (r.ticker, r.volume) for r in found.rows.collect()} == {0: ("A", 3), 11: ("A", None)}
    assert (found.accepted, found.rejected) == (2, 10)
    assert {r.reason: r.messages for r in reject_counts(found.rejects).collect()} == {
        "no value": 3, "broken JSON": 2, "wrong type": 2, "missing ticker": 1, "missing timestamp": 2,
    }


def test_the_guard_reads_the_observation(spark, tmp_path):
    assert decoded(spark, [GOOD], tmp_path / "a").require_rows().rejected == 0
    with pytest.raises(EmptyInputError, match="2 rejected"):
        decoded(spark, ["x", None], tmp_path / "b").require_rows()
    nothing = decoded(spark, [], tmp_path / "c")
    assert (nothing.accepted, nothing.rejected) == (0, 0) and nothing.rows.collect() == nothing.rejects.collect() == []


def test_one_job_writes_both(spark, tmp_path):
    tracker = spark.sparkContext.statusTracker()
    spark.sparkContext.setJobGroup("rejects", "one pass")
    try:
        decoded(spark, [v for v, _ in CASES], tmp_path / "d")
        # The exchange of the test's own repartition and the write.
        assert len(tracker.getJobIdsForGroup("rejects")) <= 2
    finally:
        spark.sparkContext.setLocalProperty("spark.jobGroup.id", None)
