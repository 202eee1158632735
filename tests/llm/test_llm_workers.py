import pyarrow as pa

from tickloom.llm import workers


def test_a_worker_holds_the_table_of_one_operator():
    made = []

    @workers.one_table
    def first(path):
        made.append(path)
        return [path]

    @workers.one_table
    def second(path):
        return {path}

    assert first("a") is first("a") and made == ["a"]
    assert second("a") == {"a"} and first("a") == ["a"] and made == ["a", "a"]
    workers.begin("other")
    assert workers._held == [("other",), None] and first("b") == ["b"]


def test_stretches_give_every_text_once():
    texts = ["x" * n for n in (0, 10, 400_000, 200_000, 5, 900_000, 1)] + [None, "é"]
    for kind in (pa.string(), pa.large_string()):
        column = pa.array(["skip", *texts], kind).slice(1)
        for size, most in ((500_000, None), (1, None), (10**9, 2), (300_000, 3)):
            found = list(workers.stretches(column, size, most))
            assert [t for _, part in found for t in part] == [t or "" for t in texts]
            assert [at for at, _ in found] == [sum(len(p) for _, p in found[:i]) for i in range(len(found))]
            assert most is None or max(len(p) for _, p in found) <= most
    assert list(workers.stretches(pa.array([], pa.string()))) in ([], [(0, [])])
    assert [p for _, p in workers.stretches(pa.array([b"a", None], pa.binary()))] == [[b"a", b""]]
