import re

from messy import documents, no_documents, prose, texts

from tickloom.llm.decontaminate import clean_documents, find_passages

WORD = re.compile(r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+")
LOWER = str.maketrans("ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz")


def words(text):
    return WORD.findall((text or "").translate(LOWER))


def plain_search(text, items, size=10):
    own, hit, found = words(text), set(), set()
    for number, item in items:
        w = words(item)
        for part in [w[i : i + size] for i in range(max(1, len(w) - size + 1))] if w else []:
            for at in range(len(own) - len(part) + 1):
                if own[at : at + len(part)] == part:
                    hit.update(range(at, at + len(part)))
                    found.add(str(number))
    return len(own), len(hit), sorted(found - {"None"})


def items(spark):
    long = (texts()[5] or "").split()
    rows = [
        (10, " ".join(long[20:35])),
        (2, "WORLD it's"),
        (3, None),
        (4, "?!"),
        (5, " ".join(long[30:45]).upper()),
        (10, " ".join(long[20:35])),
        (None, "ñandú 漢字"),
        (7, prose(9)),
    ]
    return spark.createDataFrame(rows, "item_id bigint, text string"), rows


def test_equals_a_plain_search(spark):
    bench, rows = items(spark)
    for block in (2_000_000, 60):
        got = find_passages(documents(spark, extra=True), bench, block_letters=block).collect()
        assert len(got) == len(texts()) + 4
        for row in got:
            c = row.contamination
            assert (c.n_words, c.n_hit, c["items"]) == plain_search(row.text, rows)


def test_spans_are_places_in_the_text(spark):
    text = "Ünïcode first. Then:  alpha BETA, gamma -- delta!"
    docs = spark.createDataFrame([(1, text)], "doc_id int, text string")
    bench = spark.createDataFrame([(1, "Beta gamma")], "item_id int, text string")
    (span,) = find_passages(docs, bench).first().contamination.spans
    assert text[span.begin : span.end] == "BETA, gamma"
    assert (span.first_word, span.end_word) == (4, 6)


def test_clean_documents_stay_as_they_are(spark):
    bench, rows = items(spark)
    docs = documents(spark, extra=True)
    kept = clean_documents(docs, bench)
    assert kept.columns == docs.columns
    expected = [r for r in docs.collect() if not plain_search(r.text, rows)[1]]
    assert sorted(map(str, kept.collect())) == sorted(map(str, expected))


def test_empty_tables(spark):
    bench, _ = items(spark)
    assert find_passages(no_documents(spark), bench).collect() == []
    none = find_passages(documents(spark), bench.limit(0)).collect()
    assert len(none) == len(texts()) + 4 and all(r.contamination.n_hit == 0 for r in none)


def test_a_very_long_item(spark):
    """Every window of an item of 30,000 words, and the few of it that a document has."""
    words = [f"w{i}" for i in range(30_000)]
    docs = [(1, " ".join(words)), (2, " ".join(words[100:115])), (3, " ".join(words[200:209])), (4, " ".join(words[::2]))]
    items = spark.createDataFrame([("long", " ".join(words))], "item_id string, text string")
    found = find_passages(spark.createDataFrame(docs, "doc_id bigint, text string"), items, result="found")
    rows = {r.doc_id: (r.found.n_words, r.found.n_hit, list(r.found["items"])) for r in found.collect()}
    assert rows == {1: (30_000, 30_000, ["long"]), 2: (15, 15, ["long"]), 3: (9, 0, []), 4: (15_000, 0, [])}
