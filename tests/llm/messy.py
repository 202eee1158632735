"""Small tables with every odd case: nulls, empty and long texts, ties, repeated rows,
columns called like results and like helpers."""

import random

DOCUMENTS = "doc_id bigint, text string, lang string, source string, n_chars bigint"
EXTRA = "shard string, slot int, n_tokens string, member int, words_key int, quality_score int, toxicity string, contamination int"


def prose(seed, words=40):
    rng = random.Random(seed)
    return " ".join("".join(rng.choice("abcdefghij") for _ in range(rng.randint(2, 6))) for _ in range(words))


def texts():
    base = prose(1, 200).split()
    near = [*base[:100], "changed", *base[101:]]
    return [
        "Hello, World! It's fine.",
        None,
        "",
        " \n\t ",
        "!!! ???",
        " ".join(base),
        " ".join(base).upper(),
        " ".join(near),
        prose(2, 20_000),
        "ümläut ñandú 漢字 😀 ΑΣ <|endoftext|> don't",
        "a" * 3000,
        prose(3),
        prose(3),
        prose(4),
    ]


def documents(spark, extra=False):
    rows = [(i, t, "en", "src0", len(t or "")) for i, t in enumerate(texts())]
    rows += [rows[0], (None, prose(5), None, None, None), (None, None, None, None, None), (3, prose(6), "de", None, -1)]
    if extra:
        rows = [(*row, "x", 1, "y", 2, 3, 4, "z", 5) for row in rows]
    return spark.createDataFrame(rows, f"{DOCUMENTS}, {EXTRA}" if extra else DOCUMENTS)


def no_documents(spark):
    return spark.createDataFrame([], DOCUMENTS)
