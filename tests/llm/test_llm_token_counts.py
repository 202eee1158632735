import random

import numpy as np
import public_tokenizers
from messy import documents, no_documents, texts
from test_llm_bpe import all_code_points
from tokenizers import Tokenizer

from tickloom.llm.bpe_tables import merge_table
from tickloom.llm.token_counts import DONE, NEXT, STATES, TOKENIZER, CountTransducer, TokenCounter, count_tokens, cut_places, entry_states

PATH = public_tokenizers.path(TOKENIZER)


def odd_texts(n=1500):
    rng = random.Random(5)
    parts = ["the", "'s", "'re", "'v", "'l", "'ll", "don't", "<|endoftext|>", " ", "  ", "\n", "\t", "ΑΣ", "é", "tion", "!!", "12", "\x1c", " ", "'"]
    made = ["".join(rng.choice(parts) for _ in range(rng.randint(0, 25))) for _ in range(n)]
    made += ["".join(rng.choice("aab '\nsrevl1! ") for _ in range(rng.randint(0, 40))) for _ in range(n)]
    return [*made, "", "a" * 3000, " " * 700, "\n" * 300]


def test_counts_equal_the_library():
    library = Tokenizer.from_file(PATH)
    given = odd_texts()
    expected = [len(library.encode(t, add_special_tokens=False).ids) for t in given]
    assert TokenCounter(merge_table(PATH)).counts(given) == expected


def test_forgetting_states_and_words_changes_nothing():
    library = Tokenizer.from_file(PATH)
    counter = TokenCounter(merge_table(PATH), known_words=5)
    counter.transducer = CountTransducer(merge_table(PATH), known_states=20)
    for text in odd_texts(100):
        assert counter.counts([text]) == [len(library.encode(text, add_special_tokens=False).ids)]


def test_the_scan_equals_reading_from_the_start():
    rng = np.random.default_rng(1)
    classes = rng.integers(0, 12, 5000).astype(np.uint8)
    state, seen = DONE, []
    for c in classes:
        seen.append(state)
        state = int(NEXT[c * STATES + state])
    maps = np.tile(np.arange(STATES, dtype=np.uint8), (50, 1))
    for column in classes.reshape(50, 100).T:
        maps = NEXT[column[:, None].astype(np.int64) * STATES + maps]
    assert entry_states(maps).tolist() == seen[::100]
    assert cut_places(classes, 7).tolist() == cut_places(classes, 5000).tolist()


def test_messy_documents(spark):
    library = Tokenizer.from_file(PATH)
    for extra in (False, True):
        got = count_tokens(documents(spark, extra)).select("doc_id", "text", "n_tokens").collect()
        assert len(got) == len(texts()) + 4
        for row in got:
            assert row.n_tokens == len(library.encode(row.text or "", add_special_tokens=False).ids)
    assert count_tokens(no_documents(spark)).collect() == []


def test_letters_and_digits_are_those_of_the_library():
    given = all_code_points()
    expected = [len(x.ids) for x in Tokenizer.from_file(PATH).encode_batch(given, add_special_tokens=False)]
    assert TokenCounter(merge_table(PATH)).counts(given) == expected


def test_long_words_in_chunks_equal_the_library():
    library = Tokenizer.from_file(PATH)
    rng = random.Random(9)
    words = ["".join(rng.choice("abcdeéü") for _ in range(n)) for n in (257, 1000, 20_000)]
    words += ["ab" * 3000, "a" * 5001, "".join(rng.choice(["tion", "ing", "the", "er"]) for _ in range(4000)), "漢字" * 700]
    expected = [len(library.encode(w, add_special_tokens=False).ids) for w in words]
    for states in (150_000, 300):
        transducer = CountTransducer(merge_table(PATH), known_states=states)
        assert [transducer.count(w.encode()) for w in words] == expected
        for chunk in (7, 100):
            assert [transducer.count_long(w.encode(), chunk) for w in words] == expected


def test_states_are_bounded_within_a_word():
    rng = random.Random(10)
    transducer = CountTransducer(merge_table(PATH), known_states=5_000)
    most, read = [0], transducer.read

    def watched(state, part):
        most[0] = max(most[0], len(transducer.states))
        return read(state, part)

    transducer.read = watched
    transducer.count("".join(rng.choice("abcdefghijklmnopqrstuvwxyz") for _ in range(60_000)).encode())
    assert 5_000 < most[0] < 5_000 + 2 * 256
