"""Encoding by units and counting by merges, against the library."""

import public_tokenizers
import pytest
from hypothesis import given, settings, strategies as st
from tokenizers import Tokenizer

from reportmart.llm.packing import encoder
from reportmart.llm.token_counts import count_after_merges, count_tokens, counter
from reportmart.llm.words import Kept, slices

PATH = public_tokenizers.path("byte_bpe_50k.json")
LIBRARY = Tokenizer.from_file(PATH)
CHARS = st.sampled_from(
    list("aAbéßtThe  \t\n\r\x1c\x85\xa0 'sll.,;|<>0123²½ǅ漢字́😀​_") + ["'ll", "  ", "the "]
)
TEXTS = st.one_of(st.lists(CHARS, max_size=60).map("".join), st.text(max_size=60))


def ids(text):
    return LIBRARY.encode(text, add_special_tokens=False).ids


@settings(max_examples=1500, deadline=None)
@given(TEXTS)
def test_units_and_merges_are_the_librarys(text):
    want = ids(text)
    got = encoder(PATH).ids(text)
    assert [int.from_bytes(got[i : i + 4], "little") for i in range(0, len(got), 4)] == want
    assert counter(PATH).count(text) == len(want)


@pytest.mark.parametrize(
    "text",
    [
        "",
        "<|endoftext|>",
        "a <|endoftext|> b<|endoftext|><|endoftext|>",
        " <|endoftext",
        "a" * 3000,
        "word " * 5000,
        " " * 3000,
        "ab\n" * 2000,
    ],
)
def test_special_and_long_texts(text):
    assert counter(PATH).count(text) == len(ids(text))
    assert len(encoder(PATH).ids(text)) == 4 * len(ids(text))


def test_slices_join_to_the_text_and_keep_the_count():
    text = "The  quick\n brown fox, " * 300
    parts = list(slices(text, 100))
    assert "".join(parts) == text and len(parts) > 20
    assert sum(counter(PATH).count(p) for p in parts) == len(ids(text))


def test_merges_of_equal_rank_go_left_first():
    ranks = {("a", "a"): 0}
    assert count_after_merges(list("aaaaa"), ranks) == 3
    assert count_after_merges([], ranks) == 0
    assert count_after_merges(["a"], ranks) == 1


def test_kept_values_stay_bounded():
    kept = Kept(len, limit=10)
    assert [kept[str(i)] for i in range(50)] == [len(str(i)) for i in range(50)]
    assert len(kept) <= 10


def test_counts_of_a_table(clashing):
    rows = [(1, "two words"), (1, "two words"), (None, "x"), (2, None), (3, ""), (4, "w " * 2000)]
    found = count_tokens(clashing(rows), PATH).collect()
    want = sorted(
        ((i, len((t or "").encode()), len(ids(t or "")), len(ids(t or "")) > 1024) for i, t in rows),
        key=str,
    )
    assert sorted(map(tuple, found), key=str) == want
    assert count_tokens(clashing([]), PATH).collect() == []


def test_a_vocabulary_of_another_kind_is_refused():
    with pytest.raises(ValueError, match="plain"):
        counter(public_tokenizers.path("word_bpe_49k.json"))
