"""op7_fingerprint: an insertion moves few borders, with sentence marks everywhere, without any, and without white space."""

import hashlib

import pytest

from strata.llm import fingerprint


def long_text(mark: str, n: int = 700) -> str:
    return mark.join(hashlib.md5(f"leaf {i}".encode()).hexdigest()[:2 + i % 7] for i in range(n))


@pytest.mark.parametrize("mark", [" ", "!! ", "", ", ", " | "])
def test_an_insertion_in_front_moves_few_borders(mark):
    text = long_text(mark)
    a = fingerprint.tree(text)
    for front in ("one ", "word", "two more "):
        assert fingerprint.likeness(a, fingerprint.tree(front + text)) > 0.7
    assert fingerprint.read(fingerprint.written(a)) == a


def test_leaves_keep_the_whole_text_and_their_lengths():
    for text in (long_text(" "), long_text(""), "a", "x. " * 900, "x" * 900, " " * 900, long_text(" ", 12) + ". ", ""):
        leaves = fingerprint.leaves_of(text)
        assert "".join(leaves) == text and all(80 <= len(x) <= 410 for x in leaves[:-1])
