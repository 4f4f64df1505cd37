"""Splitting of whole texts into pieces that a byte-level tokenizer treats on their own.

A space between two characters that are no white space always begins a match of the splitting
pattern, so the text can be cut there: each piece, with the space before it, has tokens that depend
on nothing else. Pieces repeat, and their tokens are kept in a bounded memo for each task.
"""

from __future__ import annotations

from collections.abc import Callable, Iterable

import regex

from clickloom.llm.texts import Memo

_SPACE_BY_SPACE = regex.compile(r" \s|\s ")
PIECES_KEPT, WORDS_KEPT = 150_000, 500_000


def white_space_pattern(pattern: str) -> regex.Pattern:
    """The pattern with Unicode's White_Space for ``\\s``, which Python's own class exceeds."""
    outside, inside = r"\p{White_Space}", r"\p{White_Space}"
    return regex.compile(pattern.replace(r"[^\s", "[^" + inside).replace(r"\S", r"\P{White_Space}").replace(r"\s", outside))


class PieceTokens:
    """What ``of_word`` gives for each match of a pattern, joined over the matches of a text.

    ``of_word`` takes a match and returns a value, ``join`` takes values in order.
    """

    def __init__(self, pattern: str, of_word: Callable, join: Callable[[Iterable], object]):
        self.find = white_space_pattern(pattern).findall
        self.join = join
        self.words = Memo(of_word, WORDS_KEPT)
        self.pieces = Memo(self._of_piece, PIECES_KEPT)

    def _of_piece(self, piece: str):
        of_word, word = self.words.__getitem__, piece.removeprefix(" ")
        if word.isalpha():  # letters alone are one match
            return of_word(piece)
        if word[:-1].isalpha() and word[-1] in ".,":
            return self.join((of_word(piece[:-1]), of_word(piece[-1])))
        return self.join(map(of_word, self.find(piece)))

    def of_text(self, text: str):
        if _SPACE_BY_SPACE.search(text):
            return self.join(map(self.words.__getitem__, self.find(text)))
        first, *rest = text.split(" ")
        pieces = [first, *[" " + piece for piece in rest]]
        return self.join(map(self.pieces.__getitem__, pieces))
