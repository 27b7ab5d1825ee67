"""Rows that the tests share."""

import random


def prose(seed: int, n: int, letters: str = "abcdefgh") -> str:
    rng = random.Random(seed)
    return " ".join("".join(rng.choices(letters, k=rng.randrange(2, 7))) for _ in range(n))


LONG = prose(5, 60_000)

# Nulls, empty and blank texts, a very long one, ties, repeated rows, a repeated id, odd letters.
ODD = [
    (None, None),
    (None, "no id, one two three four five six"),
    (None, "another without id: one two three four"),
    (1, None),
    (2, ""),
    (3, " \n\t \n"),
    (4, "same same same\nsame same same\nother line here"),
    (4, "same same same\nsame same same\nother line here"),
    (5, "same same same\nsame same same\nother line here"),
    (6, LONG),
    (7, LONG),
    (8, "Ünïcödé ▁ 你好 😀 123 !!"),
    (8, "a repeated id with another text"),
    (9, "12 34 -- ??"),
    (10, "x" * 5000),
]
