"""Texts and rows that the tests of this folder share."""

import random

WORDS = "the of and to in for is on that by this with you it not or be are from at as your all have new".split()


def prose(seed, n=80, end="."):
    """Deterministic text of n words in sentences of eight."""
    r = random.Random(seed)
    out = [r.choice(WORDS) + r.choice(["", "ing", "ed", "tion", "ly"]) + r.choice(["", "a", "b", "c", "d"]) for _ in range(n)]
    return " ".join(w + (end if k % 8 == 7 else "") for k, w in enumerate(out))


#: Edge cases that every operator takes: nulls, empty, white space only, very
#: long, ties, repeated rows, a null id.
EDGES = [
    (1, None), (2, ""), (3, " \t\n\x0b\x0c\r "), (4, "one"), (5, "word " * 20000), (6, prose(6)), (7, prose(6)),
    (7, prose(6)), (8, "  " + prose(6) + "\n"), (None, prose(9)), (None, None), (11, "x" * 50000), (12, "é\u0000 日本語 😀 ▁ <s> <|endoftext|>"),
    (13, prose(13) + "\n" + prose(14) + "\n" + prose(13)), (14, "12345 678 --- !!!"),
]
