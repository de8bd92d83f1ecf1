"""Texts and plain-Python readings that the tests of the text operators share."""

from __future__ import annotations

import string

LOWER = str.maketrans(string.ascii_uppercase, string.ascii_lowercase)


def words(text):
    """The words of a text, as bytes."""
    return (text or "").encode().split()


def lowered(text):
    return (text or "").translate(LOWER).encode().split()


def prose(seed, n):
    """n words out of a small vocabulary, always the same for a seed."""
    out, x = [], seed * 7919 + 17
    for _ in range(n):
        x = (x * 1103515245 + 12345) % (1 << 31)
        out.append(f"w{(x >> 8) % 900}")
    return " ".join(out)


#: Rows every operator must get through: nulls, empties, blanks, copies, ties, a very long text.
def awkward():
    base = prose(1, 120)
    near = base.replace(base.split()[60], "changed", 1)
    return [
        (0, base),
        (1, base),
        (2, near),
        (3, None),
        (4, ""),
        (5, " \n\t "),
        (6, "one"),
        (7, "two Words"),
        (8, prose(2, 30) + " " + base),
        (9, prose(3, 60) + "\n" + prose(3, 60)),
        (10, "a " * 500),
        (11, prose(4, 20_000)),
        (12, "Ça va où? " * 40 + prose(5, 40)),
        (13, prose(4, 20_000) + " tail"),
        (7, "two Words"),
        (None, prose(6, 40)),
        (None, prose(6, 40)),
    ]
