"""Invented texts for the tests of the training-data operators."""

import re

WORD = re.compile(r"[^\x20\x09-\x0D]+")
SYLLABLES = "an ba co de el fi go hu in jo ka lu me no or pi qu ra su te".split()


def words(text):
    return WORD.findall(text or "")


def prose(rng, n):
    """n invented words."""
    return " ".join("".join(rng.choice(SYLLABLES) for _ in range(rng.randint(1, 3))) for _ in range(n))
