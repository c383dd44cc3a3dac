"""Invented texts."""

import random

VOCABULARY = [
    a + b for a in ("ba", "do", "ke", "li", "mu", "na", "po", "ri", "sa", "tu", "Ве", "ñu") for b in ("n", "rt", "sel", "", "mo")]


def prose(seed, n):
    """``n`` words, the same for the same seed."""
    r = random.Random(seed)
    return " ".join(r.choice(VOCABULARY) + r.choice(VOCABULARY) + r.choice(["", "", "", ",", "."]) for _ in range(n))
