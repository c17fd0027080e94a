"""Small tables with everything that is awkward."""

from __future__ import annotations

import random

WORDS = "the of and bird river stone cloud über naïve señor token Glass window paper light 7 42 x-y".split()


def sentence(rng: random.Random, n: int) -> str:
    return " ".join(rng.choice(WORDS) + str(rng.randrange(30)) * (rng.random() < 0.5) for _ in range(n))


def awkward(seed: int = 3) -> list[tuple[int | None, str | None]]:
    """Nulls, empty and blank texts, repeated rows and ids, shared lines and passages."""
    rng = random.Random(seed)
    shared = [sentence(rng, n) for n in (40, 60, 12, 120)]
    rows: list[tuple[int | None, str | None]] = [
        (5, None), (6, ""), (7, "   "), (8, "\n\n \t\n"), (9, "one"), (10, "one"), (11, "a b c d"), (None, None),
        (None, shared[1]), (None, shared[1] + " end"),
    ]
    for i in range(20, 60):
        parts = [sentence(rng, rng.randrange(1, 90)) for _ in range(rng.randrange(1, 4))]
        if i % 3 == 0:
            parts.insert(rng.randrange(len(parts) + 1), rng.choice(shared))
        if i % 7 == 0:
            parts += ["  Terms And CONDITIONS apply ", "short"]
        if i % 11 == 0:
            parts += parts[:1]
        rows.append((i, rng.choice(["\n", " "]).join(parts)))
    base = sentence(rng, 200).split()
    for i in range(60, 75):
        copy = list(base)
        for _ in range(i - 62):
            copy[rng.randrange(len(copy))] = f"new{i}"
        rows.append((i, " ".join(copy)))
    rows += [(80, rows[-1][1]), (80, rows[-1][1]), (80, "other text under the same number"), (81, "same words " * 400)]
    rows += [(82, "é" * 70), (83, "é" * 64 + "ü"), (84, "long " * 5 + "x" * 3000), (85, "x" * 2990)]
    return rows


def frame(spark, rows, parts: int = 4, more: tuple[str, ...] = ()):
    """The rows as documents, with further columns of the given names (strings)."""
    schema = "doc_id long, text string" + "".join(f", {n} string" for n in more)
    return spark.createDataFrame([(*r, *(f"{n}!" for n in more)) for r in rows], schema).repartition(parts)
