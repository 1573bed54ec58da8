"""Small documents with the awkward cases: nulls, empty texts, copies, near copies, long texts, ties, extra columns."""

from __future__ import annotations

import random

SCHEMA = "doc_id long, text string, lang string, source string, n_chars long, fp string, size int, score string, rate int, target string"


def prose(rng: random.Random, n: int) -> str:
    return " ".join("".join(rng.choices("abcdefghij", k=rng.randint(2, 9))) for _ in range(n))


def rows() -> list[tuple]:
    rng = random.Random(7)
    base, passage = prose(rng, 220), prose(rng, 70)
    words = base.split()
    near = [words.copy() for _ in range(4)]
    for i, w in enumerate(near):
        w[20 * i + 5] = f"edit{i}"
    texts: list[str | None] = [None, "", " \n\t ", "one", "one two three", base, base, base.upper()]
    texts += [" ".join(w) for w in near]
    texts += [prose(rng, 60) + " " + passage + " " + prose(rng, 60) for _ in range(3)]
    texts += [prose(rng, 40) for _ in range(20)]
    texts += ["x" * 20_000, prose(rng, 6000), "a b " * 500, "Café É\u00a0İ \x1c\x85 don't 12,345.67 <|endoftext|> 日本語 🙂"]
    texts += ["mail a.b@c.example.com ip 10.0.0.1 card 4111 1111 1111 1111 call +1 (555) 010-9999 IBAN DE89 3704 0044 0532 0130 00"]
    out = [(i, t, "en", ["b", "a", "c", None][i % 4], len(t or ""), "x", 1, "s", 2, "y") for i, t in enumerate(texts)]
    return [*out, out[5], (None, "no id " + prose(rng, 10), None, None, None, None, None, None, None, None)]


def frame(spark, some=None):
    return spark.createDataFrame(rows() if some is None else some, SCHEMA)
