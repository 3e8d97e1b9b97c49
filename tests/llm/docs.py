"""Small tables with the cases every operator has to settle."""

from __future__ import annotations

import random

SCHEMA = "doc_id long, text string, lang string, source string, n_chars long"
# Columns an operator might use inside; they must neither break it nor change.
CLASHING = ("id", "content", "key", "n", "row", "tokens", "pack", "name", "token")

WORDS = "the of and stone river glass north paper winter table green hollow candle".split()


def prose(seed: int, n: int) -> str:
    rng = random.Random(seed)
    return " ".join(rng.choice(WORDS) + str(rng.randrange(40)) for _ in range(n))


def rows() -> list[tuple]:
    base = prose(1, 120)
    near = base.replace(base.split()[60], "changed", 1)
    texts = [
        base,
        base,  # an exact copy
        near,
        None,
        "",
        " \t\n ",
        "one",
        "One two",
        "one TWO",
        prose(2, 60) + " " + " ".join(base.split()[:50]),
        prose(3, 20_000),  # very long
        "x" * 5_000,
        "naïve café — 東京   end　.",
        prose(4, 80) + "\n" + prose(4, 80),
    ]
    made = [(i, text, "en", f"src{i % 3}", len(text or "")) for i, text in enumerate(texts)]
    made.append(made[0])  # a row twice
    made.append((None, "a row without an id", None, None, None))
    return made


def table(spark, kept=None, extra: bool = True):
    df = spark.createDataFrame(rows() if kept is None else kept, SCHEMA)
    if extra:
        df = df.selectExpr("*", *(f"'x' AS {name}" for name in CLASHING))
    return df


def texts(kept=None) -> list[tuple]:
    """(doc_id, text) with null as empty."""
    return [(row[0], row[1] or "") for row in (rows() if kept is None else kept)]
