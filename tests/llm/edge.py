"""Small tables with every irregularity, and brute-force helpers."""

import random
import re

SCHEMA = "doc_id bigint, text string, _id string, _key int, node string, hash int, n_chars bigint"
WORDS = "alpha beta gamma delta epsilon zeta eta theta iota kappa lambda mu nu xi omikron pi rho sigma tau ypsilon".split()


def prose(seed: int, words: int, per_line: int = 12) -> str:
    draw = random.Random(seed)
    drawn = [draw.choice(WORDS) + str(draw.randrange(400)) for _ in range(words)]
    return "\n".join(" ".join(drawn[i : i + per_line]) for i in range(0, words, per_line))


SHARED = "This very line is shared by a great many documents, word for word."


def texts() -> list[tuple[int | None, str | None]]:
    """(doc_id, text): empty, NULL, blank, copies, near copies, long, repeated rows and ids."""
    long = prose(1, 4000)
    rows: list[tuple[int | None, str | None]] = [(0, ""), (1, None), (2, " \t\n\x0b \n"), (3, long), (4, prose(2, 300))]
    rows += [(10 + i, prose(3, 200)) for i in range(8)]
    near = prose(4, 400).split(" ")
    for i in range(6):
        rows.append((20 + i, " ".join(w if j != 37 * (i + 1) else "changed" for j, w in enumerate(near))))
    rows += [(30 + i, f"{prose(40 + i, 90)}\n  {SHARED.upper() if i % 2 else SHARED}\t\n{prose(60 + i, 60)}") for i in range(9)]
    rows += [(50, "One two.\nOne two.\nthree"), (50, "One two.\nOne two.\nthree"), (51, prose(7, 80)), (51, prose(8, 80))]
    rows += [(None, prose(9, 70)), (None, f"x\n{SHARED}"), (-5, "É è ß ﬁ \U0001f600 ñ " * 30), (60, "a " * 200)]
    return rows


def frame(spark, rows, schema=SCHEMA):
    return spark.createDataFrame([(i, t, "clash", 1, "n", 2, None if t is None else len(t)) for i, t in rows], schema)


def lower(text: str) -> str:
    return re.sub("[A-Z]", lambda m: m[0].lower(), text)
