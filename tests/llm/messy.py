"""Small tables with the cases that real ones hold, and brute-force versions of operators."""

import random

EXTRA = "lang string, source string, n_chars long, key string, start long, n int, words string, row_key string, score string"
SCHEMA = f"doc_id long, text string, {EXTRA}"


def prose(seed: int, n: int) -> list[str]:
    drawn = random.Random(seed)
    return [drawn.choice("ba be bi bo bu da de di do du ka ke ki ko ku".split()) + drawn.choice(["", "na", "ra", "Ta"]) for _ in range(n)]


def texts() -> list[tuple]:
    """``(doc_id, text)`` rows: shared passages, copies, near copies, edges."""
    base = [" ".join(prose(i, 30 + 11 * i)) for i in range(12)]
    passage = " ".join(prose(99, 40))
    lines = "\n".join(" ".join(prose(200 + i, 6)) for i in range(9))
    rows = [(10 + i, t) for i, t in enumerate(base)]
    rows += [(100, base[3]), (101, base[3]), (102, base[3] + " tail"), (103, base[9].replace("ba", "bb", 1))]
    rows += [(110 + i, f"{base[i]} {passage} {base[i + 1]}") for i in range(4)]
    rows += [(120, lines), (121, "first\n" + lines), (122, "  \n\n" + lines + "\n"), (123, lines + "\nlast line")]
    rows += [(130, ""), (131, None), (132, "   "), (133, "one"), (134, "one"), (135, "\n\n"), (136, "a b")]
    rows += [(140, "word " * 3000), (141, "word " * 120), (142, "é ß Ünï " * 40), (143, " ".join(prose(7, 6000)))]
    rows += [(150, base[5]), (150, base[5]), (150, base[6]), (None, base[7]), (None, None), (None, base[7])]
    return rows


def documents(spark, rows=None):
    rows = texts() if rows is None else rows
    return spark.createDataFrame([(i, t, "en", None, 1, "k", 7, 3, "w", "r", None) for i, t in rows], SCHEMA)
