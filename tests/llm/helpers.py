"""Small frames with every hard case: nulls in all columns, empty and long texts, ties, repeated rows, clashing names."""

import random

WORDS = [f"{a}{b}" for a in ("ba", "do", "ki", "lu", "ne", "sor", "tam", "vex") for b in ("", "n", "ra", "st", "ing", "é")]


def prose(seed: int, n: int) -> str:
    r = random.Random(seed)
    out = []
    while len(out) < n:
        s = [r.choice(WORDS) for _ in range(r.randint(5, 14))]
        out += [s[0].capitalize(), *s[1:-1], s[-1] + "."]
    return " ".join(out[:n])


def edited(text: str, seed: int, changes: int) -> str:
    r, w = random.Random(seed), text.split(" ")
    for _ in range(changes):
        w[r.randrange(len(w))] = f"edit{r.randrange(10**6)}"
    return " ".join(w)


def documents(spark, rows):
    """(doc_id, text) rows with the other columns, and some whose names the operators use themselves."""
    full = [(i, t, "en", "src", None if t is None else len(t), "x", 1, 2, 3.0) for i, t in rows]
    return spark.createDataFrame(full, "doc_id long, text string, lang string, source string, n_chars long, score string, "
                                       "dedup int, row int, stats double")


BASE = prose(1, 300)
HARD = [
    (1, BASE), (2, BASE), (2, BASE), (3, edited(BASE, 5, 2)), (4, prose(4, 280)), (5, None), (6, ""), (7, " \n\t "), (None, prose(8, 40)),
    (None, None), (9, prose(9, 6000)), (10, "one"), (11, "One\none two\n" + prose(4, 280)), (12, prose(12, 90) + "\n" + prose(13, 60)),
    (13, "  Tabs\tand  spaces ﷽ 你好 🙂 don't!!  \r\n"), (14, prose(13, 60) + "\n" + prose(14, 90)),
]
