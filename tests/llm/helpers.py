"""Rows that every operator has to survive."""

import random

WORDS = "the quick brown fox jumps over a lazy dog while seven wizards quietly box up five dozen jugs Ñandú über".split()


def prose(seed, n):
    r = random.Random(seed)
    return " ".join(r.choice(WORDS) + r.choice(["", "", "", ".", ","]) for _ in range(n))


def odd_rows():
    """(doc_id, text): nulls, empty and very long texts, ties, repeated rows."""
    base = prose(1, 80)
    rows = [(1, base), (2, base), (2, base), (3, None), (4, ""), (5, "  \n\t "), (6, "one two"), (None, base),
            (None, None), (7, prose(2, 30_000)), (8, "x " * 5_000), (9, base + " tail"), (10, "a\n\n\nb\n"),
            (-5, prose(3, 40)), (11, prose(3, 40) + " and more"), (12, "\x0b\x0c é ñ <|endoftext|> İstanbul ΟΔΟΣ ﬁ ½ Ⅷ 日本")]
    return rows + [(100 + i, prose(50 + i % 7, 20) + f"\nshared line number {i}\nAll the same line here") for i in range(40)]


def frame(spark, rows, parts=3):
    """Documents with extra columns whose names clash with those the operators use."""
    full = [(i, t, "en", "s", 0, "k", 1.0, i, [1]) for i, t in rows]
    kind = ("doc_id long, text string, lang string, source string, n_chars long, key string, score double, "
            "component_id long, hit_words array<int>")
    return spark.createDataFrame(full, kind).repartition(parts)


def empty(spark):
    return frame(spark, [], 1)
