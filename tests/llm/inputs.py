"""Small documents that hold the awkward cases: nulls, empty and very long texts, ties, repeated rows."""

import random


def documents(spark, rows):
    """(doc_id, text) with extra columns whose names the operators use themselves."""
    full = [(i, t, "en", "src0", None if t is None else len(t), 1, 2, "x", 0.5) for i, t in rows]
    return spark.createDataFrame(full, "doc_id long, text string, lang string, source string, n_chars long, "
                                       "id long, n long, spans string, score double")


def awkward():
    rng = random.Random(4)
    words = [f"w{k}" for k in range(40)]
    passage = [f"p{k}" for k in range(60)]
    rows = [(0, None), (1, ""), (2, " \n\t "), (3, "A"), (4, "one two three four"), (5, "ONE two  three\nfour")]
    rows += [(i, " ".join(rng.choice(words) for _ in range(rng.randint(1, 80)))) for i in range(6, 40)]
    rows += [(i, " ".join(passage[rng.randint(0, 9):60 - rng.randint(0, 9)] + [rng.choice(words) for _ in range(rng.randint(0, 30))]))
             for i in range(40, 70)]
    base = [f"b{k}" for k in range(120)]
    for i in range(70, 110):
        near = list(base)
        for _ in range(rng.randint(0, 4)):
            near[rng.randrange(120)] = rng.choice(words)
        rows.append((i, " ".join(near)))
    rows += [(i, " ".join(base)) for i in range(110, 118)]
    rows += [(118, "a " * 3000 + "mit license"), (119, "x" * 5000), (120, "é" * 3000 + " ñandú 語 😀 " + "1" * 2500)]
    rows += [(5, rows[50][1]), (5, rows[50][1]), (None, rows[45][1]), (None, rows[45][1]), (10, rows[10][1])]
    return rows
