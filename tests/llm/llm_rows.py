"""Odd documents that every operator must take, with columns whose names clash with its own."""

ODD = [
    (1, None), (2, ""), (3, " \t\n"), (4, "one"), (5, "one"), (6, "ONE"), (7, "a b c d e f"), (7, "a b c d e f"), (None, "a b c d e f"), (None, None),
    (8, "x" * 50_000), (9, "x" * 50_000), (10, "é" * 300), (11, "w " * 30_000),
]


def frame(spark, rows):
    """Documents with extra columns whose names the operators use themselves."""
    wide = [(d, t, "en", "s", 0, 1, "k", [1], "p") for d, t in rows]
    return spark.createDataFrame(
        wide, "doc_id long, text string, lang string, source string, n_chars long, kept int, key string, parts array<int>, component_id string"
    )
