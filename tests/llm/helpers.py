"""Small inputs with the cases every operator must stand."""


LONG = " ".join(f"word{i}" for i in range(30_000))
DOCS = "doc_id long, text string, lang string, source string, n_chars long, score double, fp long, kept string, h int"


def edge_docs(spark):
    """Nulls in every column, empty and very long texts, repeated rows, ties
    and extra columns named like the operators' own."""
    base = "the quick brown fox jumps over the lazy dog near the river bank"
    lines = "\n".join(["alpha beta gamma delta epsilon zeta", "one two three four five six seven",
                       "red green blue white black grey", "north east south west up down"])
    rows = [
        (1, base, "en", "a", len(base), 0.5, 7, "x", 1),
        (2, base, "en", "a", len(base), None, None, None, None),
        (2, base, "en", "a", len(base), None, None, None, None),
        (3, None, None, None, None, None, None, None, None),
        (4, "", "en", "a", 0, 1.0, 1, "y", 2),
        (5, " \t\n ", "en", "a", 4, 1.0, 1, "y", 2),
        (None, "a text without an id " * 4, "en", None, 10, 1.0, 1, "y", 2),
        (6, LONG, "en", "a", len(LONG), 1.0, 1, "y", 2),
        (7, "two words", "en", "a", 9, 1.0, 1, "y", 2),
        (8, "intro of eight\n" + lines + "\nend of eight", "en", "a", 9, 1.0, 1, "y", 2),
        (9, "intro of nine\nmore of nine\n" + lines + "\nend of nine", "en", "a", 9, 1.0, 1, "y", 2),
        (10, "<|endoftext|> Ünïcode ΣΑΣ 漢字 😀 \x85\xa0\x1c x", "en", "a", 9, 1.0, 1, "y", 2),
    ]
    return spark.createDataFrame(rows, DOCS)


def empty_docs(spark):
    return spark.createDataFrame([], DOCS)


def rows(df):
    return [tuple(r) for r in df.collect()]
