"""Small inputs with everything that may be awkward in them."""

SCHEMA = "doc_id long, text string, lang string, source string, n_chars long, at string, row int, shard int, slot int, key string, score string, label string, id string, name string, size string"

LONG = "lorem ipsum dolor sit amet " * 8_000
UNBROKEN = "x" * 50_000

TEXTS = [
    (0, "The quick brown fox jumps over the lazy dog. It runs.", "s1"),
    (1, None, "s1"),
    (2, "", "s2"),
    (3, " \t\n ", None),
    (4, "the  quick\tbrown fox", "s2"),
    (5, "the quick brown fox", "s1"),
    (5, "the quick brown fox", "s1"),
    (6, LONG, "s1"),
    (7, UNBROKEN, "s3"),
    (8, "日本語 😀 é ▁ <s> <|endoftext|> \x00 end", "é"),
    (None, "no id at all", "s3"),
    (None, "no id at all", None),
    (9, "one", None),
    (10, "The quick brown fox jumps over the lazy dog. It runs.", None),
    (-3, "the quick brown fox", "s1"),
    (11, LONG + "end", ""),
]


def awkward(spark, texts=TEXTS):
    """Documents with nulls, empty and long texts, repeated rows, and columns named like those the operators use."""
    extra = ("?", 1, 2, 3, "k", "high", "l", "i", "n", "big")
    rows = [(i, t, None, s, None if t is None else len(t), *extra) for i, t, s in texts]
    return spark.createDataFrame(rows, SCHEMA)


def none(spark):
    return awkward(spark, [])
