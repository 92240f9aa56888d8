"""Small tables with the cases every operator must bear."""

import random

DOCUMENTS = "doc_id long, text string, lang string, source string, n_chars long"
# Names that operators use for columns of their own.
CLASHING = ["_row", "ids", "n_tokens", "score", "size", "taken", "_stats", "_whole", "component_id", "shard", "rank", "_part", "_sig"]


def words(seed: int, n: int) -> str:
    r = random.Random(seed)
    return " ".join("".join(r.choice("abcdefghij") for _ in range(r.randint(1, 6))) for _ in range(n))


def rows():
    near = words(5, 200).split()
    texts = [
        (1, "Hello there, it's a  test.\n\n Two   blanks "), (2, None), (3, ""), (4, "  \t\n "), (5, "one"), (6, "one two"),
        (7, "Straße ünïcode 日本語 العربية 🎉 é <|endoftext|> x <|endoftext|>"), (8, "a" * 3000 + " b"), (9, " " * 500 + "x" + "\n" * 300),
        (10, words(1, 4000)), (11, words(1, 4000)), (12, words(2, 4000) + " end"),
        (13, " ".join(near)), (14, " ".join(near[:100] + ["changed"] + near[101:])), (15, " ".join(near).upper()),
        (16, words(3, 300)), (16, words(3, 300)), (None, words(4, 50)), (None, None), (17, "don't I'll we've 12345 67 !!! ??\x1c \x85 end"),
    ]
    return [(i, t, "en", None if k % 5 == 4 else f"s{k % 3}", len(t or "")) for k, (i, t) in enumerate(texts)]


def documents(spark, data=None):
    return spark.createDataFrame(rows() if data is None else data, DOCUMENTS)


def clashing(df):
    from pyspark.sql import functions as F

    return df.withColumns({name: F.lit("clash") for name in CLASHING if name not in df.columns})
