"""Small tables with every edge case the operators name."""

import random

WORDS = "the a of stone river north engine copper light seven window under quiet paper signal".split()


def words(rng, n):
    return " ".join(rng.choice(WORDS) + str(rng.randrange(60)) for _ in range(n))


def near_copy(rng, text, edits):
    parts = text.split(" ")
    for _ in range(edits):
        parts[rng.randrange(len(parts))] = "edit" + str(rng.randrange(10 ** 6))
    return " ".join(parts)


def documents(seed=1, n=120):
    """(doc_id, text, lang, source): copies, near copies, a shared passage,
    nulls, empties, repeated rows, a very long text."""
    rng = random.Random(seed)
    rows, passage = [], words(rng, 60)
    for i in range(n):
        text = words(rng, rng.choice([1, 3, 5, 6, 30, 80, 200]))
        if i % 7 == 0 and rows:
            text = near_copy(rng, rng.choice(rows)[1] or "x", 1)
        if i % 11 == 0 and rows:
            text = (rng.choice(rows)[1] or "").replace(" ", "\n", 1) + " "
        if i % 5 == 0:
            text = text + "\n" + passage
        rows.append((i * 3 + 1, text, rng.choice(["en", "de", None]), rng.choice(["s0", "s0", "s0", "s1", "é", None])))
    rows += [(1000, None, "en", "s0"), (1001, "", None, "s1"), (1002, " \t\n", "de", None), (1003, None, None, None),
             (1004, words(rng, 20_000), "en", "s0"), (1005, "x" * 50_000, "en", "s0"),
             (None, words(rng, 9), "en", "s1"), rows[3], rows[3], rows[8]]
    return rows


SCHEMA = "doc_id long, text string, lang string, source string"
EMPTY: list = []


def frame(spark, rows, schema=SCHEMA):
    return spark.createDataFrame(rows, schema).repartition(4)


def clashing(df):
    """The table with extra columns named like those the operators add."""
    from pyspark.sql import functions as F
    return df.withColumns({c: F.lit(7) for c in (
        "text_sha256", "keep_id", "kept", "size", "target", "taken", "n", "v", "key", "score", "_h", "_doc", "_id", "_maybe",
        "next", "n_tokens", "token_ids", "_source", "copies", "component_id", "x y", "a.b")})
