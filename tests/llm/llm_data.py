"""Small document tables with the awkward cases of the operators' docstrings."""

import random

from pyspark.sql.types import DoubleType, LongType, StringType, StructField, StructType

SCHEMA = StructType([
    StructField("doc_id", LongType()), StructField("text", StringType()), StructField("lang", StringType()), StructField("source", StringType()), StructField("n_chars", LongType()),
    # extra columns whose names the operators use inside
    *(StructField(c, StringType()) for c in ("id", "th", "node", "key", "comp", "core", "item", "spans", "i", "t", "n", "row")),
    StructField("score", DoubleType()),
])


def word(rng):
    return "".join(rng.choice(["an", "er", "th", "in", "ou", "re", "st", "é", "ß"]) for _ in range(rng.randint(1, 4)))


def prose(rng, n):
    return " ".join(word(rng) + ("." if rng.random() < 0.1 else "") for _ in range(n)).replace(". ", ".\n", 2)


def texts(seed=1, n=60):
    rng = random.Random(seed)
    out = [prose(rng, rng.randint(1, 160)) for _ in range(n)]
    out += [out[0], out[0], out[1].upper(), out[2] + " tail word", "", "   ", "\n\t\n", "one", "one two three", "a" * 900, "ab " * 700,
            "Hello <|endoftext|> it's ½ Ǆ ΣΑΣ é 日本語 😀 \x1c▁ x", prose(rng, 5000), None, None]
    near = out[3].split(" ")
    for k in range(6):
        copy = list(near)
        if len(copy) > 20:
            copy[rng.randrange(len(copy))] = "changed"
        out.append(" ".join(copy))
    return out


def documents(spark, rows=None, seed=1):
    """Ids repeat once and are null once; languages and sources may be null."""
    if rows is None:
        own = texts(seed)
        rows = [(i, t) for i, t in enumerate(own)] + [(0, own[0]), (None, own[5]), (None, None)]
    data = [(i, t, None if k % 7 == 3 else ["en", "fr"][k % 2], None if k % 11 == 5 else "src0", len(t or ""), *["x"] * 12, 0.5) for k, (i, t) in enumerate(rows)]
    return spark.createDataFrame(data, SCHEMA)


def empty(spark):
    return spark.createDataFrame([], SCHEMA)
