"""Fixtures that every operator meets: nulls, empty and long texts, ties, repeated rows, clashing extra columns."""

import random

DOCS = "doc_id long, text string, lang string, source string, n_chars long"


def documents(spark, extra=True):
    rng = random.Random(3)
    vocabulary = ["".join(rng.choice("abcdefgh") for _ in range(rng.randint(2, 7))) for _ in range(300)]
    say = lambda n: " ".join(rng.choice(vocabulary) for _ in range(n))
    shared = say(30)
    texts = [say(rng.randint(5, 120)) for _ in range(40)]
    texts += [texts[0], texts[0], texts[1].upper(), texts[2] + " tail", shared + " " + say(40), say(20) + " " + shared, None, "", " \t\n", "one", "née " + say(60), say(6000), "😀" * 30 + shared]
    rows = [(i, t, "en", [None, "s1", "s2", "s0"][i % 4], len(t or "")) for i, t in enumerate(texts)]
    rows.append(rows[5])  # a row that repeats
    df = spark.createDataFrame(rows, DOCS)
    if extra:  # names that operators use inside
        for c in ("id", "size", "cell", "rank", "n", "bucket", "component", "position"):
            df = df.selectExpr("*", f"'x' AS {c}")
    return df, rows


def empty(spark, schema=DOCS):
    return spark.createDataFrame([], schema)
