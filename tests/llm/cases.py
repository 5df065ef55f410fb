"""Small documents with the hard cases: nulls, empty and long texts, copies, ties."""

import random

WORDS = "the of and to alpha beta gamma delta kappa omega red green blue one two three four five".split()


def prose(rng, n):
    return " ".join(rng.choice(WORDS) + rng.choice(["", "", "", "s", "ed"]) for _ in range(n))


def documents(seed=1, n=60):
    rng = random.Random(seed)
    rows, passage = [], prose(rng, 120)
    for i in range(n):
        text = prose(rng, rng.randint(1, 150))
        if i % 4 == 1:
            text += " " + " ".join(passage.split()[rng.randint(0, 40):rng.randint(60, 120)])
        if i % 5 == 2 and rows:
            text = rows[rng.randrange(len(rows))][1] or ""
        if i % 5 == 3 and rows:
            w = (rows[rng.randrange(len(rows))][1] or "x").split()
            w[rng.randrange(len(w))] = "changed"
            text = " ".join(w)
        if i % 9 == 4:
            text = text.upper().replace(" ", "\t\n")
        rows.append((i, text))
    rows += [(100, None), (101, ""), (102, " \n\t "), (103, "one"), (104, "one"), (105, "a b c d"),
             (106, "a b c d e"), (107, "a b c d e f"), (108, "A b c d e"), (109, "ab" * 400),
             (110, "é " * 300), (111, "x" * 1500), (112, prose(rng, 6000)), (113, "a b " * 400)]
    return rows


SCHEMA = "doc_id long, text string"


def frame(spark, rows, parts=3):
    """Rows as a frame with more columns, among them names the operators use themselves."""
    df = spark.createDataFrame(rows, SCHEMA).repartition(parts)
    return df.selectExpr("doc_id", "text", "'x' as node", "1 as size", "2 as key", "'r' as `row`",
                         "3 as w", "'k' as kept", "4 as rid", "5 as found", "6 as block", "7 as spans",
                         "'en' as lang")
