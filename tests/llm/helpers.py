"""Small inputs that every operator must take."""

import random

SMALL = "/root/testdata/sf0.001"

LONG = " ".join(random.Random(3).choice("alpha beta gamma delta epsilon zeta eta theta".split()) + str(i % 997) for i in range(6000))
PASSAGE = " ".join(f"shared{i}" for i in range(60))

#: (doc_id, text): null and empty and blank texts, a null id, a repeated row, copies, near copies, a very long text.
EDGE = [
    (0, None), (1, ""), (2, " \t\n "), (None, "a row without an id"), (3, "one"), (4, "Two words"), (4, "Two words"),
    (5, "Two\twords"), (6, "two words"), (7, LONG), (8, LONG + " tail"), (9, PASSAGE), (10, "before it " + PASSAGE + " after it"),
    (11, PASSAGE + " " + PASSAGE), (12, "é ü ß ÇA 🙂 汉字 x\u00a0y \x1c z"), (13, "a a a a a " * 20), (14, "a a a a a " * 21),
]
COLUMNS = "doc_id long, text string, score string, kept string, shard string, n_words string, length string, n string, host string"


def edge_docs(spark, rows=EDGE):
    """The rows with columns that have names like the operators' results."""
    return spark.createDataFrame([(*r, "s", "k", "h", "w", "l", "n", "x") for r in rows], COLUMNS)


def empty_docs(spark):
    return spark.createDataFrame([], COLUMNS)


def documents(spark):
    return spark.read.parquet(f"{SMALL}/documents.parquet")


def texts(spark):
    return [(r["doc_id"], r["text"]) for r in documents(spark).select("doc_id", "text").collect()]
