"""Shared pieces of the tests of the document operators."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

DOCS = "doc_id long, text string, lang string, source string, n_chars long"

# Null, empty, blank and markless texts; repeated rows and repeated ids; a very long text; characters beyond ASCII and Latin-1.
ODD_TEXTS = [
    (1, None), (2, ""), (3, " \n\t "), (4, "..."), (5, "one two three four five six seven eight nine ten eleven twelve"),
    (6, "one two three four five six seven eight nine ten eleven twelve"), (6, "one two three four five six seven eight nine ten eleven twelve"),
    (7, "ONE two three four five six seven eight nine ten eleven twelve"), (8, "漢字 é \U0001F600 don't <|endoftext|> ﬁ  x"),
    (9, "lorem ipsum " * 60_000), (None, "a text without an id but with enough words to make shingles"), (10, "one"),
]


def documents(spark: SparkSession, rows: list[tuple]) -> DataFrame:
    """``documents`` with columns that clash with the operators' own names."""
    full = [(i, t, "en" if t else None, "s", None) for i, t in rows]
    df = spark.createDataFrame(full, DOCS)
    for name in ("score", "part", "id", "set_key", "bands", "path", "size", "shard", "slot", "label", "features", "n_words"):
        df = df.withColumn(name, F.lit("x"))
    return df


def brute_groups(rows: list[tuple], width: int) -> dict[int, int]:
    sets = {}
    for i, text in rows:
        w = text.lower().split()
        sets[i] = {tuple(w[k:k + width]) for k in range(len(w) - width + 1)} or {tuple(w)}
    root = {i: i for i, _ in rows}

    def find(x):
        while root[x] != x:
            x = root[x]
        return x

    for a in sets:
        for b in sets:
            if a < b and 100 * len(sets[a] & sets[b]) >= 80 * len(sets[a] | sets[b]):
                p, q = find(a), find(b)
                root[max(p, q)] = min(p, q)
    return {i: find(i) for i in sets}
