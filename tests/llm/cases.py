"""Rows that every operator has to cope with."""

LONG = "long word soup " * 20_000 + "x" * 50_000

#: doc_id, text, lang, source, n_chars, and columns whose names operators use themselves
SCHEMA = ("doc_id long, text string, lang string, source string, n_chars long, key string, kept string, digest int, shard string, "
          "score string, spans int, ids string, hash string, `a.b` string, __text int, id string, label string, item int, hits string, page long, "
          "c0 string, c1 int, h string, words string, a int, b string, n string, sha string, copies int, chunk string, runs string, best int")


def docs(spark, texts, ids=None):
    ids = range(len(texts)) if ids is None else ids
    rows = [(i, t, None, None, None, "k", None, 3, "s", None, 1, None, "h", "dot", 5, "i", "l", 6, "h", 7, "c", 8,
             "h", "w", 9, "b", "n", "s", 10, "c", "r", 11) for i, t in zip(ids, texts, strict=True)]
    return spark.createDataFrame(rows, SCHEMA)


ODD = [None, "", " ", "\n\t", "a", "A", "Same Text here", "same text HERE", "same text here", "é\U0001F600 ü ß", LONG, LONG, "\x00 nul \x1c",
       "one two", "one two three", "<|endoftext|> x"]
