"""Small tables for the corpus tests."""

SCHEMA = "doc_id long, text string, lang string, source string, n_chars long"


def docs(spark, rows, extra=()):
    """Documents from ``(doc_id, text)`` or ``(doc_id, text, lang)``, with further columns of clashing names."""
    full = [(r[0], r[1], r[2] if len(r) > 2 else "en", "src", len(r[1] or ""), *["x"] * len(extra)) for r in rows]
    return spark.createDataFrame(full, ", ".join([SCHEMA, *(f"`{c}` string" for c in extra)]))


def rows_of(df):
    """Rows as tuples, sorted."""
    return sorted(map(tuple, df.collect()), key=repr)


#: Null ids and texts, empty and wordless texts, repeated rows, ties, and a very long text.
ODD = [(1, None), (2, ""), (3, " \n\t"), (4, "one"), (4, "one"), (None, "one"), (5, None), (6, "é ß 日本 😀"),
       (7, "word " * 60_000), (None, None), (8, "A b"), (9, "a  B\n")]
EXTRA = ("_id", "_th", "h", "fp", "f", "ids", "score", "row", "_text", "gone", "lid", "blocks", "words", "root", "node")
