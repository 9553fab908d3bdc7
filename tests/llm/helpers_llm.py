"""DuckDB beside Spark on small frames."""

import duckdb


def oracle_rows(sql, **frames):
    """Rows of ``sql`` over pandas frames registered by name."""
    con = duckdb.connect()
    for name, frame in frames.items():
        con.register(name, frame)
    return con.sql(sql).fetchall()


def sorted_rows(rows):
    return sorted((tuple(r) for r in rows), key=str)


def odd_documents(spark):
    """Nulls in every column, empty and long texts, repeated rows, clashing names."""
    long_text = "lorem ipsum " * 30_000
    rows = [
        (1, "one two three\none two three\nfour", "en", "a", 3, "x"), (2, None, "en", None, None, None),
        (3, "", None, "a", 0, "x"), (3, "", None, "a", 0, "x"), (None, "Some words of a text without id.", "de", "b", 1, "x"),
        (4, " \t\n ", "fr", "b", 1, "x"), (5, long_text, None, None, 1, "x"), (6, "ñandú Ünïcode 🙂 text\r\nnext", "es", "b", 2, None),
        (7, "a b c a b c a b c", "en", "a", 2, "x"),
    ]
    return spark.createDataFrame(rows, "doc_id long, text string, lang string, source string, n_chars long, n_words string")
