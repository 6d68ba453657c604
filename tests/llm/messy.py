"""Small documents with every awkward case: nulls, empty and long texts, ties, repeated rows and
columns named like results."""

SCHEMA = ("doc_id long, text string, lang string, source string, n_chars long, size long, kept string, "
          "score string, fingerprint string, n_lines long, n_bytes string")
LONG = "A long sentence that goes on and on. " * 4000


def documents(spark):
    rows = [
        (1, "One line here.\nShared line.\nAnother line.", "a"),
        (2, None, "a"), (3, "", "b"), (4, " \t\n \n", None), (5, LONG, "b"),
        (6, "One line here.\nShared line.\nAnother line.", "a"),
        (6, "One line here.\nShared line.\nAnother line.", "a"),
        (7, "same id, first text with words", "c"), (7, "same id, second text with words", "c"),
        (None, "a row without an id and a few words", "c"), (None, None, None),
        (8, "Été <|endoftext|> \u0000 \U0001f600 café x", "é"),
        (9, "SHARED LINE.  \nend", "a"),
    ]
    return spark.createDataFrame(
        [(i, t, "en", s, None, 5, "x", "y", "z", 3, "q") for i, t, s in rows], SCHEMA)


def empty(spark):
    return spark.createDataFrame([], SCHEMA)
