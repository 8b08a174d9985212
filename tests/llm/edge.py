"""Documents with every awkward case: nulls in all columns, empty and very long texts,
repeated rows, equal texts under several ids, and columns with clashing names."""

SCHEMA = "doc_id long, text string, lang string, source string, n_chars long, size int, node string, score string, start string, h string, _row int, piece string"


def edge_rows():
    long_text = " ".join(f"word{i % 997}x{i}" for i in range(9000)) + "\nYou are an idiot! Ring +1 (988) 555-2485."
    texts = [
        (1, "The quick brown fox jumps over the lazy dog and runs away into the wood.", "en", "a"),
        (1, "The quick brown fox jumps over the lazy dog and runs away into the wood.", "en", "a"),
        (2, None, None, None),
        (None, "A text without an id, that is still a text to be read and counted.", "en", None),
        (None, None, "en", "b"),
        (3, "", "en", "b"),
        (4, "   \n\t ", "fr", "b"),
        (5, long_text, "en", "a"),
        (6, long_text, "en", "c"),
        (7, "12345 67890 !!!", None, "c"),
        (8, "Élan äöü ñandú — 日本語 \U0001f600 naïve", "fr", "c"),
        (9, "one", "en", "a"),
        (10, "<|endoftext|> mail a.b@c.de now", "en", "a"),
        (11, "The quick brown fox jumps over the lazy dog and runs away into the wood.", "en", "b"),
    ]
    return [(i, t, lang, s, None if t is None else len(t), 1, "n", "s", "b", "h", 3, "p") for i, t, lang, s in texts]


def edge_docs(spark):
    return spark.createDataFrame(edge_rows(), SCHEMA).repartition(3)
