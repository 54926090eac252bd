"""Rows with nulls, ties, repeats and odd texts."""


def doc_rows():
    """Nulls in every column, empty and odd texts, ties and repeated rows."""
    words = "the quick brown fox jumps over the lazy dog and runs away from all of them again "
    base = [
        (1, words * 4, "en", "b"), (2, words * 4, "en", "b"), (3, None, "en", "a"), (4, "", None, "a"),
        (5, "   \n\t ", "de", None), (6, "one", "de", "c"), (7, "one", "de", "c"), (None, words, "en", "b"),
        (None, None, None, None), (8, "das ist ein kurzer satz und noch einer dazu " * 3, "de", "c"),
        (9, "das ist ein kurzer satz und noch einer dazu " * 3 + "ende", "de", "c"), (9, "doppelte nummer", "de", "c"),
        (10, "x" * 5000, None, "d"), (11, "123 456 !!! ???", None, "d"), (12, "Ünïcödé \U0001f600 ß é́", "fr", "d"),
        (13, words * 400, "en", "b"), (13, words * 400, "en", "b"), (14, "call +1 (555) 555-0100 or a@b.example", "en", "b"),
    ]
    return [(i, t, g, s, None if t is None else len(t)) for i, t, g, s in base]
