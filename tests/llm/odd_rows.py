"""Rows that every operator must take."""

#: Null, empty, blank and very long texts, and ties; the `odd` fixture adds columns named like the operators' own.
ODD = [
    (1, None),
    (2, ""),
    (3, " \n\t "),
    (4, "one"),
    (5, "ä ö ü " * 120),
    (6, "ä ö ü " * 120),
    (7, "same words again and again. " * 300),
    (8, "x" * 5_000),
    (9, "Plain text with a few words, nothing else in it."),
    (10, "Plain text with a few words, nothing else in it."),
]
