"""Rows that operators must not trip over."""

# Nulls, empty and blank texts, a long line, ties, repeated rows, a row without id.
ODD = [
    (0, None), (1, ""), (2, " \t\n"), (3, "a b c"), (4, "word " * 3000), (5, "Same line here\nown 5"),
    (6, "same LINE here \nown 6"), (7, "one two three four five six"), (7, "one two three four five six"),
    (8, "one two three four five six", None), (None, "no id at all here"), (9, "é ü 漢字   x"),
]
