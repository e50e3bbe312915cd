"""Rows shared by the tests: nulls, empty and odd texts, a repeated row, ties, a very long text."""

ODD = [
    (None, "no id here"), (1, None), (2, ""), (3, " \t\n "), (4, "one"), (4, "one"), (5, "The same text, twice over and more."),
    (6, "The same text, twice over and more."), (7, "word " * 60_000), (8, "Ünïcödé ñandú 日本語 🤣 <|endoftext|> x"),
    (9, "\x1c\x85\xa0a"),
]
