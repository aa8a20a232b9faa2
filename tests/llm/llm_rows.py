"""Rows that the operators must bear."""

FOLDER = "/root/testdata/sf0.001"
WORDS = "the of and to in is that for it as was with be by on not he his but at are this have from or had an they which one you were her all she".split()


def prose(seed, count):
    """Repeatable text of ``count`` words."""
    state, out = seed + 1, []
    for k in range(count):
        state = (state * 1103515245 + 12345) % 2**31
        out.append(WORDS[state // 65536 % len(WORDS)] + (str(state // 7 % 9) if state % 3 == 0 else ""))
    return " ".join(out)


LONG = prose(99, 60_000)
# Nulls in any column, empty and blank texts, very long ones, ties and repeated rows.
ROWS = [
    (1, prose(1, 120), "en", "a"), (1, prose(1, 120), "en", "a"), (2, prose(1, 120).upper(), None, "b"), (None, prose(5, 80), "de", None),
    (None, prose(5, 80), "de", None), (3, None, "en", "a"), (4, "", None, "b"), (5, " \n\t ", "en", None), (6, LONG, "en", "a"),
    (7, "x" * 70_000, "de", "b"), (8, "one two", "en", "c"), (9, "ONE  two", "en", "c"), (10, "1234 5678 !!! ###", None, "c"),
    (1, "another text under a known id", "en", "b"), (11, "été señor 日本語 🙂 x  y <|endoftext|> z", "de", "c"),
    (12, "write to a.b@mail.example.com or +1 (523) 555-1055 or 10.0.0.1", "en", "c"),
]
SCHEMA = "doc_id long, text string, lang string, source string"
# Names that the operators use inside.
CLASHING = ["size", "code", "node", "key", "row", "base", "candidates", "times", "n", "ids", "whole", "_letters", "component", "score"]
