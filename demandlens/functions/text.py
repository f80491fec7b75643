"""Tokens and phrase keys. Text and taxonomy go through the same tokeniser."""

from pyspark.sql import functions as F

# A word keeps inner "&" and ".x" (R&D, Node.js) and a trailing "++" or "#"
# (C++, C#); every other non-blank character is a token of its own. Unicode
# classes keep "R" from matching inside a longer accented word. All repeats are
# possessive: what follows never needs to step back, and Java then iterates
# instead of recursing, so a very long dotted chain cannot overflow the stack.
_WORD = r"[\p{L}\p{M}\p{N}_]"
TOKEN_PATTERN = rf"{_WORD}++(?:(?:&{_WORD}|\.\p{{Ll}}){_WORD}*+)*+(?:\+\+|#)?+|\S"


def tokens(text):
    """All tokens of the whole text; null gives an empty list."""
    return F.regexp_extract_all(F.coalesce(text, F.lit("")), F.lit(TOKEN_PATTERN), F.lit(0))


def phrase_key(text):
    """Tokens of a phrase, joined by one blank, case kept."""
    return F.array_join(tokens(text), " ")
