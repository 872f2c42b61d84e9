"""Text expressions shared by rules and data."""

from __future__ import annotations

import string
import unicodedata
from functools import lru_cache

from pyspark.sql import Column
from pyspark.sql import functions as F

# Combining marks the tokenizer drops after a letter.
DROPPED_MARKS = (
    "̀́̂̃̄̆̇̈̉̊̋̌̏"
    "̧̨̛̣̤̥̦̭̮̰̱̑"
)
# Letter variants the tokenizer folds besides Latin diacritics.
LETTER_VARIANTS = {
    "µ": "μ", "ſ": "s", "ẛ": "s", "ς": "σ", "ϐ": "β", "ϑ": "θ", "ϕ": "φ",
    "ϖ": "π", "ϰ": "κ", "ϱ": "ρ", "ϵ": "ε", "ι": "ι",
}

TOKEN_PATTERN = r"[\p{L}\p{N}\p{Co}]+"
#: Opens every padded token text, so that "first token" is a containment too.
START = "^"


@lru_cache(maxsize=1)
def fold_map() -> tuple[str, str]:
    """``translate`` arguments that fold lower-case letters and drop marks.

    A letter folds when it decomposes into one ASCII letter and one mark, so
    Cyrillic and accented Greek letters stay as they are.
    """
    source, target = [], []
    for code in range(0x80, 0x2000):
        letter = chr(code)
        parts = unicodedata.normalize("NFD", letter)
        if letter == letter.lower() and len(parts) == 2 and parts[0].isascii() and parts[0].isalpha():
            source.append(letter)
            target.append(parts[0])
    source.extend(LETTER_VARIANTS)
    target.extend(LETTER_VARIANTS.values())
    # characters of `source` beyond the length of `target` are removed
    return "".join(source) + DROPPED_MARKS, "".join(target)


def ascii_upper(value: Column) -> Column:
    """Upper-case a-z only; other letters keep their case."""
    return F.translate(value, string.ascii_lowercase, string.ascii_uppercase)


def fold_case(value: Column, case: str) -> Column:
    return F.upper(value) if case == "unicode" else ascii_upper(value)


def tokens(value: Column) -> Column:
    """Lower-cased, diacritic-folded runs of letters and digits."""
    folded = F.translate(F.lower(value), *fold_map())
    return F.regexp_extract_all(folded, F.lit(TOKEN_PATTERN), F.lit(0))


def pad_tokens(words: Column) -> Column:
    """``^ a b c ``: a phrase ``' b c '`` occurs in a text iff it is contained."""
    return F.concat(F.lit(START + " "), F.array_join(words, " "), F.lit(" "))


def grams(value: Column, size: Column) -> Column:
    """All distinct character runs of one length."""
    every_run = F.concat(F.lit("(?s)(?=(.{"), size.cast("string"), F.lit("}))"))
    return F.array_distinct(F.regexp_extract_all(value, every_run, F.lit(1)))


def like_literal(pattern: Column) -> Column:
    """A LIKE pattern without an escape character, for Spark's LIKE (escape ``\\``)."""
    return F.replace(pattern, F.lit("\\"), F.lit("\\\\"))
