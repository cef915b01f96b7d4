"""Scalar text functions, all JVM-side expressions
except :func:`fold_to_ascii`, which needs Unicode decomposition."""

from __future__ import annotations

import re
import unicodedata
from collections.abc import Sequence

import pandas as pd
from pyspark.sql import Column
from pyspark.sql import functions as F
from pyspark.sql import types as T

# ASCII punctuation (Python ``string.punctuation``), in order.
PUNCTUATION = "!\"#$%&'()*+,-./:;<=>?@[\\]^_`{|}~"

# English stop words (the NLTK list the reference filters with), in order.
STOP_WORDS = (
    "i me my myself we our ours ourselves you you're you've you'll you'd your yours yourself "
    "yourselves he him his himself she she's her hers herself it it's its itself they them "
    "their theirs themselves what which who whom this that that'll these those am is are was "
    "were be been being have has had having do does did doing a an the and but if or because "
    "as until while of at by for with about against between into through during before after "
    "above below to from up down in out on off over under again further then once here there "
    "when where why how all any both each few more most other some such no nor not only own "
    "same so than too very s t can will just don don't should should've now d ll m o re ve y "
    "ain aren aren't couldn couldn't didn didn't doesn doesn't hadn hadn't hasn hasn't haven "
    "haven't isn isn't ma mightn mightn't mustn mustn't needn needn't shan shan't shouldn "
    "shouldn't wasn wasn't weren weren't won won't wouldn wouldn't"
).split()

# Characters a folded name may keep (ASCII letters and " .,;'").
ALLOWED_LETTERS = "abcdefghijklmnopqrstuvwxyzABCDEFGHIJKLMNOPQRSTUVWXYZ .,;'"

# The basic English tokenizer's substitutions, applied in order
# after lower-casing (pattern, replacement).
BASIC_TOKEN_RULES = (
    ("'", " '  "),
    ('"', ""),
    (r"\.", " . "),
    (r"<br />", " "),
    (",", " , "),
    (r"\(", " ( "),
    (r"\)", " ) "),
    ("!", " ! "),
    (r"\?", " ? "),
    (";", " "),
    (":", " "),
    (r"\s+", " "),
)

#: patterns that stand for one fixed string
LITERAL = re.compile(r"""(?:[\w '"<>/,!;:]|\\\W)+""")

WHITESPACE = "[ \\t\\n\\r\\f]+"


def _c(col: str | Column) -> Column:
    return F.col(col) if isinstance(col, str) else col


def strip_punctuation(col: str | Column) -> Column:
    """delete every ASCII punctuation character."""
    return F.translate(_c(col), PUNCTUATION, "")


def split_words(col: str | Column) -> Column:
    """Words separated by runs of ASCII whitespace, empty pieces dropped."""
    return F.filter(F.split(_c(col), WHITESPACE), lambda w: w != "")


def remove_stopwords(col: str | Column, stop_words: Sequence[str] = STOP_WORDS) -> Column:
    """drop words whose lower case is a stop word; rejoin with one space."""
    stop = list(stop_words)  # IN over literals is planned as a hash-set lookup
    kept = F.filter(split_words(col), lambda w: ~F.lower(w).isin(stop))
    return F.array_join(kept, " ")


def clean_claim_line(col: str | Column, replacements: Sequence[tuple[str, str]],
                     strict: bool = False) -> Column:
    """ordered literal replacements, then blanks removed.

    ``strict`` removes every blank (names lose their spaces, as the reference
    does); otherwise fields are only trimmed around the separators.
    """
    out = _c(col)
    for old, new in replacements:
        out = F.replace(out, F.lit(old), F.lit(new))
    if strict:
        return F.replace(out, F.lit(" "), F.lit(""))
    return F.regexp_replace(F.trim(out), " *, *", ",")


def numeric_cast(col: str | Column, to: str = "bigint") -> Column:
    """Thousands separators removed, blanks trimmed, cast (NULL if not a number)."""
    return F.regexp_replace(F.trim(_c(col)), ",", "").try_cast(to)


def era_year(col: str | Column) -> Column:
    """trim; ``50 BC`` becomes -50; cast to int."""
    return F.regexp_replace(F.trim(_c(col)), r"(\d+)\s*BC", "-$1").try_cast("int")


@F.pandas_udf(T.StringType())
def _fold(s: pd.Series) -> pd.Series:
    allowed = set(ALLOWED_LETTERS)

    def one(x):
        if x is None:
            return None
        return "".join(ch for ch in unicodedata.normalize("NFD", x)
                       if unicodedata.category(ch) != "Mn" and ch in allowed)
    return s.map(one)


def fold_to_ascii(col: str | Column) -> Column:
    """Unicode NFD, combining marks dropped, only the 57 allowed characters kept.

    Decomposition has no built-in expression, so this runs as an Arrow-batched
    pandas UDF inside the task (vectorised transfer, no per-row JVM round trip).
    """
    return _fold(_c(col))


def char_index(col: str | Column) -> Column:
    """0-based index of each character in :data:`ALLOWED_LETTERS` (-1 if absent),
    as an array aligned with the characters."""
    chars = F.filter(F.split(_c(col), ""), lambda ch: ch != "")
    return F.transform(chars, lambda ch: F.instr(F.lit(ALLOWED_LETTERS), ch) - 1)


def basic_tokens(col: str | Column) -> Column:
    """lower case, punctuation set apart, split on blanks."""
    out = F.lower(_c(col))
    for pat, rep in BASIC_TOKEN_RULES:
        if LITERAL.fullmatch(pat):  # found faster without a regular expression
            out = F.replace(out, F.lit(re.sub(r"\\(\W)", r"\1", pat)), F.lit(rep))
        else:
            out = F.regexp_replace(out, pat, rep)
    return split_words(out)


def word_tokens(col: str | Column, min_len: int = 2) -> Column:
    """Lower-cased runs of Unicode letters, digits or underscore of at least
    ``min_len`` characters (the default TF-IDF token rule)."""
    return F.regexp_extract_all(F.lower(_c(col)), F.lit(f"([\\p{{L}}\\p{{N}}_]{{{min_len},}})"), 1)
