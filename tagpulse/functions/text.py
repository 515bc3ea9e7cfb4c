"""Column-level text operators (ingest normalisation, hashtags, cleaning, stop words).

All helpers take and return ``Column`` objects so that they compose inside a
single projection and stay in whole-stage codegen.  Java regex semantics apply
(Spark evaluates ``regexp_*`` with ``java.util.regex``).
"""

from __future__ import annotations

import re
import string
from collections.abc import Iterable

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

# --- fixed values (must match the original application's behaviour) -------
# Ingest normalisation: newline becomes a space, colon is removed.
NEWLINE = "\n"
COLON = ":"
# First hashtag: the whole text must match  .*?\s(#\w+).*?  and group 1 is the
# tag.  ``matches()`` semantics are kept with \A ... \z anchors.
HASHTAG_PATTERN = r"\A.*?\s(#\w+).*?\z"
# The same texts match when any hashtag may be the one found.  The greedy dot runs to the line's end in one loop
# and looks for the tag backwards; the rest is taken at once.
ANY_HASHTAG_PATTERN = r"\A.*\s#\w.*+\z"
# Cleaning keeps ASCII letters and whitespace, then trims and lower-cases.
NON_LETTER_PATTERN = r"[^a-zA-Z\s]"
# The same class letter by letter.  java.util.regex keeps single characters below 256 as a table of bits and asks it
# once for each character, where ranges and classes are tested one after the other; tests check equality.
NON_LETTER_PATTERN_JAVA = "[^" + string.ascii_letters + r" \t\n\x0B\f\r]"
EDGE_SPACE_PATTERN = r"\A\s+|\s+\z"
# The characters of \s.
SPACES = " \t\n\x0b\f\r"
LETTER_PATTERN = r"[a-zA-Z]"
# Tokens are separated by runs of whitespace.
TOKEN_SEPARATOR = r"\s+"
# Up to this many words are counted by taking them out of the tokens one after the other.
FEW_WORDS = 8
# ---------------------------------------------------------------------------

_LETTERS_ONLY = re.compile(r"[a-z]+")


def _col(c: Column | str) -> Column:
    return F.col(c) if isinstance(c, str) else c


def normalize_text(c: Column | str) -> Column:
    """Newline -> space, colon removed (applied to text and created)."""
    return F.replace(F.replace(_col(c), F.lit(NEWLINE), F.lit(" ")), F.lit(COLON), F.lit(""))


def made_once(df: DataFrame, name: str, column: Column) -> DataFrame:
    """``df`` with a column that is computed once for each row.

    Spark merges projections and pushes filters below them, and every use then computes the column anew; nothing is pushed
    below an explode of the rows' own values."""
    others = [c for c in df.columns if c != name]
    return df.select(*others, F.explode(F.array(column)).alias(name)).select(*(df.columns if name in df.columns else [*others, name]))


def extract_hashtag(text: Column | str) -> Column:
    """The first ``#\\w+`` preceded by whitespace, or ``""`` when none."""
    return F.regexp_extract(_col(text), HASHTAG_PATTERN, 1)


def has_hashtag(text: Column | str) -> Column:
    """the whole text matches the hashtag pattern (equivalent to P4 != "")."""
    return _col(text).rlike(ANY_HASHTAG_PATTERN)


def clean_text(text: Column | str) -> Column:
    """Drop every char outside ``[a-zA-Z\\s]``, trim, lower-case.

    Java's ``String.trim`` strips chars <= U+0020; after the first replace only
    letters and ``\\s`` remain, so stripping ``\\s`` at both ends is the same.
    """
    stripped = F.regexp_replace(_col(text), NON_LETTER_PATTERN_JAVA, "")
    return F.lower(F.btrim(stripped, F.lit(SPACES)))


def matchable_words(words: Iterable[str]) -> list[str]:
    """Lexicon entries that can equal a cleaned token (lower-case ASCII letters).

    Entries such as ``co.`` or ``no-one`` can never match a cleaned token and
    are left out of the generated expressions.
    """
    return sorted({w for w in words if w and _LETTERS_ONLY.fullmatch(w)})


def prefix_tree(words: Iterable[str]) -> str:
    """An alternation of plain words as a prefix tree: a token is compared letter by letter, however many words there are."""
    tree: dict = {}
    for word in words:
        node = tree
        for letter in word:
            node = node.setdefault(letter, {})
        node[""] = {}
    # Spelled from the leaves upwards with a stack of its own: a word may have any length.
    spelled: dict[int, str] = {}
    waiting = [tree]
    while waiting:
        node = waiting[-1]
        below = [node[letter] for letter in node if letter]
        missing = [child for child in below if id(child) not in spelled]
        if missing:
            waiting += missing
            continue
        waiting.pop()
        rest = [letter + spelled[id(node[letter])] for letter in sorted(node) if letter]
        body = "" if not rest else rest[0] if len(rest) == 1 and "" not in node else "(?:" + "|".join(rest) + ")"
        spelled[id(node)] = body + "?" if rest and "" in node else body
    return spelled[id(tree)]


def stop_word_pattern(stop_words: Iterable[str]) -> str | None:
    """One-pass regex equal to repeatedly replacing ``\\s+w\\s+`` by a space.

    A run of interior stop words collapses, with its surrounding whitespace,
    into one space; the first and the last token always survive.  The run is
    matched possessively: nothing follows that could need a give-back, and the
    matcher then loops instead of recursing, so a run may have any length.
    """
    words = matchable_words(stop_words)
    if not words:
        return None
    return r"\s+(?:" + prefix_tree(words) + r"\s+)++"


def remove_stop_words(text: Column | str, stop_words: Iterable[str]) -> Column:
    """Remove interior stop words, keep the original spacing elsewhere."""
    pattern = stop_word_pattern(stop_words)
    return _col(text) if pattern is None else F.regexp_replace(_col(text), pattern, " ")


def has_letter(text: Column | str) -> Column:
    """F5 on the raw text: ``clean_text`` is non-empty exactly when the text
    holds an ASCII letter (the cleaner keeps letters and whitespace, then
    strips the whitespace at both ends).  Testing it before cleaning keeps the
    filter from re-running the cleaning regexes when Catalyst pushes it below
    the projection."""
    return _col(text).rlike(LETTER_PATTERN)


def not_blank(text: Column | str) -> Column:
    """text has at least one non-whitespace character."""
    return F.length(F.regexp_replace(_col(text), EDGE_SPACE_PATTERN, "")) > 0


def tokens(text: Column | str) -> Column:
    """Split on whitespace runs (input is already trimmed)."""
    return F.split(_col(text), TOKEN_SEPARATOR)


def count_members(token_array: Column, words: Iterable[str]) -> Column:
    """F8 + A1/A2: multiset count of tokens that belong to ``words``.

    ``isin`` with more than a handful of literals becomes a hash ``INSET``
    inside the lambda, so the lookup is O(1) per token and stays JVM-side.
    """
    members = matchable_words(words)
    if not members:
        return F.lit(0)
    return F.size(F.filter(token_array, lambda w: w.isin(members)))


def count_made_members(tokens_col: str, words: Iterable[str]) -> Column:
    """``count_members`` of a column of tokens that is made once (``made_once``): it is read twice here.

    Few words are taken out of the tokens, in compiled code, and what is gone is counted."""
    members = matchable_words(words)
    if not members or len(members) > FEW_WORDS:
        return count_members(F.col(tokens_col), words)
    rest = F.col(tokens_col)
    for word in members:
        rest = F.array_remove(rest, word)
    return F.size(tokens_col) - F.size(rest)


def _at_the_ends(tokens_col: str, words: list[str]) -> Column:
    """How many of the first and the last token (one, if there is one token) are among ``words``."""
    if not words:
        return F.lit(0)
    n, tokens_ = F.size(tokens_col), F.col(tokens_col)
    first, last = F.get(tokens_, F.lit(0)).isin(words), F.get(tokens_, n - 1).isin(words)
    return first.cast("int") + F.when(n > 1, last.cast("int")).otherwise(0)


def count_inside(tokens_col: str, stop_words: Iterable[str]) -> Column:
    """How many tokens ``remove_stop_words`` takes out of a cleaned text, of the made column of its tokens: the stop words but
    for a first and a last token."""
    stop = matchable_words(stop_words)
    return count_made_members(tokens_col, stop) - _at_the_ends(tokens_col, stop)


def count_left(tokens_col: str, words: Iterable[str], stop_words: Iterable[str]) -> Column:
    """``count_members`` of the tokens that ``remove_stop_words`` leaves, of the made column of a cleaned text's tokens: a word that is
    a stop word too is left at the ends only."""
    members, stop = matchable_words(words), set(matchable_words(stop_words))
    return count_made_members(tokens_col, [w for w in members if w not in stop]) + _at_the_ends(tokens_col, [w for w in members if w in stop])
