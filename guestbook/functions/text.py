"""Text normalisation and tokens.

Java's ``\\w``, ``\\d`` and ``\\s`` are ASCII-only by default: letters and numbers are spelled out as Unicode
categories, and ``(?U)`` makes ``\\s`` every white space.
"""

from __future__ import annotations

import string
from collections.abc import Sequence

from pyspark.sql import Column
from pyspark.sql import functions as F

from guestbook.functions.fixed_values import NO_NEGATIVE, NO_POSITIVE

SPACE = r"\s\x1c-\x1f"  # inside a character class of a (?U) pattern
SPACE_CHARACTERS = "".join(chr(x) for x in range(0x3001) if chr(x).isspace())


def stripped(text: Column) -> Column:
    return F.btrim(text, F.lit(SPACE_CHARACTERS))


def words(text: Column) -> Column:
    """Whitespace-separated pieces; an empty text gives one empty piece."""
    return F.split(text, f"(?U)[{SPACE}]+")


def bare(piece: Column) -> Column:
    return F.btrim(piece, F.lit(string.punctuation))


def bare_word(piece: Column) -> Column:
    """Word without punctuation around it; a piece of punctuation only (an emoticon) stays."""
    return F.when(bare(piece) == "", piece).otherwise(bare(piece))


def with_bare_words(text: Column) -> Column:
    """A text each of whose ``words`` is a ``bare_word``: in one go over the text, where trimming looks every end of every
    word up in the list of marks."""
    marks = "".join(f"\\{mark}" for mark in string.punctuation)
    before, after = rf"(?<![^{SPACE}])[{marks}]++(?=[^{SPACE}])", rf"(?<=[^{SPACE}{marks}])[{marks}]++(?![^{SPACE}])"
    return F.regexp_replace(text, f"(?U)(?=[{marks}])(?:{before}|{after})", "")


def plain_text(text: Column) -> Column:
    """Lower-case text without links, tags in angle brackets, punctuation and digits.

    NULL and the "nothing was written" sentinels give an empty text.
    """
    low = F.lower(F.coalesce(text, F.lit("")))
    out = F.regexp_replace(low, f"(?U)(?:http|www)[^{SPACE}]+", "")
    out = F.regexp_replace(out, r"<[^\n>]*>", "")
    out = F.regexp_replace(out, rf"(?U)[^a-z\p{{L}}\p{{Nl}}\p{{No}}_{SPACE}]+", "")
    return F.when(low.isin(NO_POSITIVE.lower(), NO_NEGATIVE.lower()), F.lit("")).otherwise(out)


def kept_words(text: Column, stop_words: Sequence[str] = ()) -> Column:
    """Words of a plain text that are not empty and not stop words, in order, repeats kept."""
    drop = ["", *stop_words]
    return F.filter(words(text), lambda word: ~word.isin(drop))


def grams(text: Column, size: Column) -> Column:
    """All runs of ``size`` characters in a text, in order; none in a shorter text, and one empty run of size 0."""
    places = F.greatest(F.length(text) - size + 1, F.lit(0))
    runs = F.transform(F.sequence(F.lit(1), F.greatest(places, F.lit(1))), lambda at: F.substring(text, at, size))
    return F.when(places == 0, F.array().cast("array<string>")).when(size == 0, F.array(F.lit(""))).otherwise(runs)


def without_reasoning(text: Column) -> Column:
    """Text without its first reasoning block; other texts stay as they are.

    The block opens at the first ``<think>`` and closes at the next ``</think>``; where it stands in the text
    again, word for word, it goes too. One that is never closed, or opened again before that, stays.
    """
    start = F.instr(text, "<think>")
    rest = F.substr(text, start + len("<think>"))
    end, again = F.instr(rest, "</think>"), F.instr(rest, "<think>")
    closed = (start > 0) & (end > 0) & ((again == 0) | (again > end))
    block = F.substr(text, start, end + len("<think></think>") - 1)
    return F.when(closed, F.replace(text, block, F.lit(""))).otherwise(text)
