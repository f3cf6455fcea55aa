"""Column functions for message text."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

#: The 29 code points that count as white space at the ends of a text.
BLANKS = "".join(map(chr, [*range(9, 14), *range(28, 33), 0x85, 0xA0, 0x1680, *range(0x2000, 0x200B), 0x2028, 0x2029, 0x202F, 0x205F, 0x3000]))
AUTHOR_CHARS = 40


def strip(text: Column) -> Column:
    return F.btrim(text, F.lit(BLANKS))


def is_blank(text: Column) -> Column:
    return strip(F.coalesce(text, F.lit(""))) == ""


def truncate(text: Column, most: int) -> Column:
    """One line of at most `most` code points, an ellipsis at the end of a longer text."""
    line = strip(F.replace(text, F.lit("\n"), F.lit(" ")))
    return F.when(F.length(line) <= most, line).otherwise(F.concat(F.substring(line, 1, most - 1), F.lit("…")))


def context_line(author: Column, content: Column, most: int) -> Column:
    return F.concat(F.lit("["), truncate(author, AUTHOR_CHARS), F.lit("] "), truncate(content, most))


def length_bucket(length: Column) -> Column:
    """short, medium, long; "nan" beyond 10,000 as the report's consumers expect."""
    return F.when(length <= 20, "short").when(length <= 100, "medium").when(length <= 10_000, "long").otherwise("nan")


def display_name(name: Column) -> Column:
    """The part before the first colon, or the name itself where that is empty."""
    return F.coalesce(F.nullif(F.trim(F.split_part(name, F.lit(":"), F.lit(1))), F.lit("")), name)


def estimated_tokens(length: Column, chars_per_token: int = 4) -> Column:
    return F.when(length <= 0, 0).otherwise(F.greatest(F.lit(1), F.floor(length / chars_per_token))).cast("long")


def first_words(text: Column, most: int = 15) -> Column:
    """The first `most` words where there are more; else the stripped text with its inner spacing."""
    bare = strip(text)
    words = F.split(bare, r"[\s\x1c-\x1f\x85\xa0  -     　]+")
    return F.when(F.size(words) > most, F.array_join(F.slice(words, 1, most), " ")).otherwise(bare)


def to_boolean(value: Column) -> Column:
    """true/false, yes/no, on/off, t/f, y/n, 1/0 in any case; null for anything else."""
    low = F.lower(strip(value))
    return F.when(low.isin("true", "1", "yes", "on", "t", "y"), True).when(low.isin("false", "0", "no", "off", "f", "n"), False)
