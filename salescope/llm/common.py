"""What several operators of this subpackage share: text expressions, and shipping task code with the tasks."""

from __future__ import annotations

import sys

from pyspark import cloudpickle
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

# The characters that separate words, and the two alphabets.
BLANKS = " \t\n\x0b\x0c\r"
UPPER, LOWER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"


def ship(module: str) -> None:
    """Send the functions of ``module`` with the tasks that use them, so that executors need no copy of the package."""
    cloudpickle.register_pickle_by_value(sys.modules[module])


ship(__name__)


def text_of(name: str = "text") -> Column:
    """The text, with null as the empty text."""
    return F.coalesce(F.col(name), F.lit(""))


def ascii_lower(text: Column) -> Column:
    """A-Z in lower case and nothing else; pure ASCII texts take the faster built-in."""
    plain = F.length(text) == F.octet_length(text)
    return F.when(plain, F.lower(text)).otherwise(F.translate(text, UPPER, LOWER))


def blank_words(text: Column) -> Column:
    """The words between blanks (U+0020 and U+0009 to U+000D), in order."""
    spaced = F.trim(F.translate(text, BLANKS[1:], " " * len(BLANKS[1:])))
    return F.when(spaced == "", F.array().cast("array<string>")).otherwise(F.split(spaced, " +"))


def item_words(text: Column) -> Column:
    """The lower-cased words of ASCII letters, digits and characters beyond ASCII, in order."""
    return F.regexp_extract_all(ascii_lower(text), F.lit(r"[0-9a-z\x{80}-\x{10FFFF}]+"), F.lit(0))


def with_run_hashes(df: DataFrame, words: str, lengths: dict[str, int]) -> DataFrame:
    """Add array columns: for each name the hashes of all runs of so many words, by their start.

    Longer runs are put together from runs of powers of two, each a column of its own, so that none is worked out twice.
    """
    size, names = F.size(words), df.columns

    def paired(left: str, right: str, by: int) -> Column:
        # Where the shifted side has ended, a value is left that no full run has; those places are cut off below.
        return F.zip_with(left, F.slice(right, by + 1, size), lambda a, b: F.xxhash64(a, b))

    df = df.withColumn("_run1", F.transform(words, lambda w: F.xxhash64(w)))
    power = 1
    while power * 2 <= max(lengths.values(), default=0):
        df = df.withColumn(f"_run{power * 2}", paired(f"_run{power}", f"_run{power}", power))
        power *= 2
    for name, length in lengths.items():
        parts = [1 << b for b in range(length.bit_length()) if length >> b & 1]
        have = parts.pop()
        df = df.withColumn(name, F.col(f"_run{have}"))
        for part in reversed(parts):
            df = df.withColumn(name, paired(name, f"_run{part}", have))
            have += part
        whole = F.slice(name, F.lit(1), F.greatest(size - length + 1, F.lit(0)))
        df = df.withColumn(name, whole)
    return df.select(*names, *lengths)
