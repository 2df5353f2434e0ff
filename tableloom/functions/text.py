"""Prose cleaning as column expressions over whole texts."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tableloom.functions.columns import col

# Marks removed, characters replaced, and line starts that drop a line.
HEADING_MARKS = ["###", "##", "**"]
BULLET_MARKS = "■▪•"
REPLACED_CHARACTERS = {"‑": "-", "×": "x", "→": "->"}
INLINE_MARKS = "`*"
DROPPED_LINE_STARTS = "#-*."

# The characters counted as white space, and those among them that stay within a line.
WHITESPACE = "\\t\\n\\u000b\\f\\r\\u001c-\\u001f \\u0085\\u00a0\\u1680\\u2000-\\u200a\\u2028\\u2029\\u202f\\u205f\\u3000"
IN_LINE_WHITESPACE = WHITESPACE.replace("\\n", "")


def normalize_marks(text: Column, removed: str = BULLET_MARKS) -> Column:
    """Remove heading, bold and bullet marks and write special characters plainly.

    Plain replacements search bytes and hand a text without the mark through unchanged.
    """
    replaced = dict.fromkeys(HEADING_MARKS, "") | dict.fromkeys(removed, "") | REPLACED_CHARACTERS
    for mark, plain in replaced.items():
        text = F.replace(text, F.lit(mark), F.lit(plain))
    return text


def squeeze(text: Column) -> Column:
    """One space between words, none at the ends. Texts that have single spaces only are not rewritten."""
    uneven = text.contains("  ") | text.rlike(f"[{WHITESPACE.replace(' ', '')}]")
    return F.btrim(F.when(uneven, F.regexp_replace(text, f"[{WHITESPACE}]+", " ")).otherwise(text), F.lit(" "))


def _is_prose(part: Column) -> Column:
    """Does the part have a first character besides white space, and one that does not drop it?"""
    starts = "".join("\\" + c for c in DROPPED_LINE_STARTS)
    return part.rlike(f"^[{WHITESPACE}]*+[^{WHITESPACE}{starts}]")


def clean_prose(text: Column) -> Column:
    """Cleaned lines joined by blank lines; empty lines and list or heading lines are dropped.

    All steps work on the whole text, so the expression stays in generated code.
    """
    marked = normalize_marks(text, BULLET_MARKS + INLINE_MARKS)
    # Most texts have single spaces only; finding that out is cheaper than rewriting every space.
    uneven = marked.contains("  ") | marked.rlike(f"[{IN_LINE_WHITESPACE.replace(' ', '')}]")
    runs = F.regexp_replace(marked, f"[{IN_LINE_WHITESPACE}]+", " ")
    squeezed = F.when(uneven, runs).otherwise(marked)
    starts = "".join("\\" + c for c in DROPPED_LINE_STARTS)
    kept = F.regexp_replace(F.concat(F.lit("\n"), squeezed), f"\n ?[{starts}][^\n]*", "\n")
    joined = F.replace(F.regexp_replace(kept, "\n[ \n]*", "\n\n"), F.lit(" \n\n"), F.lit("\n\n"))
    return F.btrim(joined, F.lit(" \n"))


def paragraphs(df: DataFrame, text: str, keys: list[str]) -> DataFrame:
    """One row per prose paragraph: keys, position among all blank-line separated parts, paragraph."""
    parts = df.select(
        *[col(k) for k in keys],
        F.posexplode(F.split(normalize_marks(col(text)), "\n\n")).alias("position", "part"),
    )
    # The first character decides before anything is rewritten.
    return parts.where(_is_prose(F.col("part"))).select(*[col(k) for k in keys], "position", squeeze(F.col("part")).alias("paragraph"))
