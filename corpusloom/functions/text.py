"""Transcript cleaning as Column expressions."""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from corpusloom.functions.binding import let

# Fixed value: the 29 characters that Python's str.strip() and str.split() treat as whitespace, as
# the body of a regular-expression class. The separator category is one test in Java, whereas a
# range for each group of characters takes twice as long on plain text.
WHITESPACE = r" \t-\r\x1c-\x1f\x{85}\p{Z}"

# The markup of the tagged source.
GARBAGE_TAGS = ("<SIL>", "<MUSIC>", "<NOISE>", "<OTHER>")
PUNCTUATION_TAGS = {
    "<COMMA>": ",",
    "<PERIOD>": ".",
    "<QUESTIONMARK>": "?",
    "<EXCLAMATIONPOINT>": "!",
}
SHORTEST_TRANSCRIPT = 3

# Fixed value: the prompt put before every transcript.
INSTRUCTION_TEMPLATE = "User: Please transcribe the following audio recording.\n<|audio_chunk|>\nAssistant: "

_TRIM_SET = "".join(chr(c) for c in range(0x3001) if chr(c).isspace())


def strip_ws(text: Column) -> Column:
    """Python's ``strip()``; Spark's ``trim`` alone takes off spaces only."""
    return F.trim(text, F.lit(_TRIM_SET))


def collapse_ws(text: Column) -> Column:
    """Python's ``" ".join(text.split())``."""
    return F.trim(F.regexp_replace(text, f"[{WHITESPACE}]+", " "))


def split_ws(text: Column) -> Column:
    """Python's ``text.split()``."""
    return F.array_remove(F.split(strip_ws(text), f"[{WHITESPACE}]+"), "")


def is_rejected(text: Column) -> Column:
    """True if, for some garbage tag in the text, too little is left without that one tag."""
    tests = [
        F.when(
            F.contains(text, F.lit(tag)),
            F.length(strip_ws(F.replace(text, F.lit(tag), F.lit("")))) < SHORTEST_TRANSCRIPT,
        ).otherwise(F.lit(False))
        for tag in GARBAGE_TAGS
    ]
    return reduce(Column.__or__, tests)


def reject_tags(text: Column) -> Column:
    """The text unchanged, or NULL if it is rejected."""
    return F.when(~is_rejected(text), text)


def clean_text(text: Column) -> Column:
    """The cleaned transcript, NULL for an unusable one."""
    names = "|".join(tag.strip("<>") for tag in GARBAGE_TAGS)

    def cleaned(raw: Column) -> Column:
        spelled = raw
        for tag, mark in PUNCTUATION_TAGS.items():
            spelled = F.replace(spelled, F.lit(tag), F.lit(mark))
        spelled = F.regexp_replace(spelled, f"<({names})>", " ")
        # Most transcripts carry no markup, so the replacements are kept off their path.
        plain = F.when(F.contains(raw, F.lit("<")), spelled).otherwise(raw)
        return F.when(~is_rejected(raw), let(collapse_ws(plain), lambda t: F.when(t != "", t)))

    return let(text, cleaned)


def has_markup(text: Column) -> Column:
    return F.contains(text, F.lit("<")) & F.contains(text, F.lit(">"))


def clean_guarded(text: Column) -> Column:
    """Clean only what looks like markup; other text is passed on as it is."""
    return let(text, lambda raw: F.when(has_markup(raw), clean_text(raw)).otherwise(raw))


def text_fallback_value(text: Column, sentence: Column) -> Column:
    """The first of both that is neither NULL nor empty, else the empty string."""
    return F.coalesce(F.nullif(text, F.lit("")), F.nullif(sentence, F.lit("")), F.lit(""))


def text_by_value(df: DataFrame) -> Column:
    """``text_fallback_value`` over whichever of the two columns exist."""
    present = [F.col(name) if name in df.columns else F.lit(None) for name in ("text", "sentence")]
    return text_fallback_value(*present)


def text_fallback_schema(df: DataFrame) -> Column:
    """``text`` if that column exists, even where it is NULL, else ``sentence``, else empty."""
    for name in ("text", "sentence"):
        if name in df.columns:
            return F.col(name)
    return F.lit("")


def instruction_text(text: Column, template: str = INSTRUCTION_TEMPLATE) -> Column:
    return F.concat(F.lit(template), text)
