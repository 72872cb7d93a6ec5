"""Line filtering, tokenizing and title clean-up."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import Column
from pyspark.sql import functions as F

# The header fields whose lines are not part of a mail's body.
MAIL_HEADERS = (
    "Message-ID",
    "Date",
    "From",
    "To",
    "Subject",
    "Mime-Version",
    "Content-Type",
    "Content-Transfer-Encoding",
    "X-From",
    "X-To",
    "X-cc",
    "X-bcc",
    "X-Folder",
    "X-Origin",
    "X-FileName",
)


def mail_body(line: Column, *, strict: bool = False) -> Column:
    """True for lines of a mail that belong to its body.

    A line is dropped when it starts with a header name (case matters) or is shorter
    than two characters. The bare prefix also drops body lines such as "Tomorrow we
    go"; ``strict`` asks for the colon too. Length counts UTF-16 units, so a lone
    four-byte character passes.
    """
    colon = ":" if strict else ""
    header = line.rlike("^(" + "|".join(MAIL_HEADERS) + ")" + colon)
    long_enough = (F.length(line) >= 2) | (F.octet_length(line) == 4)
    return long_enough & ~header


def lines(text: Column) -> Column:
    """Split at any kind of line break.

    Plain replacing first leaves a one-character separator, which splits several times
    faster than a pattern.
    """
    unified = F.replace(F.replace(text, F.lit("\r\n"), F.lit("\n")), F.lit("\r"), F.lit("\n"))
    return F.split(unified, "\n")


def keep_lines(text: Column, predicate: Callable[[Column], Column] = mail_body) -> Column:
    """The lines of ``text`` that pass, each followed by one space, as one string."""
    kept = F.filter(lines(text), lambda line: predicate(line))
    return F.array_join(F.transform(kept, lambda line: F.concat(line, F.lit(" "))), "")


def tokens(text: Column, keep_empty: bool = True) -> Column:
    """Split at single spaces.

    Trailing empty tokens go; inner and leading ones stay as ``""`` unless
    ``keep_empty`` is off. The empty text is one empty token, a text of blanks none.
    """
    trimmed = F.rtrim(text)
    words = F.split(trimmed, " ")
    if not keep_empty:
        return F.filter(words, lambda w: w != "")
    return F.when((trimmed == "") & (text != ""), F.array().cast("array<string>")).otherwise(words)


def clean_title(title: Column) -> Column:
    """Lower case, without one closing full stop."""
    return F.lower(F.regexp_replace(title, r"\.$", ""))


def between_tags(text: Column, tag: str) -> Column:
    """Raw text of the first ``<tag ...>...</tag>``; null when there is none."""
    pattern = rf"(?s)<{tag}(?:\s[^>]*)?>(.*?)</{tag}>"
    return F.get(F.regexp_extract_all(text, F.lit(pattern), 1), F.lit(0))


def last_record(text: Column, tag: str) -> Column:
    """Text from the last opening ``<tag`` on; null when there is none."""
    last = F.element_at(F.split(text, rf"(?=<{tag}[\s>])"), -1)
    return F.when(last.rlike(rf"\A<{tag}[\s>]"), last)
