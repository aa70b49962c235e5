"""Comment cleaning and the texts that get embedded."""

from __future__ import annotations

from pyspark.sql import Column, functions as F

# Editing shorthand and boilerplate words without topical meaning.
JARGON = (
    "add", "addition", "alpha", "abc", "cap", "capital", "cpt", "lc", "lcase", "uc", "ucase", "cat", "recat",
    "cl", "clean", "tidy", "cm", "cmt", "re", "copyedit", "cpyed", "ced", "ce", "mce", "creation", "new", "dab",
    "disamb", "disam", "disambig", "byp", "dup", "dupe", "fmt", "frmt", "mo", "mos", "ft", "ref", "refs",
    "reference", "references", "rm", "rmv", "del", "rv", "rvt", "rvrt", "rvv", "sp", "typo", "typos", "talk",
    "wfy", "wky", "wkfy", "top", "undo", "undid", "minor", "misc", "na", "n/a", "see", "also", "external",
    "links", "link", "notes", "note", "further", "reading", "attendances", "attendance", "infobox",
    "categories", "category", "created", "creating", "page", "pages", "article", "articles", "restored",
    "revision", "revisions", "wikify", "wikification",
)

# Punctuation removed from both ends of a quadgram.
EDGE_PUNCTUATION = " \t\r\n.,;:!?\"'()[]{}"

# The characters that count as white space.
WHITE_SPACE = (
    "\t\n\x0b\x0c\r\x1c\x1d\x1e\x1f \x85\xa0\u1680\u2000\u2001\u2002\u2003\u2004\u2005\u2006"
    "\u2007\u2008\u2009\u200a\u2028\u2029\u202f\u205f\u3000"
)

# The wiki markup that is recognised. "." stops at a line feed only.
REVERT_PREFIX = (
    r"(?iU)^(?:Undid|Restored)\s+revisions?\s+\d+(?:\s*(?:through|to|-)\s*\d+)?"
    r"\s+by\s+\[\[[^\]]*\]\](?:\s*\(\[\[[^\]]*\]\]\))?\s*:?\s*"
)
SECTION = r"(?dU)/\*\s*(.*?)\s*\*/"
LINK = r"\[\[(?:[^\]|]*\|)?([^\]]+)\]\]"
TEMPLATE = r"\{\{|\}\}|\|"

# A token outside the jargon list: starts where no ASCII letter or digit
# precedes, and is not exactly one of the words.
_CONTENT_TOKEN = (
    r"(?<![a-z0-9])(?!(?:" + "|".join(w for w in JARGON if w.isalnum()) + r")(?![a-z0-9]))[a-z0-9]"
)


def strip(text: Column) -> Column:
    """Trim Unicode white space on both ends (plain ``trim`` removes only blanks)."""
    return F.trim(text, F.lit(WHITE_SPACE))


def blank_to_null(text: Column) -> Column:
    return F.nullif(strip(text), F.lit(""))


def clean_comment(comment: Column) -> Column:
    """An edit comment without wiki markup; null reads as "".

    The four ASCII separators count as white space, which Java's ``\\s`` leaves out.
    """
    text = F.translate(F.coalesce(comment, F.lit("")), "\x1c\x1d\x1e\x1f", "    ")
    text = F.regexp_replace(strip(text), REVERT_PREFIX, "")
    text = F.regexp_replace(text, SECTION, "$1")
    text = F.regexp_replace(text, LINK, "$1")
    text = F.regexp_replace(text, TEMPLATE, " ")
    return F.trim(F.regexp_replace(text, r"(?U)\s+", " "))


def has_content(cleaned: Column) -> Column:
    """Whether any token of a cleaned comment carries content.

    One regular expression instead of a token array keeps the test inside
    whole-stage codegen.
    """
    return F.lower(cleaned).rlike(_CONTENT_TOKEN)


def substantive_comment(comment: Column) -> Column:
    """The cleaned comment, or null when no token of it carries content."""
    cleaned = clean_comment(comment)
    return F.when(has_content(cleaned), cleaned)


def anomaly_text(page_title: Column, recent_comments: Column) -> Column:
    title = blank_to_null(F.replace(page_title, F.lit("_"), F.lit(" ")))
    return F.concat_ws(" ", title, blank_to_null(recent_comments))


def article_text(title: Column, snippet: Column) -> Column:
    return F.concat_ws(". ", blank_to_null(title), blank_to_null(snippet))


def edge_trim(text: Column) -> Column:
    """Cut punctuation and blanks off both ends; the inside stays."""
    return F.trim(text, F.lit(EDGE_PUNCTUATION))
