"""Rewriting record XML so that one typed parse yields every field.

Two rules apply to elements that may hold inline markup. Titles and abstract parts count with all
the text inside them; terms and names only with the text before their first child. The typed
parser knows neither, so the record text is brought into a form where both hold by construction:
tags inside the former are taken out, and the latter are cut at their first child.
"""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

WHOLE_TEXT_TAGS = ("ArticleTitle", "AbstractText")
LEADING_TEXT_TAGS = (
    "LastName",
    "ForeName",
    "Title",
    "DescriptorName",
    "Keyword",
    "PublicationType",
    "ArticleId",
)

# What may stand between a tag name and its ">", quoted values included.
_INSIDE_TAG = r"""(?:[^>"']++|"[^"]*+"|'[^']*+')*+"""


def _opening(names: tuple[str, ...]) -> str:
    return rf"<(?:{'|'.join(names)})(?=[\s>]){_INSIDE_TAG}(?<!/)>"




def _inner_tag(names: tuple[str, ...]) -> str:
    # \G chains the matches: after the opening tag, each further match starts where the last
    # ended, so a single pass removes every tag up to the element's own closing tag.
    return (
        rf"(?s)((?:\G(?!\A)|{_opening(names)})[^<]*+)"
        rf"<(?!/(?:{'|'.join(names)})\s*>){_INSIDE_TAG}>"
    )


def _first_child(names: tuple[str, ...]) -> str:
    return (
        rf"(?s)(<({'|'.join(names)})(?=[\s>]){_INSIDE_TAG}(?<!/)>[^<]*+)<(?!/).*?</\2\s*>"
    )


_LEXEMES = r"(?s)<!--.*?-->|<!\[CDATA\[.*?\]\]>|<\?.*?\?>|[^<]+|<"


def escape_xml(text: Column) -> Column:
    for char, entity in (("&", "&amp;"), ("<", "&lt;"), (">", "&gt;"), ('"', "&quot;")):
        text = F.replace(text, F.lit(char), F.lit(entity))
    return text


def unescape_xml(text: Column) -> Column:
    """Decode character references; only text that has any is parsed."""
    wrapped = F.concat(F.lit("<a><b>"), text, F.lit("</b></a>"))
    parsed = F.from_xml(wrapped, "b string", {"ignoreSurroundingSpaces": "false"})
    return F.when(F.contains(text, F.lit("&")), parsed["b"]).otherwise(text)


def has_special_sections(raw: Column) -> Column:
    """Whether there are comments, processing instructions or CDATA."""
    return F.contains(raw, F.lit("<!")) | F.contains(raw, F.lit("<?"))


def has_inline_markup(raw: Column, names: tuple[str, ...]) -> Column:
    """Whether an element of these names has a child."""
    return raw.rlike(rf"{_opening(names)}[^<]*+<(?!/)")


def without_special_sections(raw: Column) -> Column:
    """Drop comments and processing instructions and turn CDATA into escaped text."""
    lexemes = F.regexp_extract_all(raw, F.lit(_LEXEMES), F.lit(0))

    def plain(lexeme: Column) -> Column:
        cdata = F.regexp_extract(lexeme, r"(?s)\A<!\[CDATA\[(.*)\]\]>\z", 1)
        return (
            F.when(lexeme.startswith("<![CDATA["), escape_xml(cdata))
            .when(lexeme.startswith("<!--") | lexeme.startswith("<?"), "")
            .otherwise(lexeme)
        )

    rebuilt = F.array_join(F.transform(lexemes, plain), "")
    return F.when(has_special_sections(raw), rebuilt).otherwise(raw)


def without_inline_markup(
    plain: Column,
    whole: tuple[str, ...] = WHOLE_TEXT_TAGS,
    leading: tuple[str, ...] = LEADING_TEXT_TAGS,
) -> Column:
    """Apply both rules to a record free of comments and CDATA."""
    text = F.regexp_replace(plain, F.lit(_inner_tag(whole)), F.lit("$1"))
    if leading:
        text = F.regexp_replace(text, F.lit(_first_child(leading)), F.lit("$1</$2>"))
    return text
