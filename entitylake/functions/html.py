"""Mail HTML to Markdown: pairs of tags by ordered rules, all other tags in one pass.

Known limits: nested lists come out flat, ordered lists use bullets, tables become
lines, and Markdown signs in the text are not escaped.
"""

from __future__ import annotations

from collections.abc import Callable
from functools import reduce
from html.entities import html5, name2codepoint
from operator import or_

from pyspark.sql import Column
from pyspark.sql import functions as F

from entitylake import constants as K
from entitylake.functions import text as T

_ATTRS = r"(?:\s[^>]*)?"

# Tags that start and end a block.
BLOCK_TAGS = (
    "address article aside blockquote body dd div dl dt figure footer form header html main "
    "nav ol p pre section table tbody td tfoot th thead tr ul"
).split()
# What single tags turn into; closing tags carry their slash. Tags not named here go.
TAG_TEXT = {
    **{f"h{n}": "\n\n" + "#" * n + " " for n in range(1, 7)},
    **{f"/h{n}": "\n\n" for n in range(1, 7)},
    "li": "\n*   ",
    "/li": "\n",
    "br": "\n",
    "hr": "\n\n* * *\n\n",
}
TAG_PATTERN = r"^(/?[a-zA-Z][a-zA-Z0-9:._-]*)" + _ATTRS + "/?>"
DECLARATION_PATTERN = r"^![a-zA-Z][^>]*>"

# One space next to a block tag carries no meaning once white space is collapsed.
_TIGHT = "|".join([*BLOCK_TAGS, "h1", "h2", "h3", "h4", "h5", "h6", "hr", "li", "br"])
TIGHTEN_RULE = (rf"(?i) ?(</?(?:{_TIGHT}){_ATTRS}/?>) ?", r"$1")

# Tags that need their partner or their attributes, in this order, each with the signs
# one of which a text must hold for the rule to matter.
PAIR_RULES: tuple[tuple[str, str, tuple[str, ...]], ...] = (
    (rf"(?is)<(?:strong|b){_ATTRS}>(.*?)</(?:strong|b)\s*>", "**$1**", ("</strong", "</b")),
    (rf"(?is)<(?:em|i){_ATTRS}>(.*?)</(?:em|i)\s*>", "_$1_", ("</em", "</i")),
    (rf"(?is)<code{_ATTRS}>(.*?)</code\s*>", "`$1`", ("</code",)),
    (
        r"""(?is)<a\s[^>]*?\bhref\s*=\s*["']([^"'>]*)["'][^>]*>(.*?)</a\s*>""",
        "[$2]($1)",
        ("</a",),
    ),
    (
        r"""(?is)<img\s[^>]*?\balt\s*=\s*["']([^"'>]*)["'][^>]*?\bsrc\s*=\s*["']([^"'>]*)["'][^>]*>""",
        "![$1]($2)",
        ("<img",),
    ),
    (
        r"""(?is)<img\s[^>]*?\bsrc\s*=\s*["']([^"'>]*)["'][^>]*?\balt\s*=\s*["']([^"'>]*)["'][^>]*>""",
        "![$2]($1)",
        ("<img",),
    ),
    (r"""(?is)<img\s[^>]*?\bsrc\s*=\s*["']([^"'>]*)["'][^>]*>""", "![]($1)", ("<img",)),
)

# A reference ends the text before it, so splitting on '&' finds each one exactly once
# and '&amp;lt;' is decoded to '&lt;' and no further.
REFERENCE_PATTERN = r"^(#[0-9]{1,7}|#[xX][0-9a-fA-F]{1,6}|[a-zA-Z][a-zA-Z0-9]{1,31});"
# The names of HTML 5 that end in a semicolon and stand for one character, as the standard
# library lists them.
NAMED_REFERENCES = {name[:-1]: ord(text) for name, text in html5.items() if name.endswith(";") and len(text) == 1}
_MAX_CODEPOINT = 0x10FFFF


def clean_mail_html(html: Column) -> Column:
    """Drop comments, style, script, head and XML declarations."""
    for pattern in K.MAIL_NOISE_PATTERNS:
        # Patterns for declarations and comments start with their own sign.
        sign = "<!--" if "<!--" in pattern else "<?" if "<\\?" in pattern else "<"
        html = T.replace_where(html, sign, pattern, "")
    return html


def _has_any(text: Column, signs: tuple[str, ...]) -> Column:
    return reduce(or_, [F.contains(text, F.lit(sign)) for sign in signs])


def _rule(pattern: str, replacement: str, needed: Column) -> Callable[[Column], Column]:
    return lambda text: F.when(
        needed, F.regexp_replace(text, pattern, replacement)
    ).otherwise(text)


def _apply_pairs(markup: Column) -> Column:
    """The pair rules a text needs; looking for a sign is far cheaper than a pattern."""

    def rules(low: Column) -> Column:
        out = markup
        for pattern, replacement, signs in PAIR_RULES:
            out = T.bind(out, _rule(pattern, replacement, _has_any(low, signs)))
        return out

    return T.bind(F.lower(markup), rules)


def _render_tags(markup: Column) -> Column:
    """All other tags at once: each ends the text before it, so a split finds them."""
    texts = T.literal_map(TAG_TEXT)
    blocks = [*BLOCK_TAGS, *[f"/{name}" for name in BLOCK_TAGS]]

    def render(piece: Column) -> Column:
        rest = F.substring(piece, F.locate(">", piece) + 1, F.length(piece))

        def by_name(name: Column) -> Column:
            return (
                F.when(name.isin(*blocks), F.concat(F.lit("\n\n"), rest))
                .when(name != "", F.concat(F.coalesce(F.try_element_at(texts, name), F.lit("")), rest))
                .when(piece.rlike(DECLARATION_PATTERN), rest)
                .otherwise(F.concat(F.lit("<"), piece))
            )

        return T.bind(F.lower(F.regexp_extract(piece, TAG_PATTERN, 1)), by_name)

    rendered = F.transform(
        F.split(markup, "<"), lambda piece, i: F.when(i == 0, piece).otherwise(render(piece))
    )
    return F.array_join(rendered, "")


def _collapse(markup: Column) -> Column:
    return F.regexp_replace(T.collapse_space(markup), *TIGHTEN_RULE)


def _render_preformatted(piece: Column) -> Column:
    """One piece that begins right after ``<pre``: fence the code, collapse the rest."""
    inside = F.regexp_extract(piece, r"(?is)^[^>]*>(.*?)(?:</pre\s*>|\z)", 1)
    after = F.regexp_extract(piece, r"(?is)^[^>]*>.*?</pre\s*>(.*)\z", 1)
    code = F.regexp_replace(inside, K.LEFTOVER_TAG_PATTERN, "")
    code = F.rtrim(code, F.lit("\n"))
    return F.concat(F.lit("\n\n```\n"), code, F.lit("\n```\n\n"), F.ltrim(_collapse(after)))


def _collapse_outside_pre(html: Column) -> Column:
    rendered = F.transform(
        F.split(html, r"(?i)<pre\b"),
        lambda piece, i: F.rtrim(
            F.when(i == 0, _collapse(piece)).otherwise(_render_preformatted(piece))
        ),
    )
    return F.array_join(rendered, "")


def _codepoint_text(codepoint: Column) -> Column:
    valid = codepoint.between(1, _MAX_CODEPOINT) & ~codepoint.between(0xD800, 0xDFFF)
    return F.when(valid, F.decode(F.unhex(F.lpad(F.hex(codepoint), 8, "0")), "UTF-32"))


def decode_references(text: Column) -> Column:
    """Replace named, decimal and hexadecimal character references, each once."""
    # A constant map is searched from its start: the usual names come first and alone.
    usual = T.literal_map({name: chr(NAMED_REFERENCES[name]) for name in sorted(name2codepoint)})
    others = {name: chr(cp) for name, cp in sorted(NAMED_REFERENCES.items()) if name not in name2codepoint}
    named = T.literal_map(others)

    def decode(piece: Column, name: Column) -> Column:
        number = F.when(
            F.lower(F.left(name, F.lit(2))) == "#x",
            F.conv(F.substring(name, 3, 6), 16, 10),
        ).when(F.left(name, F.lit(1)) == "#", F.substring(name, 2, 7))
        char = (
            F.when(name == "amp", F.lit("&"))
            .when(name == "nbsp", F.lit(chr(160)))
            .when(number.isNotNull(), _codepoint_text(number.try_cast("bigint")))
            .otherwise(F.coalesce(F.try_element_at(usual, name), F.try_element_at(named, name)))
        )
        rest = F.substring(piece, F.length(name) + 2, F.length(piece))
        return F.coalesce(
            F.when(name != "", F.concat(char, rest)), F.concat(F.lit("&"), piece)
        )

    decoded = F.transform(
        F.split(text, "&"),
        lambda piece, i: F.when(i == 0, piece).otherwise(
            T.bind(
                F.regexp_extract(piece, REFERENCE_PATTERN, 1), lambda name: decode(piece, name)
            )
        ),
    )
    return F.array_join(decoded, "")


def markup_to_markdown(html: Column) -> Column:
    """Headings, emphasis, code, links, images, lists and blocks to Markdown."""
    out = decode_references(_render_tags(T.bind(_collapse_outside_pre(html), _apply_pairs)))
    return T.js_trim(T.squeeze_newlines(out))


def drop_style_lines(markdown: Column) -> Column:
    """Remove lines that are plainly style sheet leftovers."""


    def keep(text: Column) -> Column:
        kept = F.filter(F.split(text, "\n"), lambda line: ~line.rlike(K.STYLE_LINE_PATTERN))
        # One look at the whole text spares the split in the usual case.
        return F.when(text.rlike("(?m)" + K.STYLE_LINE_PATTERN), F.array_join(kept, "\n")).otherwise(
            text
        )

    joined = T.bind(markdown, keep)
    return T.js_trim(T.squeeze_newlines(joined))


def strip_leftover_tags(markdown: Column) -> Column:
    """Remove tag-like chunks that survive conversion, decoded ones included."""
    out = T.replace_where(markdown, "<", K.LEFTOVER_TAG_PATTERN, "")
    return T.js_trim(T.replace_where(out, "<!--", K.COMMENT_PATTERN, ""))


def mail_markdown(html: Column) -> Column:
    """The whole conversion of one mail body; NULL when nothing is left."""
    cleaned = T.js_trim(clean_mail_html(html))
    markdown = strip_leftover_tags(drop_style_lines(markup_to_markdown(cleaned)))
    return T.bind(markdown, lambda md: F.when(md != "", md))
