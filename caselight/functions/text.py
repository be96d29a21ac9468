"""Column functions on text: tokens, trimming, casing, HTML."""

from __future__ import annotations

import json

from collections.abc import Callable

from pyspark.sql import Column
from pyspark.sql import functions as F

# Two or more word characters make a token, as in the usual TF-IDF defaults.
NON_WORD = r"[^\p{L}\p{N}_]+"
TOKEN_CHARS = 2

def let(value: Column, use: Callable[[Column], Column]) -> Column:
    """``use(value)`` with the value worked out once per row.

    Inside the lambdas of array functions a repeated expression is evaluated at every use.
    """
    return F.get(F.transform(F.array(value), use), F.lit(0))


def word_runs(text: Column) -> Column:
    """Lower-cased runs of word characters of any length; the empty string where the text has none."""
    return F.split(F.lower(text), NON_WORD)


def tokens(text: Column) -> Column:
    """Lower-cased tokens in order, with repeats."""
    return F.filter(word_runs(text), lambda w: F.length(w) >= TOKEN_CHARS)


def words(text: Column) -> Column:
    """The pieces between white space."""
    return F.regexp_extract_all(text, F.lit(r"(?U)\S+"), F.lit(0))


def word_count(text: Column) -> Column:
    return F.regexp_count(text, F.lit(r"(?U)\S+")).cast("long")


def strip(text: Column) -> Column:
    """Trim all white space, line ends included (``trim`` takes only blanks)."""
    return F.regexp_replace(text, r"(?U)^\s+|\s+$", "")


def collapse_space(text: Column) -> Column:
    return strip(F.regexp_replace(text, r"(?U)\s+", " "))


def blank_to_null(text: Column) -> Column:
    return F.when(F.length(strip(text)) > 0, text)


def title_case(text: Column) -> Column:
    """A capital after every non-letter: ``r&d team`` gives ``R&D Team``, where ``initcap`` would not."""
    marked = F.regexp_replace(F.lower(text), r"(?<!\p{L})(?=\p{L})", "\u0001")
    parts = F.split(marked, "\u0001")
    return F.array_join(
        F.transform(
            parts,
            lambda part, i: F.when(i == 0, part).otherwise(
                F.concat(F.upper(F.substring(part, 1, 1)), F.substring(part, 2, 2**31 - 1))
            ),
        ),
        "",
    )


def named_references() -> dict[str, str]:
    """Names of HTML character references with their text, as the standard library lists them.

    Numbers 128 to 159 are read as Windows-1252, as browsers do; they are listed as ``#number``.
    """
    from html.entities import html5

    named = {name[:-1]: text for name, text in html5.items() if name.endswith(";")}
    for code in range(128, 160):
        named[f"#{code}"] = bytes([code]).decode("cp1252", "ignore") or chr(code)
    return named


_REFERENCE = r"&(#[0-9]{1,7}|#[xX][0-9a-fA-F]{1,6}|[A-Za-z][A-Za-z0-9]{1,31});"


def _code_point(code: Column) -> Column:
    """The character of a number; what is no character becomes U+FFFD."""
    bad = (code == 0) | (code > 0x10FFFF) | code.between(0xD800, 0xDFFF)
    safe = F.when(bad, F.lit(0xFFFD)).otherwise(code)
    return F.decode(F.unhex(F.lpad(F.hex(safe), 8, "0")), "UTF-32")


def decode_entities(text: Column) -> Column:
    """Every character reference that ends in a semicolon, decoded once; unknown names stay as they are."""
    names = F.from_json(F.lit(json.dumps(named_references())), "map<string,string>")

    def part(piece: Column, place: Column) -> Column:
        name = F.regexp_extract(piece, "^" + _REFERENCE, 1)
        is_hex = F.lower(F.substring(name, 2, 1)) == "x"
        code = F.when(is_hex, F.conv(F.substring(name, 3, 6), 16, 10)).otherwise(F.substring(name, 2, 7)).try_cast("int")
        key = F.when(F.startswith(name, F.lit("#")), F.concat(F.lit("#"), code.cast("string"))).otherwise(name)
        found = F.coalesce(F.try_element_at(names, key), F.when(F.startswith(name, F.lit("#")), _code_point(code)))
        rest = F.substr(piece, F.length(name) + 3)
        return F.when((name == "") | found.isNull(), piece).otherwise(F.concat(found, rest))

    pieces = F.split(text, f"(?={_REFERENCE})")
    return F.when(F.contains(text, F.lit("&")), F.array_join(F.transform(pieces, part), "")).otherwise(text)


def drop_hidden(html: Column) -> Column:
    """Cut scripts, styles and comments; a line end stays in their place."""
    return F.regexp_replace(
        html, r"(?is)<script\b.*?</script\s*>|<style\b.*?</style\s*>|<!--.*?-->", "\n"
    )


def drop_tags(html: Column, filler: str) -> Column:
    return F.regexp_replace(html, r"<[/a-zA-Z!?][^>]*>", filler)


def html_lines(html: Column) -> Column:
    """Visible text as an array of trimmed, non-empty lines."""
    visible = decode_entities(drop_tags(drop_hidden(html), "\n"))
    return F.filter(F.transform(F.split(visible, "\n"), strip), lambda line: F.length(line) > 0)


def html_to_text(html: Column) -> Column:
    return F.array_join(html_lines(html), "\n")


# Elements that end a snippet, and phrases that mark boilerplate.
BLOCK_TAGS = ["p", "h1", "h2", "h3", "h4", "h5", "h6", "li", "span", "div"]
BOILERPLATE_PHRASES = ["sign up", "sign in", "cookie", "privacy policy"]


def html_snippets(html: Column) -> Column:
    """Text between the borders of block elements, trimmed and non-empty."""
    borders = r"(?i)</?(" + "|".join(BLOCK_TAGS) + r")\b[^>]*>"
    cut = F.regexp_replace(drop_hidden(html), borders, "\u0001")
    plain = decode_entities(drop_tags(cut, ""))
    return F.filter(F.transform(F.split(plain, "\u0001"), strip), lambda s: F.length(s) > 0)


def not_boilerplate(
    snippet: Column, min_chars: int = 20, phrases: list[str] = BOILERPLATE_PHRASES
) -> Column:
    hit = F.lit(False)
    for phrase in phrases:
        hit = hit | F.contains(F.lower(snippet), F.lit(phrase))
    return (F.length(snippet) > min_chars) & ~hit


def strip_code_fence(text: Column) -> Column:
    bare = strip(text)
    bare = F.regexp_replace(bare, r"^```json|^```", "")
    return strip(F.regexp_replace(bare, r"```$", ""))


def fill_template(template: Column, fields: dict[str, Column]) -> Column:
    """Put each field where its ``{name}`` stands."""
    for name, value in fields.items():
        template = F.replace(template, F.lit("{" + name + "}"), value)
    return template
