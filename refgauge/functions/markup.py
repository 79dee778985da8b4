"""Counts of wiki markup in a text column. Every function maps a Column to a Column.

NULL text gives NULL. All patterns run in time linear in the text for ordinary pages, and
none recurses per character or per line, so a page of any size fits the default stack:
quantified groups are possessive wherever the next character decides alone, because Java
walks those in a loop and the others by recursion.
"""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column
from pyspark.sql import functions as F

from refgauge import fixed

_RUN = fixed.PLAIN + "++"
_HOST = r"https?://(?:[-\w.]++|%[\da-fA-F]{2})++"

# Line ends as Java's dot sees them; the dot stops at each of them.
_EOL = r"\n\r\u0085  "
_END = rf"(?:\r\n|[{_EOL}])"
# Marks, both noncharacters: an opening brace with which no template starts, and a place before
# a line end that no template reaches over.
_INNER, _CUT = "﷑", "﷒"
_BRACE = rf"[{{{_INNER}]"
_BARE = rf"[^{{}}{_INNER}{_CUT}{_EOL}]*+"
# A line within a template: no braces, or first brace pair opens and last one closes.
_INSIDE = rf"{_BARE}(?:{_BRACE}{_BRACE}(?>.*\}}\}}){_BARE})?+"
_LINE = _INSIDE + _END
# A line of that kind which may also be the last one of its template.
_EITHER = rf"{_BARE}{_BRACE}{_BRACE}.*\}}\}}{_BARE}\}}\}}"
_NEWLINE = rf"{_CUT}?+\n"

# What the inside of a template begins with: its end, or a pair of braces closed on its line.
_CLOSES = rf"(?=[^{{}}{_INNER}{_CUT}]*+(?:\}}\}}|{_BRACE}{_BRACE}.*\}}\}}))"

# A template followed by a newline, up to the latest line on which it can close: either on
# the first line that cannot belong to its inside, or on the last ambiguous line before that.
TEMPLATE_BLOCK = (
    rf"\{{{_BRACE}{_CLOSES}(?:(?:{_LINE})*+{_BARE}\}}\}}(?:{_NEWLINE})++"
    rf"|(?:(?:(?!{_EITHER}{_NEWLINE}){_LINE})*+{_EITHER}{_NEWLINE})++(?:{_NEWLINE})*+)"
)
# A template that closes at the end of the text (or before its final line end).
TEMPLATE_TAIL = rf"\{{{_BRACE}{_CLOSES}(?:{_LINE}(?!\n?\z))*+(?:{_BARE}\}}\}}|{_EITHER}){_CUT}?+$"
# How the last line of either kind looks from its start.
_CLOSING = rf"{_BARE}(?:{_BRACE}{_BRACE}.*\}}\}}{_BARE})?\}}\}}"
BLOCK_END, TAIL_END = rf"{_CLOSING}\n", rf"{_CLOSING}$"

# An opening that no closing braces follow on its line, or not as the next ones; and how many of
# them a text may have without marks.
_REACHES = rf"\{{(?=\{{[^{{}}{_EOL}]*+(?!\}}\}}))"
FEW = 16

# An opening whose next braces open too, on its line.
_NESTS = rf"\{{(?=\{{[^{{}}{_EOL}]*+\{{\{{)"
_SIMPLE = rf"[^{{{_EOL}]*+(?:(?!{_NESTS})\{{[^{{{_EOL}]*+)*+"
_UNOPENED = rf"[^{{{_EOL}]*+(?:\{{(?!{_BRACE})[^{{{_EOL}]*+)*+"
_OPENED = rf"{_UNOPENED}\{{[^{_EOL}]*+"


def _mark_inner(text: Column) -> Column:
    """Marks the openings of a line whose next braces open too, but for the first of them.

    They reach the end of their line as the first one does, with less before it, so where it starts
    no template neither do they. One opening a line looks through the rest of the line that way.
    """
    return F.regexp_replace(text, rf"((?:(?m:^){_SIMPLE}\{{|\G(?!(?m:^))){_SIMPLE}){_NESTS}", f"$1{_INNER}")


def _mark_cuts(text: Column, closing: str) -> Column:
    """Marks the ends of lines with openings after which lines do not lead on to a closing one.

    One match goes over everything up to the next mark: lines without openings, and openings whose
    closing line is found. From a mark on, all lines up to the first that ends the inside of any template
    lead nowhere as well, so their openings are marked without a look ahead. Each line is gone through a few times.
    """
    idle = rf"(?:(?!{_OPENED}){_LINE})*+"
    found = rf"{_OPENED}{_END}(?:(?!{closing}){_LINE})*+(?={closing})"
    more = rf"(?!(?m:^)){_END}{idle}"
    pattern = (
        rf"\G({more}(?={_OPENED}){_INSIDE}(?={_END})"
        rf"|(?:{more})?+(?:{_UNOPENED}{_END}|{found})*+{_OPENED}(?={_END}))"
    )
    return F.regexp_replace(text, pattern, f"$1{_CUT}")


def replace_templates(text: Column, template: str, closing: str, by: str, few: int = FEW) -> Column:
    """Each match of a template pattern replaced, in time linear in the text; `closing` is the pattern's last line.

    Marks change no result. Only openings that reach beyond their own closing braces may look through
    the text in vain, so up to `few` of them go without.
    """
    many = F.regexp_count(text, F.lit(_REACHES)) > few
    marked = F.when(many, _mark_cuts(_mark_inner(text), closing)).otherwise(text)
    replaced = F.regexp_replace(marked, template, by)
    return F.replace(F.replace(replaced, F.lit(_INNER), F.lit("{")), F.lit(_CUT), F.lit(""))


def without_templates(text: Column) -> Column:
    """Each template that ends its line or the text, replaced by a blank line."""
    blocks = replace_templates(text, TEMPLATE_BLOCK, BLOCK_END, "\n\n")
    return replace_templates(blocks, TEMPLATE_TAIL, TAIL_END, "\n\n")


def _link_before(end: str) -> str:
    """A double-bracketed link before `end`, and in group 1 all that lies between the last
    match and this one. Links that are not closed are passed over in one go, not bracket by bracket.
    """
    other = rf"[^\[]++|\[(?!\[)|\[\[[^\]]*+(?!\]\]{end})"
    return rf"\G((?:{other})*+)\[\[[^\]]*+\]\]{end}"


def _count(text: Column, pattern: str, needle: str | None = None) -> Column:
    """Matches of `pattern`; texts without `needle`, which every match holds, skip the regex."""
    matches = F.regexp_count(text, F.lit(pattern))
    if needle is None:
        return matches
    return F.when(~F.contains(text, F.lit(needle)), F.lit(0)).otherwise(matches)


def n_words(text: Column) -> Column:
    """Pieces between single spaces: one more than there are spaces."""
    spaces = F.octet_length(text) - F.octet_length(F.replace(text, F.lit(" "), F.lit("")))
    return spaces + 1


def heading_count(text: Column, level: int) -> Column:
    """Headings of a level, and of deeper ones; none with `links` behind it, nor `References`.

    What precedes the last `links` of a line is cut off first, once for all levels, so that no
    heading has to look through the rest of its line.
    """
    if level not in fixed.HEADING_LEVELS:
        raise ValueError(f"heading level {level} is not one of {fixed.HEADING_LEVELS}")
    cut = F.regexp_replace(text, "(?m)^.*[Ll]inks", "")
    seen = F.when(F.contains(text, F.lit("inks")), cut).otherwise(text)
    return _count(seen, rf"={{{level}}}(?!References){_RUN}={{{level}}}", "=" * level)


def heading_count_v1(text: Column, level: int) -> Column:
    """Headings of a level and of deeper ones, whatever they say."""
    if level not in fixed.HEADING_LEVELS:
        raise ValueError(f"heading level {level} is not one of {fixed.HEADING_LEVELS}")
    return _count(text, rf"={{{level}}}{_RUN}={{{level}}}", "=" * level)


def citation_count(text: Column, source: str, any_case: bool = True, space: bool = False) -> Column:
    """`{cite <source> ...}` that closes on its line.

    `any_case` folds case as Unicode does; `space` wants a space after the source name.
    """
    flags = "(?iu)" if any_case else ""
    gap = " " if space else ""
    return _count(text, rf"{flags}\{{cite {source}{gap}[^}}\n]*+\}}", "{")


def n_internal_links(text: Column) -> Column:
    """`[[A]]`, `[[A|B]]` and `[[A#C|B]]` with plain names."""
    return _count(text, rf"\[\[{_RUN}(?:(?:#{_RUN})?\|{_RUN})?\]\]", "[[")


def n_external_links(text: Column) -> Column:
    """Addresses, bare or in brackets; a labeled one joined to a named reference is one match."""
    pair = rf'\[{_HOST} {_RUN}\]<ref name="{_RUN}">\[{_HOST}\]'
    return _count(text, rf"{_HOST}|\[{_HOST}\]|{pair}", "http")


def n_unreferenced(text: Column) -> Column:
    """`{{cn}}` marks and references of plain words only."""
    matches = F.regexp_count(text, F.lit(rf"\{{\{{cn\}}\}}|<ref>{_RUN}</ref>"))
    possible = F.contains(text, F.lit("{{cn}}")) | F.contains(text, F.lit("<ref>"))
    return F.when(~possible, F.lit(0)).otherwise(matches)


def n_categories(text: Column) -> Column:
    return _count(text, r"\[\[:?Category:[a-zA-Z0-9.,\-!?\(\) ]++\]\]", "Category:")


def n_images(text: Column) -> Column:
    """Brackets around exactly eight plain parts."""
    return _count(text, rf"\[{_RUN}(?:\|{_RUN}){{7}}\]", "[")


def n_paragraphs(text: Column) -> Column:
    """Blocks of prose, less one.

    So a text with one block has 0, and one with none has -1; averages over it follow suit.
    """
    before = (
        # blocks that stand alone between blank lines
        (r"\n(?<!\n\n)\n++(?:\{\{[^}]*+\}\}|\[\[[^\]]*+\]\]|={1,7}.*={1,7})\n\n++", "\n\n"),
        # everything from these sections on
        (r"(?s)==References==.*+", "\n\n"),
        (r"(?s)==External [lL]inks==.*+", "\n\n"),
    )
    after = (
        (_link_before(r"\n++"), "$1\n\n"),
        (_link_before("$"), "$1\n\n"),
    )
    replaced = lambda c, steps: reduce(lambda c, step: F.regexp_replace(c, *step), steps, c)
    prose = replaced(without_templates(replaced(text, before)), after)
    return F.size(F.array_remove(F.split(prose, r"\n\n+"), "")) - 1


def n_paragraphs_v1(text: Column) -> Column:
    """Blank lines left once marked-up blocks between blank lines are cut out."""
    blocks = r"\n\n\{\{.*\}\}\n\n|\n\n\[\[.*\]\]\n\n|\n\n={1,7}.*={1,7}\n\n"
    return _count(F.regexp_replace(text, blocks, ""), r"\n\n")


def per_paragraph(links: Column, paragraphs: Column) -> Column:
    return links / (paragraphs + F.lit(fixed.EPS))


def split_digits(text: Column) -> Column:
    return F.split(text, "[0-9]+")


def n_level4_pieces(text: Column) -> Column:
    """Pieces between runs of four equal signs."""
    return _count(text, "====", "====") + 1


def first_lines(text: Column, n: int = 5) -> Column:
    return F.substring_index(text, "\n", n)
