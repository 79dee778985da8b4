"""What kind of page a row is, and how its title is written."""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column
from pyspark.sql import functions as F

from refgauge import fixed


def page_tags(title: Column, text: Column) -> dict[str, Column]:
    """One boolean column per kind of page that is not an article."""
    # The test is anchored at the start, so only that many characters are lowered.
    start = F.lower(F.substring(text, 1, len(fixed.REDIRECT_PREFIX)))
    lowered = F.lower(text)
    tags = {
        "redirect": start == fixed.REDIRECT_PREFIX,
        "disambig": F.contains(lowered, F.lit("disambig")) & lowered.rlike(fixed.DISAMBIG_PATTERN),
    }
    for tag, prefix in fixed.TITLE_PREFIXES.items():
        tags[tag] = F.startswith(F.lower(title), F.lit(prefix))
    return {tag: tags[tag] for tag in fixed.TAGS}


def first_tag(tags: dict[str, Column]) -> Column:
    """Name of the first tag that holds, in tag order; NULL for an article."""
    return F.coalesce(*[F.when(tags[tag], F.lit(tag)) for tag in fixed.TAGS])


def is_article(title: Column, text: Column) -> Column:
    """No tag holds. Titles are tested first: they are short."""
    tags = page_tags(title, text)
    order = [*fixed.TITLE_PREFIXES, "redirect", "disambig"]
    return reduce(lambda a, b: a & b, [~tags[tag] for tag in order])


def display_title(title: Column) -> Column:
    """Ends trimmed of spaces, runs of spaces made one."""
    return F.regexp_replace(_trimmed(title), " +", " ")


def url_title(title: Column) -> Column:
    """Ends trimmed of spaces, runs of spaces made an underscore."""
    return F.regexp_replace(_trimmed(title), " +", "_")


def _trimmed(title: Column) -> Column:
    return F.regexp_replace(title, r"^ +| +(?=\n?\z)", "")
