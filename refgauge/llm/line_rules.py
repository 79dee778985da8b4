"""Line-first cleaning: rules on single lines, then on what is left of the document.

A line with words fails if
* punctuation: it has more than one symbol of `#*$%&|<>` in ten words, or three words in ten end in
  two or more exclamation or question marks, or it has 40 words or more and no sentence mark at all;
* navigation: separators cut it into four or more pieces of at most four words on average, or nearly
  all its words (of eight at most) are labels of menus;
* boilerplate: it has a fixed phrase of notices, or is equal to an earlier line of the document.
A document that loses more than half of the characters in its words is rejected, as is one with
fewer than 50 words or more than half of its words in repeated three-word windows.

Null texts have no words and are rejected, like empty ones. Rows that repeat give repeated results;
a line is only compared with lines of its own row. Further columns are left out. An empty table
gives an empty result.
"""

from __future__ import annotations

import re
from collections.abc import Iterator
from typing import NamedTuple

import pyarrow as pa
from pyspark.sql import DataFrame

from refgauge.llm.encode import small_batches
from refgauge.llm.inputs import documents_of, reachable

# White space, symbols and the limits of the base rules.
SPACE = " \t\n\x0b\x0c\r"
SYMBOLS = "#*$%&|<>"
LEAST_WORDS, WINDOW, MOST_REPEATED_PERCENT = 50, 3, 50

SEPARATORS = re.compile(r"\s[|»›•·>/]\s")
SHOUTED = re.compile(r"[!?]{2,}(?=[ \t\n\x0b\x0c\r]|$)")
SENTENCE_MARK = re.compile(r"[.!?…:;。！？]")
LABELS = frozenset(
    "home menu login logout register contact about sitemap search share next previous back top "
    "categories tags archive help faq news shop cart subscribe follow print email".split()
)
NOTICES = re.compile(
    r"(?i)accept (all )?cookies|uses cookies|privacy policy|cookie policy|terms (of (use|service)|and conditions)"
    r"|all rights reserved|enable javascript|click here|read more|sign up for our|subscribe to our"
    r"|share this (page|article|post)|follow us on|back to top|skip to (main )?content|lorem ipsum"
)
NOTICE_WORDS = 30  # a longer line that has such a phrase is prose about it


class Verdict(NamedTuple):
    n_words: int
    word_chars: int
    n_symbols: int
    n_dup_lines: int
    n_repeat_words: int
    base_failed: bool
    kept: bool
    kept_chars: int
    cleaned: str


def repeated_words(words: list) -> int:
    """Words that lie in a window of three that comes twice or more."""
    windows = list(zip(words, words[1:], words[2:]))
    if len(set(windows)) == len(windows):
        return 0
    first: dict = {}
    covered = bytearray(len(words))
    for i, window in enumerate(windows):
        j = first.setdefault(window, i)
        if j != i:
            covered[i : i + WINDOW] = covered[j : j + WINDOW] = b"\x01" * WINDOW
    return sum(covered)


def count_any(text: str, characters: str) -> int:
    return sum(map(text.count, characters))


def line_fails(line: str, n_words: int) -> bool:
    if 10 * count_any(line, SYMBOLS) > n_words:
        return True
    if 10 * len(SHOUTED.findall(line)) >= 3 * n_words:
        return True
    if n_words >= 40 and not SENTENCE_MARK.search(line):
        return True
    pieces = len(SEPARATORS.findall(line)) + 1
    if pieces >= 4 and n_words - pieces + 1 <= 4 * pieces:
        return True
    if n_words <= 8 and 5 * sum(w.strip(".,:;!?").lower() in LABELS for w in line.split()) >= 4 * n_words:
        return True
    return n_words <= NOTICE_WORDS and NOTICES.search(line) is not None


def judge(text: str) -> Verdict:
    """Everything about one document."""
    words = text.encode("utf-8", "surrogatepass").split()  # bytes split at ASCII white space only
    n_words = len(words)
    word_chars = len(text) - count_any(text, SPACE)
    repeated = repeated_words(words)
    seen: set[str] = set()
    copies = kept_chars = 0
    kept_lines = []
    for line in text.split("\n"):
        n = len(line.encode("utf-8", "surrogatepass").split())
        if not n:
            kept_lines.append(line)
            continue
        copy = line in seen
        copies += copy
        seen.add(line)
        if not copy and not line_fails(line, n):
            kept_lines.append(line)
            kept_chars += len(line) - count_any(line, SPACE)
    failed = n_words < LEAST_WORDS or 100 * repeated > MOST_REPEATED_PERCENT * n_words
    return Verdict(
        n_words, word_chars, count_any(text, SYMBOLS), copies, repeated, failed,
        not failed and 2 * kept_chars >= word_chars, kept_chars, "\n".join(kept_lines),
    )


FIELDS = {
    "n_words": pa.int64(), "word_chars": pa.int64(), "n_symbols": pa.int64(), "n_dup_lines": pa.int64(),
    "n_repeat_words": pa.int64(), "base_failed": pa.bool_(), "kept": pa.bool_(), "kept_chars": pa.int64(),
    "cleaned": pa.string(),
}
SCHEMA = (
    "doc_id bigint, n_words bigint, word_chars bigint, n_symbols bigint, n_dup_lines bigint, "
    "n_repeat_words bigint, base_failed boolean, kept boolean, kept_chars bigint"
)


def judged(docs: DataFrame, with_text: bool = True) -> DataFrame:
    """One row a document: counts, verdict, and with `with_text` the lines that stay."""
    fields = [name for name in FIELDS if with_text or name != "cleaned"]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in small_batches(batches):
            found = [judge(text or "") for text in batch.column("text").to_pylist()]
            columns = [pa.array([getattr(v, name) for v in found], FIELDS[name]) for name in fields]
            yield pa.RecordBatch.from_arrays([batch.column("doc_id"), *columns], ["doc_id", *fields])

    reachable(docs.sparkSession)
    return documents_of(docs).mapInArrow(run, SCHEMA + (", cleaned string" if with_text else ""))
