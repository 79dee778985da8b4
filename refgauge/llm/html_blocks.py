"""Main text of web pages by two passes over their blocks.

A page is cut into blocks at block-level tags. Each block knows its text, the share of it inside
links, the share of function words, and the landmark around it (article, navigation, footer, an
advert by its class, ...). The first pass decides blocks that are clear: those in boilerplate
landmarks or mostly of links are bad, long ones with many function words are good. Short blocks, and
longer ones with few function words inside an article, stay open; the second pass gives them the
label of the nearest decided block in the same landmark. Where nothing is decided there, blocks in
an article are good, and elsewhere all but short ones.

Classes, ids and forms are evidence only: an element that they call boilerplate, but that holds most
of the page's long blocks of few links, is read as if it had none of them (`wrappers`). Pages in
languages without a list of function words are told by length and links alone; wide characters, as
of Chinese, count twice there.

Null pages count as empty: text "" and 0 code points. Rows that repeat give repeated results.
Further columns are left out. An empty table gives an empty result. Markup cut off at the end of a
page counts as text no further than its last closed tag; elements left open end with the page.
"""

from __future__ import annotations

import html
import re
from collections import Counter
from collections.abc import Iterator
from typing import NamedTuple

import pyarrow as pa
from pyspark.sql import DataFrame

from refgauge.llm.encode import small_batches
from refgauge.llm.inputs import columns_of, reachable

# Element names of HTML by their part in a page, and function words of languages.
BLOCK_TAGS = frozenset(
    "address article aside blockquote body caption center dd details dialog dir div dl dt fieldset figcaption "
    "figure footer form h1 h2 h3 h4 h5 h6 head header hgroup hr html legend li main menu nav ol "
    "p pre section summary table tbody td tfoot th thead title tr ul".split()
)
UNREAD_TAGS = frozenset(
    "script style iframe textarea title noscript template svg select datalist annotation annotation-xml".split()
)
VOID_TAGS = frozenset("area base br col embed hr img input link meta source track wbr".split())
BOILERPLATE_TAGS = frozenset("nav footer aside form header dialog menu".split())
COMMENT_NAMES = frozenset("comment comments reply replies respond disqus".split())
MAIN_TAGS = frozenset("article main".split())
BOILERPLATE_ROLES = frozenset(
    "navigation banner contentinfo complementary search dialog alertdialog alert form menu menubar toolbar".split()
)
BOILERPLATE_NAMES = frozenset(
    "ad ads adv advert adverts advertisement advertising banner sponsor sponsored promo promotion cookie cookies "
    "consent gdpr notice notices popup modal overlay newsletter subscribe subscription signup login share sharing "
    "social related recommended recommendations sidebar widget widgets menu nav navbar navigation breadcrumb "
    "breadcrumbs pagination pager footer header masthead toolbar comment comments reply replies respond disqus "
    "copyright legal disclaimer search form skip hidden tags".split()
)
FUNCTION_WORDS = {
    "en": "the of and to a in is it that for on with as was be are this by from at or an not have has had but they you "
    "which his her he she we all there their been were will would can if so no one more who what when out up into",
    "de": "der die das und in den von zu mit sich des auf für ist im dem nicht ein eine als auch es an werden aus er hat "
    "dass sie nach wird bei einer um am sind noch wie einem über einen so zum war haben nur oder aber vor zur bis",
    "fr": "le la les de des du et en un une que est pour qui dans par plus pas au sur se ne ce il sont avec son aux ou "
    "elle cette d l ont mais comme être nous vous leur fait été deux même ses était tout si sa lui je on",
    "es": "el la los las de y en que un una es por con para no se del al lo como más o pero sus le ha me si sin sobre "
    "este ya entre cuando todo esta ser son dos también fue había era muy años hasta desde está mi porque su",
}
FUNCTION_WORDS = {language: frozenset(words.split()) for language, words in FUNCTION_WORDS.items()}

SHORT, LONG = 70, 140  # characters
MANY, SOME = 0.28, 0.15  # share of function words
MOST_LINKED, FEW_LINKED = 0.5, 0.25
LISTED = 0.2  # least share in long blocks at which a page is taken for one in a language with a list
ALONE = 3  # long blocks that an element must hold to be read, unless it holds half of all blocks

TAG = re.compile(r"<(/?)([A-Za-z][A-Za-z0-9:-]*+)")
REST_OF_TAG = re.compile(r"""(?:[^>"']++|"[^"]*+"|'[^']*+')*+>""")
ATTRIBUTE = re.compile(r"""(?i)\b(class|id|role|lang|style|aria-hidden)\s*+=\s*+("[^"]*+"|'[^']*+'|[^\s>]++)|\s(hidden)(?=[\s/>=]|$)""")
UNREAD_ENDS = {tag: re.compile(rf"(?i)</{tag}(?=[\s/>])[^>]*+>") for tag in UNREAD_TAGS}
WIDE = re.compile("[\u1100-\u11ff\u2e80-\ua4cf\uac00-\ud7af\uf900-\ufaff\uff01-\uff60\U00020000-\U0003ffff]")
LATIN = re.compile("[A-Za-z\u00c0-\u024f]")
NOT_LETTERS = re.compile(r"[^a-z]+")
EDGES = "".join(map(chr, [*range(33, 48), *range(58, 65), *range(91, 97), *range(123, 127)])) + "«»„“”‘’…¿¡"


class Landmark(NamedTuple):
    tag: str
    kind: str  # main, boilerplate or body
    number: int
    soft: bool = False  # boilerplate by its class, its id or as a form


class Block(NamedTuple):
    text: str
    linked: float
    landmark: Landmark


def pieces(page: str) -> Iterator[tuple[str, str, str]]:
    """(kind, name, rest) of texts, opening and closing tags; unread elements and comments are left out."""
    at, n = 0, len(page)
    while at < n:
        start = page.find("<", at)
        if start < 0:
            yield "text", page[at:], ""
            return
        if start > at:
            yield "text", page[at:start], ""
        if page.startswith("<!--", start):
            end = page.find("-->", start + 4)
            at = n if end < 0 else end + 3
        elif page.startswith(("<!", "<?"), start):
            end = page.find(">", start)
            at = n if end < 0 else end + 1
        elif tag := TAG.match(page, start):
            rest = REST_OF_TAG.match(page, tag.end())
            end = rest.end() if rest else page.find(">", tag.end()) + 1
            if not end:
                return
            name = tag[2].lower()
            yield ("close" if tag[1] else "open"), name, page[tag.end() : end - 1]
            at = end
            if not tag[1] and name in UNREAD_ENDS and not page.endswith("/>", start, end):
                close = UNREAD_ENDS[name].search(page, end)
                at = close.end() if close else n if name in ("script", "style") else end
        else:
            yield "text", "<", ""
            at = start + 1


def attributes(rest: str) -> dict[str, str]:
    found = {}
    for name, value, hidden in ATTRIBUTE.findall(rest):
        if hidden:
            found["hidden"] = ""
        else:
            found.setdefault(name.lower(), value.strip("\"'").lower())
    return found


def landmark(tag: str, rest: str, outer: Landmark, number: int, overruled: frozenset[int] = frozenset()) -> Landmark | None:
    """The landmark that an element opens, if it opens one; class, id and form do not if overruled."""
    soft = number not in overruled
    if tag in MAIN_TAGS:
        inside_comment = outer.kind == "boilerplate" and outer.tag == "comment"
        return Landmark("comment", "boilerplate", number, True) if inside_comment else Landmark(tag, "main", number)
    if tag in BOILERPLATE_TAGS and (tag != "form" or soft):
        # An article's own header has its title.
        return None if tag == "header" and outer.kind == "main" else Landmark(tag, "boilerplate", number, tag == "form")
    if not rest or tag in ("body", "html"):
        return None
    own = attributes(rest)
    if "hidden" in own or own.get("aria-hidden") == "true" or "display:none" in own.get("style", "").replace(" ", ""):
        return Landmark(tag, "boilerplate", number)
    if own.get("role") == "main":
        return Landmark(tag, "main", number)
    if own.get("role") in BOILERPLATE_ROLES and (own["role"] != "form" or soft):
        return Landmark(tag, "boilerplate", number, own["role"] == "form")
    names = set(NOT_LETTERS.split(own.get("class", "") + " " + own.get("id", ""))) & BOILERPLATE_NAMES
    if outer.kind == "main":
        names -= {"header", "form", "notice", "legal", "tags", "hidden"}
    if not names or not soft:
        return None
    return Landmark("comment" if names & COMMENT_NAMES else tag, "boilerplate", number, True)


def width(text: str) -> int:
    return len(text) if text.isascii() else len(text) + len(WIDE.findall(text))


def clear(block: Block) -> bool:
    """Whether a block is long and has few links."""
    return width(block.text) >= LONG and block.linked <= FEW_LINKED


def wrappers(blocks: list[Block], inside: dict[Landmark, Landmark]) -> frozenset[int]:
    """The soft landmarks that hold most of the page's clear blocks, those of comments if all of them.

    Blocks in other boilerplate do not count, and nothing is a wrapper beside an article that has
    clear blocks. inside: the landmark around each one.
    """
    every: Counter[Landmark] = Counter(b.landmark for b in blocks)
    body = Landmark("body", "body", 0)
    long = Counter(b.landmark for b in blocks if clear(b))
    main = Counter({mark: n for mark, n in long.items() if mark.kind == "main"})
    for mark in sorted(inside, key=lambda mark: -mark.number):  # inner ones first
        outer = inside[mark]
        every[outer] += every[mark]
        if mark.kind != "boilerplate" or mark.soft:
            long[outer] += long[mark]
            main[outer] += main[mark]
    return frozenset(
        mark.number for mark in inside
        if mark.soft and main[mark] == main[body]
        and (long[mark] == long[body] if mark.tag == "comment" else 2 * long[mark] > long[body])
        and long[mark] >= (1 if 2 * every[mark] >= every[body] else ALONE)
    )


def blocks_of(page: str) -> tuple[list[Block], str]:
    """The blocks with text in page order, and the language that the page states."""
    found, language, inside = read(page, frozenset())
    if any(mark.soft for mark in inside):
        overruled = wrappers(found, inside)
        if overruled:
            found, language, _ = read(page, overruled)
    return found, language


def read(page: str, overruled: frozenset[int]) -> tuple[list[Block], str, dict[Landmark, Landmark]]:
    """The blocks, the language, and the landmark around each landmark."""
    body = Landmark("body", "body", 0)
    stack: list[tuple[str, Landmark]] = []  # open elements and the landmark inside each
    n_open: Counter[str] = Counter()
    here, language, opened = body, "", 0
    text: list[str] = []
    linked = in_link = 0
    found: list[Block] = []
    inside: dict[Landmark, Landmark] = {}

    def end_block() -> None:
        nonlocal text, linked, in_link
        joined = " ".join("".join(text).split())
        if joined:
            found.append(Block(joined, min(linked / len(joined), 1.0), here))
        text, linked, in_link = [], 0, 0

    def leave(name: str) -> None:
        """Closes the innermost element of that name and those inside it."""
        nonlocal here
        while n_open[name]:
            gone = stack.pop()[0]
            n_open[gone] -= 1
            if gone == name:
                break
        here = stack[-1][1] if stack else body

    for kind, name, rest in pieces(page):
        if kind == "text":
            own = html.unescape(name) if "&" in name else name
            text.append(own)
            linked += in_link and len(own.strip())
        elif kind == "close":
            if name in BLOCK_TAGS:
                end_block()
            if name == "a":
                in_link = 0
            if n_open[name]:
                before = here
                leave(name)
                if here != before:  # the text so far belongs to the landmark that ends
                    after, here = here, before
                    end_block()
                    here = after
        else:
            if name in BLOCK_TAGS:
                end_block()
                if n_open["p"]:  # a block ends the paragraph before it
                    leave("p")
            if name == "br":
                text.append(" ")
            elif name == "a":
                in_link = 1
            elif name == "html":
                language = attributes(rest).get("lang", "")[:2]
            if name in VOID_TAGS:
                continue
            opened += 1
            inner = landmark(name, rest, here, opened, overruled)
            if inner:
                inside[inner] = here
                end_block()
                in_link = name == "a"
            stack.append((name, inner or here))
            n_open[name] += 1
            here = stack[-1][1]
    end_block()
    return found, language, inside


def function_share(words: list[str], language: str) -> float:
    own = FUNCTION_WORDS[language]
    return sum(w in own for w in words) / len(words) if words else 0.0


def listed(blocks: list[Block], bare: list[list[str]], stated: str) -> str | None:
    """The language whose function words tell the blocks of a page, if there is a list for its own.

    A stated language holds, but for one in Latin letters where most letters of the long blocks are not.
    """
    long = [k for k, b in enumerate(blocks) if clear(b) and b.landmark.kind != "boilerplate"]
    text = "".join(blocks[k].text for k in long)
    if not text.isascii():
        letters = sum(map(str.isalpha, text))
        if 2 * len(LATIN.findall(text)) < letters:
            return None
    if stated and stated.isalpha():
        return stated if stated in FUNCTION_WORDS else None
    every = [w for k in long for w in bare[k]]
    best = max(FUNCTION_WORDS, key=lambda name: function_share(every, name))
    return best if function_share(every, best) >= LISTED else None


def labels(blocks: list[Block], language: str) -> list[bool]:
    """Whether each block is main text."""
    bare = [[w.strip(EDGES).lower() for w in b.text.split()] for b in blocks]
    own_language = listed(blocks, bare, language)
    decided: list[bool | None] = []
    for block, words in zip(blocks, bare):
        share = function_share(words, own_language) if own_language else 0.0
        main = block.landmark.kind == "main"
        if block.landmark.kind == "boilerplate" or block.linked > MOST_LINKED and not main:
            decided.append(False)
        elif block.linked > MOST_LINKED:  # lists of links belong to the article they stand in
            decided.append(None)
        elif not own_language:
            long = width(block.text) >= (SHORT if block.landmark.kind == "main" else LONG)
            decided.append(True if long and block.linked <= FEW_LINKED else None)
        elif len(block.text) < SHORT:
            decided.append(None)
        elif share >= MANY and len(block.text) >= LONG or share >= SOME and block.landmark.kind == "main":
            decided.append(True)
        elif share >= SOME or block.landmark.kind == "main":
            decided.append(None)
        else:
            decided.append(False)
    n = len(blocks)
    places: list[dict[bool, int]] = [{} for _ in blocks]  # distance to the nearest of each label
    for order in (range(n), range(n - 1, -1, -1)):
        last: dict[Landmark, int] = {}
        for k in order:
            own = blocks[k].landmark
            if decided[k] is not None:
                last[own] = k
            elif own in last:
                label, far = decided[last[own]], abs(last[own] - k)
                places[k][label] = min(places[k].get(label, n), far)
    return [inherited(blocks[k], places[k], n) if label is None else label for k, label in enumerate(decided)]


def inherited(block: Block, nearest: dict[bool, int], far: int) -> bool:
    """The label of the nearest decided block of the same landmark; the good one if both are as near."""
    if not nearest:
        return block.landmark.kind == "main" or len(block.text) >= SHORT
    return nearest.get(True, far) <= nearest.get(False, far)


def main_text(page: str) -> str:
    blocks, language = blocks_of(page)
    return "\n".join(b.text for b, good in zip(blocks, labels(blocks, language)) if good)


def extracted(pages: DataFrame) -> DataFrame:
    """page_id, url, main text and its number of code points."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in small_batches(batches, "html"):
            texts = [main_text(page or "") for page in batch.column("html").to_pylist()]
            yield pa.RecordBatch.from_arrays(
                [batch.column("page_id"), batch.column("url"), pa.array(texts, pa.string()),
                 pa.array(map(len, texts), pa.int64())],
                ["page_id", "url", "text", "n_chars"],
            )

    reachable(pages.sparkSession)
    rows = columns_of(pages, ("page_id", "bigint"), ("url", "string"), ("html", "string"))
    return rows.mapInArrow(run, "page_id bigint, url string, text string, n_chars bigint")
