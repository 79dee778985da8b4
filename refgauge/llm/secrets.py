"""Secret scans: keywords first, patterns only where a keyword stands, checksums last.

An Aho-Corasick automaton over the ASCII lower-cased bytes finds all keywords in one pass; each
hit is then tried with a pattern anchored at it. Runs of hexadecimal digits have no keyword: one of
32 or more covers two neighbouring places of a grid of step 16, so the grid is looked at and the
run around such a pair is measured. Added kinds (access tokens of code hosts with a checksum, card
numbers, bank account numbers, private keys, web tokens) count only if the checksum or structure
that they carry holds. Cards and bank accounts are also looked for where they do not follow their
keyword directly but start within `NEAR` bytes after it; the span is then the number alone.

Within a kind, matches are leftmost and do not overlap, as if the pattern had been run over the
whole text; numbers near a keyword fill what is left. Spans are in code points, the end exclusive. Null texts count as empty: no spans.
Repeated rows give repeated results; further columns are left out; an empty table gives an empty
result.
"""

from __future__ import annotations

import base64
import binascii
import hashlib
import json
import re
import zlib
from bisect import bisect_left
from collections.abc import Callable, Iterator
from typing import NamedTuple

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame

from refgauge.llm.encode import small_batches
from refgauge.llm.inputs import documents_of, mapped, reachable

DIGITS = "0123456789ABCDEFGHIJKLMNOPQRSTUVWXYZabcdefghijklmnopqrstuvwxyz"


def code_host_token(found: bytes) -> bool:
    """The last six characters are the CRC-32 of the thirty after the prefix, in base 62."""
    body, check = found[4:34], found[34:40].decode()
    value, digits = zlib.crc32(body), ""
    while value:
        value, digit = divmod(value, 62)
        digits = DIGITS[digit] + digits
    return digits.rjust(6, "0") == check


def luhn(found: bytes) -> bool:
    digits = [c - 48 for c in found if 48 <= c < 58][::-1]
    doubled = sum(sum(divmod(2 * d, 10)) for d in digits[1::2])
    return 13 <= len(digits) <= 19 and len(set(digits)) > 1 and (sum(digits[::2]) + doubled) % 10 == 0


def bank_account(found: bytes) -> bool:
    """Letters as numbers from 10 on, country and check digits last: 1 modulo 97."""
    code = found.replace(b" ", b"").decode()
    return 15 <= len(code) <= 34 and int("".join(str(int(c, 36)) for c in code[4:] + code[:4])) % 97 == 1


def web_token(found: bytes) -> bool:
    """The first part is JSON with an algorithm, in URL-safe base 64."""
    head = found.split(b".")[0]
    try:
        return "alg" in json.loads(base64.urlsafe_b64decode(head + b"=" * (-len(head) % 4)))
    except (ValueError, TypeError, binascii.Error):
        return False


def crc24(data: bytes) -> int:
    """The checksum of armored keys. Start and polynomial are fixed values."""
    crc = 0xB704CE
    for byte in data:
        crc ^= byte << 16
        for _ in range(8):
            crc = crc << 1 ^ (0x1864CFB if crc & 0x800000 else 0)
    return crc


def whole_der(data: bytes) -> bool:
    """A sequence whose stated length is that of the data."""
    if len(data) < 2 or data[0] != 0x30:
        return False
    more = data[1] - 0x80 if data[1] > 0x80 else 0
    size = int.from_bytes(data[2 : 2 + more], "big") if more else data[1]
    return data[1] != 0x80 and more < 5 and size == len(data) - 2 - more


def private_key(found: bytes) -> bool:
    """The body is a whole DER sequence or OpenSSH key, whole cipher blocks, or agrees with its CRC-24."""
    lines = [line.strip() for line in re.split(rb"\\+[nrt]|[\r\n]", found)]
    told = [line for line in lines[1:-1] if b":" in line]
    body = [line for line in lines[1:-1] if line and b":" not in line]
    if len(lines) == 1:  # all on one line
        body = [found.split(b"-----")[2].strip()]
    sums = [line[1:] for line in body if line.startswith(b"=") and len(line) == 5]
    try:
        data = base64.b64decode(b"".join(b"".join(line.split()) for line in body if not line.startswith(b"=")), validate=True)
        if sums:
            return crc24(data) == int.from_bytes(base64.b64decode(sums[0], validate=True), "big")
    except binascii.Error:
        return False
    ciphered = any(b"ENCRYPTED" in line for line in told)
    return whole_der(data) or data.startswith(b"openssh-key-v1\0") or (ciphered and len(data) >= 8 and len(data) % 8 == 0)


class Kind(NamedTuple):
    name: str
    keywords: tuple[bytes, ...]  # lower case; the pattern starts where one of them does
    pattern: re.Pattern[bytes]
    valid: Callable[[bytes], bool]
    group: int = 0
    begins: re.Pattern[bytes] | None = None  # where numbers near a keyword may begin, and the longest
    longest: re.Pattern[bytes] | None = None


# The kinds that every scan reports, with their patterns and least lengths.
ASSIGN = Kind(
    "assign", (b"password", b"passwd", b"secret", b"token", b"apikey", b"api_key"),
    re.compile(rb"""(password|passwd|secret|token|api_?key)["']?\x20*[:=]\x20*["']?([A-Za-z0-9+/_.=-]+)""", re.I),
    lambda value: len(value) >= 8, 2,
)
ACCESS = Kind("access", (b"akia",), re.compile(rb"AKIA[A-Z0-9]+"), lambda found: len(found) >= 16)
HEX, HEX_LENGTH = "hex", 32

NEAR = 64  # bytes after a keyword in which a number may begin
NEWLINES = rb"(?:\s|\\++[nrt])*+"  # also as JSON and string literals write them

#: Kinds added to those; their patterns are anchored at the keyword as well.
ADDED = (
    Kind("code_host", (b"ghp_", b"gho_", b"ghu_", b"ghs_", b"ghr_"),
         re.compile(rb"gh[pousr]_[A-Za-z0-9]{36}(?![A-Za-z0-9])"), code_host_token),
    Kind("web_token", (b"eyj",),
         re.compile(rb"(?<![A-Za-z0-9_-])eyJ[A-Za-z0-9_-]++\.eyJ[A-Za-z0-9_-]++\.[A-Za-z0-9_-]++"), web_token),
    Kind("private_key", (b"-----begin ",),
         re.compile(
             rb"-----BEGIN [A-Z ]{0,30}PRIVATE KEY(?: BLOCK)?-----" + NEWLINES
             + rb"(?:[A-Za-z][A-Za-z0-9-]{0,40}+:(?:[^\r\n\\]|\\(?![nr\\])){0,300}+" + NEWLINES + rb")*+"
             + rb"(?:[A-Za-z0-9+/=\s]|\\++[nrt])++-----END [A-Z ]{0,30}PRIVATE KEY(?: BLOCK)?-----"),
         private_key),
    Kind("iban", (b"iban",), re.compile(rb"(?i:iban)[:\x20]{1,3}([A-Z]{2}[0-9]{2}(?:\x20?[A-Z0-9]{4}){2,7}(?:\x20?[A-Z0-9]{1,3})?)(?![A-Za-z0-9])"), bank_account, 1,
         re.compile(rb"(?<![A-Za-z0-9])[A-Z]{2}[0-9]{2}"), re.compile(rb"[A-Z]{2}[0-9]{2}(?:\x20?[A-Z0-9]){11,30}")),
    Kind("card", (b"card",), re.compile(rb"(?i:card)(?:\x20?(?i:number|no\.?))?[:#=\x20]{1,3}([0-9](?:[ -]?[0-9]){12,18})(?![0-9])"), luhn, 1,
         re.compile(rb"(?<![A-Za-z0-9])[0-9]"), re.compile(rb"[0-9](?:[ -]?[0-9]){12,18}")),
)
ORDER = (ASSIGN.name, ACCESS.name, HEX, *(kind.name for kind in ADDED))

_hex = np.zeros(256, bool)
_hex[list(b"0123456789abcdef")] = True
_hex_run = re.compile(rb"[0-9a-f]+")
_automaton = None


def automaton():
    """Keywords to the kinds they may start; bytes are read as characters of the same number."""
    global _automaton
    if _automaton is None:
        import ahocorasick

        _automaton = ahocorasick.Automaton()
        for kind in (ASSIGN, ACCESS, *ADDED):
            for word in kind.keywords:
                _automaton.add_word(word.decode("latin-1"), (kind, len(word)))
        _automaton.make_automaton()
    return _automaton


def hex_runs(data: bytes) -> Iterator[tuple[int, int]]:
    step = HEX_LENGTH // 2
    grid = _hex[np.frombuffer(data, np.uint8)[::step]]
    end = 0
    for place in np.flatnonzero(grid[:-1] & grid[1:]).tolist():
        at = place * step
        if at < end:
            continue
        start = at
        while start > end and _hex[data[start - 1]]:
            start -= 1
        end = _hex_run.match(data, at).end()
        if end - start >= HEX_LENGTH:
            yield start, end


def near(kind: Kind, data: bytes, start: int, after: int) -> Iterator[tuple[int, int]]:
    """The valid numbers of a kind that begin within `NEAR` bytes from start, and not before `after`."""
    # A beginning may reach over the window's end, as far as the pattern is long.
    for begin in kind.begins.finditer(data, start, start + NEAR + 4):
        at = begin.start()
        longest = kind.longest.match(data, at) if after <= at < start + NEAR else None
        if longest:
            for end in range(longest.end(), at + 12, -1):
                if data[end - 1 : end].isalnum() and not data[end : end + 1].isalnum() and kind.valid(data[at:end]):
                    yield at, end
                    after = end
                    break


def byte_spans(data: bytes) -> list[tuple[int, int, str]]:
    """(start, end, kind) in bytes, by start and then the order of kinds."""
    spans = [(a, b, HEX) for a, b in hex_runs(data)]
    ends: dict[str, int] = {}
    found = automaton().iter(data.lower().decode("latin-1"))
    hits = sorted(((last - n + 1, n, kind) for last, (kind, n) in found), key=lambda hit: hit[0])
    for start, _, kind in hits:
        if start < ends.get(kind.name, 0):
            continue
        match = kind.pattern.match(data, start)
        if match:
            ends[kind.name] = match.end()
            if kind.valid(match[kind.group]):
                spans.append((start, match.end(), kind.name))
    for kind in ADDED:
        if kind.begins and any(k is kind for _, _, k in hits):
            direct = [(a, b) for a, b, name in spans if name == kind.name]
            starts, end = [a for a, _ in direct], 0
            for start, n, hit in hits:
                for a, b in near(kind, data, start + n, end) if hit is kind else ():
                    before = bisect_left(starts, b) - 1
                    if before < 0 or direct[before][1] <= a:
                        spans.append((a, b, kind.name))
                    end = b
    return sorted(spans, key=lambda span: (span[0], ORDER.index(span[2])))


def spans_of(text: str) -> list[tuple[str, int, int]]:
    """(kind, start, end) in code points."""
    data = text.encode("utf-8", "surrogatepass")
    spans = byte_spans(data)
    if spans and len(data) > len(text):
        starts = (np.frombuffer(data, np.uint8) & 0xC0) != 0x80
        before = np.concatenate([[0], np.cumsum(starts)])
        spans = [(int(before[a]), int(before[b]), kind) for a, b, kind in spans]
    return [(kind, a, b) for a, b, kind in spans]


def told(spans: list[tuple[str, int, int]]) -> str:
    return ",".join(f"{kind}:{a}:{b}" for kind, a, b in spans)


def masked(text: str, spans: list[tuple[str, int, int]]) -> str:
    """The text with every span (or union of spans that overlap) replaced by its first kind."""
    out, at = [], 0
    for kind, a, b in spans:
        if a >= at:
            out += [text[at:a], f"[{kind}]"]
        at = max(at, b)
    return "".join(out) + text[at:]


RESULT = (
    "doc_id bigint, n_assign bigint, n_access bigint, n_hex bigint, base_sha256 string, spans string"
)


def scan(docs: DataFrame) -> DataFrame:
    """One row a document: spans, their counts, and a digest of the base spans."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        base_kinds = ORDER[:3]
        for batch in small_batches(batches):
            counts, digests, listed = [[], [], []], [], []
            for text in batch.column("text").to_pylist():
                spans = spans_of(text or "")
                base = [span for span in spans if span[0] in base_kinds]
                for column, kind in zip(counts, base_kinds):
                    column.append(sum(span[0] == kind for span in base))
                digests.append(hashlib.sha256(told(base).encode()).hexdigest())
                listed.append(told(spans))
            yield pa.RecordBatch.from_arrays(
                [batch.column("doc_id"), *(pa.array(c, pa.int64()) for c in counts),
                 pa.array(digests, pa.string()), pa.array(listed, pa.string())],
                ["doc_id", "n_assign", "n_access", "n_hex", "base_sha256", "spans"],
            )

    reachable(docs.sparkSession)
    return documents_of(docs).mapInArrow(run, RESULT)


def without_secrets(docs: DataFrame) -> DataFrame:
    """The rows of `docs`, all columns, with secrets in `text` replaced; `n_chars` follows if there.

    A null text stays null.
    """

    def make(places: dict[str, int]):
        def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
            place = places["text"]
            for batch in small_batches(batches, f"c{place}"):
                texts = [t if t is None else masked(t, spans_of(t)) for t in batch.column(place).to_pylist()]
                columns, types = list(batch.columns), batch.schema.types
                columns[place] = pa.array(texts, types[place])
                if "n_chars" in places:
                    k = places["n_chars"]
                    columns[k] = pa.array([None if t is None else len(t) for t in texts], types[k])
                yield pa.RecordBatch.from_arrays(columns, batch.schema.names)

        return run

    reachable(docs.sparkSession)
    return mapped(docs, make)
