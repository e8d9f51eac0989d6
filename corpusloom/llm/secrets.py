"""Secret scan with a recursive decoding worklist.

Every text is scanned, then each URL-escaped, Unicode-escaped, base64 and compressed stretch in it is
unwrapped into a layer of its own, which is scanned and unwrapped in turn until nothing new comes
out. A layer's content is remembered, so cycles end. Every layer knows which code points of the original
text each of its own came from, so a finding at any depth is a span of the original text.
"""

from __future__ import annotations

import base64
import binascii
import gzip
import hashlib
import re
import zlib
from collections import deque
from collections.abc import Callable, Iterator

import pyarrow as pa
import zstandard
from pyspark.sql import DataFrame

KINDS = ("assign", "access", "hex")
# The base rules.
NAMES = ("password", "passwd", "secret", "token", "apikey", "api_key")
ASSIGN = re.compile(
    r"(password|passwd|secret|token|api_?key)[\"']?\x20*[:=]\x20*[\"']?([A-Za-z0-9+/_.=-]+)", re.IGNORECASE | re.ASCII
)
ACCESS = re.compile(r"AKIA[A-Z0-9]+")
# runs are maximal, so asking for 16 at once finds the runs of 16 and more
HEX = re.compile(r"[0-9a-f]{16,}")

# A search begins at the start of a run only: later starts in it would find no more.
URL_RUN = re.compile(r"(?<![A-Za-z0-9._~+/=:?&;,!*'()@$-])(?:[A-Za-z0-9._~+/=:?&;,!*'()@$-]*%[0-9A-Fa-f]{2})+[A-Za-z0-9._~+/=:?&;,!*'()@$-]*")
ESCAPES = re.compile(r"\\u\{([0-9A-Fa-f]{1,6})\}|\\u([0-9A-Fa-f]{4})|\\x([0-9A-Fa-f]{2})|&#([0-9]{1,7});|&#[xX]([0-9A-Fa-f]{1,6});")
ESCAPED_RUN = re.compile(rf"(?<![!-~])(?:[!-~]*?(?:{ESCAPES.pattern}))+[!-~]*".replace("([", "(?:["))
BASE64_RUN = re.compile(r"[A-Za-z0-9+/_-]{16,}={0,2}")
NEXT_LINE = re.compile(r"\r?\n[\x20\t]*([A-Za-z0-9+/_-]+={0,2})")
#: Text inside other bytes; no finding is shorter, and none of its wrapped forms.
STRETCH = re.compile(
    rb"(?:[\t\r\n\x20-\x7e]|[\xc2-\xdf][\x80-\xbf]|\xe0[\xa0-\xbf][\x80-\xbf]|[\xe1-\xec\xee\xef][\x80-\xbf]{2}"
    rb"|\xed[\x80-\x9f][\x80-\xbf]|\xf0[\x90-\xbf][\x80-\xbf]{2}|[\xf1-\xf3][\x80-\xbf]{3}|\xf4[\x80-\x8f][\x80-\xbf]{2}){16,}"
)
PACKED = re.compile(rb"\x1f\x8b\x08|\x28\xb5\x2f\xfd|\x78[\x01\x5e\x9c\xda]")
#: A compressed stretch may unfold to so many bytes; beyond that it is left packed, as a safeguard
#: against decompression bombs, and reported as UNSCANNED.
UNFOLDED = 1 << 26
UNSCANNED = "unscanned"
ORDER = (*KINDS, UNSCANNED)
#: zstd has no output limit: input goes in by so many bytes, which unfold to 8 MB at most.
STEP = 256

Span = tuple[int, int]
Place = Callable[[int, int], Span]
Way = tuple[Place, "Way | None"]


def matches(text: str) -> Iterator[tuple[str, int, int]]:
    """Base findings of one layer: kind, start, end."""
    low = text.lower()
    if any(name in low for name in NAMES):
        for m in ASSIGN.finditer(text):
            if len(m[2]) >= 12:
                yield "assign", m.start(), m.end()
    if "AKIA" in text:
        for m in ACCESS.finditer(text):
            if m.end() - m.start() >= 18:
                yield "access", m.start(), m.end()
    for m in HEX.finditer(text):
        yield "hex", m.start(), m.end()


def readable(raw: bytes) -> str | None:
    """``raw`` as text, if it is UTF-8 with hardly any control characters."""
    try:
        text = raw.decode("utf-8")
    except UnicodeDecodeError:
        return None
    if not text:
        return None
    odd = sum(1 for c in text if not c.isprintable() and c not in "\t\r\n")
    return text if odd * 50 <= len(text) else None


def _stream(raw: bytes, most: int) -> tuple[bytes, int] | None:
    """Content of the gzip, zlib or zstd stream at the start of ``raw``, up to a little over ``most``
    bytes, and the bytes it takes up; None if there is none."""
    try:
        if raw[:2] == b"\x1f\x8b":
            d = zlib.decompressobj(31)
        elif raw[:4] == b"\x28\xb5\x2f\xfd":
            d = zstandard.ZstdDecompressor().decompressobj()
            out, at = bytearray(), 0
            while at < len(raw) and not d.eof and len(out) <= most:
                out += d.decompress(raw[at : at + STEP])
                at += STEP
            return bytes(out), min(at, len(raw)) - len(d.unused_data)
        elif raw[:1] == b"\x78" and len(raw) > 2 and (raw[0] * 256 + raw[1]) % 31 == 0:
            d = zlib.decompressobj()
        else:
            return None
        return d.decompress(raw, most + 1), len(raw) - len(d.unused_data)
    except (zlib.error, gzip.BadGzipFile, zstandard.ZstdError, EOFError):
        return None


def unfolded(raw: bytes) -> tuple[bytes | None, int] | None:
    """Content of the gzip, zlib or zstd streams at the start of ``raw``, one behind the other, and the
    bytes they take up. The content is None when it is over UNFOLDED bytes."""
    out, used = bytearray(), 0
    while used < len(raw):
        got = _stream(raw[used:], UNFOLDED - len(out))
        if got is None or not got[1]:
            break
        out += got[0]
        used += got[1]
        if len(out) > UNFOLDED:
            return None, len(raw)
    return (bytes(out), used) if out else None


Piece = tuple[str | None, int]


def _pieces(text: str, run: re.Match, pattern: re.Pattern, decode: Callable[[list[re.Match]], Iterator[Piece]]):
    """A run with its escapes replaced, and the (start, end) in ``text`` behind each new code point;
    None if none of them decodes.

    ``decode`` turns adjacent escapes into characters, each with the number of escapes behind it. An
    escape that gives no character (None) stays as it is written.
    """
    out: list[str] = []
    spans: list[Span] = []

    def keep(start: int, end: int) -> None:
        out.extend(text[start:end])
        spans.extend((i, i + 1) for i in range(start, end))

    at, decoded = run.start(), False
    escapes = list(pattern.finditer(text, run.start(), run.end()))
    low = 0
    while low < len(escapes):
        high = low + 1
        while high < len(escapes) and escapes[high].start() == escapes[high - 1].end():
            high += 1
        keep(at, escapes[low].start())
        for c, size in decode(escapes[low:high]):
            start, end = escapes[low].start(), escapes[low + size - 1].end()
            if c is None:
                keep(start, end)
            else:
                out.append(c)
                spans.append((start, end))
                decoded = True
            low += size
        at = escapes[high - 1].end()
    keep(at, run.end())
    return ("".join(out), spans) if decoded else None


# A percent sign that was escaped over and over loses all but the last sixteen of its layers at once.
PERCENT = re.compile(r"%(?:25(?=(?:25){16}))*([0-9A-Fa-f]{2})")


def _percent(escapes: list[re.Match]) -> Iterator[Piece]:
    """UTF-8 out of percent escapes."""
    raw = bytes(int(m[1], 16) for m in escapes)
    at = 0
    while at < len(raw):
        lead = raw[at]
        size = 1 if lead < 0x80 else 2 if lead < 0xE0 else 3 if lead < 0xF0 else 4
        try:
            c, size = raw[at : at + size].decode("utf-8"), min(size, len(raw) - at)
        except UnicodeDecodeError:
            c, size = None, 1
        yield c, size
        at += size


def _unicode(escapes: list[re.Match]) -> Iterator[Piece]:
    """Characters out of Unicode escapes; the two halves of a surrogate pair are one."""
    codes = [int(next(g for g in m.groups() if g is not None), 10 if m[4] is not None else 16) for m in escapes]
    at = 0
    while at < len(codes):
        code = codes[at]
        if 0xD800 <= code < 0xDC00 and at + 1 < len(codes) and 0xDC00 <= codes[at + 1] < 0xE000:
            yield chr(0x10000 + (code - 0xD800) * 0x400 + codes[at + 1] - 0xDC00), 2
            at += 2
            continue
        yield (chr(code) if code < 0x110000 and not 0xD800 <= code < 0xE000 else None), 1
        at += 1


def unwrapped(text: str) -> Iterator[tuple[str | None, Place]]:
    """Every layer directly inside ``text``, with the way back to spans of ``text``. None for one that is
    too long to scan."""
    escaped = []
    if "%" in text:
        escaped += [(m, PERCENT, _percent) for m in URL_RUN.finditer(text)]
    if "\\" in text or "&#" in text:
        escaped += [(m, ESCAPES, _unicode) for m in ESCAPED_RUN.finditer(text)]
    for run, pattern, decode in escaped:
        got = _pieces(text, run, pattern, decode)
        if got:
            out, spans = got
            yield out, lambda s, e, spans=spans: (spans[s][0], spans[e - 1][1])
    done = 0
    for m in BASE64_RUN.finditer(text):
        if m.start() < done:
            continue
        lines = _lines(text, m)
        done = lines[-1][1]
        got = list(_base64(text, lines))
        if not got and len(lines) > 1:  # the lines do not belong together
            got = [layer for line in lines if line[1] - line[0] >= 16 for layer in _base64(text, [line])]
        yield from got


def _lines(text: str, run: re.Match) -> list[Span]:
    """A base64 run with the lines that go on with it: all between the first and the last are full."""
    lines = [run.span()]
    before = text[text.rfind("\n", 0, run.start()) + 1 : run.start()]
    full = None if before.strip(" \t") else run.end() - run.start()
    while text[lines[-1][1] - 1] != "=":
        start, end = lines[-1]
        m = NEXT_LINE.match(text, end)
        if m is None or full is not None and (end - start != full and len(lines) > 1 or len(m[1].rstrip("=")) > full):
            break
        lines.append(m.span(1))
        full = full or len(m[1])
    return lines


def _base64(text: str, lines: list[Span]) -> Iterator[tuple[str | None, Place]]:
    """Layers in the base64 of ``lines``: all of it if it decodes from the first character on, else
    whatever texts and compressed streams there are at any of the four alignments."""
    body = "".join(text[a:b] for a, b in lines).rstrip("=").replace("-", "+").replace("_", "/")
    origin = [i for a, b in lines for i in range(a, b)]
    whole = lines[0][0], lines[-1][1]

    def place(shift: int, first: int, last: int) -> Span:
        # three bytes come from four characters
        end = min(shift - (-last * 4 // 3), len(body))
        return origin[shift + first // 3 * 4 + first % 3], origin[end - 1] + 1

    def layer(out: str, shift: int, low: int) -> tuple[str, Place]:
        ends = [low]
        for c in out:
            ends.append(ends[-1] + len(c.encode("utf-8")))
        return out, lambda s, e: place(shift, ends[s], ends[e])

    for shift in range(4):
        part = body[shift:]
        part = part[: len(part) - (len(part) % 4 == 1)]
        try:
            raw = base64.b64decode(part + "=" * (-len(part) % 4), validate=True)
        except (binascii.Error, ValueError):
            continue
        if shift == 0 and len(part) == len(body):
            packed = unfolded(raw)
            out = readable(raw) if packed is None else packed[0] and readable(packed[0])
            if packed is None and out:
                yield layer(out, 0, 0)
                return
            if packed is not None and packed[1] == len(raw) and (out or packed[0] is None):
                yield out, lambda s, e: whole
                return
        for m in STRETCH.finditer(raw):
            yield layer(m[0].decode("utf-8"), shift, m.start())
        upto = 0
        for m in PACKED.finditer(raw):
            if m.start() < upto:
                continue
            packed = unfolded(raw[m.start() :])
            if packed is None:
                continue
            out = packed[0] and readable(packed[0])
            if out or packed[0] is None:
                upto = m.start() + packed[1]
                start, end = place(shift, m.start(), upto)
                yield out, lambda s, e, start=start, end=end: (start, end)


def findings(text: str) -> tuple[list[tuple[str, int, int]], list[tuple[str, int, int, int]]]:
    """Base findings of the text itself, and those of inner layers with their depth, as spans of it.

    A layer that is too long to scan is listed with the kind UNSCANNED."""
    base = list(matches(text))
    inner: dict[tuple[str, int, int], int] = {}
    known = {hashlib.sha256(text.encode("utf-8", "surrogatepass")).digest()}
    # the way back from a layer: that to its parent, and the parent's way
    work: deque[tuple[str, Way | None, int]] = deque([(text, None, 0)])
    while work:
        layer, way, depth = work.popleft()

        def place(s: int, e: int, way: Way | None = way) -> Span:
            while way is not None:
                back, way = way
                s, e = back(s, e)
            return s, e

        if depth:
            for kind, s, e in matches(layer):
                inner.setdefault((kind, *place(s, e)), depth)
        for out, back in unwrapped(layer):
            if out is None:
                inner.setdefault((UNSCANNED, *place(*back(0, 0))), depth + 1)
                continue
            mark = hashlib.sha256(out.encode("utf-8", "surrogatepass")).digest()
            # the same content elsewhere in the text is a finding elsewhere: only ancestors make a cycle
            start, end = place(*back(0, len(out)))
            here = hashlib.sha256(mark + f"{start}:{end}".encode()).digest()
            if out == layer or mark in known or here in known:
                continue
            known.add(here)
            work.append((out, (back, way), depth + 1))
    taken = set(base)
    return base, sorted(((k, s, e, d) for (k, s, e), d in inner.items() if (k, s, e) not in taken), key=lambda x: (x[1], ORDER.index(x[0]), x[2]))


def _joined(spans) -> str:
    return ",".join(f"{k}:{s}:{e}" for k, s, e in sorted(spans, key=lambda x: (x[1], ORDER.index(x[0]), x[2])))


FOUND = pa.list_(pa.struct([("kind", pa.string()), ("start", pa.int32()), ("end", pa.int32()), ("depth", pa.int32())]))


def scanned(docs: DataFrame) -> DataFrame:
    """Per document the numbers of base findings, the digest of their spans, ``spans`` (base and inner,
    joined) and ``found`` (kind, start, end, depth; depth 0 for base). NULL counts as empty."""

    def look(batches):
        for batch in batches:
            counts = {k: [] for k in KINDS}
            digest, spans, found = [], [], []
            for text in batch.column(1).to_pylist():
                base, inner = findings(text or "")
                for k in KINDS:
                    counts[k].append(sum(1 for x in base if x[0] == k))
                digest.append(hashlib.sha256(_joined(base).encode()).hexdigest())
                spans.append(_joined([*base, *[x[:3] for x in inner]]))
                found.append([{"kind": k, "start": s, "end": e, "depth": d} for k, s, e, d in [*[(*x, 0) for x in base], *inner]])
            yield pa.record_batch(
                [batch.column(0), *[pa.array(counts[k], pa.int64()) for k in KINDS], pa.array(digest), pa.array(spans), pa.array(found, FOUND)],
                names=["doc_id", *[f"n_{k}" for k in KINDS], "base_sha256", "spans", "found"],
            )

    kind = docs.schema["doc_id"].dataType.simpleString()
    counts = ", ".join(f"n_{k} long" for k in KINDS)
    return docs.select("doc_id", "text").mapInArrow(
        look, f"doc_id {kind}, {counts}, base_sha256 string, spans string, found array<struct<kind:string,start:int,end:int,depth:int>>"
    )
