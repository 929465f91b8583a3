"""Secret scan with a recursive decoding worklist.

A text is a layer. Each layer is scanned for secrets and for encodings:
URL escapes (%41), Unicode escapes (\\u0041, \\x41, &#65;, &#x41;) and base64
tokens. A layer with its escapes decoded once is a new layer, and so is the layer with
all of them decoded until none is left; a chain like %25252541 is unwound in one pass, in time
in proportion to the text. (Layers between those two would show nothing else: a secret holds no escape
characters, so what one of them shows is in the last as well.) So is a decoded base64 token and what a base64 token decompresses
to (gzip, zlib, bzip2 or xz). All go on the worklist until nothing new
appears. A layer already seen for the same range is not opened again, which
ends cycles; each decoding shortens the text, except decompression. Compressed
data is found anywhere in decoded bytes and read through all its members. What
unpacks to more than MOST_UNPACKED bytes is read to its end in overlapping windows; its token counts in n_too_large
and is itself a span of kind large, so that redaction takes it out whole.

The worklist goes down first. A layer is let go once its last inner layer is taken up, and that is the one
as long as itself; the others are at most three quarters of it, so what is held at a time is a few times the text.
Where a layer came from is kept as two arrays of 4 bytes a code point, or as arithmetic for base64.

A base64 token is a run of base64 characters, also one that goes on over single
line breaks. It is decoded at each of its four alignments, so a prefix before a
slash or a dash does not hide what follows. Decoded bytes are read as UTF-8, or
else as Latin-1; stretches with a NUL at every other byte also as UTF-16.

Spans refer to the document's own text: a secret in a URL-escaped
segment maps to its exact escapes, one in a base64 token to the groups of four
characters that hold it, and one in compressed data to the whole token.

Kinds, in order: assign, access, hex, large. The document's own layer gives the base
spans (leftmost, not overlapping, for each kind; matches that are too short are
dropped); decoded layers only add spans. A span that several layers give is
listed once.

Edge cases: null text is empty; a text without secrets has zero counts, the
hash of the empty string and empty spans. Bytes that are not UTF-8 after
URL decoding are read as Latin-1. n_layers counts the layers that read as text.
Repeated rows are scanned one by one; other columns are not read.
"""

from __future__ import annotations

import binascii
import bz2
import hashlib
import html
import lzma
import re
import zlib
from array import array
from collections.abc import Callable, Iterator, Sequence

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from panelscope.llm.memory import giving_back

#: Most bytes that a compressed layer may unpack to in one piece, and how far the windows of a larger one overlap.
MOST_UNPACKED = 1 << 24
OVERLAP = 1 << 16
CHUNK = 1 << 16
ROWS = 512  # of a batch that redaction gives

KINDS = ("assign", "access", "hex")
SPAN_KINDS = (*KINDS, "large")
# The patterns of the base scan.
_ASSIGN = re.compile(r"""(password|passwd|secret|token|api_?key)["']?\x20*[:=]\x20*["']?([A-Za-z0-9+/_.=-]+)""", re.I | re.A)
_ACCESS = re.compile(r"AKIA[A-Z0-9]{14,}")
_HEX = re.compile(r"[0-9a-f]{16,}")
LEAST_ASSIGNED = 12

_STEP = re.compile(r"(?:%[0-9A-Fa-f]{2})+|\\u[0-9A-Fa-f]{4}|\\x[0-9A-Fa-f]{2}|\\U[0-9A-Fa-f]{8}|&#[0-9]{1,7};|&#[xX][0-9A-Fa-f]{1,6};")
#: Where an escape may begin, now or once what follows is decoded.
_STARTS = re.compile(r"%(?=[0-9A-Fa-f%\\&])|\\(?=[uxU%\\&])|&(?=[#%\\&])")
_HIGH = re.compile("[\udc80-\udcff]+")
_REFERENCE = re.compile(r"&#(?:[0-9]{1,7}|[xX][0-9A-Fa-f]{1,6});\Z")
_HEXES = frozenset("0123456789abcdefABCDEF")
#: Code points of the longest escape, \\U and eight digits.
LONGEST = 10
_ODD = re.compile(r"[\x00-\x08\x0b\x0c\x0e-\x1f\x7f]")
_BASE64 = re.compile(r"(?<![A-Za-z0-9+/_-])[A-Za-z0-9+/_-]{16,}={0,2}")
_WRAPPED = re.compile(r"(?<![A-Za-z0-9+/_-])[A-Za-z0-9+/_-]++(?:\r?\n[ \t]*+[A-Za-z0-9+/_-]++)+={0,2}")
_LINE = re.compile(r"[A-Za-z0-9+/_-]+")
_NESTED = re.compile(r"%[0-9A-Fa-f]{2}|\\[uUx]|&#|[A-Za-z0-9+/_-]{16}|[A-Za-z0-9+/_-]\r?\n[ \t]*[A-Za-z0-9+/_-]")
_WIDE = re.compile(rb"(?:[^\x00]\x00){15,}[^\x00]?")
_PACKED = re.compile(rb"\x1f\x8b\x08|BZh[1-9]1AY&SY|\xfd7zXZ\x00|x[\x01\x5e\x9c\xda]")
_PADDING = re.compile(rb"\x00*")
_KEY_SIGN = re.compile(r"[:=]")

Range = tuple[int, int]
Span = Callable[[int, int], Range]  # code points a to b of a layer to a range of the document


def scan(text: str) -> list[tuple[int, int, str]]:
    """(start, end, kind) of all secrets of one layer."""
    found = []
    if _KEY_SIGN.search(text):
        found += [(m.start(), m.end(), "assign") for m in _ASSIGN.finditer(text) if len(m[2]) >= LEAST_ASSIGNED]
    if "AKIA" in text:
        found += [(m.start(), m.end(), "access") for m in _ACCESS.finditer(text)]
    found += [(m.start(), m.end(), "hex") for m in _HEX.finditer(text)]
    return found


def _readable(text: str) -> bool:
    return len(_ODD.findall(text)) * 20 <= len(text)


def _texts(data: bytes) -> Iterator[tuple[str, Callable[[int], int], bool]]:
    """Texts that bytes hold: code points, where the k-th of them begins, and whether it reads as text."""
    try:
        text = data.decode("utf-8")
        if len(text) == len(data):
            yield text, lambda k: k, _readable(text)
        else:
            leads: list[np.ndarray] = []

            def begins(k: int) -> int:
                if not leads:
                    leads.append(np.flatnonzero((np.frombuffer(data, np.uint8) & 0xC0) != 0x80).astype(np.int32))
                return int(leads[0][k]) if k < len(leads[0]) else len(data)

            yield text, begins, _readable(text)
    except UnicodeDecodeError:
        yield data.decode("latin-1"), lambda k: k, False
    if b"\x00" in data:
        for m in _WIDE.finditer(data):
            yield m[0][::2].decode("latin-1"), lambda k, a=m.start(), n=len(data): min(a + 2 * k, n), True


def _opened(magic: bytes):
    if magic[0] == 0x1F:
        return zlib.decompressobj(31)
    return bz2.BZ2Decompressor() if magic[0] == 0x42 else lzma.LZMADecompressor() if magic[0] == 0xFD else zlib.decompressobj()


def _member(data: bytes, at: int, magic: bytes) -> Iterator[bytes]:
    """Chunks of one compressed member; returns where it ends, or None if it is broken or cut short."""
    reader, wait = _opened(magic), b""
    tail = hasattr(reader, "unconsumed_tail")
    try:
        while not reader.eof:
            if not wait and (tail or reader.needs_input):
                wait = data[at : at + CHUNK]
                at += len(wait)
                if not wait:
                    if tail:
                        yield reader.flush()
                    return None
            out = reader.decompress(wait, CHUNK)
            wait = reader.unconsumed_tail if tail else b""
            yield out
    except (zlib.error, OSError, lzma.LZMAError, EOFError, ValueError):
        return None
    return at - len(reader.unused_data)


def _unpacked(data: bytes, whole_members: list[Range]) -> Iterator[Iterator[bytes]]:
    """For each place where compressed data begins, the chunks of it and of the members that follow on it; ranges of whole members are added to the list."""
    at = 0
    while found := _PACKED.search(data, at):
        at = found.start() + 1

        def chunks(m: re.Match | None) -> Iterator[bytes]:
            nonlocal at
            while m:
                end = yield from _member(data, m.start(), m[0])
                if end is None:
                    return
                at = max(at, end)
                whole_members.append((m.start(), end))
                m = _PACKED.match(data, _PADDING.match(data, end).end())

        yield chunks(found)


Layer = tuple[str, array, array]  # text, and where each code point starts and ends in the layer that holds it


def _url_decoded(run: str) -> Iterator[tuple[str, int, int]]:
    data = bytes.fromhex(run.replace("%", ""))
    try:
        i = 0
        for c in data.decode("utf-8"):
            n = len(c.encode("utf-8"))
            yield c, 3 * i, 3 * (i + n)
            i += n
    except UnicodeDecodeError:
        for i, c in enumerate(data.decode("latin-1")):
            yield c, 3 * i, 3 * i + 3


def _character(code: str) -> str:
    """What an escape other than a URL's stands for; empty for a reference to no character."""
    if code[0] == "&":
        return html.unescape(code)
    c = chr(min(int(code[2:], 16), 0x10FFFF))
    return "\ufffd" if 0xD800 <= ord(c) < 0xE000 else c


def _once(text: str) -> Layer | None:
    """The layer with every escape decoded once; None without any."""
    out, starts, ends, at = [], array("i"), array("i"), 0
    for m in _STEP.finditer(text):
        lo = m.start()
        out.append(text[at:lo])
        starts.extend(range(at, lo))
        ends.extend(range(at + 1, lo + 1))
        for c, a, b in _url_decoded(m[0]) if m[0][0] == "%" else ((c, 0, len(m[0])) for c in _character(m[0])):
            out.append(c)
            starts.append(lo + a)
            ends.append(lo + b)
        at = m.end()
    if not at:
        return None
    out.append(text[at:])
    starts.extend(range(at, len(text)))
    ends.extend(range(at + 1, len(text) + 1))
    return "".join(out), starts, ends


def _last_escape(held: list[str]) -> int:
    """Length of the escape that these code points end with, 0 if none."""
    n, c = len(held), held[-1]
    if c in _HEXES:
        if n > 2 and held[-3] == "%" and held[-2] in _HEXES:
            return 3
        for sign, digits in (("x", 2), ("u", 4), ("U", 8)):
            if n > digits + 1 and held[-digits - 2] == "\\" and held[-digits - 1] == sign and _HEXES.issuperset(held[-digits:]):
                return digits + 2
    elif c == ";" and (m := _REFERENCE.search("".join(held[-LONGEST:]))):
        return len(m[0])
    return 0


def _unwound(text: str) -> Layer:
    """The layer with escapes decoded until none is left: each is replaced as soon as its last code point is read, and what
    it stands for is read on together with what came before."""
    out, starts, ends, at = [], array("i"), array("i"), 0
    while found := _STARTS.search(text, at):
        lo = found.start()
        out.append(text[at:lo])
        starts.extend(range(at, lo))
        ends.extend(range(at + 1, lo + 1))
        held, a, b = [], [], []
        i, until = lo, lo + LONGEST
        while i < min(until, len(text)):
            held.append(text[i])
            a.append(i)
            b.append(i + 1)
            i += 1
            if held[-1] in "%\\&":
                until = i + LONGEST
            while held and (n := _last_escape(held)):
                code = "".join(held[-n:])
                c = chr(int(code[1:], 16)) if code[0] == "%" else _character(code)
                c = chr(0xDC00 + ord(c)) if code[0] == "%" and c > "\x7f" else c  # a byte of UTF-8, read below
                first, last = a[-n], b[-1]
                del held[-n:], a[-n:], b[-n:]
                until = i + LONGEST
                if len(c) != 1:  # nothing, or more than one letter: never part of an escape
                    held.extend(c)
                    a.extend([first] * len(c))
                    b.extend([last] * len(c))
                    break
                held.append(c)
                a.append(first)
                b.append(last)
        out.append("".join(held))
        starts.extend(a)
        ends.extend(b)
        at = i
    out.append(text[at:])
    starts.extend(range(at, len(text)))
    ends.extend(range(at + 1, len(text) + 1))
    return _with_utf8("".join(out), starts, ends)


def _with_utf8(text: str, starts: array, ends: array) -> Layer:
    """Stretches of bytes above 127 that URL escapes gave, as UTF-8 or else Latin-1."""
    out, first, last, at = [], array("i"), array("i"), 0
    for m in _HIGH.finditer(text):
        out.append(text[at : m.start()])
        first.extend(starts[at : m.start()])
        last.extend(ends[at : m.start()])
        k = m.start()
        data = bytes(ord(c) - 0xDC00 for c in m[0])
        try:
            letters = [(c, len(c.encode("utf-8"))) for c in data.decode("utf-8")]
        except UnicodeDecodeError:
            letters = [(c, 1) for c in data.decode("latin-1")]
        for c, n in letters:
            out.append(c)
            first.append(starts[k])
            last.append(ends[k + n - 1])
            k += n
        at = m.end()
    if not at:
        return text, starts, ends
    out.append(text[at:])
    first.extend(starts[at:])
    last.extend(ends[at:])
    return "".join(out), first, last


def _tokens(text: str) -> Iterator[tuple[str, Sequence[int], int, int]]:
    """Base64 characters of a token, their places in the text, and the token's start and end."""
    for m in _BASE64.finditer(text):
        token = m[0].rstrip("=")
        yield token, range(m.start(), m.start() + len(token)), m.start(), m.end()
    for m in _WRAPPED.finditer(text) if "\n" in text else ():
        lines = [(x.start(), x.end()) for x in _LINE.finditer(text, m.start(), m.end())]
        if sum(b - a for a, b in lines) >= 16:
            yield "".join(text[a:b] for a, b in lines), np.concatenate([np.arange(a, b, dtype=np.int32) for a, b in lines]), m.start(), m.end()


def _decoded(token: str) -> Iterator[tuple[bytes, int]]:
    """Bytes of a base64 token, and the character that they begin at."""
    token = token.translate({45: 43, 95: 47})
    for k in range(4):
        n = len(token) - k
        n -= n % 4 == 1
        yield binascii.a2b_base64(token[k : k + n] + "=" * (-n % 4)), k


class Inner:
    """A layer that was found in another one."""

    __slots__ = ("text", "data", "whole", "span", "readable", "escapes", "last")

    def __init__(self, text: str | None, data: bytes | None, whole: Range, span: Span, readable: bool, escapes: bool = True, last: bool = False):
        self.text = text  # None: what follows is more than is kept in one piece
        self.data = data  # its bytes, if it was decoded from bytes
        self.whole = whole  # range in the document
        self.span = span
        self.readable = readable
        self.escapes = escapes  # whether its escapes are to be decoded
        self.last = last  # whether it is the last that its layer gives


def _of_bytes(data: bytes, whole: Range) -> Iterator[Inner]:
    for k, (text, _, readable) in enumerate(_texts(data)):
        yield Inner(text, None if k else data, whole, lambda a, b: whole, readable)


def _of_stream(chunks: Iterator[bytes], whole: Range) -> Iterator[Inner]:
    """Layers of unpacked data, in windows that overlap; one without text first if there is more than one window."""
    held, flagged = bytearray(), False
    for chunk in chunks:
        held += chunk
        if len(held) > MOST_UNPACKED:
            if not flagged:
                flagged = True
                yield Inner(None, None, whole, lambda a, b: whole, False)
            yield from _of_bytes(bytes(held), whole)
            del held[: -min(OVERLAP, MOST_UNPACKED // 2)]
    if held:
        yield from _of_bytes(bytes(held), whole)


def _through(span: Span, starts: array, ends: array) -> Span:
    return lambda a, b: span(starts[a], ends[b - 1])


def _inner(text: str, data: bytes | None, whole: Range, span: Span, escapes: bool, members: list[Range]) -> Iterator[Inner]:
    """Layers that one layer holds; `whole` is the range of the token that it was decoded from, `members` gets what was unpacked."""
    for chunks in _unpacked(data, members) if data else ():
        yield from _of_stream(chunks, whole)
    for token, at, start, end in _tokens(text):
        of = span(start, end)
        for raw, first in _decoded(token):
            for k, (decoded, begins, readable) in enumerate(_texts(raw)):

                def placed(a: int, b: int, first=first, begins=begins, at=at, n=len(raw)) -> Range:
                    x, y = begins(a), min(begins(b), n)
                    return span(int(at[first + x * 4 // 3]), int(at[first + (y - 1) * 4 // 3 + 1]) + 1)

                yield Inner(decoded, None if k else raw, of, placed, readable)
    if escapes and _STARTS.search(text) and (once := _once(text)):
        if once[0]:
            yield Inner(once[0], None, span(once[1][0], once[2][-1]), _through(span, *once[1:]), True, escapes=False)
        del once
        decoded, starts, ends = _unwound(text)
        del text
        if decoded:
            yield Inner(decoded, None, span(starts[0], ends[-1]), _through(span, starts, ends), True, last=True)


def _key(text: str) -> str | bytes:
    return text if len(text) <= 64 else hashlib.blake2b(text.encode("utf-8", "surrogatepass")).digest()


def secrets(text: str) -> tuple[list[tuple[int, int, str]], set[tuple[int, int, str]], int, int]:
    """Base spans, all spans, number of decoded layers, and of layers that were read in windows."""
    base = scan(text)
    spans, seen, layers, large = set(base), {(_key(text), 0, len(text))}, 0, 0

    def listed(found: list[tuple[int, int, str]], span: Span, members: Sequence[Range] = ()) -> None:
        for a, b, kind in found:
            if not any(x <= a and b <= y for x, y in members):  # what compressed data shows as it is has been read unpacked
                spans.add((*span(a, b), kind))

    work = [(_inner(text, None, (0, len(text)), lambda a, b: (a, b), True, []), lambda: None)]
    while work:
        item = next(work[-1][0], None)
        if item is None:
            work.pop()[1]()
            continue
        if item.last:
            inner, done = work.pop()
            inner.close()  # lets go of the layer's text
            done()
        if item.text is None:
            large += 1
            spans.add((*item.whole, "large"))
            continue
        key = _key(item.text), *item.whole
        if not item.text or key in seen:
            continue
        seen.add(key)
        layers += item.readable
        found = scan(item.text)
        if not (_NESTED.search(item.text) or item.data and _PACKED.search(item.data)):
            listed(found, item.span)
            continue
        members: list[Range] = []
        of = members if item.data and len(item.data) == len(item.text) else ()
        work.append((_inner(item.text, item.data, item.whole, item.span, item.escapes, members), lambda f=found, p=item.span, m=of: listed(f, p, m)))
    return base, spans, layers, large


def joined(spans: Iterator[tuple[int, int, str]]) -> str:
    """kind:start:end by start, then kind as listed, then end; joined by commas."""
    return ",".join(f"{kind}:{a}:{b}" for a, b, kind in sorted(spans, key=lambda s: (s[0], SPAN_KINDS.index(s[2]), s[1])))


def _scanned(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        rows = []
        for text in batch.column(1):
            base, spans, layers, large = secrets(text.as_py() or "")
            rows.append([*(sum(1 for s in base if s[2] == kind) for kind in KINDS), hashlib.sha256(joined(base).encode()).hexdigest(), joined(spans), layers, large])
        columns = list(zip(*rows, strict=True)) if rows else [[]] * 7
        kinds = [pa.int64()] * 3 + [pa.string()] * 2 + [pa.int64()] * 2
        yield pa.RecordBatch.from_arrays(
            [batch.column(0), *(pa.array(c, k) for c, k in zip(columns, kinds, strict=True))],
            names=["doc_id", "n_assign", "n_access", "n_hex", "base_sha256", "spans", "n_layers", "n_too_large"],
        )


SCHEMA = "doc_id long, n_assign long, n_access long, n_hex long, base_sha256 string, spans string, n_layers long, n_too_large long"


def secret_spans(docs: DataFrame) -> DataFrame:
    """A row for each row of `docs` (doc_id, text): counts and hash of the base spans, all spans, decoded layers."""
    return docs.select(F.col("doc_id").cast("long"), "text").mapInArrow(giving_back(_scanned), SCHEMA)


def redacted_text(text: str) -> str:
    """The text with every span replaced by its kind in angle brackets; overlapping spans count as one."""
    spans = sorted(secrets(text)[1], key=lambda s: (s[0], SPAN_KINDS.index(s[2]), s[1]))
    out, at = [], 0
    k = 0
    while k < len(spans):
        a, b, kind = spans[k]
        while k + 1 < len(spans) and spans[k + 1][0] < b:
            k += 1
            b = max(b, spans[k][1])
        out += [text[at:a], f"<{kind}>"]
        at = b
        k += 1
    return "".join([*out, text[at:]])


def redacted(docs: DataFrame) -> DataFrame:
    """`docs` with its secrets replaced in text; n_chars, if there is one, follows the new text. A null text stays null."""
    names = docs.columns

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for whole in batches:
            for lo in range(0, whole.num_rows, ROWS):
                batch = whole.slice(lo, ROWS)
                texts = [None if (t := cell.as_py()) is None else redacted_text(t) for cell in batch.column(batch.schema.get_field_index("text"))]
                columns = [pa.array(texts, pa.string()) if n == "text" else batch.column(k) for k, n in enumerate(names)]
                yield pa.RecordBatch.from_arrays(columns, names=names)

    out = docs.mapInArrow(giving_back(run), docs.schema)
    if "n_chars" in names:
        out = out.withColumn("n_chars", F.coalesce(F.length("text").cast(docs.schema["n_chars"].dataType), F.col("n_chars")))
    return out
