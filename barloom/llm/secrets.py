"""Secrets in texts, also inside nested encodings, found by a worklist of decoded layers."""

from __future__ import annotations

import base64
import binascii
import bz2
import codecs
import hashlib
import itertools
import lzma
import re
import zlib

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import bounded, column

KINDS = ("assign", "access", "hex")
ASSIGN = re.compile(
    r"(password|passwd|secret|token|api_?key)[\"']?\x20*[:=]\x20*[\"']?([A-Za-z0-9+/_.=-]+)", re.I | re.A
)
ACCESS = re.compile(r"AKIA[A-Z0-9]+")
HEX = re.compile(r"[0-9a-f]{24,}")
KEYWORDS = ("password", "passwd", "secret", "token", "apikey", "api_key")

PERCENT = re.compile(r"(?:%[0-9A-Fa-f]{2})+")
UNICODE = re.compile(r"\\u\{([0-9A-Fa-f]{1,6})\}|\\u([0-9A-Fa-f]{4})|\\U([0-9A-Fa-f]{8})|\\x([0-9A-Fa-f]{2})|&#x([0-9A-Fa-f]{1,6});|&#([0-9]{1,7});")
BASE64 = re.compile(r"[A-Za-z0-9+/_-]{16,}={0,2}")
#: Base64 over single line breaks, with blanks around them.
WRAPPED = re.compile(
    r"(?<![A-Za-z0-9+/_-])[A-Za-z0-9+/_-]{16,}+(?:[\x20\t]*+\r?\n[\x20\t]*+[A-Za-z0-9+/_-]++)++={0,2}"
)
LINE = re.compile(r"[A-Za-z0-9+/_-]+={0,2}")
#: What no secret and no encoded run has in it, so that a long layer can be divided there.
BORDER = re.compile(r"[^A-Za-z0-9+/_.=:\"'%\\{}&#;\x20\t\r\n-]")
#: What any layer but plain text shows somewhere; the same tests as above, for a whole Arrow column.
#: Code points of inflated text held at most while no border shows; then it is cut with an overlap.
HELD, OVERLAP = 16_000_000, 4096
ENCODED = r"%[0-9A-Fa-f]{2}|\\[uUx][0-9A-Fa-f{]|&#[0-9xX]|[A-Za-z0-9+/_-]{16}"
PLAIN = r"[0-9a-f]{24}|AKIA[A-Z0-9]{16}|(?i)password|passwd|secret|token|api_?key"


def scan(text: str):
    """(kind, start, end) of the plain secrets of one text: leftmost, not overlapping per kind."""
    found = []
    low = text.lower()
    if any(k in low for k in KEYWORDS):
        found += [("assign", m.start(), m.end()) for m in ASSIGN.finditer(text) if len(m[2]) >= 6]
    if "AKIA" in text:
        found += [("access", m.start(), m.end()) for m in ACCESS.finditer(text) if len(m[0]) >= 20]
    found += [("hex", m.start(), m.end()) for m in HEX.finditer(text)]
    return found


def _spliced(text, pieces):
    """The text with (start, end, replacement) pieces put in, and where each new character came from."""
    out, begin, end, at = [], [], [], 0
    for start, stop, new in pieces:
        out.append(text[at:start])
        begin.append(np.arange(at, start))
        end.append(np.arange(at, start) + 1)
        out.append(new)
        begin.append(np.full(len(new), start))
        end.append(np.full(len(new), stop))
        at = stop
    out.append(text[at:])
    begin.append(np.arange(at, len(text)))
    end.append(np.arange(at, len(text)) + 1)
    return "".join(out), np.concatenate(begin), np.concatenate(end)


def _percent(text):
    pieces = []
    for m in PERCENT.finditer(text):
        raw = bytes.fromhex(m[0].replace("%", ""))
        try:
            # Decode character by character so that spans stay as narrow as the text allows.
            at = 0
            for char in raw.decode("utf-8"):
                size = len(char.encode("utf-8"))
                pieces.append((m.start() + 3 * at, m.start() + 3 * (at + size), char))
                at += size
        except UnicodeDecodeError:
            pieces += [(m.start() + 3 * i, m.start() + 3 * i + 3, chr(b)) for i, b in enumerate(raw) if b < 128]
    return _spliced(text, pieces) if pieces else None


def _escapes(text):
    pieces = []
    for m in UNICODE.finditer(text):
        point = int(m[6]) if m[6] else int(next(g for g in m.groups() if g), 16)
        if 0 < point < 0x110000 and not 0xD800 <= point < 0xE000:
            pieces.append((m.start(), m.end(), chr(point)))
    return _spliced(text, pieces) if pieces else None


def _printable(text):
    return bool(text) and sum(c.isprintable() or c in "\t\r\n" for c in text) >= 0.95 * len(text)


#: Compressed data by its first bytes, and what reads it.
FORMATS = (
    (b"\x1f\x8b", lambda: zlib.decompressobj(31)),
    (b"BZh", bz2.BZ2Decompressor),
    (b"\xfd7zXZ\x00", lzma.LZMADecompressor),
)


def _format(raw: bytes):
    """(first bytes, reader) of compressed data; raw deflate has no sign, so it is read by trial."""
    for sign, reader in FORMATS:
        if raw.startswith(sign):
            return sign, reader
    if len(raw) > 2 and raw[0] & 15 == 8 and (raw[0] * 256 + raw[1]) % 31 == 0:
        return None, lambda: zlib.decompressobj(15)
    return None, None


def _expanded(raw: bytes, sign, reader, most: int):
    """Bytes of a compressed stream in pieces of `most` at most; none where it is none.

    Members that follow each other with the same sign are all read. A stream that breaks off
    counts only as far as it gave whole pieces.
    """
    try:
        while raw:
            machine, data, held = reader(), raw, []
            while not machine.eof:
                out = machine.decompress(data, most)
                # zlib hands back what it has not taken, the others keep it.
                data = getattr(machine, "unconsumed_tail", b"")
                if not out and not data and not machine.eof:
                    return
                held.append(out)
                if len(out) == most or machine.eof:
                    yield from filter(None, held)
                    held = []
            # Zeros may pad a member; anything but another one ends the data.
            raw = machine.unused_data.lstrip(b"\0")
            if not sign or not raw.startswith(sign):
                return
    except (zlib.error, OSError, EOFError, lzma.LZMAError):
        pass


def _pieces(parts, most: int):
    """(text, whether it goes on) of inflated parts, in pieces that no secret and no encoded run spans.

    They end behind a character that is in none of these, `most` bytes apart or more. A text of
    up to `most` bytes is one piece and has to be UTF-8; in longer ones what is not is left out.
    Where HELD code points show no such character the text is cut all the same, and OVERLAP of
    them are read with either piece: enough for the beginning of any secret.
    """
    first, more = next(parts, None), next(parts, None)
    if first is None:
        return
    if more is None:
        try:
            yield first.decode("utf-8"), len(first) >= most
        except UnicodeDecodeError:
            # A full piece may end inside a character.
            if len(first) == most:
                yield first.decode("utf-8", "ignore"), True
        return
    decoder = codecs.getincrementaldecoder("utf-8")("ignore")
    held, size, points, total = [], 0, 0, 0
    for part in itertools.chain((first, more), parts):
        new = decoder.decode(part)
        size, total = size + len(part), total + len(part)
        points += len(new)
        if size < most:
            held.append(new)
            continue
        stop = max((m.end() for m in BORDER.finditer(new, max(0, len(new) - 10_000))), default=0) or max(
            (m.end() for m in BORDER.finditer(new)), default=0
        )
        if stop:
            yield "".join([*held, new[:stop]]), True
            held, size, points = [new[stop:]], 0, len(new) - stop
        else:
            held.append(new)
            if points > HELD:
                whole = "".join(held)
                yield whole, True
                held, size, points = [whole[-OVERLAP:]], 0, OVERLAP
    yield "".join([*held, decoder.decode(b"", True)]), total >= most


def _runs(text):
    """Base64 runs of a text, line by line and joined over line breaks, and where each character is."""
    for m in BASE64.finditer(text):
        yield m[0], lambda i, start=m.start(): start + i
    for m in WRAPPED.finditer(text):
        lines = [(x[0], m.start() + x.start()) for x in LINE.finditer(m[0])]
        for group in _blocks(lines):
            places = np.concatenate([np.arange(at, at + len(x)) for x, at in group])
            yield "".join(x for x, _ in group), places.__getitem__


def _blocks(lines):
    """Lines to join: all, and those of equal length in a row, also with the shorter line behind them.

    A word before the first or behind the last line of a block looks like one of its lines. A line
    is in three of them at most.
    """
    at, found = 0, {(0, len(lines))}
    while at < len(lines):
        size, stop = len(lines[at][0]), at + 1
        while stop < len(lines) and len(lines[stop][0]) == size:
            stop += 1
        if stop - at > 1:
            found.add((at, stop))
        if stop < len(lines) and len(lines[stop][0]) < size:
            found.add((at, stop + 1))
        at = stop
    for a, b in sorted(found):
        yield lines[a:b]


def _starts(chars):
    """Where base64 may begin in a run: at its front, or behind a mark that ends a path or name."""
    yield 0
    for i, c in enumerate(chars[:128]):
        if c in "/_-" and len(chars) - i > 16:
            yield i + 1


def _text(raw):
    """The printable text that bytes begin with, all of them but for a tail that is none; else None."""
    try:
        text = raw.decode("utf-8")
    except UnicodeDecodeError as e:
        if e.start < 12:
            return None
        text = raw[: e.start].decode("utf-8")
    return text if _printable(text) else None


def _base64(text, most):
    """Layers inside base64 runs: (decoded text, begin, end, whether it is a piece of a larger one)."""
    for chars, spot in _runs(text):
        body = chars.rstrip("=").replace("-", "+").replace("_", "/")
        for start in _starts(chars):
            # One letter over is part of what stands behind.
            code = body[start : len(body) - ((len(body) - start) % 4 == 1)]
            try:
                raw = base64.b64decode(code + "=" * (-len(code) % 4), validate=True)
            except (binascii.Error, ValueError):
                continue
            given = False
            for inner, large in _unpacked(raw, most):
                size, given = len(inner), True
                first, last = spot(start), spot(len(chars) - 1) + 1
                yield inner, np.broadcast_to(first, size), np.broadcast_to(last, size), large
            inner = None if given else _text(raw)
            if inner is not None:
                # Character i of the inner text starts at byte at[i]; three bytes come from four characters.
                data = np.frombuffer(inner.encode("utf-8"), np.uint8)
                at = np.append(np.flatnonzero((data & 0xC0) != 0x80), len(data))
                begin = spot(start + at[:-1] // 3 * 4)
                end = spot(np.minimum(start + (at[1:] - 1) // 3 * 4 + 3, len(chars) - 1)) + 1
                yield inner, begin, end, False
                given = True
            if given:
                break


def _unpacked(raw, most):
    """Pieces of the text of compressed bytes, none where they are not."""
    sign, reader = _format(raw)
    if reader:
        yield from _pieces(_expanded(raw, sign, reader, most), most)
    elif len(raw) > 8 and _text(raw) is None:
        # Bytes that are neither text nor known by a sign: raw deflate, if it ends well and gives text.
        parts = _expanded(raw, None, lambda: zlib.decompressobj(-15), most)
        first = next(parts, b"")
        if len(first) >= 8 and _text(first) is not None:
            yield from _pieces(itertools.chain((first,), parts), most)


def _inner(text, most, begin, end):
    """The layers directly inside a text, with the places of their characters in the outermost one."""

    def layers():
        for form in (_percent, _escapes):
            found = form(text)
            if found:
                yield *found, False
        yield from _base64(text, most)

    for new, b, e, large in layers():
        if begin is not None and len(b):
            if b.strides == (0,):
                b, e = np.broadcast_to(begin[b[0]], len(b)), np.broadcast_to(end[max(e[0] - 1, 0)], len(e))
            else:
                b, e = begin[b], end[np.maximum(e - 1, 0)]
        yield new, b, e, large


def unwrap(text: str, most: int = 1_000_000):
    """Spans of all secrets of a text, of every layer, in code points of the text itself.

    The worklist holds the layers that are open, the innermost last. A layer is scanned when it is
    found; then come the layers inside it: its URL-decoded form, its form without Unicode escapes,
    and the content of its base64 runs, also of those behind a path or wrapped over lines,
    decompressed where it is gzip, zlib, bzip2, xz or raw deflate data. A layer whose text was seen
    before at the same place is not taken again, so cycles end, and every decoding shortens its
    input except for decompression. Compressed data is read to its end; of more than `most` bytes it
    is taken piece by piece, each a layer that is done with before the next one is inflated.
    Returns (spans, layers, pieces of layers of more than `most` bytes).
    """
    found, seen, cut = set(scan(text)), {hashlib.sha1(text.encode("utf-8", "surrogatepass")).digest()}, 0
    work, layers = [_inner(text, most, None, None)], 1
    while work:
        layer = next(work[-1], None)
        if layer is None:
            work.pop()
            continue
        new, b, e, large = layer
        # The same content at two places gives two spans, so the place belongs to the mark.
        mark = hashlib.sha1(new.encode("utf-8", "surrogatepass")).digest()
        mark += repr((int(b[0]), int(e[-1]))).encode() if len(b) else b""
        if not new or mark in seen:
            continue
        seen.add(mark)
        layers += 1
        cut += large
        for kind, s, t in scan(new):
            found.add((kind, int(b[s]), int(e[t - 1])) if b.strides == (0,) else (kind, int(b[s:t].min()), int(e[s:t].max())))
        work.append(_inner(new, most, b, e))
        # Only what is inside is still needed of it.
        del layer, new, b, e
    return found, layers, cut


def listed(spans):
    """kind:start:end by start, then kind in the order of KINDS, comma-joined."""
    order = sorted(spans, key=lambda x: (x[1], KINDS.index(x[0]), x[2]))
    return ",".join(f"{kind}:{start}:{end}" for kind, start, end in order)


def _masked(text, spans):
    """The text with each span, overlapping ones joined, replaced by its kind in brackets."""
    out, at = [], 0
    for kind, start, end in sorted(spans, key=lambda x: (x[1], -x[2])):
        if start >= at:
            out += [text[at:start], f"[{kind}]"]
        at = max(at, end)
    return "".join([*out, text[at:]])


def _suspects(texts):
    """Which texts of an Arrow column can hold a secret or an encoded layer at all."""
    looks = pc.or_(pc.match_substring_regex(texts, PLAIN), pc.match_substring_regex(texts, ENCODED))
    return pc.fill_null(looks, False).to_pylist()


def mask_secrets(docs: DataFrame, most: int = 1_000_000) -> DataFrame:
    """`docs`, all columns, with every secret of any layer replaced in `text` by its kind in brackets.

    Null texts stay null; see find_secrets for the other cases. A column n_chars, where there is
    one, is brought up to date.
    """

    def run(batches):
        for batch in bounded(batches):
            texts = column(batch, "text")
            changed = [
                _masked(t.as_py(), unwrap(t.as_py(), most)[0]) if look else t.as_py()
                for t, look in zip(texts, _suspects(texts))
            ]
            at = batch.schema.get_field_index("text")
            yield batch.set_column(at, "text", pa.array(changed, texts.type))

    masked = docs.mapInArrow(run, docs.schema)
    if "n_chars" in docs.columns:
        kind = docs.schema["n_chars"].dataType
        masked = masked.withColumn("n_chars", F.char_length("text").cast(kind))
    return masked


def find_secrets(docs: DataFrame, mask: bool = False, most: int = 1_000_000) -> DataFrame:
    """Secrets of every document: counts and list of the plain ones, list of those of all layers.

    Columns: doc_id, n_assign, n_access, n_hex, base_spans, spans, n_layers, n_cut (pieces of
    compressed layers of more than `most` bytes, which are read to the end), and with `mask` the text with all spans replaced. Null text counts as empty and
    stays null when masked; empty texts have no spans; repeated rows are scanned each; extra
    columns are ignored; an empty table gives no rows. One pass, no shuffle; a worker holds one
    slice of texts and the layers of one document.
    """

    def run(batches):
        for batch in bounded(batches):
            texts = column(batch, "text")
            rows = {k: [] for k in names}
            for doc_id, text, look in zip(column(batch, "doc_id").to_pylist(), texts, _suspects(texts)):
                base, spans, layers, cut, value = [], set(), 1, 0, None
                if look:
                    value = text.as_py()
                    base = scan(value)
                    spans, layers, cut = unwrap(value, most)
                rows["doc_id"].append(doc_id)
                for kind in KINDS:
                    rows[f"n_{kind}"].append(sum(x[0] == kind for x in base))
                rows["base_spans"].append(listed(base))
                rows["spans"].append(listed(spans))
                rows["n_layers"].append(layers)
                rows["n_cut"].append(cut)
                if mask:
                    rows["text"].append(_masked(value, spans) if spans else text.as_py())
            yield pa.RecordBatch.from_pydict(rows, schema=kinds)

    names = ["doc_id", "n_assign", "n_access", "n_hex", "base_spans", "spans", "n_layers", "n_cut"]
    text_names = {"base_spans", "spans", "text"}
    names += ["text"] if mask else []
    kinds = pa.schema([(k, pa.string() if k in text_names else pa.int64()) for k in names])
    schema = ", ".join(f"{k} {'string' if k in text_names else 'long'}" for k in names)
    return docs.select("doc_id", "text").mapInArrow(run, schema)
