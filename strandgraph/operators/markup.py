"""Elements of XML texts with their byte offsets, and balanced brackets.

Catalyst has no expression that gives a match's offset, so the scan runs over Arrow batches, a text at a time.
"""

from __future__ import annotations

import re

import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

_INSIDE = rb"(?:[^<>\"']|\"[^\"]*\"|'[^']*')"
_TOKEN = re.compile(rb"<!--.*?-->|<!\[CDATA\[.*?\]\]>|<\?.*?\?>|<!" + _INSIDE + rb"*>|<(?P<close>/?)(?P<tag>[^\s<>/!?\"'=]+)(?P<attrs>" + _INSIDE + rb"*?)(?P<alone>/?)>", re.S)
_ATTR = re.compile(rb"([^\s=]+)\s*=\s*(?:\"([^\"]*)\"|'([^']*)')")
_SPAN = pa.schema([("key", pa.int64()), ("outcome", pa.string()), ("tag", pa.string()), ("depth", pa.int32()), ("ord", pa.int32()), *[(f"{a}_{b}", pa.int64()) for a in ("outer", "inner") for b in ("start", "end")], ("attrs", pa.map_(pa.string(), pa.string())), ("self_closing", pa.bool_())])
_GROUPS = pa.list_(pa.struct([("start", pa.int64()), ("end", pa.int64())]))
_DDL = "key long, outcome string, tag string, depth int, ord int, outer_start long, outer_end long, inner_start long, inner_end long, attrs map<string,string>, self_closing boolean"

#: Elements inside which white space parts no words, and elements that never stand among a line's words.
_WRAPPING = frozenset("sGr aGr d num c AO:Sumgram AO:Akkgram".split())
_FRAMING = frozenset("w lb clb parsep parsep_dbl P___Standard".split())
#: A group of masked text, where markup and wrapped white space are zero bytes: what leads up to a word, and the word.
_GROUP = re.compile(rb"[\x00 \t\r\n]*[^\x00 \t\r\n][^ \t\r\n]*")


_NAME = re.compile(rb"[A-Za-z_:\x80-\xff][-A-Za-z0-9._:\x80-\xff]*")
_GIVEN = re.compile(rb"[ \t\r\n]+(?P<name>" + _NAME.pattern + rb")[ \t\r\n]*=[ \t\r\n]*(?:\"(?P<a>[^\"]*)\"|'(?P<b>[^']*)')")
_LOOSE = re.compile(rb"&(?!(?:amp|lt|gt|quot|apos|#[0-9]+|#x[0-9A-Fa-f]+);)")
_CONTROL = re.compile(rb"[\x00-\x08\x0b\x0c\x0e-\x1f]")


class Malformed(ValueError):
    """The text isn't one well-formed element; the message is the outcome."""


def attributes(tag: bytes, raw: bytes) -> list[tuple[str, str]]:
    """The attributes of a tag in order; Malformed where its name or one of them leaves the grammar."""
    if not _NAME.fullmatch(tag):
        raise Malformed("bad_name")
    out, at = {}, 0
    while m := _GIVEN.match(raw, at):
        at, name, value = m.end(), m["name"].decode("utf-8", "replace"), m["a"] if m["a"] is not None else m["b"]
        if name in out:
            raise Malformed("repeated_attribute")
        if b"<" in value:
            raise Malformed("lt_in_attribute")
        if _LOOSE.search(value):
            raise Malformed("loose_ampersand")
        out[name] = value.decode("utf-8", "replace")
    if raw[at:].strip(b" \t\r\n"):
        raise Malformed("bad_attribute")
    return list(out.items())


def scan(data: bytes) -> list[list]:
    """[tag, depth, outer start and end, inner start and end, attributes, self-closing] of each element, in the
    order of their start tags.  Inner offsets are None where the element closes itself."""
    spans: list[list] = []
    open_: list[list] = []
    at = 0

    if _CONTROL.search(data):
        raise Malformed("control_character")
    try:
        data.decode("utf-8")
    except UnicodeDecodeError:
        raise Malformed("not_utf8") from None

    def outside(piece: bytes):
        if b"<" in piece:
            raise Malformed("stray_lt")
        if _LOOSE.search(piece):
            raise Malformed("loose_ampersand")
        if b"]]>" in piece:
            raise Malformed("stray_cdata_end")
        if not open_ and piece.strip():
            raise Malformed("text_outside")

    for m in _TOKEN.finditer(data):
        outside(data[at : m.start()])
        at = m.end()
        if m["tag"] is None:
            if m[0].startswith(b"<![CDATA[") and not open_:
                raise Malformed("text_outside")
            if m[0].startswith(b"<!--") and (b"--" in m[0][4:-3] or m[0].endswith(b"--->")):
                raise Malformed("dashes_in_comment")
            if re.match(rb"<\?xml[ \t\r\n?]", m[0], re.I) and m.start():
                raise Malformed("late_prolog")
            continue
        tag = m["tag"].decode("utf-8", "replace")
        given = attributes(m["tag"], m["attrs"])
        if m["close"]:
            if given or m["alone"]:
                raise Malformed("attribute_in_end")
            if not open_:
                raise Malformed("stray_close")
            if open_[-1][0] != tag:
                raise Malformed("crossing")
            span = open_.pop()
            span[3], span[5] = m.end(), m.start()
            continue
        if spans and not open_:
            raise Malformed("second_root")
        span = [tag, len(open_), m.start(), m.end(), None if m["alone"] else m.end(), None, given, bool(m["alone"])]
        spans.append(span)
        if not m["alone"]:
            open_.append(span)
    outside(data[at:])
    if open_:
        raise Malformed("unclosed")
    if not spans:
        raise Malformed("no_root")
    return spans


def spans(texts: DataFrame, key: str, content: str) -> DataFrame:
    """A row for each element, with outcome ok; a text that isn't well formed, or null, gives one row that has only
    its outcome."""

    def run(batches):
        rows: list[tuple] = []
        for batch in batches:
            for k, data in zip(batch.column(0).to_pylist(), batch.column(1)):
                try:
                    rows += [(k, "ok", tag, depth, n, *rest) for n, (tag, depth, *rest) in enumerate(scan(data.as_py() or b""))]
                except Malformed as e:
                    rows.append((k, str(e), *[None] * 9))
                if len(rows) >= 8192:
                    yield _batch(rows)
                    rows = []
        if rows:
            yield _batch(rows)

    return texts.select(F.col(key).cast("long").alias("key"), F.col(content).cast("binary").alias("content")).mapInArrow(run, _DDL)


def word_groups(data: bytes) -> list[tuple[int, int]]:
    """Byte ranges of the words of a line that marks none: white space outside wrapping elements parts them, and goes
    with the word after it, or at the end with the last one.  The ranges fill the line; a line without a word has none.
    Malformed names markup that can't stand there."""
    mask, wrapping, at = bytearray(data), [], 0

    def blank(start: int, end: int):
        mask[start:end] = bytes(end - start)

    def between(end: int):
        if b"<" in data[at:end]:
            raise Malformed("stray_lt")
        if wrapping:
            for space in re.finditer(rb"[ \t\r\n]+", data[at:end]):
                blank(at + space.start(), at + space.end())

    for m in _TOKEN.finditer(data):
        between(m.start())
        at = m.end()
        blank(*m.span())
        if m["tag"] is None:
            raise Malformed("not_an_element")
        tag = m["tag"].decode("utf-8", "replace")
        if tag in _FRAMING:
            raise Malformed(f"framing {tag}")
        if tag in _WRAPPING and not m["close"] and not m["alone"]:
            wrapping.append(tag)
        elif tag in _WRAPPING and m["close"]:
            if not wrapping or wrapping.pop() != tag:
                raise Malformed(f"unbalanced {tag}")
        elif m["close"] or not m["alone"]:
            raise Malformed(f"nested {tag}")
    between(len(data))
    if wrapping:
        raise Malformed(f"unclosed {wrapping[-1]}")
    ends = [m.end() for m in _GROUP.finditer(mask)]
    return list(zip([0, *ends[:-1]], [*ends[:-1], len(data)])) if ends else []


def unmarked_words(lines: DataFrame, key: str, content: str) -> DataFrame:
    """key, fault (null: none), groups: ``word_groups`` of each line; a faulty line has none, a null one is empty."""

    def run(batches):
        for batch in batches:
            groups, faults = [], []
            for data in batch.column(1).to_pylist():
                try:
                    found, fault = word_groups(data or b""), None
                except Malformed as e:
                    found, fault = [], str(e)
                groups.append([{"start": a, "end": b} for a, b in found])
                faults.append(fault)
            yield pa.RecordBatch.from_arrays([batch.column(0), pa.array(faults, pa.string()), pa.array(groups, _GROUPS)], ["key", "fault", "groups"])

    kind = lines.schema[key].dataType.simpleString()
    return lines.select(F.col(key).alias("key"), F.col(content).cast("binary").alias("content")).mapInArrow(run, f"key {kind}, fault string, groups array<struct<start:bigint,end:bigint>>")


def _batch(rows: list[tuple]) -> pa.RecordBatch:
    return pa.RecordBatch.from_arrays([pa.array(c, f.type) for c, f in zip(zip(*rows), _SPAN)], schema=_SPAN)


def balanced(text: str, at: int = 0) -> str | None:
    """What the first bracket at or after ``at`` holds up to the one that closes it; None if none does."""
    depth, begin = 0, None
    for i in range(at, len(text)):
        if text[i] == "(":
            if begin is None:
                begin = i + 1
            depth += 1
        elif text[i] == ")" and begin is not None:
            depth -= 1
            if not depth:
                return text[begin:i]
    return None
