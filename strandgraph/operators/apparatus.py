"""Apparatus blocks: from the mixed content of an element to entries, separators and barriers, and join statements.

Text is cut into lexemes (a siglum in braces, a join mark that stands free, or words); what they mean depends on where
the text stands: in an entry element, right behind one, at the head of the block, or behind another element.
"""

from __future__ import annotations

import html
import re

import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from . import hierarchy
from .markup import Malformed, scan

#: Elements that are entries, elements that are joins, what a siglum and a join mark look like, and kinds.
ENTRIES = {"TxtPubl": "txtpubl", "TextPubl": "txtpubl", "InvNr": "invnr"}
JOINS = {"DirectJoin": "direct", "InDirectJoin": "indirect"}
SIGLUM = r"\{\s*(?P<siglum>€\s*\d+|[A-Za-z]\d+|\d+)\s*\}"
MARK = r"(?<![^\s}])(?P<mark>\(\+\)\s*\?|\+\s*\?|(?:\(\+\)){2,}|\+\+|\(\+\)|\+)(?![^\s{])"
STATUS = r"(?P<label>[^{}]*?\S)\s*(?P<mark>(?:\(\+\)){2,}|\+\+|\(\+\)|\+)"
KINDS = {"+": "direct", "(+)": "indirect", "++": "direct-multi", "+?": "uncertain", "(+)?": "uncertain"}

_LEXEME = re.compile(f"{SIGLUM}|{MARK}")
_STATUS = re.compile(STATUS)
_TAG = re.compile("<[^>]*>")


def spaced(text: str) -> str:
    return " ".join(text.split())


def siglum(text: str) -> str:
    bare = spaced(text)
    return "".join(bare.split()) if bare.startswith("€") else bare


def mark(raw: str) -> tuple[str, str, str]:
    bare = "".join(raw.split())
    return "mark", KINDS.get(bare, "indirect-multi" if len(bare) > 3 else "unknown"), spaced(raw)


def lexemes(text: str) -> list[tuple[str, str, str]]:
    """(kind, value, raw) of text, siglum or mark, in order; white space alone is none."""
    out, at = [], 0

    def words(end: int):
        if said := spaced(text[at:end]):
            out.append(("text", said, said))

    for m in _LEXEME.finditer(text):
        words(m.start())
        at = m.end()
        if m["mark"]:
            out.append(mark(m[0]))
        else:
            out.append(("siglum", siglum(m["siglum"]), m[0]))
    words(len(text))
    return out


class _Block:
    def __init__(self):
        self.tokens: list[dict] = []

    def put(self, kind: str, value: str, encoding: str, join: str = "", context: str = "") -> dict:
        token = {"kind": kind, "value": value, "encoding": encoding, "join": join, "context": context, "candidates": [], "raw": [], "sources": []}
        self.tokens.append(token)
        return token

    def barrier(self, text: str) -> None:
        if said := spaced(text):
            self.put("barrier", said, "text")

    def mark(self, lexeme: tuple[str, str, str], context: str = "") -> None:
        self.put("separator", lexeme[2], "textual", lexeme[1], context)

    @staticmethod
    def named(entry: dict, value: str, raw: str, source: str) -> None:
        if value not in entry["candidates"]:
            entry["candidates"].append(value)
            entry["sources"].append(source)
        if raw not in entry["raw"]:
            entry["raw"].append(raw)

    def plain(self, found: list[tuple[str, str, str]]) -> None:
        """Words before a siglum are an entry; a siglum without any, and words without one, bar the way."""
        label = ""
        for kind, value, raw in [*found, ("end", "", "")]:
            if kind == "text":
                label = value
                continue
            if kind == "siglum" and label:
                self.named(self.put("entry", label, "plain"), value, raw, "plain-text")
            else:
                self.barrier(label)
                if kind == "siglum":
                    self.barrier(raw)
                elif kind == "mark":
                    self.mark((kind, value, raw))
            label = ""

    def status(self, text: str) -> bool:
        """Words with one mark at their end and nothing after: a state, not a join; the mark may touch them."""
        found = _STATUS.fullmatch(spaced(text))
        if found is None or [k for k, _, _ in lexemes(text)] not in (["text"], ["text", "mark"]):
            return False
        self.barrier(found["label"])
        self.mark(mark(found["mark"]), spaced(found["label"]))
        return True

    def head(self, text: str) -> None:
        found = lexemes(text)
        kinds = [k for k, _, _ in found]
        chain = len(found) > 2 and kinds[::2] == ["text"] * len(kinds[::2]) and all(x[:2] == ("mark", "direct") for x in found[1::2]) and len(found) % 2
        if chain:
            for x in found:
                self.put("entry", x[1], "plain") if x[0] == "text" else self.mark(x)
        elif not self.status(text):
            self.plain(found)

    def element(self, text: str, kind: str, nr: str) -> dict | None:
        """An entry element, which its marks part into several; the last of them."""
        made, part, whole = [], [], lexemes(text)
        for x in [*whole, ("end", "", "")]:
            if x[0] in ("text", "siglum"):
                part.append(x)
                continue
            last = part[-1] if part and part[-1][0] == "siglum" else None
            label = spaced(" ".join(raw for _, _, raw in (part[:-1] if last else part)))
            if label or not any(k == "mark" for k, _, _ in whole):
                made.append(self.put("entry", label, kind))
                if last and label:
                    self.named(made[-1], last[1], last[2], "element-text")
            if x[0] == "mark":
                self.mark(x)
            part = []
        said = siglum(nr)
        owners = made if len(made) == 1 else [e for e in made if e["candidates"] == [said]]
        if said and len(owners) == 1:
            self.named(owners[0], said, nr, "attr")
        return made[-1] if made else None

    def tail(self, text: str, entry: dict | None) -> None:
        found = lexemes(text)
        if entry is not None and found and found[0][0] == "siglum":
            self.named(entry, found[0][1], found[0][2], "tail")
            found = found[1:]
        rest = " ".join(raw for _, _, raw in found)
        if entry is not None and rest.startswith("#"):
            self.barrier(rest)
        elif entry is not None and rest and not any(k == "mark" for k, _, _ in found) and re.search("[+(]", rest):
            self.put("separator", rest, "textual", "malformed")
        elif entry is not None or not self.status(text):
            self.plain(found)


def parse(data: bytes) -> list[dict]:
    """The tokens of one block element in order; Malformed where the bytes aren't one."""
    root, *inner = scan(data)
    block = _Block()
    read = lambda a, b: html.unescape(_TAG.sub("", data[a:b].decode("utf-8", "replace")))
    children = [s for s in inner if s[1] == 1]
    starts = [s[2] for s in children] + [root[5] if root[5] is not None else root[3]]
    if root[4] is not None:
        block.head(read(root[4], starts[0]))
    for child, end in zip(children, starts[1:]):
        name, tail = child[0].split(":")[-1], read(child[3], end)
        if name in ENTRIES:
            text = read(child[4], child[5]) if child[4] is not None else ""
            block.tail(tail, block.element(text, ENTRIES[name], html.unescape(dict(child[6]).get("nr", ""))))
        elif name in JOINS:
            block.put("separator", name, "xml", JOINS[name])
            block.tail(tail, None)
        else:
            block.put("barrier", name, "element")
            block.barrier(tail)
    return block.tokens


_SCHEMA = "ord int, kind string, value string, encoding string, join string, context string, siglum string, siglum_source string, candidates array<string>, raw array<string>"


def tokens(blocks: DataFrame, key: str, content: str) -> DataFrame:
    """key, fault, ord (from 1), kind (entry, separator or barrier), value (label, mark or text), encoding, join, context,
    siglum (of entries that have one candidate), siglum_source (conflict: several), candidates and raw spellings.  A
    block that isn't well formed gives one row with its fault."""

    def run(batches):
        types = [pa.string(), pa.int32(), *[pa.string()] * 7, pa.list_(pa.string()), pa.list_(pa.string())]
        for batch in batches:
            at, rows = [], []
            for i, data in enumerate(batch.column(1)):
                try:
                    found = [(None, n, t["kind"], t["value"], t["encoding"], t["join"], t["context"], t["candidates"][0] if len(t["candidates"]) == 1 else "", "conflict" if len(t["candidates"]) > 1 else "".join(t["sources"]), t["candidates"], t["raw"]) for n, t in enumerate(parse(data.as_py() or b""), 1)]
                except Malformed as e:
                    found = [(str(e), *[None] * 10)]
                at += [i] * len(found)
                rows += found
            columns = [pa.array(c, t) for c, t in zip(zip(*rows), types)] if rows else [pa.array([], t) for t in types]
            yield pa.RecordBatch.from_arrays([batch.column(0).take(pa.array(at, pa.int64())), *columns], ["key", "fault", *[f.split(" ")[0] for f in _SCHEMA.split(", ")]])

    kind = blocks.schema[key].dataType.simpleString()
    return blocks.select(F.col(key).alias("key"), F.col(content).cast("binary").alias("content")).mapInArrow(run, f"key {kind}, fault string, {_SCHEMA}")


def _said(found: list[dict]) -> list[tuple]:
    """(ord, join, encoding, mark, left, right, resolved) of each separator, with the labels of the entries next to it:
    past other separators, not past a barrier."""
    near, out = None, []
    for n, t in enumerate(found, 1):
        if t["kind"] == "separator":
            out.append([n, t["join"], t["encoding"], t["value"], near, None])
        else:
            near = t["value"] if t["kind"] == "entry" else None
    near, i = None, len(out)
    for n, t in zip(range(len(found), 0, -1), reversed(found)):
        if t["kind"] == "separator":
            i -= 1
            out[i][5] = near
        else:
            near = t["value"] if t["kind"] == "entry" else None
    return [(*x, x[4] is not None and x[5] is not None and x[1] in ("direct", "indirect")) for x in out]


def _per_block(blocks: DataFrame, key: str, content: str, rows, fields: list[tuple[str, str, pa.DataType]]) -> DataFrame:
    """key, place (from 1) and the fields of the tuples that ``rows`` makes of a block's tokens, map side; blocks that aren't
    well formed give none."""

    def run(batches):
        for batch in batches:
            at, out = [], []
            for i, data in enumerate(batch.column(1)):
                try:
                    found = rows(parse(data.as_py() or b""))
                except Malformed:
                    continue
                at += [i] * len(found)
                out += [(n, *x) for n, x in enumerate(found, 1)]
            types = [pa.int32(), *[t for _, _, t in fields]]
            columns = [pa.array(c, t) for c, t in zip(zip(*out), types)] if out else [pa.array([], t) for t in types]
            yield pa.RecordBatch.from_arrays([batch.column(0).take(pa.array(at, pa.int64())), *columns], ["key", "place", *[n for n, _, _ in fields]])

    kind = blocks.schema[key].dataType.simpleString()
    schema = ", ".join(f"{n} {t}" for n, t, _ in fields)
    return blocks.select(F.col(key).alias("key"), F.col(content).cast("binary").alias("content")).mapInArrow(run, f"key {kind}, place int, {schema}")


def entries(blocks: DataFrame, key: str, content: str) -> DataFrame:
    """key, place (from 1), ord, label, kind, siglum and source of the entries of each block."""

    def rows(found):
        return [(n, t["value"], t["encoding"], t["candidates"][0] if len(t["candidates"]) == 1 else "", "conflict" if len(t["candidates"]) > 1 else "".join(t["sources"])) for n, t in enumerate(found, 1) if t["kind"] == "entry"]

    return _per_block(blocks, key, content, rows, [("ord", "int", pa.int32()), *[(n, "string", pa.string()) for n in ("label", "kind", "siglum", "source")]])


def joins(blocks: DataFrame, key: str, content: str) -> DataFrame:
    """key, place (from 1), ord, join, encoding, mark, left, right, resolved: the join statements of each block, as
    ``statements`` gives them, with the labels of both entries."""
    text = [(f"`{n}`", "string", pa.string()) for n in ("join", "encoding", "mark", "left", "right")]
    return _per_block(blocks, key, content, _said, [("ord", "int", pa.int32()), *[(n.strip("`"), t, k) for n, t, k in text], ("resolved", "boolean", pa.bool_())])


def statements(found: DataFrame) -> DataFrame:
    """key, ord, join, mark, left, right, resolved: each separator with the entries next to it, by their ``ord``; only
    direct and indirect joins with both are resolved."""
    rows = found.where("fault IS NULL").select("key", "ord", "kind", F.when(F.col("kind") == "entry", F.struct(F.col("ord").alias("entry"), F.lit("").alias("join"), F.lit("").alias("mark"))).otherwise(F.struct(F.lit(None).cast("int").alias("entry"), "join", F.col("value").alias("mark"))).alias("value"))
    near = hierarchy.apparatus(rows, ["key"], "ord")
    return near.select("key", "ord", "mark.join", "mark.mark", F.col("left.entry").alias("left"), F.col("right.entry").alias("right"), (F.col("resolved") & F.col("mark.join").isin("direct", "indirect")).alias("resolved"))
