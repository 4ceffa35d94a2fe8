"""Token ids in files of independent zstandard frames with a trailing seek table.

File layout: data frames (each holds the little-endian unsigned 32-bit ids of whole documents, about
``frame`` bytes of them), a skippable frame with the document index (doc_id, first id, ids; itself
compressed), and the public seekable format's seek table (a skippable frame of compressed size, size and
xxhash64 check sum of each data frame, then the footer).  A reader fetches the two tables and then only the
frames of the documents that it wants, and checks each.

Edge cases: null and empty texts have only the end id; a null doc_id sorts first; repeated doc_ids each keep
their own run; an empty table gives no file and an empty result; other columns are ignored.
"""

from __future__ import annotations

import os
import posixpath
import re
import struct
import uuid
import zlib
from bisect import bisect_right

import numpy as np
import pyarrow as pa
import xxhash
import zstandard
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from .common import SharedWriter, bound_batches, file_system, lean, materialise, shared_folder

#: Fixed values of the seekable format: skippable frame of the table, its footer's number, the check sum flag.
_SEEK_FRAME, _SEEK_MAGIC, _WITH_SUMS = 0x184D2A5E, 0x8F92EAB1, 0x80
#: The skippable frame of the document index.
_INDEX_FRAME = 0x184D2A50
#: Bytes of ids to a frame and of a file.
FRAME, ROLL = 256 << 10, 256 << 20
#: Bytes of words and ids that an encoder remembers, what one entry costs beside them, and its longest word.
REMEMBERED, ENTRY, LONGEST = 128 << 20, 250, 64

_encoders: dict[str, "Encoder"] = {}


#: Texts on which an encoder compares its ways of splitting with the plain library; else it uses that alone.
_PROBES = ("It's <|endoftext|> don't\n\nx", "á\t b c\u0301 naïve ÀÉÎß übergröße", "12three!! x,y. (z) Word*** ÀÉ, ...", "  a", "the quick brown unbelievableness")


def _byte_letters() -> dict[int, str]:
    """Byte-level vocabularies write each byte as one character: itself if it prints, else the next free one past 255."""
    prints = {*range(0x21, 0x7F), *range(0xA1, 0xAD), *range(0xAE, 0x100)}
    rest = (b for b in range(256) if b not in prints)
    return {b: chr(b) for b in prints} | {b: chr(256 + i) for i, b in enumerate(rest)}


class Encoder(dict):
    """Ids of a text by its space-separated pieces, each encoded once and remembered.

    Exact where the tokenizer splits on white space and drops it, and keeps a word of letters whole for its model;
    an encoder tries that on a few texts first and otherwise encodes whole texts with the plain library."""

    def __init__(self, path: str):
        os.environ.setdefault("TOKENIZERS_PARALLELISM", "false")
        from tokenizers import Tokenizer

        super().__init__()
        self.held = 0
        self.plain = Tokenizer.from_file(path)
        self.model = self.plain.model
        self.marked = re.compile("([A-Za-zÀ-ÖØ-öø-ÿ]+)([!\"#$%&()*+,./:;=?@\\[\\]^_`{|}~-]+)")
        self.letters = re.compile("[a-zß-öø-ÿ]+")
        self.byte_letters = str.maketrans({chr(b): c for b, c in _byte_letters().items()})
        self.split = True
        self.split = self.check(list(_PROBES))

    def _ids(self, piece: str) -> bytes:
        return np.asarray(self.plain.encode(piece, add_special_tokens=False).ids, "<u4").tobytes()

    def __missing__(self, piece: str) -> bytes:
        if self.letters.fullmatch(piece):  # one pre-token, already in its normal form
            word = piece if piece.isascii() else piece.encode().decode("latin-1").translate(self.byte_letters)
            value = np.asarray([t.id for t in self.model.tokenize(word)], "<u4").tobytes()
        elif m := self.marked.fullmatch(piece):  # letters, then marks: two pre-tokens
            value = self[m[1]] + self[m[2]]
        elif self.letters.fullmatch(low := piece.lower()) and len(low) == len(piece) and max(piece) < "\u0100":
            value = self[low]
        else:
            value = self._ids(piece)
        if len(piece) <= LONGEST:
            self.held += ENTRY + 4 * len(piece) + len(value)
            if self.held > REMEMBERED:
                self.clear()
                self.held = 0
            self[piece] = value
        return value

    def encode(self, text: str) -> bytes:
        if not self.split:
            return self._ids(text)
        return b"".join(map(self.__getitem__, text.replace("\n", " ").split(" ")))

    def check(self, texts: list[str]) -> bool:
        return all(self.encode(t) == self._ids(t) for t in texts)


def encoder(path: str) -> Encoder:
    if path not in _encoders:
        _encoders[path] = Encoder(path)
    return _encoders[path]


class StoreWriter:
    def __init__(self, folder: str, name: str, frame: int = FRAME, level: int = 1):
        self.out, self.frame, self.zip = SharedWriter(folder, name), frame, zstandard.ZstdCompressor(level=level)
        self.pending: list[bytes] = []
        self.held = self.ids = 0
        self.table: list[tuple[int, int, int]] = []
        self.index: list[tuple] = []

    @property
    def path(self) -> str:
        return self.out.path

    def add(self, doc_id, data: bytes) -> None:
        self.index.append((doc_id, self.ids, len(data) // 4))
        self.ids += len(data) // 4
        self.pending.append(data)
        self.held += len(data)
        if self.held >= self.frame:
            self._flush()

    def _flush(self) -> None:
        if self.pending:
            data = b"".join(self.pending)
            packed = self.zip.compress(data)
            self.table.append((len(packed), len(data), xxhash.xxh64_intdigest(data) & 0xFFFFFFFF))
            self.out.write(packed)
            self.pending, self.held = [], 0

    def close(self) -> None:
        self._flush()
        columns = [[x[0] for x in self.index], [x[1] for x in self.index], [x[2] for x in self.index]]
        known = np.array([x is not None for x in columns[0]], "u1").tobytes()
        body = struct.pack("<Q", len(self.index)) + known + b"".join(np.array([0 if v is None else v for v in c], "<i8").tobytes() for c in columns)
        packed = self.zip.compress(body)
        self.out.write(struct.pack("<II", _INDEX_FRAME, len(packed)) + packed)
        entries = b"".join(struct.pack("<III", *x) for x in self.table)
        footer = struct.pack("<IBI", len(self.table), _WITH_SUMS, _SEEK_MAGIC)
        self.out.write(struct.pack("<II", _SEEK_FRAME, len(entries) + len(footer)) + entries + footer)
        self.out.commit()


class StoreReader:
    """Random access to the documents of one file; ``source`` has size(), seek() and read()."""

    def __init__(self, source):
        self.source = source
        frames, flags, magic = struct.unpack("<IBI", self._at(source.size() - 9, 9))
        if magic != _SEEK_MAGIC or flags != _WITH_SUMS:
            raise ValueError("no seek table")
        table = struct.iter_unpack("<III", self._at(source.size() - 9 - 12 * frames, 12 * frames))
        self.frames, place, ids = [], 0, 0
        for packed, size, total in table:
            self.frames.append((ids, place, packed, size, total))
            place, ids = place + packed, ids + size // 4
        magic, n = struct.unpack("<II", self._at(place, 8))
        if magic != _INDEX_FRAME:
            raise ValueError("no document index")
        self.unzip = zstandard.ZstdDecompressor()
        body = self.unzip.decompress(self._at(place + 8, n))
        docs = struct.unpack_from("<Q", body)[0]
        known = np.frombuffer(body, "u1", docs, 8)
        self.doc_ids, self.first, self.count = (np.frombuffer(body, "<i8", docs, 8 + docs + 8 * docs * k) for k in range(3))
        self.known = known.astype(bool)
        self.starts = [f[0] for f in self.frames]
        self._held = (-1, b"")

    def _at(self, position: int, n: int) -> bytes:
        self.source.seek(position)
        return self.source.read(n)

    def _frame(self, k: int) -> bytes:
        if self._held[0] != k:
            _, place, packed, size, total = self.frames[k]
            data = self.unzip.decompress(self._at(place, packed), max_output_size=size)
            if len(data) != size or xxhash.xxh64_intdigest(data) & 0xFFFFFFFF != total:
                raise ValueError(f"frame {k}: check sum differs")
            self._held = (k, data)
        return self._held[1]

    def ids(self, row: int) -> bytes:
        """The ids of the file's row-th document; one frame is read."""
        k = bisect_right(self.starts, self.first[row]) - 1
        at = 4 * int(self.first[row] - self.starts[k])
        return self._frame(k)[at : at + 4 * int(self.count[row])]


_FILES = "file string, part string, first long, ids long"


def _encoding(folder: str, tokenizer: str, end_id: int, frame: int, roll: int):
    """Writes runs of rows (doc_id, text, part, row): a new file begins with each part, after a gap in the rows, or
    when a file is large enough.  Yields a row for each committed file, with the part and row that it begins at."""
    end = np.asarray([end_id], "<u4").tobytes()

    def run(batches):
        rows, out, encode, after = [], None, encoder(tokenizer).encode, None

        def close():
            out.close()
            rows.append((out.path, *began, out.ids))

        for batch in batches:
            for doc_id, whole, part, row in zip(*(c.to_pylist() for c in batch.columns)):
                if out is not None and ((part, row) != after or out.out.size >= roll):
                    close()
                    out = None
                if out is None:
                    out, began = StoreWriter(folder, f"ids-{uuid.uuid4().hex}.zst", frame), (part, row)
                out.add(doc_id, (encode(whole) if whole else b"") + end)
                after = part, row + 1
        if out is not None:
            close()
        yield pa.RecordBatch.from_arrays([pa.array([r[k] for r in rows], t) for k, t in enumerate((pa.string(), pa.string(), pa.int64(), pa.int64()))], ["file", "part", "first", "ids"])

    return lean(run)


def _listed(spark, written: DataFrame) -> DataFrame:
    """file, before: the committed files in order, with the ids of the files before each; a small row for each file."""
    files, before = [], 0
    for r in materialise(written, "token-files").orderBy(F.length("part"), "part", "first").toLocalIterator():
        files.append((r["file"], before))
        before += r["ids"]
    return spark.createDataFrame(files, "file string, before long")


def write(docs: DataFrame, folder: str, tokenizer: str, end_id: int, text: str = "text", key: str = "doc_id", frame: int = FRAME, roll: int = ROLL) -> DataFrame:
    """Sorts by the key over range partitions and writes their ids; returns the list of committed files in order,
    each with the ids of the files before it."""
    bound_batches(docs.sparkSession)
    rows = docs.select(F.col(key).cast("long").alias("doc_id"), F.col(text).alias("text"))
    order = F.col("doc_id").asc_nulls_first()
    ranged = rows.repartitionByRange(order).sortWithinPartitions(order, F.xxhash64("text"))  # the hash only settles ties
    placed = ranged.select("doc_id", "text", F.spark_partition_id().cast("string").alias("part"), (F.monotonically_increasing_id() % F.lit(1 << 33)).alias("row"))
    return _listed(docs.sparkSession, placed.mapInArrow(_encoding(folder, tokenizer, end_id, frame, roll), _FILES))


def write_placed(docs: DataFrame, folder: str, tokenizer: str, end_id: int, part: Column, row: Column, text: str = "text", key: str = "doc_id", frame: int = FRAME, roll: int = ROLL) -> DataFrame:
    """As ``write``, for rows that lie in order already, as those of files read from disk: ``part`` names the file
    (shorter names first) and ``row`` is the row's number in it.  Nothing is shuffled."""
    bound_batches(docs.sparkSession)
    placed = docs.select(F.col(key).cast("long").alias("doc_id"), F.col(text).alias("text"), part.cast("string").alias("part"), row.cast("long").alias("row"))
    return _listed(docs.sparkSession, placed.mapInArrow(_encoding(folder, tokenizer, end_id, frame, roll), _FILES))


def read(files: DataFrame) -> DataFrame:
    """Each document's doc_id, start (ids before it), n_tokens and the crc32 of its ids, from the files."""
    types, names = (pa.int64(),) * 4, ["doc_id", "start", "n_tokens", "ids_crc32"]

    def run(batches):
        for batch in batches:
            for path, before in zip(*(c.to_pylist() for c in batch.columns)):
                fs, name = file_system(path)
                with fs.open_input_file(name) as source:
                    store = StoreReader(source)
                    n = len(store.count)
                    for a in range(0, n, 4096):
                        sums = [zlib.crc32(store.ids(i)) for i in range(a, min(n, a + 4096))]
                        b = a + len(sums)
                        columns = [pa.array(store.doc_ids[a:b], pa.int64(), mask=~store.known[a:b]), store.first[a:b] + before, store.count[a:b], sums]
                        yield pa.RecordBatch.from_arrays([c if isinstance(c, pa.Array) else pa.array(c, t) for c, t in zip(columns, types)], names)

    spread = files.repartition(max(1, int(files.sparkSession.conf.get("spark.sql.shuffle.partitions"))))
    return spread.mapInArrow(lean(run), "doc_id long, start long, n_tokens long, ids_crc32 long")


def fetch(files: DataFrame, wanted: list[int]) -> dict[int, list[int]]:
    """The ids of a few documents by key; only their frames are decompressed."""
    found = {}
    for r in files.toLocalIterator():
        fs, name = file_system(r["file"])
        with fs.open_input_file(name) as source:
            store = StoreReader(source)
            for i in np.flatnonzero(np.isin(store.doc_ids, wanted) & store.known):
                found[int(store.doc_ids[i])] = np.frombuffer(store.ids(int(i)), "<u4").tolist()
    return found


def round_trip(docs: DataFrame, tokenizer: str, end_id: int, place: tuple[Column, Column] | None = None, text: str = "text", key: str = "doc_id") -> DataFrame:
    """Write to the shared folder, in ascending order of the key or at the rows' places (part, row), and read back."""
    folder = posixpath.join(shared_folder(docs.sparkSession, "tokens"))
    if place is None:
        return read(write(docs, folder, tokenizer, end_id, text, key))
    return read(write_placed(docs, folder, tokenizer, end_id, *place, text, key))
