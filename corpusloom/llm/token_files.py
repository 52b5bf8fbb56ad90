"""Token ids in seekable zstandard files.

A file is a row of independent zstandard frames, each with a content checksum, then two skippable frames: an index of what each
frame holds, and the public seek table of the zstandard seekable format (sizes and an XXH64 checksum for each frame, with its footer at the very end). Any
zstandard reader can unpack the whole file; ours reads the tables from the end and unpacks only the frames that hold the documents asked for.

A frame holds whole documents: a header (number of documents, bytes of an id), document ids with a validity byte, token counts, token ids;
everything is little-endian. Documents are sorted by ranges, so files and frames follow one global order. Each task streams its file under a
name of its attempt and renames it when it is whole, so a repeated task replaces a file by an equal one.
"""

from __future__ import annotations

import struct
from collections.abc import Iterator, Sequence
from itertools import chain

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from ..session import land
from . import words

# --- fixed values: the public zstandard formats ---
SKIPPABLE_SEEK_TABLE = 0x184D2A5E
SKIPPABLE_INDEX = 0x184D2A5D
SEEKABLE_MAGIC = 0x8F92EAB1
CHECKSUM_FLAG = 0x80

END_ID = 0
FRAME_TOKENS = 1 << 18  # a frame is closed when it holds this many ids; a longer document has a frame of its own
CACHE = 1 << 22  # pieces of text whose ids a task remembers
ENCODED = 4096  # new pieces encoded at once
ENCODED_BYTES = 1 << 20  # text cut and looked up at once
LEVEL = 3
MANIFEST = "part int, path string, n_frames int, n_docs long, n_tokens long"


# ---- tokens ----


class Encoder:
    """Ids of whole texts by a tokenizer file, computed once for each distinct piece of text.

    A byte-level tokenizer splits a text before it merges, and it always splits at some places that bytes alone show (see ``_cuts``).
    Texts are cut there, and each distinct piece is encoded by the library once. Tasks that share a Python worker share what it knows.
    """

    def __init__(self, path: str):
        from tokenizers import Tokenizer

        self.tokenizer = Tokenizer.from_file(path)
        self.width = 2 if self.tokenizer.get_vocab_size() <= 1 << 16 else 4
        self._forget()

    def _forget(self) -> None:
        """What is known: sorted hashes of pieces, where their ids begin in the pool, how many there are."""
        self.known, self.begins, self.sizes = np.empty(0, np.uint64), np.empty(0, np.int64), np.empty(0, np.int32)
        self.pool, self.filled = np.empty(1 << 16, np.uint16 if self.width == 2 else np.uint32), 0

    @classmethod
    def shared(cls, path: str) -> Encoder:
        kept = words.worker_state()
        if ("encoder", path) not in kept:
            kept["encoder", path] = cls(path)
        return kept["encoder", path]

    def ids(self, texts: pa.Array) -> Iterator[tuple[int, np.ndarray, np.ndarray]]:
        """(first row, ids of the rows one after another, number of ids of each row) of each piece of the column."""
        for at, data, offsets in words.pieces(texts, ENCODED_BYTES):
            n = len(offsets) - 1
            starts = _cuts(data, offsets)
            if not len(starts):
                yield at, self.pool[:0], np.zeros(n, np.int64)
                continue
            ends = np.r_[starts[1:], len(data)]
            which, keys = pd.factorize(words.span_hashes(data, starts, ends))
            some = np.empty(len(keys), np.int64)
            some[which] = np.arange(len(which))
            begins, sizes = self._encoded(keys, data, starts[some], ends[some])
            lengths = sizes[which].astype(np.int64)
            out = np.cumsum(lengths)
            ids = self.pool[np.repeat(begins[which] - (out - lengths), lengths) + np.arange(out[-1])]
            owner = np.searchsorted(offsets, starts, side="right") - 1
            yield at, ids, np.bincount(owner, lengths, n).astype(np.int64)

    def _encoded(self, keys: np.ndarray, data: np.ndarray, starts: np.ndarray, ends: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """(begin in the pool, number of ids) of each distinct piece."""
        if len(self.known) > CACHE:
            self._forget()
        order = np.argsort(keys)
        sorted_keys = keys[order]
        at = np.searchsorted(self.known, sorted_keys)
        new = np.ones(len(keys), bool)
        if len(self.known):
            new = self.known[np.minimum(at, len(self.known) - 1)] != sorted_keys
        if new.any():
            raw = data.tobytes()
            where = zip(starts[order][new].tolist(), ends[order][new].tolist(), strict=True)
            strings = [raw[s:e].decode() for s, e in where]
            ids = []
            for i in range(0, len(strings), ENCODED):  # an encoding holds far more than its ids
                ids += [e.ids for e in self.tokenizer.encode_batch_fast(strings[i : i + ENCODED], add_special_tokens=False)]
            lengths = np.fromiter(map(len, ids), np.int32, len(ids))
            total = int(lengths.sum())
            while self.filled + total > len(self.pool):
                self.pool = np.concatenate([self.pool, np.empty_like(self.pool)])
            self.pool[self.filled : self.filled + total] = np.fromiter(chain.from_iterable(ids), self.pool.dtype, total)
            self.begins = np.insert(self.begins, at[new], self.filled + np.cumsum(lengths) - lengths)
            self.sizes = np.insert(self.sizes, at[new], lengths)
            self.known = np.insert(self.known, at[new], sorted_keys[new])
            self.filled += total
            at = np.searchsorted(self.known, sorted_keys)
        begins, sizes = np.empty(len(keys), np.int64), np.empty(len(keys), np.int32)
        begins[order], sizes[order] = self.begins[at], self.sizes[at]
        return begins, sizes


def _cuts(data: np.ndarray, offsets: np.ndarray) -> np.ndarray:
    """Starts of the pieces: where a row begins, and, all between characters that are no white space,

    before a single space; before and after a single line feed; before ASCII punctuation that follows an ASCII letter.

    White space beyond ASCII begins with the bytes C2, E1, E2 or E3; next to any character that does, no cut is made.
    """
    wide, mark, letter = np.zeros(256, bool), np.zeros(256, bool), np.zeros(256, bool)
    wide[[0xC2, 0xE1, 0xE2, 0xE3]] = True
    mark[[ord(c) for c in ",.;:!?"]] = True
    letter[[*range(65, 91), *range(97, 123)]] = True
    plain = data > 0x20
    cut = np.zeros(len(data), bool)
    borders = offsets[1:-1]
    if len(data) > 2:
        lead = np.zeros(len(data), bool)  # the character before begins with such a byte
        lead[2:] = wide[data[:-2]] & (data[1:-1] >= 0x80)
        lead[3:] |= wide[data[:-3]] & (data[1:-2] >= 0x80) & (data[2:-1] >= 0x80)
        alone = plain[:-2] & plain[2:] & ~wide[data[2:]] & ~lead[1:-1]
        # not where the next or the last character is another row's
        edge = np.zeros(len(data) + 1, bool)
        edge[borders] = True
        alone &= ~edge[1:-2] & ~edge[2:-1]
        line = alone & (data[1:-1] == 0x0A)
        cut[1:-1] = line | (alone & (data[1:-1] == 0x20))
        cut[2:] |= line
        cut[1:] |= mark[data[1:]] & letter[data[:-1]]
    cut[offsets[:-1][offsets[1:] > offsets[:-1]]] = True
    return np.flatnonzero(cut)


# ---- files ----


def _filesystem(path: str):
    from pyarrow import fs

    return fs.FileSystem.from_uri(path)


class _Writer:
    """Streams frames into one file and adds the tables at its end."""

    def __init__(self, stream, width: int):
        import zstandard

        self.stream, self.width = stream, width
        self.pack = zstandard.ZstdCompressor(level=LEVEL, write_checksum=True, write_content_size=True)
        self.seek, self.index = [], []
        self.docs = self.tokens = 0
        self._clear()

    def _clear(self) -> None:
        self.ids, self.counts, self.values, self.held = [], [], [], 0

    def add(self, doc_id: int | None, ids: np.ndarray) -> None:
        if self.held and self.held + len(ids) > FRAME_TOKENS:
            self.flush()
        self.ids.append(doc_id)
        self.counts.append(len(ids))
        self.values.append(ids)
        self.held += len(ids)

    def flush(self) -> None:
        import xxhash

        if not self.ids:
            return
        n = len(self.ids)
        valid = np.array([i is not None for i in self.ids], np.uint8)
        ids = np.array([i or 0 for i in self.ids], "<i8")
        body = b"".join([
            struct.pack("<II", n, self.width), ids.tobytes(), valid.tobytes(), np.array(self.counts, "<u4").tobytes(),
            np.concatenate(self.values).astype(f"<u{self.width}").tobytes(),
        ])
        packed = self.pack.compress(body)
        self.stream.write(packed)
        self.seek.append((len(packed), len(body), xxhash.xxh64(body).intdigest() & 0xFFFFFFFF))
        known = ids[valid == 1]
        low, high = (int(known.min()), int(known.max())) if len(known) else (0, -1)
        self.index.append((low, high, self.docs, self.tokens))
        self.docs += n
        self.tokens += self.held
        self._clear()

    def close(self) -> None:
        self.flush()
        index = b"".join(struct.pack("<qqQQ", *row) for row in self.index)
        self.stream.write(struct.pack("<II", SKIPPABLE_INDEX, len(index)) + index)
        table = b"".join(struct.pack("<III", *row) for row in self.seek) + struct.pack("<IBI", len(self.seek), CHECKSUM_FLAG, SEEKABLE_MAGIC)
        self.stream.write(struct.pack("<II", SKIPPABLE_SEEK_TABLE, len(table)) + table)


class TokenFile:
    """Random access to one file: the tables at first, then only the frames that are asked for."""

    def __init__(self, path: str):
        system, place = _filesystem(path)
        self.file = system.open_input_file(place)
        size = self.file.size()
        frames, flags, magic = struct.unpack("<IBI", self.file.read_at(9, size - 9))
        if magic != SEEKABLE_MAGIC or flags != CHECKSUM_FLAG:
            raise ValueError(f"{path} has no seek table")
        start = size - 9 - 12 * frames
        self.seek = np.frombuffer(self.file.read_at(12 * frames, start), "<u4").reshape(-1, 3)
        self.begins = np.r_[0, np.cumsum(self.seek[:, 0].astype(np.int64))]
        rows = self.file.read_at(32 * frames, start - 8 - 32 * frames)
        self.index = np.frombuffer(rows, [("low", "<i8"), ("high", "<i8"), ("docs", "<u8"), ("tokens", "<u8")])
        self.unpacked = 0

    def frame(self, number: int) -> tuple[list[int | None], np.ndarray, np.ndarray]:
        """(document ids, number of ids of each, all ids) of a frame, checked against both checksums."""
        import xxhash
        import zstandard

        packed = self.file.read_at(int(self.seek[number, 0]), int(self.begins[number]))
        body = zstandard.ZstdDecompressor().decompress(packed)
        if xxhash.xxh64(body).intdigest() & 0xFFFFFFFF != int(self.seek[number, 2]):
            raise ValueError(f"frame {number} does not match its checksum")
        self.unpacked += 1
        n, width = struct.unpack_from("<II", body)
        ids = np.frombuffer(body, "<i8", n, 8)
        valid = np.frombuffer(body, np.uint8, n, 8 + 8 * n)
        counts = np.frombuffer(body, "<u4", n, 8 + 9 * n).astype(np.int64)
        tokens = np.frombuffer(body, f"<u{width}", int(counts.sum()), 8 + 13 * n)
        return [int(i) if v else None for i, v in zip(ids, valid, strict=True)], counts, tokens

    def documents(self, wanted: Sequence[int]) -> list[tuple[int, np.ndarray]]:
        """(id, token ids) of the documents with the wanted ids, in file order; other frames stay packed."""
        want = np.unique(np.asarray(wanted, np.int64))
        out = []
        for number, row in enumerate(self.index):
            lo, hi = np.searchsorted(want, [row["low"], row["high"] + 1])
            if hi > lo:
                ids, counts, tokens = self.frame(number)
                ends = np.cumsum(counts)
                out += [(i, tokens[e - c : e]) for i, c, e in zip(ids, counts, ends, strict=True) if i is not None and i in set(want[lo:hi].tolist())]
        return out


def _write(folder: str, tokenizer: str, end_id: int):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        context = TaskContext.get()
        part, attempt = context.partitionId(), context.taskAttemptId()
        system, place = _filesystem(folder)
        encoder = stream = writer = None
        held, name = f"{place}/.part-{part:06d}-{attempt}", f"part-{part:06d}.zst"
        for batch in batches:
            if not batch.num_rows:
                continue
            if writer is None:
                encoder = Encoder.shared(tokenizer)
                system.create_dir(place, recursive=True)
                stream = system.open_output_stream(held)
                writer = _Writer(stream, encoder.width)
            doc_ids = batch.column(0).to_pylist()
            for at, ids, counts in encoder.ids(batch.column(1)):
                ends = np.cumsum(counts)
                for i, (c, e) in enumerate(zip(counts, ends, strict=True)):
                    writer.add(doc_ids[at + i], np.append(ids[e - c : e], ids.dtype.type(end_id)))
        if writer is not None:
            writer.close()
            stream.close()
            system.move(held, f"{place}/{name}")
            yield pa.RecordBatch.from_pylist(
                [{"part": part, "path": f"{folder}/{name}", "n_frames": len(writer.seek), "n_docs": writer.docs, "n_tokens": writer.tokens}],
                schema=pa.schema([("part", pa.int32()), ("path", pa.string()), ("n_frames", pa.int32()), ("n_docs", pa.int64()), ("n_tokens", pa.int64())]),
            )

    return run


def write_tokens(
    docs: DataFrame, folder: str, tokenizer: str, order_by: Sequence[str | Column] = ("doc_id",), end_id: int = END_ID,
    doc_id: str = "doc_id", text: str = "text",
) -> DataFrame:
    """Write the texts' ids, an end id after each document, in the order of ``order_by``; returns the table of files.

    ``folder`` is one that all executors reach; ``tokenizer`` is the path of a byte-level tokenizer file on every machine. NULL texts are empty: their
    document is the end id alone. NULL ids come first and are kept as NULL; repeated rows are written each; rows that ``order_by`` does not tell
    apart stand by their text's hash, then their text. An empty table writes no file.
    Other columns are only looked at if ``order_by`` names them.
    """
    keys = [F.col(k) if isinstance(k, str) else k for k in order_by]
    rows = docs.select(F.col(doc_id).cast("long").alias("_id"), F.col(text).alias("_text"), *[k.alias(f"_key{i}") for i, k in enumerate(keys)])
    names = [*(f"_key{i}" for i in range(len(keys))), "_tie"]
    rows = rows.withColumn("_tie", F.xxhash64("_text"))
    parts = int(docs.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    dealt = rows.repartitionByRange(parts, *names).sortWithinPartitions(*names, "_text")
    files = dealt.select("_id", "_text").mapInArrow(_write(folder, tokenizer, end_id), MANIFEST)
    return land(files, "token-manifest")


def _read(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    from zlib import crc32

    opened, name = None, None
    for batch in batches:
        for row in batch.to_pylist():
            if row["path"] != name:
                opened, name = TokenFile(row["path"]), row["path"]
            ids, counts, tokens = opened.frame(row["frame"])
            ends = np.cumsum(counts)
            start = row["before"] + int(opened.index["tokens"][row["frame"]])
            wide = tokens.astype("<u4")
            yield pa.RecordBatch.from_arrays(
                [pa.array(ids, pa.int64()), pa.array(ends - counts + start), pa.array(counts), pa.array([crc32(wide[e - c : e].tobytes()) for c, e in zip(counts, ends, strict=True)], pa.int64())],
                names=["doc_id", "start", "n_tokens", "ids_crc32"],
            )


def read_tokens(files: DataFrame) -> DataFrame:
    """``doc_id, start, n_tokens, ids_crc32`` of every document, from the files of a table that ``write_tokens`` returned.

    ``start`` is the number of ids of all documents before; the sum behind it runs over files, of which there is one a task.
    """
    before = Window.orderBy("part").rowsBetween(Window.unboundedPreceding, -1)
    placed = files.select("path", "n_frames", F.coalesce(F.sum("n_tokens").over(before), F.lit(0)).alias("before"))
    frames = placed.select("path", "before", F.explode(F.sequence(F.lit(0), F.col("n_frames") - 1)).alias("frame"))
    dealt = frames.repartition("path", (F.col("frame") / 16).cast("int")).sortWithinPartitions("path", "frame")
    return dealt.mapInArrow(_read, "doc_id long, start long, n_tokens long, ids_crc32 long")
