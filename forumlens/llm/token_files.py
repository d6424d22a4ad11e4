"""Token ids in flat files of unsigned integers, with 64-bit document offsets.

A dataset is a folder of numbered pairs of files: ``part-N-X.bin`` holds the ids of
all documents of a part one after another, as little-endian unsigned integers
(16 bits wide if the vocabulary allows, else 32), and ``part-N-X.idx`` a header of
four 64-bit numbers (format, width in bytes, documents, tokens), then the
documents' offsets in the part, one more than documents, then their ids. Parts
follow each other in ascending doc_id order; ``manifest`` names the files that
belong to the dataset with their bases, which are prefix sums of the parts' sizes.
Files of lost task attempts are in no manifest.
"""

from __future__ import annotations

import json
import re
import sys
import uuid
from array import array
from collections.abc import Iterator
from functools import lru_cache

import numpy as np
import pyarrow as pa
import pyarrow.fs as pafs
from pyspark import TaskContext
from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from forumlens.session import new_path

FORMAT = 1
#: Ids that follow a document.
END = 0
#: Pieces whose ids a worker remembers in each of two generations (some 200 bytes each).
CACHE = 600_000
#: Bytes of ids gathered before they go to the file.
BUFFER = 8 << 20
#: Characters of a batch read back at once, in ids.
CHUNK = 4 << 20

# Fixed value: how a byte-level tokenizer splits a text, here for the letters and
# numbers of the characters below. Its contractions begin like no word, so words can
# come first.
_LETTER, _NUMBER = "A-Za-zªµºÀ-ÖØ-öø-ɏ", "0-9²³¹¼-¾"
_PIECES = re.compile(
    rf" ?[{_LETTER}]+|'(?:s|t|re|ve|m|ll|d)| ?[{_NUMBER}]+| ?[^\s{_LETTER}{_NUMBER}]+|\s+(?!\S)|\s+"
)
# Texts with other characters, or with a special token's string, are encoded as a whole
_UNUSUAL = re.compile(r"[^\t\n\r\x20-\x7e¡-ɏ]|<\|")


def _byte_letters() -> dict[int, str]:
    """The letter of each byte in a byte-level vocabulary: itself if it can be seen, else the next from U+0100 on."""
    seen = [*range(0x21, 0x7F), *range(0xA1, 0xAD), *range(0xAE, 0x100)]
    hidden = [b for b in range(256) if b not in seen]
    return {b: chr(b) for b in seen} | {b: chr(256 + i) for i, b in enumerate(hidden)}


class Encoder:
    """A tokenizer that remembers the ids of pieces it has met.

    Byte-level BPE splits a text into pieces and encodes each by itself, so the
    pieces' ids joined are the text's ids. Other kinds encode whole texts.
    """

    def __init__(self, path: str) -> None:
        from tokenizers import Tokenizer

        self.tokenizer = Tokenizer.from_file(path)
        self.width = 2 if self.tokenizer.get_vocab_size() <= 1 << 16 else 4
        self.kind = np.dtype(f"<u{self.width}")
        self.code = "H" if self.width == 2 else "I"
        told = json.loads(self.tokenizer.to_str())
        split = told["pre_tokenizer"] or {}
        plain = {"type": "ByteLevel", "add_prefix_space": False, "use_regex": True}
        self.by_piece = told["model"]["type"] == "BPE" and not told["normalizer"] and plain.items() <= split.items() and sys.byteorder == "little"
        self.letters = _byte_letters()
        # Two generations: pieces that are met again outlive a full memory
        self.known: dict[str, bytes] = {}
        self.older: dict[str, bytes] = {}

    def _whole(self, text: str) -> bytes:
        return np.array(self.tokenizer.encode(text, add_special_tokens=False).ids, dtype=self.kind).tobytes()

    def _learn(self, pieces: set[str]) -> None:
        if len(self.known) > CACHE:
            self.known, self.older = {}, self.known
        known, older, tokenize = self.known, self.older, self.tokenizer.model.tokenize
        for piece in pieces.difference(known):
            found = older.get(piece)
            if found is None:
                # A byte is a character of Latin-1, and that one a letter of the vocabulary
                tokens = tokenize(piece.encode().decode("latin-1").translate(self.letters))
                found = array(self.code, [t.id for t in tokens]).tobytes()
            known[piece] = found

    def __call__(self, text: str | None) -> bytes:
        """The ids of a text and END."""
        end = END.to_bytes(self.width, "little")
        if not text:
            return end
        if not self.by_piece or _UNUSUAL.search(text):
            return self._whole(text) + end
        pieces = _PIECES.findall(text)
        self._learn(set(pieces))
        known = self.known
        return b"".join([known[p] for p in pieces]) + end


@lru_cache(maxsize=1)
def encoder(path: str) -> Encoder:
    """One per worker process, whose memory of pieces outlives a task."""
    return Encoder(path)


def _open(folder: str) -> tuple[pafs.FileSystem, str]:
    """The file system of a folder that all executors share, and the folder's path in it."""
    return pafs.FileSystem.from_uri(folder if "://" in folder or folder.startswith("file:") else f"file://{folder}")


def write_tokens(docs: DataFrame, folder: str, tokenizer: str) -> None:
    """Encode every text of ``docs`` (``doc_id, text``) into a dataset at ``folder``.

    Null and empty texts hold END alone. Rows follow in ascending doc_id order,
    null ids first (as -1) and equal ids by text. An empty table gives a dataset
    without files. ``folder`` must be one that all executors reach.
    """
    spark = docs.sparkSession
    rows = docs.select(F.coalesce(F.col("doc_id").cast("long"), F.lit(-1)).alias("doc_id"), "text")
    ordered = rows.repartitionByRange("doc_id").sortWithinPartitions("doc_id", "text")

    def write(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        part = TaskContext.get().partitionId()
        name = f"part-{part:08d}-{uuid.uuid4().hex}"
        encode, ids, lengths = encoder(tokenizer), [], []
        out, fs, path = None, None, ""
        waiting: list[bytes] = []
        size = 0
        for batch in batches:
            for doc_id, text in zip(batch.column(0).to_pylist(), batch.column(1), strict=True):
                data = encode(text.as_py())
                ids.append(doc_id)
                lengths.append(len(data) // encode.width)
                waiting.append(data)
                size += len(data)
                if size >= BUFFER:
                    if out is None:
                        fs, path = _open(folder)
                        fs.create_dir(path)
                        out = fs.open_output_stream(f"{path}/{name}.bin")
                    out.write(b"".join(waiting))
                    waiting, size = [], 0
        if not ids:
            return
        if out is None:
            fs, path = _open(folder)
            fs.create_dir(path)
            out = fs.open_output_stream(f"{path}/{name}.bin")
        out.write(b"".join(waiting))
        out.close()
        offsets = np.concatenate([[0], np.cumsum(lengths, dtype=np.int64)]).astype("<u8")
        head = np.array([FORMAT, encode.width, len(ids), int(offsets[-1])], dtype="<u8")
        with fs.open_output_stream(f"{path}/{name}.idx") as index:
            index.write(head.tobytes() + offsets.tobytes() + np.array(ids, dtype="<i8").tobytes())
        yield pa.RecordBatch.from_pydict({"part": [part], "file": [name], "n_docs": [len(ids)], "n_tokens": [int(offsets[-1])]})

    written = new_path(spark, "token-parts")
    ordered.mapInArrow(write, "part long, file string, n_docs long, n_tokens long").write.parquet(written)
    # One row per file
    before = Window.orderBy("part").rowsBetween(Window.unboundedPreceding, -1)
    found = spark.read.schema("part long, file string, n_docs long, n_tokens long").parquet(written)
    found.withColumn("base", F.coalesce(F.sum("n_tokens").over(before), F.lit(0))).write.parquet(f"{folder}/manifest")


def read_tokens(spark: SparkSession, folder: str) -> DataFrame:
    """``doc_id, start, n_tokens, ids_crc32`` per document of a dataset.

    ``start`` is the number of ids of all documents before it. Local files are
    memory-mapped; from other stores a part is read in bounded pieces. A file that
    does not have the size its index tells is an error.
    """
    files = spark.read.schema("part long, file string, n_docs long, n_tokens long, base long").parquet(f"{folder}/manifest")

    def read(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        import zlib

        for batch in batches:
            for row in batch.to_pylist():
                fs, path = _open(folder)
                with fs.open_input_stream(f"{path}/{row['file']}.idx") as index:
                    head = np.frombuffer(index.read(32), "<u8")
                    n = int(head[2])
                    offsets = np.frombuffer(index.read(8 * (n + 1)), "<u8").astype(np.int64)
                    ids = np.frombuffer(index.read(8 * n), "<i8")
                if int(head[0]) != FORMAT or n != row["n_docs"] or len(ids) != n:
                    raise ValueError(f"damaged index {row['file']}")
                width, data = int(head[1]), f"{path}/{row['file']}.bin"
                if fs.get_file_info(data).size != int(offsets[-1]) * width:
                    raise ValueError(f"damaged part {row['file']}")
                local = isinstance(fs, pafs.LocalFileSystem)
                mapped = np.memmap(data, f"<u{width}", "r") if local else None
                source = None if local else fs.open_input_file(data)
                sums = []
                for a, b in zip(offsets[:-1].tolist(), offsets[1:].tolist(), strict=True):
                    crc = 0
                    for c in range(a, b, CHUNK):
                        d = min(b, c + CHUNK)
                        values = mapped[c:d] if local else np.frombuffer(source.read_at((d - c) * width, c * width), f"<u{width}")
                        crc = zlib.crc32(values.astype("<u4").tobytes(), crc)
                    sums.append(crc)
                for k in range(0, n, 50_000):
                    piece = slice(k, min(n, k + 50_000))
                    yield pa.RecordBatch.from_pydict(
                        {
                            "doc_id": pa.array(ids[piece]),
                            "start": pa.array(offsets[:-1][piece] + row["base"]),
                            "n_tokens": pa.array(np.diff(offsets)[piece]),
                            "ids_crc32": pa.array(sums[piece], pa.int64()),
                        }
                    )

    # One task per file: each holds a part's worth of work
    spread = files.repartitionByRange(max(1, min(files.count(), 10_000)), "part")
    return spread.mapInArrow(read, "doc_id long, start long, n_tokens long, ids_crc32 long")
