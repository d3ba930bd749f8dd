"""Files of token ids as compressed bit or byte planes.

A file holds chunks, then an index, then the index's length and ``MAGIC``. A chunk has the ids of some
documents in blocks of ``BLOCK`` ids; the last block is filled up with zeros. A block is turned into 32
bit planes (or 4 byte planes), so that the high planes of small ids are all zeros. Planes of the
same rank are put together over the chunk's blocks and compressed by zstandard. The index has a row
for each chunk: where it starts, how many documents and ids it has, and the length of every plane.
"""

from __future__ import annotations

import json
import struct
import zlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import zstandard
from pyarrow import fs
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from featloom.llm.common import Batches, map_batches, present, ship, text_bytes, to_arrow
from featloom.llm.tokens import END, WORD_BPE, token_ids
from featloom.operators.ranking import running_totals
from featloom.session import checkpointed, scratch_path

BLOCK = 4096
CHUNK = 1 << 18
"""Ids after which a chunk ends; a document is never split over chunks."""
FILE = 1 << 22
"""Ids after which a file ends, so that a reader holds little."""
LEVEL = 3
MAGIC = b"IDPLANES"


def shuffled(ids: np.ndarray, bits: bool) -> list[bytes]:
    """The planes of ``ids``, lowest first."""
    blocks = np.zeros(-(-len(ids) // BLOCK) * BLOCK, "<u4")
    blocks[: len(ids)] = ids
    by_byte = blocks.view(np.uint8).reshape(-1, BLOCK, 4)
    if not bits:
        return [by_byte[:, :, k].tobytes() for k in range(4)]
    planes = []
    for k in range(4):
        column = np.ascontiguousarray(by_byte[:, :, k])
        if not column.any():
            planes += [bytes(column.size // 8)] * 8
            continue
        planes += [np.packbits(column >> j & 1, axis=1, bitorder="little").tobytes() for j in range(8)]
    return planes


def restored(planes: list[bytes], n: int) -> np.ndarray:
    """The ids whose planes these are."""
    size = -(-n // BLOCK) * BLOCK
    out = np.zeros((size, 4), np.uint8)
    for at, plane in enumerate(planes):
        raw = np.frombuffer(plane, np.uint8)
        if len(planes) == 4:
            out[:, at] = raw
        elif raw.any():
            out[:, at // 8] |= np.unpackbits(raw, bitorder="little") << (at % 8)
    return out.reshape(-1).view("<u4")[:n]


class PlaneFile:
    """One file in the making: documents in, bytes out."""

    def __init__(self, bits: bool) -> None:
        self.bits, self.body, self.index = bits, bytearray(), []
        self.ids: list[bytes] = []
        self.docs: list[int | None] = []
        self.lengths: list[int] = []
        self.open_ids = self.n_ids = self.n_docs = 0
        self.press = zstandard.ZstdCompressor(level=LEVEL)

    def add(self, doc_id: int | None, ids: bytes) -> None:
        """Append a document."""
        self.ids.append(ids)
        self.docs.append(doc_id)
        self.lengths.append(len(ids) // 4)
        self.open_ids += len(ids) // 4
        self.n_ids += len(ids) // 4
        self.n_docs += 1
        if self.open_ids >= CHUNK:
            self.close_chunk()

    def close_chunk(self) -> None:
        """Compress what came since the last chunk."""
        if not self.docs:
            return
        planes = shuffled(np.frombuffer(b"".join(self.ids), "<u4"), self.bits)
        known = np.array([x is not None for x in self.docs])
        numbers = np.array([x or 0 for x in self.docs], "<i8")
        heads = [numbers.tobytes(), np.packbits(known).tobytes(), np.array(self.lengths, "<i8").tobytes()]
        parts = [self.press.compress(x) for x in [*heads, *planes]]
        self.index.append([len(self.body), len(self.docs), self.open_ids, [len(x) for x in parts]])
        for part in parts:
            self.body += part
        self.ids, self.docs, self.lengths, self.open_ids = [], [], [], 0

    def finish(self) -> bytes:
        """The whole file."""
        self.close_chunk()
        index = json.dumps({"bits": self.bits, "chunks": self.index}).encode()
        return bytes(self.body) + index + struct.pack("<q", len(index)) + MAGIC


def read_chunks(data: bytes) -> Iterator[tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray]]:
    """doc_ids, which of them are known, lengths and ids of each chunk of a file."""
    if data[-8:] != MAGIC:
        raise ValueError("not a file of id planes, or cut off")
    size = struct.unpack("<q", data[-16:-8])[0]
    index = json.loads(data[-16 - size : -16])
    opened = zstandard.ZstdDecompressor()
    for start, n_docs, n_ids, lengths in index["chunks"]:
        ends = start + np.cumsum([0, *lengths])
        parts = [opened.decompress(data[a:b]) for a, b in zip(ends[:-1], ends[1:], strict=True)]
        known = np.unpackbits(np.frombuffer(parts[1], np.uint8))[:n_docs].astype(bool)
        numbers, counts = np.frombuffer(parts[0], "<i8"), np.frombuffer(parts[2], "<i8")
        yield numbers, known, counts, restored(parts[3:], n_ids)


def write_planes(
    docs: DataFrame,
    folder: str,
    text: str = "text",
    doc_id: str = "doc_id",
    vocabulary: str = WORD_BPE,
    bits: bool = True,
) -> DataFrame:
    """Write the ids of all texts in ascending doc_id order; file_no, path, n_docs and n_ids of each file.

    Null texts are empty and still get the end id; null doc_ids come first; rows of one doc_id
    follow in the order of their texts. Files are written by the tasks under a name of their own
    and then moved, so a repeated task changes nothing. ``folder`` must be shared by all executors.
    """
    spark = docs.sparkSession
    ship(spark)
    rows = docs.select(F.col(doc_id).cast("long").alias("doc_id"), present(text).alias("text"))
    rows = rows.repartitionByRange("doc_id").sortWithinPartitions("doc_id", "text")
    schema = "file_no long, path string, n_docs long, n_ids long"
    arrow = to_arrow(spark, schema)

    def run(batches: Batches) -> Batches:
        from pyspark import TaskContext

        context = TaskContext.get()
        part, attempt = context.partitionId(), context.taskAttemptId()
        store, root = fs.FileSystem.from_uri(folder)
        made, current = 0, PlaneFile(bits)

        def put(file: PlaneFile, number: int) -> pa.RecordBatch:
            name = f"{root}/ids-{number:015d}.planes"
            with store.open_output_stream(f"{name}.{attempt}") as out:
                out.write(file.finish())
            if store.get_file_info(name).type == fs.FileType.NotFound:
                store.move(f"{name}.{attempt}", name)
            else:
                # an attempt before this one got as far, with the same rows
                store.delete_file(f"{name}.{attempt}")
            values = [number], [f"{folder}/ids-{number:015d}.planes"], [file.n_docs], [file.n_ids]
            return pa.RecordBatch.from_arrays(
                [pa.array(v, f.type) for v, f in zip(values, arrow, strict=True)], schema=arrow
            )

        end = END.to_bytes(4, "little")
        store.create_dir(root, recursive=True)
        for batch in batches:
            for number, data in zip(batch.column("doc_id").to_pylist(), text_bytes(batch), strict=True):
                current.add(number, token_ids(data, vocabulary) + end)
                if current.n_ids >= FILE:
                    yield put(current, part * 1_000_000 + made)
                    made, current = made + 1, PlaneFile(bits)
        if current.n_docs:
            yield put(current, part * 1_000_000 + made)

    return checkpointed(rows.mapInArrow(run, schema))


def read_planes(spark: SparkSession, files: DataFrame, folder: str) -> DataFrame:
    """doc_id, start, n_tokens and ids_crc32 of every document in ``files``, read from ``folder``.

    Files are whole rows of Spark's binary source, each of bounded size. A document starts after the ids
    of all files before its own, of which a table of one row per file is summed up.
    """
    if files.isEmpty():
        return spark.createDataFrame([], "doc_id long, start long, n_tokens long, ids_crc32 long")
    upto = running_totals(files.select("file_no", "n_ids"), "file_no", {"upto": F.col("n_ids")})
    starts = upto.select("file_no", (F.col("upto") - F.col("n_ids")).alias("first"))

    def make(batch: pa.RecordBatch) -> dict:
        out: dict[str, list] = {n: [] for n in ("file_no", "doc_id", "start", "n_tokens", "ids_crc32")}
        for number, data in zip(batch.column("file_no").to_pylist(), batch.column("content"), strict=True):
            at = 0
            for numbers, known, counts, ids in read_chunks(data.as_py()):
                raw, place = memoryview(ids.tobytes()), 0
                for doc, there, n in zip(numbers.tolist(), known.tolist(), counts.tolist(), strict=True):
                    out["file_no"].append(number)
                    out["doc_id"].append(doc if there else None)
                    out["start"].append(at)
                    out["n_tokens"].append(n)
                    out["ids_crc32"].append(zlib.crc32(raw[place : place + 4 * n]))
                    at, place = at + n, place + 4 * n
        return out

    stored = (
        spark.read.format("binaryFile")
        .option("pathGlobFilter", "ids-*.planes")
        .load(folder)
        .select(F.regexp_extract("path", r"ids-(\d+)\.planes$", 1).cast("long").alias("file_no"), "content")
    )
    rows = map_batches(
        stored, make, "file_no long, doc_id long, start long, n_tokens long, ids_crc32 long"
    )
    return rows.join(starts, "file_no").select(
        "doc_id", (F.col("start") + F.col("first")).alias("start"), "n_tokens", "ids_crc32"
    )


def encoded_files(docs: DataFrame, text: str = "text", doc_id: str = "doc_id") -> DataFrame:
    """Write all ids to a new shared folder, read the files back, and describe every document."""
    spark = docs.sparkSession
    folder = scratch_path(spark, "planes")
    return read_planes(spark, write_planes(docs, folder, text, doc_id), folder)
