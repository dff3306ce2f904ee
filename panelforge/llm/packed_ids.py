"""Token-id files with fixed-width bit packing, as a Spark data source named ``packed_ids``.

A data set is a folder with one ``ids-*.pack`` file for each task that wrote and a ``manifest.json``. A file holds
ids of consecutive documents in blocks of ``block_ids`` ids. Each id takes the ``bits`` that the vocabulary needs;
block k starts at ``block_offsets[k]``, so any range of ids is read with one seek and unpacked by numpy shifts.

    magic "PKIDS001" | blocks | documents (Arrow: doc_id, start in the file) | block offsets (uint64) |
    trailer: bits, block_ids (uint32), n_ids, n_docs, n_blocks, documents offset, block offsets' offset (uint64), magic

Writing is safe when tasks fail or run twice: each attempt writes a file of its own, and the manifest, put in place
last, names the files of the attempts that count; the next commit deletes what others left. Files are in the
order of the partitions that wrote them, and the manifest has the number of ids before each file. Appending puts the
new files behind those that the manifest names, overwriting replaces them. One job at a time may write to a folder.
Paths are full URIs of any file system that pyarrow knows; a bare path would mean another disk on each executor.
"""

from __future__ import annotations

import json
import struct
import uuid
from collections.abc import Callable, Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
import pyarrow.fs as pafs
from pyspark import TaskContext
from pyspark.sql.datasource import DataSource, DataSourceArrowWriter, DataSourceReader, InputPartition, WriterCommitMessage

MAGIC = b"PKIDS001"
BLOCK_IDS = 1 << 16
_TRAILER = struct.Struct("<IIQQQQQ8s")
#: Documents are handed to Spark in batches of about so many ids.
_BATCH_IDS = 1 << 18


def width(vocabulary: int) -> int:
    """Bits that the ids 0 to vocabulary - 1 need."""
    return max(1, (vocabulary - 1).bit_length())


def pack(ids: np.ndarray, bits: int) -> bytes:
    """Ids one after the other in ``bits`` bits each, lowest bit first, filled up to whole groups of 64 ids."""
    lanes = np.zeros((-(-len(ids) // 64), 64), np.uint64)
    lanes.ravel()[: len(ids)] = ids
    words = np.zeros((len(lanes), bits), np.uint64)
    for k in range(64):
        word, shift = divmod(k * bits, 64)
        words[:, word] |= lanes[:, k] << np.uint64(shift)
        if shift + bits > 64:
            words[:, word + 1] |= lanes[:, k] >> np.uint64(64 - shift)
    return words.astype("<u8").tobytes()


def unpack(data: bytes, n: int, bits: int) -> np.ndarray:
    """The first ``n`` ids of a packed block."""
    words = np.frombuffer(data, "<u8").reshape(-1, bits)
    lanes, mask = np.empty((len(words), 64), np.uint32), np.uint64((1 << bits) - 1)
    for k in range(64):
        word, shift = divmod(k * bits, 64)
        value = words[:, word] >> np.uint64(shift)
        if shift + bits > 64:
            value = value | words[:, word + 1] << np.uint64(64 - shift)
        lanes[:, k] = value & mask
    return lanes.ravel()[:n]


def _open(path: str) -> tuple[pafs.FileSystem, str]:
    if ":/" not in path:
        raise ValueError(f"{path} has no scheme; give a URI, as common.qualified makes one")
    return pafs.FileSystem.from_uri(path)


class PackedFile:
    """Random access to one file; a path without a scheme is on this machine."""

    def __init__(self, path: str):
        fs, place = _open(path) if ":/" in path else (pafs.LocalFileSystem(), path)
        self.source = fs.open_input_file(place)
        self.source.seek(self.source.size() - _TRAILER.size)
        self.bits, self.block_ids, self.n_ids, self.n_docs, n_blocks, docs_at, blocks_at, magic = _TRAILER.unpack(self.source.read(_TRAILER.size))
        if magic != MAGIC:
            raise ValueError(f"{path} is no complete file of packed ids")
        self.source.seek(docs_at)
        self.docs = pa.ipc.open_stream(pa.BufferReader(self.source.read(blocks_at - docs_at))).read_all()
        self.source.seek(blocks_at)
        self.offsets = np.frombuffer(self.source.read(8 * (n_blocks + 1)), "<u8")

    def ids(self, start: int, stop: int) -> np.ndarray:
        """Ids ``start`` to ``stop`` of the file."""
        if stop <= start:
            return np.zeros(0, np.uint32)
        first, last = start // self.block_ids, (stop - 1) // self.block_ids
        out = []
        for k in range(first, last + 1):
            self.source.seek(int(self.offsets[k]))
            n = min(self.block_ids, self.n_ids - k * self.block_ids)
            out.append(unpack(self.source.read(int(self.offsets[k + 1] - self.offsets[k])), n, self.bits))
        return np.concatenate(out)[start - first * self.block_ids : stop - first * self.block_ids]

    def close(self) -> None:
        self.source.close()


@dataclass
class _Written(WriterCommitMessage):
    name: str | None
    partition: int
    n_ids: int
    n_docs: int


class _Writer(DataSourceArrowWriter):
    #: Makes (doc_id, ids) of the rows to be written.
    prepare: Callable[[Iterator[pa.RecordBatch]], Iterator[pa.RecordBatch]] = staticmethod(iter)

    def __init__(self, path: str, bits: int, block_ids: int, overwrite: bool):
        self.path, self.bits, self.block_ids, self.overwrite = path.rstrip("/"), bits, block_ids, overwrite
        self.job = uuid.uuid4().hex

    def write(self, iterator: Iterator[pa.RecordBatch]) -> _Written:
        fs, place = _open(self.path)
        name = f"ids-{self.job}-{uuid.uuid4().hex}.pack"
        try:
            n_ids, n_docs = self._write(fs, place, name, self.prepare(iterator))
        except BaseException:
            _delete(fs, [f"{place}/{name}"])
            raise
        context = TaskContext.get()
        return _Written(name if n_docs else None, context.partitionId() if context else 0, n_ids, n_docs)

    def _write(self, fs: pafs.FileSystem, place: str, name: str, batches: Iterator[pa.RecordBatch]) -> tuple[int, int]:
        sink, doc_ids, sizes, offsets, held, n_held = None, [], [], [len(MAGIC)], [], 0

        def flush(everything: bool) -> None:
            nonlocal held, n_held
            if n_held >= self.block_ids or everything and n_held:
                flat = np.concatenate(held)
                cut = len(flat) if everything else len(flat) // self.block_ids * self.block_ids
                for at in range(0, cut, self.block_ids):
                    data = pack(flat[at : at + self.block_ids], self.bits)
                    sink.write(data)
                    offsets.append(offsets[-1] + len(data))
                held, n_held = [flat[cut:]], len(flat) - cut

        try:
            for batch in batches:
                if not batch.num_rows:
                    continue
                if sink is None:
                    fs.create_dir(place, recursive=True)
                    sink = fs.open_output_stream(f"{place}/{name}")
                    sink.write(MAGIC)
                column = batch.column("ids")
                flat = column.flatten().to_numpy(zero_copy_only=False)
                if len(flat) and (flat.min() < 0 or int(flat.max()) >> self.bits):
                    raise ValueError(f"an id does not fit in {self.bits} bits")
                doc_ids.append(batch.column("doc_id"))
                sizes.append(np.asarray(column.value_lengths().fill_null(0)))
                held.append(flat)
                n_held += len(flat)
                flush(False)
            if sink is None:
                return 0, 0
            flush(True)
            lengths = np.concatenate(sizes).astype(np.int64)
            docs = pa.table({"doc_id": pa.chunked_array(doc_ids), "start": pa.array(np.cumsum(lengths) - lengths)})
            buffer = pa.BufferOutputStream()
            with pa.ipc.new_stream(buffer, docs.schema) as stream:
                stream.write_table(docs)
            listed = buffer.getvalue()
            sink.write(listed)
            sink.write(np.array(offsets, "<u8").tobytes())
            n_ids, docs_at = int(lengths.sum()), offsets[-1]
            sink.write(_TRAILER.pack(self.bits, self.block_ids, n_ids, len(lengths), len(offsets) - 1, docs_at, docs_at + listed.size, MAGIC))
        finally:
            if sink is not None:
                sink.close()
        return n_ids, len(lengths)

    def _left_over(self, fs: pafs.FileSystem, place: str, kept: set[str], prefix: str = "ids-") -> list[str]:
        """Files that do not count."""
        found = fs.get_file_info(pafs.FileSelector(place, allow_not_found=True))
        return [x.path for x in found if x.base_name.startswith(prefix) and x.base_name not in kept]

    def commit(self, messages: list[_Written]) -> None:
        fs, place = _open(self.path)
        fs.create_dir(place, recursive=True)
        old = read_manifest(fs, place)
        files = [] if self.overwrite else old
        before = files[-1]["before"] + files[-1]["n_ids"] if files else 0
        done = sorted((m for m in messages if m is not None and m.name), key=lambda m: m.partition)
        for m in done:
            files = [*files, {"name": m.name, "before": before, "n_ids": m.n_ids, "n_docs": m.n_docs}]
            before += m.n_ids
        with fs.open_output_stream(f"{place}/manifest.json.tmp") as out:
            out.write(json.dumps({"n_ids": before, "files": files}).encode())
        fs.move(f"{place}/manifest.json.tmp", f"{place}/manifest.json")
        _delete(fs, self._left_over(fs, place, {f["name"] for f in files}))

    def abort(self, messages: list[_Written]) -> None:
        fs, place = _open(self.path)
        _delete(fs, self._left_over(fs, place, set(), f"ids-{self.job}-"))


def _delete(fs: pafs.FileSystem, paths: list[str]) -> None:
    for path in paths:
        try:
            fs.delete_file(path)
        except FileNotFoundError:
            pass  # never begun, or gone already


def read_manifest(fs: pafs.FileSystem, place: str) -> list[dict]:
    """The files of a data set in order; none if there is no manifest yet."""
    if fs.get_file_info(f"{place}/manifest.json").type == pafs.FileType.NotFound:
        return []
    with fs.open_input_stream(f"{place}/manifest.json") as source:
        return json.loads(source.read())["files"]


@dataclass
class _File(InputPartition):
    name: str
    before: int


class _Reader(DataSourceReader):
    def __init__(self, path: str, as_bytes: bool):
        self.path, self.as_bytes = path.rstrip("/"), as_bytes

    def partitions(self) -> list[_File]:
        return [_File(f["name"], f["before"]) for f in read_manifest(*_open(self.path))] or [_File("", 0)]

    def read(self, partition: _File) -> Iterator[pa.RecordBatch]:
        if not partition.name:
            return
        file = PackedFile(f"{self.path}/{partition.name}")
        starts = np.append(file.docs["start"].to_numpy(), file.n_ids)
        a = 0
        while a < file.n_docs:
            b = max(a + 1, int(np.searchsorted(starts, starts[a] + _BATCH_IDS, "right")) - 1)
            ids, ends = file.ids(int(starts[a]), int(starts[b])).astype("<u4"), (starts[a : b + 1] - starts[a]).astype(np.int32)
            if self.as_bytes:
                lists = pa.Array.from_buffers(pa.binary(), b - a, [None, pa.py_buffer((ends * 4).tobytes()), pa.py_buffer(ids.tobytes())])
            else:
                lists = pa.ListArray.from_arrays(pa.array(ends), pa.array(ids.view(np.int32)))
            doc_ids = file.docs["doc_id"].slice(a, b - a).combine_chunks()
            yield pa.RecordBatch.from_arrays([doc_ids.cast(pa.int64()), pa.array(starts[a:b] + partition.before), lists], ["doc_id", "start", "ids"])
            a = b
        file.close()


class PackedIds(DataSource):
    """Options: ``path``; for writing ``bits`` and ``block_ids``; for reading ``layout``.

    Rows: doc_id, start (ids before it), ids. With the layout ``bytes`` the ids are little-endian unsigned 32-bit
    integers in one binary value, else an array.
    """

    @classmethod
    def name(cls) -> str:
        return "packed_ids"

    def schema(self) -> str:
        return f"doc_id long, start long, ids {'binary' if self._as_bytes() else 'array<int>'}"

    def _as_bytes(self) -> bool:
        return self.options.get("layout") == "bytes"

    def writer(self, schema, overwrite: bool) -> _Writer:
        return _Writer(self.options["path"], int(self.options["bits"]), int(self.options.get("block_ids", BLOCK_IDS)), overwrite)

    def reader(self, schema) -> _Reader:
        return _Reader(self.options["path"], self._as_bytes())
