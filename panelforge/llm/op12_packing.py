"""Packing of tokenised documents into training sequences of several context sizes, without padding.

Hierarchical multi-length packing, in pools of about ``POOL_IDS`` ids that pass through each task: documents longer
than the largest context give full windows; what is left of each goes to the tier of the smallest context that holds it.
From the longest tier to the shortest, each piece opens a window of its tier, whose gap is filled with the longest
pieces that fit whole, which come from shorter tiers; if none fits, the shortest piece left is cut to the gap. A window
that cannot be filled goes back and meets the next pool; only the last one of a task is closed in descending powers of
two. So every sequence is as long as its tier. The sequences of a pool are dealt to step groups, longest and dearest
first to the group with the fewest tokens and the least attention, so that steps cost the same; numbers of sequences
follow their steps.

How it runs: one scan, no shuffle. A task tokenises, packs and numbers the rows of its input partition, in Arrow
batches and bounded memory (a pool, the cache of words, a slice of texts); numbers begin with the partition's, so they are
unique without any exchange. A lost task is run again alone. Rows must come in the same order then, as those of a
table do.

Tokenising uses the tokenizers library on the parts between blanks: this kind of vocabulary drops white space, and
neither its normaliser nor its pre-tokeniser looks across it. Words of Latin letters go straight to the library's
model. Vocabularies of another kind are encoded text by text.

Defined results: null and empty texts hold the end id alone, and so do texts of white space. Null, equal and repeated
ids make no difference: each row is a document of its own. Very long texts are encoded in one piece and cut. An empty
table gives no rows. Other columns never take part, whatever their names.
"""

from __future__ import annotations

import heapq
import json
from collections.abc import Iterator
from functools import lru_cache

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark import TaskContext
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from .common import in_batches, table, text_or_empty
from .op9_token_files import _LETTERS, ByteBpe, _slices, closed

NAME = "op12_packing"
END_ID = 1
#: Context sizes; powers of two.
TIERS = (2048, 1024, 512, 256)
#: Ids that are packed together, and ids of a step group.
POOL_IDS, STEP_IDS = 1 << 20, 1 << 17
#: The pre-tokeniser that is known not to look across white space (fixed value).
_PATTERN = r"'s|'t|'re|'ve|'m|'ll|'d|[\p{L}]+|[\p{N}]|[^\s\p{L}\p{N}]+"
_LOCAL = {"NFC", "Lowercase"}


class WordBpe(ByteBpe):
    """A tokenizers file whose tokens are parts of words, encoding by parts between blanks where that is exact."""

    def __init__(self, path: str):
        super().__init__(path)
        with open(path, encoding="utf-8") as source:
            spec = json.load(source)
        steps = (spec.get("normalizer") or {}).get("normalizers", [])
        blank = [s for s in steps if s["type"] == "Replace" and s["pattern"] == {"Regex": r"\s+"} and s["content"] == " "]
        split, *coded = (spec.get("pre_tokenizer") or {}).get("pretokenizers") or [{}]
        letters = [c for c in coded if c["type"] == "ByteLevel" and not c["add_prefix_space"] and not c["use_regex"]]
        self.apart = "İ"  # its small form is a letter and a mark, which goes with the signs behind it
        self.splits = (
            all(s in blank or s["type"] in _LOCAL for s in steps)
            and any(s["type"] == "Lowercase" for s in steps)
            and split.get("pattern") == {"Regex": _PATTERN}
            and (split.get("behavior"), split.get("invert")) == ("Removed", True)
            and len(coded) == len(letters) == 1
            and not any(c.isspace() for x in spec.get("added_tokens", []) for c in x["content"])
        )

    def _by_parts(self, texts: pa.StringArray) -> pa.ListArray:
        parts = pc.split_pattern(pc.replace_substring(texts, "\n", " "), " ")
        coded = parts.flatten().dictionary_encode()
        each = self.part_ids(coded.dictionary).take(coded.indices)
        ends = np.concatenate([[0], np.cumsum(np.asarray(each.value_lengths()))])
        places = np.concatenate([[0], np.cumsum(np.asarray(parts.value_lengths()))])
        return pa.ListArray.from_arrays(pa.array(ends[places].astype(np.int32)), each.flatten())

    def _stem_ids(self, stems: pa.StringArray) -> list[bytes]:
        word = np.asarray(pc.match_substring_regex(stems, rf"\A[{_LETTERS}]+\z"))
        names, found = stems.to_pylist(), [b""] * len(stems)
        at = np.flatnonzero(word).tolist()
        if at:  # a word of letters is one pre-token
            code = self.alphabet[np.frombuffer("\n".join([names[i] for i in at]).lower().encode(), np.uint8)]
            for i, ids in zip(at, self._pre_tokens(code.tobytes().decode("utf-32-le").split(chr(self.alphabet[10])))):
                found[i] = ids
        other = np.flatnonzero(~word).tolist()
        for i, ids in zip(other, self._whole([names[i] for i in other])):
            found[i] = ids
        return found


@lru_cache(maxsize=2)
def tokenizer(path: str) -> WordBpe:
    """The worker's tokenizer for ``path``."""
    return WordBpe(path)


class Pool:
    """Pieces (document, start, length) by length, none longer than the largest tier."""

    def __init__(self, tiers: tuple[int, ...]):
        self.tiers, self.by_length, self.lengths = tiers, [[] for _ in range(tiers[0] + 1)], 0

    def put(self, doc: int, start: int, length: int) -> None:
        self.by_length[length].append((doc, start, length))
        self.lengths |= 1 << length

    def take(self, length: int) -> tuple[int, int, int]:
        pieces = self.by_length[length]
        piece = pieces.pop()
        if not pieces:
            self.lengths ^= 1 << length
        return piece

    def longest(self, most: int) -> int:
        """The greatest length of a piece up to ``most``; 0 if there is none."""
        return max((self.lengths & ((1 << most + 1) - 1)).bit_length() - 1, 0)

    def shortest(self) -> int:
        return (self.lengths & -self.lengths).bit_length() - 1 if self.lengths else 0

    def windows(self) -> Iterator[list[tuple[int, int, int]]]:
        """Full windows, those of the longest tier first; what does not fill one stays."""
        for tier, below in zip(self.tiers, (*self.tiers[1:], 0)):
            while (length := self.longest(tier)) > below:
                window, gap = [self.take(length)], tier - length
                while gap and self.lengths:
                    if fits := self.longest(gap):
                        window.append(self.take(fits))
                        gap -= fits
                    else:
                        doc, start, length = self.take(self.shortest())
                        window.append((doc, start, gap))
                        self.put(doc, start + gap, length - gap)
                        gap = 0
                if gap:
                    for piece in window:
                        self.put(*piece)
                    return
                yield window

    def rest(self) -> Iterator[list[tuple[int, int, int]]]:
        """All that is left, in windows of descending powers of two."""
        pieces = [self.take(length) for length in iter(self.shortest, 0)]
        left = sum(length for _, _, length in pieces)
        while left:
            gap = 1 << left.bit_length() - 1
            gap, window = min(gap, self.tiers[0]), []
            left -= gap
            while gap:
                doc, start, length = pieces.pop()
                window.append((doc, start, min(length, gap)))
                if length > gap:
                    pieces.append((doc, start + gap, length - gap))
                gap -= window[-1][2]
            yield window


def _joined_up(window: list[tuple[int, int, int]]) -> list[tuple[int, int, int]]:
    """Pieces of one document that follow each other become one."""
    out: list[tuple[int, int, int]] = []
    for doc, start, length in sorted(window):
        if out and out[-1][0] == doc and out[-1][1] + out[-1][2] == start:
            out[-1] = (doc, out[-1][1], out[-1][2] + length)
        else:
            out.append((doc, start, length))
    return out


def steps(windows: list[list[tuple[int, int, int]]], step_ids: int) -> list[list[list[tuple[int, int, int]]]]:
    """The windows in groups of about ``step_ids`` ids and of equal cost."""
    weighed = [(sum(n for *_, n in w), sum(n * n for *_, n in w), k) for k, w in enumerate(windows)]
    n_groups = max(1, round(sum(size for size, _, _ in weighed) / step_ids))
    groups: list[list] = [[] for _ in range(n_groups)]
    heap = [(0, 0, g) for g in range(n_groups)]
    for size, cost, k in sorted(weighed, reverse=True):
        ids, spent, g = heapq.heappop(heap)
        groups[g].append(windows[k])
        heapq.heappush(heap, (ids + size, spent + cost, g))
    return [g for g in groups if g]


class _Packer:
    """The documents of one task."""

    def __init__(self, tiers: tuple[int, ...], partition: int, id_type: pa.DataType):
        self.tiers, self.id_type, self.pool = tiers, id_type, Pool(tiers)
        self.docs: dict[int, tuple[object, np.ndarray]] = {}
        self.held = self.n_docs = 0
        self.full: list[list[tuple[int, int, int]]] = []
        self.sequence = self.step = partition << 33

    def add(self, doc_id: object, ids: np.ndarray) -> None:
        doc, self.n_docs, n, most = self.n_docs, self.n_docs + 1, len(ids), self.tiers[0]
        self.docs[doc] = (doc_id, ids)
        self.held += n
        self.full += [[(doc, start, most)] for start in range(0, n - most + 1, most)]
        if n % most:
            self.pool.put(doc, n - n % most, n % most)

    def packed(self, last: bool) -> pa.RecordBatch:
        windows = [*self.full, *self.pool.windows(), *(self.pool.rest() if last else ())]
        rows, parts = [], []
        for group in steps([_joined_up(w) for w in windows], STEP_IDS):
            for window in group:
                offset = 0
                for doc, start, length in window:
                    doc_id, ids = self.docs[doc]
                    rows.append((doc_id, start, length, len(ids), self.sequence, offset, self.step))
                    parts.append(ids[start : start + length])
                    offset += length
                self.sequence += 1
            self.step += 1
        left = {piece[0] for pieces in self.pool.by_length for piece in pieces}
        # what stays is copied, since a slice would hold the ids of all documents around it
        self.docs = {doc: (self.docs[doc][0], self.docs[doc][1].copy()) for doc in left}
        self.full, self.held = [], sum(n * len(p) for n, p in enumerate(self.pool.by_length))
        doc_ids, *numbers = zip(*rows) if rows else [()] * 7
        lengths = np.array(numbers[1], np.int64)
        offsets = np.concatenate([[0], np.cumsum(lengths * 4)]).astype(np.int32)
        flat = np.concatenate(parts).astype("<u4") if parts else np.zeros(0, "<u4")
        binary = pa.Array.from_buffers(pa.binary(), len(rows), [None, pa.py_buffer(offsets.tobytes()), pa.py_buffer(flat.tobytes())])
        columns = [pa.array(doc_ids, self.id_type), *(pa.array(x, pa.int64()) for x in numbers), binary]
        return pa.RecordBatch.from_arrays(columns, _NAMES)


_NAMES = ["doc_id", "start", "length", "doc_tokens", "sequence_id", "offset", "step", "ids"]


def pack(docs: DataFrame, path: str, end_id: int = END_ID, tiers: tuple[int, ...] = TIERS, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """One row per piece: doc_id, start (ids of its document before it), length, doc_tokens, sequence_id, offset (in its
    sequence), step (its step group) and ids (little-endian unsigned 32-bit integers)."""
    if list(tiers) != sorted({1 << t.bit_length() - 1 for t in tiers}, reverse=True):
        raise ValueError("tiers are descending powers of two")

    def pieces(it: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        bpe, packer = tokenizer(path), None
        for batch in _slices(it):
            packer = packer or _Packer(tiers, TaskContext.get().partitionId(), batch.column(0).type)
            lists = closed(bpe.encode(batch.column(1)), end_id)
            flat, ends = lists.flatten().to_numpy(), np.asarray(lists.offsets).tolist()
            for doc_id, a, b in zip(batch.column(0).to_pylist(), ends, ends[1:]):
                packer.add(doc_id, flat[a:b])
                if packer.held >= POOL_IDS:
                    yield packer.packed(False)
        if packer:
            yield packer.packed(True)

    rows = docs.select(F.col(id_col).alias("doc_id"), text_or_empty(text_col).alias("text"))
    kind = rows.schema["doc_id"].dataType.simpleString()
    return in_batches(rows, pieces, f"doc_id {kind}, start long, length long, doc_tokens long, sequence_id long, offset long, step long, ids binary")


def sequences(pieces: DataFrame) -> DataFrame:
    """One row per sequence: sequence_id, step, length, ids (binary) and lengths (of its pieces, in order). A sequence
    has at most as many pieces as its context size."""
    each = F.array_sort(F.collect_list(F.struct("offset", "length", "ids")))
    rows = pieces.groupBy("sequence_id", "step").agg(F.sum("length").alias("length"), each.alias("x"))
    ids = F.aggregate("x", F.lit(b""), lambda joined, x: F.concat(joined, x["ids"]))
    return rows.select("sequence_id", "step", "length", ids.alias("ids"), F.transform("x", lambda x: x["length"]).alias("lengths"))


def default_path() -> str:
    import public_tokenizers

    return public_tokenizers.path("word_bpe_49k.json")


def query(spark: SparkSession, sf_dir: str) -> DataFrame:
    pieces = pack(table(spark, sf_dir, "documents"), default_path())
    return pieces.select("doc_id", "start", "length", F.crc32("ids").alias("ids_crc32"), "doc_tokens", "sequence_id", "offset")
