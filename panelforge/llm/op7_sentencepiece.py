"""SentencePiece encoding and decoding for merge-type (BPE) vocabularies.

A text is normalised as such vocabularies ask (a leading word mark, spaces as word marks, nothing else). Encoding
keeps an agenda of adjacent symbol pairs ordered by score, then by position: the best pair is merged and its new
neighbours join the agenda, until no pair is a piece. Symbols that are no piece become their UTF-8 byte pieces.

A merge never crosses a place that no piece spans. When the vocabulary is loaded, all its pieces are checked: if each
is made of word marks followed by letters alone or by other characters alone, texts are split there, and these short
segments are encoded one by one and kept in a bounded cache; otherwise a text is one segment.
Every segment is checked against the sentencepiece library when it is first encoded, and every decoded text against
the library's decode(), in the Arrow batch it belongs to; a difference is an error.

Defined results: null and empty texts have no ids and decode to the empty text. Ids decode to the normalised text.
Very long texts are encoded whole. Rows are handled one by one, so repeated rows give repeated results. An empty table
gives no rows. Other columns never take part, whatever their names.
"""

from __future__ import annotations

import re
import unicodedata
from collections.abc import Iterator
from heapq import heapify, heappop, heappush
from itertools import accumulate, chain

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from .common import in_batches, slices, table, text_or_empty
from .segments import SegmentCache, id_lists

NAME = "op7_sentencepiece"
MARK = "▁"
#: Entries of a generation of each of the two caches of a worker.
CACHE_ENTRIES = 180_000
#: Segments up to the last width are encoded in lock step.
_WIDTHS = (8, 12, 20, 40)


def _segment_pattern(pieces: list[str]) -> re.Pattern:
    """Word marks with the letters, or with the other characters, that follow them; letters are those in ``pieces``."""
    letters = sorted({c for p in pieces for c in p if unicodedata.category(c)[0] in "LM"})
    inside = "".join(map(re.escape, letters)) or "a"
    return re.compile(f"{MARK}*(?:[{inside}]+|[^{inside}{MARK}]+)|{MARK}+")


class BpeModel:
    """A merge-type vocabulary read through the library, with an encoder and a decoder of its own."""

    def __init__(self, path: str, entries: int = CACHE_ENTRIES):
        import sentencepiece

        self.library = lib = sentencepiece.SentencePieceProcessor(model_file=path)
        names = [lib.id_to_piece(i) for i in range(lib.get_piece_size())]
        special = {i for i in range(len(names)) if lib.is_control(i) or lib.is_unknown(i)}
        bytes_of = {i: int(names[i][3:5], 16) for i in range(len(names)) if lib.is_byte(i)}
        normal = [i for i in range(len(names)) if i not in special and i not in bytes_of and not lib.is_unused(i)]
        self.id_of = {names[i]: i for i in normal}
        self.rank = {names[i]: -lib.get_score(i) for i in normal if len(names[i]) > 1}
        self.byte_id = {b: i for i, b in bytes_of.items()}
        self.unknown = lib.unk_id()
        if len(self.byte_id) != 256:
            raise ValueError("the vocabulary has no byte fallback")
        self.segment = _segment_pattern(list(self.rank))
        self.splits = all(self.segment.fullmatch(name) and "\n" not in name for name in self.rank)
        self.piece_bytes = [
            bytes([bytes_of[i]]) if i in bytes_of else b"" if lib.is_control(i) else name.replace(MARK, " ").encode()
            for i, name in enumerate(names)
        ]
        self.cache = SegmentCache(self.encode_segments, entries)
        self.word_cache = SegmentCache(self.encode_words, entries)
        # for agendas in lock step: symbols as numbers (a character that is no piece gets one above all ids), and
        # every pair of symbols that makes a piece, sorted
        top = len(names)
        self.symbol_of = np.arange(0x110000, dtype=np.int64) + top
        for name, i in self.id_of.items():
            if len(name) == 1:
                self.symbol_of[ord(name)] = i
        pairs = {}
        for name, rank in self.rank.items():
            for k in range(1, len(name)):
                a, b = (self.id_of.get(x, top + ord(x) if len(x) == 1 else -1) for x in (name[:k], name[k:]))
                if a >= 0 and b >= 0:
                    pairs[a << 32 | b] = (rank, self.id_of[name])
        self.pair_key = np.array(sorted(pairs), np.int64)
        self.pair_rank = np.array([pairs[k][0] for k in self.pair_key.tolist()] or [np.inf])
        self.pair_id = np.array([pairs[k][1] for k in self.pair_key.tolist()] or [0], np.int64)

    def split(self, text: str) -> list[str]:
        """Segments of the normalised text."""
        if not text:
            return []
        marked = MARK + text.replace(" ", MARK)
        return self.segment.findall(marked) if self.splits else [marked]

    def pieces(self, segment: str) -> list[str]:
        """Merge the best-scored adjacent pair, leftmost first, until no pair is a piece."""
        rank, sym = self.rank, list(segment)
        n = len(sym)
        agenda = [(rank[p], i, i + 1, p) for i in range(n - 1) if (p := sym[i] + sym[i + 1]) in rank]
        heapify(agenda)
        before, after = list(range(-1, n - 1)), list(range(1, n + 1))
        while agenda:
            _, i, j, p = heappop(agenda)
            if not sym[i] or not sym[j] or len(sym[i]) + len(sym[j]) != len(p):
                continue  # one side has been merged meanwhile
            sym[i], sym[j] = p, ""
            after[i] = k = after[j]
            if k < n:
                before[k] = i
                if (q := p + sym[k]) in rank:
                    heappush(agenda, (rank[q], i, k, q))
            if (h := before[i]) >= 0 and (q := sym[h] + p) in rank:
                heappush(agenda, (rank[q], h, i, q))
        return [x for x in sym if x]

    def encode_segment(self, segment: str) -> list[int]:
        out: list[int] = []
        for piece in self.pieces(segment):
            known = self.id_of.get(piece)
            out += [self.byte_id[b] for b in piece.encode()] if known is None else [known]
        return out

    def _pairs(self, a: np.ndarray, b: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """Rank and id of the piece that two symbols make; an infinite rank if they make none."""
        key = np.where((a >= 0) & (b >= 0), a << 32 | b, -1)
        at = np.minimum(np.searchsorted(self.pair_key, key), len(self.pair_rank) - 1)
        ok = self.pair_key[at] == key if len(self.pair_key) else np.zeros(key.shape, bool)
        return np.where(ok, self.pair_rank[at], np.inf), self.pair_id[at]

    def _lock_step(self, segments: list[str], width: int) -> list[list[int]]:
        """``encode_segment`` for segments of at most ``width`` characters: their agendas advance together, each
        merging its best pair (leftmost first) in every step."""
        n, sizes = len(segments), np.fromiter(map(len, segments), np.int64, len(segments))
        code = np.frombuffer("".join(segments).encode("utf-32-le", "surrogatepass"), "<u4")
        row, ends = np.repeat(np.arange(n), sizes), np.cumsum(sizes)
        column = np.arange(len(code)) - np.repeat(ends - sizes, sizes)
        symbol = np.full((n, width + 1), -1, np.int64)  # the last column stays empty: no neighbour
        symbol[row, column] = self.symbol_of[code]
        rank, made = np.full((n, width + 1), np.inf), np.zeros((n, width + 1), np.int64)
        rank[:, :-1], made[:, :-1] = self._pairs(symbol[:, :-1], symbol[:, 1:])
        after = np.tile(np.arange(1, width + 2), (n, 1))
        after[:, -1] = width
        before = np.tile(np.arange(-1, width), (n, 1))
        after = np.minimum(after, width)
        before[:, 0] = width
        active = np.arange(n)
        while len(active):
            i = rank[active].argmin(axis=1)
            going = rank[active, i] < np.inf
            active, i = active[going], i[going]
            j = after[active, i]
            k, h = after[active, j], before[active, i]
            symbol[active, i], symbol[active, j] = made[active, i], -1
            after[active, i], before[active, k] = k, i
            rank[active, j] = np.inf
            now = symbol[active, i]
            rank[active, i], made[active, i] = self._pairs(now, symbol[active, k])
            left_rank, left_made = self._pairs(symbol[active, h], now)
            rank[active, h], made[active, h] = left_rank, left_made
            rank[active, width] = np.inf
        alive = symbol >= 0
        flat, stops = symbol[alive], np.cumsum(alive.sum(axis=1))
        unknown = (symbol >= len(self.piece_bytes)).any(axis=1)
        out = [x.tolist() for x in np.split(flat, stops[:-1])]
        for r in np.flatnonzero(unknown):
            out[r] = [y for x in out[r] for y in ([x] if x < len(self.piece_bytes) else [self.byte_id[b] for b in chr(x - len(self.piece_bytes)).encode()])]
        return out

    def encode_all(self, segments: list[str]) -> list[list[int]]:
        """Ids of each segment; short ones in lock step with others of about their length."""
        out: list[list[int]] = [[]] * len(segments)
        groups: dict[int, list[int]] = {}
        for i, x in enumerate(segments):
            groups.setdefault(next((w for w in _WIDTHS if len(x) <= w), 0), []).append(i)
        for width, members in groups.items():
            for at in range(0, len(members), 8192):
                part = members[at : at + 8192]
                held = [segments[i] for i in part]
                found = self._lock_step(held, width) if width else map(self.encode_segment, held)
                for i, ids in zip(part, found):
                    out[i] = ids
        return out

    def encode_segments(self, segments: list[str]) -> list[bytes]:
        """Packed ids of each segment, each checked against the library."""
        found = self.encode_all(segments)
        # the library puts a mark in front; behind a line end, which no piece spans, a segment stands as it is
        front, lead = ("\n", [self.id_of.get(MARK), self.byte_id[10]]) if self.splits else ("", [])
        theirs = self.library.encode([front + (x if front else x[1:]).replace(MARK, " ") for x in segments], num_threads=1)
        for segment, mine, ids in zip(segments, found, theirs):
            if ids != lead + mine:
                raise RuntimeError(f"ids differ from the library's for {segment!r}")
        flat = np.fromiter(chain.from_iterable(found), "<i4").tobytes()
        ends = [4 * n for n in accumulate(map(len, found))]
        return [flat[a:b] for a, b in zip([0, *ends], ends)]

    def encode_words(self, words: list[str]) -> list[bytes]:
        """Packed ids of words that stand between single blanks."""
        return self.cache.ids([self.segment.findall(MARK + w) for w in words])

    def encode(self, texts: list[str]) -> list[bytes]:
        """Packed ids of each text. Words between single blanks go through a cache of their own."""
        plain = [self.splits and x and x[0] != " " and x[-1] != " " and "  " not in x and MARK not in x for x in texts]
        by_word = iter(self.word_cache.ids([x.split(" ") for x, p in zip(texts, plain) if p]))
        other = iter(self.cache.ids([self.split(x) for x, p in zip(texts, plain) if not p]))
        return [next(by_word if p else other) for p in plain]

    def decode(self, ids: list[int]) -> str:
        text = b"".join(map(self.piece_bytes.__getitem__, ids)).decode("utf-8", "replace")
        return text[1:] if text.startswith(" ") else text


_models: dict[str, BpeModel] = {}


def model(path: str, entries: int = CACHE_ENTRIES) -> BpeModel:
    """The worker's model for ``path``; a new one gets caches of so many entries, which change no result."""
    if path not in _models:
        _models[path] = BpeModel(path, entries)
    return _models[path]


def encode(docs: DataFrame, path: str, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """One row per row of ``docs``: doc_id, ids (array<int>)."""

    def batches(it: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        bpe = model(path)
        for batch in it:
            texts = batch.column(1).to_pylist()
            for a, b in slices(texts, 2_000_000):
                yield pa.RecordBatch.from_arrays([batch.column(0)[a:b], id_lists(bpe.encode(texts[a:b]))], ["doc_id", "ids"])

    rows = docs.select(F.col(id_col).alias("doc_id"), text_or_empty(text_col).alias("text"))
    return in_batches(rows, batches, f"doc_id {rows.schema['doc_id'].dataType.simpleString()}, ids array<int>")


def _lists(column: pa.ListArray) -> list[list[int]]:
    flat, ends = column.flatten().to_numpy().tolist(), np.cumsum(np.asarray(column.value_lengths())).tolist()
    return [flat[a:b] for a, b in zip([0, *ends], ends)]


def _decoded(bpe: BpeModel, column: pa.ListArray) -> pa.Array:
    ids = _lists(column)
    texts = [bpe.decode(x) for x in ids]
    if texts != bpe.library.decode(ids, num_threads=1):
        raise RuntimeError("a decoded text differs from the library's")
    return pa.array(texts, pa.string())


def decode(encoded: DataFrame, path: str) -> DataFrame:
    """The rows of ``encoded`` (doc_id, ids) with the decoded text."""

    def batches(it: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in it:
            yield pa.RecordBatch.from_arrays([*batch.columns, _decoded(model(path), batch.column(1))], ["doc_id", "ids", "decoded"])

    rows = encoded.select("doc_id", "ids")
    return in_batches(rows, batches, f"doc_id {rows.schema['doc_id'].dataType.simpleString()}, ids array<int>, decoded string")


def round_trip(docs: DataFrame, path: str, id_col: str = "doc_id", text_col: str = "text", entries: int = CACHE_ENTRIES) -> DataFrame:
    """``decode(encode(docs))`` in one pass, so a task needs one Python worker and the ids cross over once.

    ``entries`` bounds a worker's caches, for executors whose memory other work has taken too.
    """

    def batches(it: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        bpe = model(path, entries)
        for batch in it:
            texts = batch.column(1).to_pylist()
            for a, b in slices(texts, 2_000_000):
                ids = id_lists(bpe.encode(texts[a:b]))
                yield pa.RecordBatch.from_arrays([batch.column(0)[a:b], ids, _decoded(bpe, ids)], ["doc_id", "ids", "decoded"])

    rows = docs.select(F.col(id_col).alias("doc_id"), text_or_empty(text_col).alias("text"))
    return in_batches(rows, batches, f"doc_id {rows.schema['doc_id'].dataType.simpleString()}, ids array<int>, decoded string")


def digests(decoded: DataFrame, with_ids: bool = False) -> DataFrame:
    """doc_id, n_tokens, ids_sha256 and decoded_sha256 from (doc_id, ids, decoded)."""
    listed = F.array_join(F.col("ids").cast("array<string>"), ",")
    found = [F.size("ids").cast("long").alias("n_tokens"), F.sha2(listed, 256).alias("ids_sha256"), F.sha2("decoded", 256).alias("decoded_sha256")]
    return decoded.select("doc_id", *found, *(["ids"] if with_ids else []))


def default_path() -> str:
    import public_tokenizers

    return public_tokenizers.path("piece_bpe_32k.model")


def query(spark: SparkSession, sf_dir: str) -> DataFrame:
    return digests(round_trip(table(spark, sf_dir, "documents"), default_path()))
