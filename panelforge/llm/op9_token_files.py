"""Token-id files: byte-level BPE ids, packed in the fewest bits, in ascending document order, and read back.

Documents are dealt by ranges of (id, hash of the text), so text crosses the network once, ids never do, and rows
that share an id spread over tasks too. The writer of the ``packed_ids`` source tokenises the rows of its range and
packs them into one file, in one Python worker; the number of ids before a document is the manifest's number for its
file plus its place in the file.

Tokenising uses the tokenizers library on the parts between blanks, through a bounded cache. A byte-level pre-tokeniser
starts a new token at a blank that stands between other characters, at a line end between two of them, and at a sign
behind a letter or digit, so the ids of a text are those of its parts. Texts stay Arrow arrays: only words that a
worker has not met lately become Python objects. Vocabularies with another pre-tokeniser, and texts with double
blanks, control characters or special tokens, for which that would not hold, are encoded whole.

Defined results: null and empty texts hold the end id alone. A null id stands before all others. Rows with equal ids
stand in the order of the xxhash64 of their texts, so equal rows stand together. Very long texts are encoded in one
piece. An empty table gives a data set without files, which reads as no rows. Other columns never take part,
whatever their names.
"""

from __future__ import annotations

import json
import os
import re
import uuid
from array import array
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from .common import in_batches, qualified, shared_folder, small_batches, table, text_or_empty
from .packed_ids import PackedIds, width
from .segments import Generations, id_lists

NAME = "op9_token_files"
END_ID = 0
#: Mark the part that starts a text, and one that starts a line after a line end; neither has a blank in front. Texts
#: with control characters are encoded whole, so the marks mean nothing else.
_FIRST, _LINE = "\x1c", "\x1d"
#: Signs that never join a letter or digit in front of them (an apostrophe can).
_SIGNS = ".,;:!?%$&*#|"
#: Letters whose class is taken for granted: those below U+0250.
_LETTERS = "A-Za-zÀ-ÖØ-öø-ɏ"
_SPACES = r"\t\n\x0b\f\r \x{85}\x{a0}\x{1680}\x{2000}-\x{200a}\x{2028}\x{2029}\x{202f}\x{205f}\x{3000}"
#: A line end that does not stand between two other characters.
_UNEVEN = rf"\A\n|\n\z|[{_SPACES}]\n|\n[{_SPACES}]"
_WHITE = re.compile(r"\s")
#: Parts in one call of the library.
_JOINED = 1024
#: Bytes of text that are encoded together, so that frequent words are looked up once.
SLICE_BYTES = 6 << 20


class ByteBpe:
    """A tokenizers file, encoding by parts between blanks where that is exact."""

    def __init__(self, path: str):
        os.environ["TOKENIZERS_PARALLELISM"] = "false"  # Spark's tasks are the parallelism
        from tokenizers import Tokenizer

        with open(path, encoding="utf-8") as source:
            spec = json.load(source)
        self.tokenizer = Tokenizer.from_file(path)
        pre = spec.get("pre_tokenizer") or {}
        self.line_end = self.tokenizer.encode("\n", add_special_tokens=False).ids
        plain = pre.get("type") == "ByteLevel" and pre.get("use_regex", True) and not pre.get("add_prefix_space") and not spec.get("normalizer")
        self.splits = plain and len(self.line_end) == 1
        #: Texts with any of these are encoded whole: at a blank between white space no pre-token need start.
        self.apart = "|".join(["  ", rf"[{_SPACES}] (?:[{_SPACES}]|\z)", r"[\x1c-\x1f]", *(re.escape(x["content"]) for x in spec.get("added_tokens", []))])
        self.vocabulary = self.tokenizer.get_vocab_size(with_added_tokens=True)
        self.model = self.tokenizer.model
        # byte-level alphabets write printable bytes as themselves and the others as the characters from 256 on
        plain = [*range(33, 127), *range(161, 173), *range(174, 256)]
        self.alphabet = np.arange(256, dtype="<u4")
        self.alphabet[sorted(set(range(256)) - set(plain))] = 256 + np.arange(256 - len(plain))
        self.stems, self.signs = Generations(), {}

    def encode(self, texts: pa.StringArray) -> pa.ListArray:
        """The ids of each text."""
        whole = pc.match_substring_regex(texts, self.apart) if self.splits else pa.array([True] * len(texts))
        if not pc.any(whole).as_py():
            return self._by_parts(texts)
        apart = np.asarray(whole)
        found = [self._by_parts(texts.filter(pa.array(~apart))), id_lists(self._whole(texts.filter(whole).to_pylist()))]
        order = np.argsort(np.concatenate([np.flatnonzero(~apart), np.flatnonzero(apart)]))
        return pa.concat_arrays(found).take(pa.array(order))

    def _whole(self, texts: list[str]) -> list[bytes]:
        found = self.tokenizer.encode_batch_fast(texts, add_special_tokens=False)
        return [np.array(x.ids, "<i4").tobytes() for x in found]

    def _by_parts(self, texts: pa.StringArray) -> pa.ListArray:
        lines = pc.if_else(pc.match_substring_regex(texts, _UNEVEN), texts, pc.replace_substring(texts, "\n", " " + _LINE))
        parts = pc.split_pattern(pc.binary_join_element_wise(_FIRST, lines, ""), " ")
        coded = parts.flatten().dictionary_encode()
        each = self.part_ids(coded.dictionary).take(coded.indices)  # the ids of every part in place
        ends = np.concatenate([[0], np.cumsum(np.asarray(each.value_lengths()))])
        places = np.concatenate([[0], np.cumsum(np.asarray(parts.value_lengths()))])
        return pa.ListArray.from_arrays(pa.array(ends[places].astype(np.int32)), each.flatten())

    def part_ids(self, parts: pa.StringArray) -> pa.ListArray:
        """Ids of distinct parts: those of the stem, then those of the signs behind its last letter or digit."""
        stems = pc.utf8_rtrim(parts, _SIGNS)
        stems = pc.if_else(pc.match_substring_regex(stems, rf"[0-9{_LETTERS}]\z"), stems, parts)
        sizes, stem_sizes = (np.asarray(pc.binary_length(x)).astype(np.int64) for x in (parts, stems))
        ends, tail = np.cumsum(sizes), sizes - stem_sizes
        data = np.frombuffer(b"".join([b for b in [parts.buffers()[2]] if b is not None]), np.uint8)[_first_offset(parts) :]
        coded = stems.dictionary_encode()
        stem_ids = id_lists(self._known(coded.dictionary))
        # the signs of all parts that have any, as strings in a row
        has = np.flatnonzero(tail)
        stops = np.cumsum(tail[has])
        at = np.repeat(ends[has] - stops, tail[has]) + np.arange(stops[-1] if len(has) else 0)
        signs = pa.StringArray.from_buffers(len(has), pa.py_buffer(np.concatenate([[0], stops]).astype(np.int32)), pa.py_buffer(data[at].tobytes())).dictionary_encode()
        sign_ids = id_lists([*map(self._sign_ids, signs.dictionary.to_pylist()), b""])
        which = np.full(len(parts), len(signs.dictionary))
        which[has] = np.asarray(signs.indices)
        both = pa.concat_arrays([stem_ids, sign_ids])
        order = np.stack([np.asarray(coded.indices), which + len(stem_ids)], axis=1).ravel()
        pairs = both.take(pa.array(order))
        offsets = np.concatenate([[0], np.cumsum(np.asarray(pairs.value_lengths()))])[::2]
        return pa.ListArray.from_arrays(pa.array(offsets.astype(np.int32)), pairs.flatten())

    def _sign_ids(self, signs: str) -> bytes:
        """Ids of signs behind a letter or digit: one pre-token."""
        found = self.signs.get(signs)
        if found is None:
            found = self._pre_tokens([signs])[0]
            if len(self.signs) < 10_000:
                self.signs[signs] = found
        return found

    def _known(self, stems: pa.StringArray) -> list[bytes]:
        names = stems.to_pylist()
        found, new = self.stems.look_up(names)
        if new:
            computed = self._stem_ids(stems.take(pa.array(new)))
            for i, ids in zip(new, computed):
                found[i] = ids
            self.stems.add([names[i] for i in new], computed)
        return found

    def _stem_ids(self, stems: pa.StringArray) -> list[bytes]:
        """Ids of stems, a blank in front of each but those that start a text or a line.

        A word of letters is one pre-token, which goes straight to the library's model. Other stems without further
        white space go through the whole library many at a time, a line end between them: it is a token of its own
        there, and no other token holds one.
        """
        word, marked = (np.asarray(pc.match_substring_regex(stems, rf"\A{front}[{_LETTERS}]+\z")) for front in ("", r"[\x1c\x1d]"))
        names, found = stems.to_pylist(), [b""] * len(stems)
        for which, front in ((word, " "), (marked, "")):
            at = np.flatnonzero(which).tolist()
            if at:
                joined = "\n".join([front + names[i] if front else names[i][1:] for i in at])
                code = self.alphabet[np.frombuffer(joined.encode(), np.uint8)]
                for i, ids in zip(at, self._pre_tokens(code.tobytes().decode("utf-32-le").split(chr(self.alphabet[10])))):
                    found[i] = ids
        other = np.flatnonzero(~word & ~marked).tolist()
        whole = [names[i][1:] if names[i].startswith((_FIRST, _LINE)) else " " + names[i] for i in other]
        for i, ids in zip(other, self._joint(whole)):
            found[i] = np.array(ids, "<i4").tobytes()
        line_end = np.array(self.line_end, "<i4").tobytes()
        for i in np.flatnonzero(np.asarray(pc.starts_with(stems, _LINE))).tolist():
            found[i] = line_end + found[i]
        return found

    def _pre_tokens(self, texts: list[str]) -> list[bytes]:
        """Packed ids of pre-tokens in the byte-level alphabet."""
        tokenise, flat, ends = self.model.tokenize, array("i"), [0]
        for x in texts:  # few objects stay, else Python's garbage collection takes as long as this
            flat.extend([token.id for token in tokenise(x)])
            ends.append(4 * len(flat))
        data = flat.tobytes()
        return [data[a:b] for a, b in zip(ends, ends[1:])]

    def _joint(self, texts: list[str]) -> list[list[int]]:
        joint = [len(t) > 1 and _WHITE.search(t, 1) is None and (t[0] == " " or not t[0].isspace()) for t in texts]
        lines = [t for t, j in zip(texts, joint) if j]
        by_line: list[list[int]] = []
        for page in self.tokenizer.encode_batch_fast(["\n".join(lines[k : k + _JOINED]) for k in range(0, len(lines), _JOINED)], add_special_tokens=False):
            ids = page.ids
            stops = [*(k for k, x in enumerate(ids) if x == self.line_end[0]), len(ids)]
            by_line += [ids[a:b] for a, b in zip([0, *(x + 1 for x in stops)], stops)]
        alone = (x.ids for x in self.tokenizer.encode_batch_fast([t for t, j in zip(texts, joint) if not j], add_special_tokens=False))
        joined = iter(by_line)
        return [next(joined if j else alone) for j in joint]


def _first_offset(strings: pa.StringArray) -> int:
    offsets = strings.buffers()[1]
    return int(np.frombuffer(offsets, np.int32)[strings.offset]) if offsets is not None and len(offsets) else 0


def closed(lists: pa.ListArray, end_id: int) -> pa.ListArray:
    """Every list with one more id at its end."""
    ends = np.cumsum(np.asarray(lists.value_lengths()))
    flat = np.insert(lists.flatten().to_numpy(), ends, end_id)
    return pa.ListArray.from_arrays(pa.array(np.concatenate([[0], ends + np.arange(1, len(ends) + 1)]).astype(np.int32)), pa.array(flat))


_tokenizers: dict[str, ByteBpe] = {}


def tokenizer(path: str) -> ByteBpe:
    """The worker's tokenizer for ``path``."""
    if path not in _tokenizers:
        _tokenizers[path] = ByteBpe(path)
    return _tokenizers[path]


def _slices(it: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """The rows (doc_id, text) of ``it`` in slices of about SLICE_BYTES; a longer text stands alone."""
    held, size = [], 0
    for batch in it:
        ends = np.cumsum(np.asarray(pc.binary_length(batch.column(1))).astype(np.int64))
        start = 0
        while start < batch.num_rows:
            gone = int(ends[start - 1]) if start else 0
            stop = max(start + 1, int(np.searchsorted(ends, gone + SLICE_BYTES - size, "right")))
            held.append(batch.slice(start, stop - start))
            size += int(ends[stop - 1]) - gone
            start = stop
            if size >= SLICE_BYTES or start < batch.num_rows:
                yield pa.concat_batches(held)
                held, size = [], 0
    if held:
        yield pa.concat_batches(held)


def encoded(it: Iterator[pa.RecordBatch], path: str, end_id: int | None) -> Iterator[pa.RecordBatch]:
    """(doc_id, ids) of the rows (doc_id, text), in their order, each closed by ``end_id``."""
    bpe = tokenizer(path)
    for batch in _slices(it):
        ids = bpe.encode(batch.column(1))
        yield pa.RecordBatch.from_arrays([batch.column(0), ids if end_id is None else closed(ids, end_id)], ["doc_id", "ids"])


def tokenise(docs: DataFrame, path: str, end_id: int | None = END_ID) -> DataFrame:
    """(doc_id, ids) of (doc_id, text), row by row in the given order, each closed by ``end_id``."""
    rows = docs.select(F.col("doc_id").cast("long").alias("doc_id"), text_or_empty("text").alias("text"))
    return in_batches(rows, lambda it: encoded(it, path, end_id), "doc_id long, ids array<int>")


class TokenFiles(PackedIds):
    """``packed_ids`` written from rows (doc_id, text); options ``tokenizer`` and ``end_id`` (empty: none)."""

    @classmethod
    def name(cls) -> str:
        return "token_files"

    def writer(self, schema, overwrite: bool):
        out = super().writer(schema, overwrite)
        path, end = self.options["tokenizer"], self.options["end_id"]
        out.prepare = lambda it: encoded(it, path, int(end) if end else None)
        return out


def write_ids(docs: DataFrame, folder: str, path: str, end_id: int | None = END_ID, id_col: str = "doc_id", text_col: str = "text", mode: str = "append") -> None:
    """Tokenise ``docs`` and write them to ``folder`` in ascending order of their ids; ``append`` puts them behind what
    the folder holds, ``overwrite`` replaces it. Another writer of the folder must not run meanwhile."""
    spark = docs.sparkSession
    spark.dataSource.register(TokenFiles)
    rows = docs.select(F.col(id_col).cast("long").alias("doc_id"), text_or_empty(text_col).alias("text"))
    order = ["doc_id", F.xxhash64("text")]
    rows = small_batches(rows.repartitionByRange(*order).sortWithinPartitions(*order, "text"))
    options = {"tokenizer": path, "end_id": "" if end_id is None else str(end_id), "bits": str(width(tokenizer(path).vocabulary))}
    rows.write.format("token_files").mode(mode).options(**options).save(qualified(spark, folder))


def read_ids(spark: SparkSession, folder: str, layout: str = "array") -> DataFrame:
    """(doc_id, start, ids) of a folder written by ``write_ids``; layout ``array`` or ``bytes``."""
    spark.dataSource.register(PackedIds)
    return spark.read.format("packed_ids").option("layout", layout).load(qualified(spark, folder))


def digests(rows: DataFrame) -> DataFrame:
    """doc_id, start, n_tokens and ids_crc32 of rows read with the layout ``bytes``."""
    n = (F.octet_length("ids") / 4).cast("long")
    return rows.select("doc_id", "start", n.alias("n_tokens"), F.crc32("ids").alias("ids_crc32"))


def default_path() -> str:
    import public_tokenizers

    return public_tokenizers.path("byte_bpe_50k.json")


def query(spark: SparkSession, sf_dir: str) -> DataFrame:
    folder = f"{shared_folder(spark)}/ids-{uuid.uuid4().hex}"
    write_ids(table(spark, sf_dir, "documents"), folder, default_path())
    return digests(read_ids(spark, folder, "bytes"))
