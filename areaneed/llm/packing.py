"""Token packing in harmonic classes, each worker for itself.

A document's ids are first cut into pieces of whole sequences, as long as it has enough. Its rest, of
length r, belongs to class j, with capacity / (j + 1) < r <= capacity / j, and a sequence of class j is
filled with exactly j rests. What such a sequence then lacks is cut from the head of the next
document, so a full sequence has no padding and a document is cut only to fill what is left. Each
partition fills its own sequences in one pass, with one open sequence a class (fewer than two
times the square root of the capacity) and at most one that lacks ids. At its end their pieces are
laid one after the other into common sequences, and the last of these is cut into sequences
whose length is a power of two. No shuffle, no state across workers; a partition that is
run again gives the same sequences.

Ids are those of the given tokenizer for the whole text, looked up under the strings themselves. A
text of ASCII and composed Latin letters is cut into the tokenizer's own pre-tokens, other texts into
words, which its pre-tokenizer never joins. Both are kept with their ids in stores that a worker
process keeps from task to task and that are bounded by their bytes.
"""

import os
import re
import sys
import types
from collections.abc import Callable, Iterator
from functools import partial
from itertools import chain

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from areaneed.llm.words import byte_slices

_PIECES = (
    "id long, start long, length long, ids binary, doc_tokens long, sequence_id long, offset long"
)
# Letters that are their own composed form, and ASCII without controls that are not white space.
_PLAIN = re.compile("[\t-\r -~À-ÖØ-öø-ÿ]*")
# Pre-tokens of such a text in lower case: fixed values of the tokenizer's file.
_PRE_TOKENS = re.compile("'s|'t|'re|'ve|'m|'ll|'d|[a-zß-öø-ÿ]+|[0-9]|[^\\sa-zß-öø-ÿ0-9]+")
_SPECIAL = "<|"  # opens the special tokens, which are found before pre-tokens are cut
_ENTRY_BYTES = 190  # of an entry beside its string and ids
_SLICE_BYTES = 1 << 19  # a task holds a few dozen bytes for each byte of a slice
_LINE, _LINES = 500, 8  # strings encoded at once
_ROWS = 1000


def harmonic_pack(
    docs: DataFrame,
    tokenizer_path: str,
    end_id: int,
    id_col: str = "doc_id",
    text_col: str = "text",
    capacity: int = 4096,
    store_bytes: int = 56 << 20,
) -> DataFrame:
    """One row per piece: the id, ``start`` (ids of its document before it), ``length``, ``ids``
    (little-endian unsigned 32-bit), ``doc_tokens``, ``sequence_id`` and ``offset`` in it.

    A document is the tokenizer's ids of its text and then ``end_id``; ``doc_tokens`` counts both.
    ``capacity`` is a power of two. Within a sequence the offsets have no gap. Every sequence is full
    or as long as a power of two.

    A null or empty text is ``end_id`` alone, so every row has at least one piece. A null id stays
    null; ``store_bytes`` bounds the strings and ids a worker keeps, in each of two generations, and
    changes no result; rows with equal ids are packed one by one. Other columns are not read. An
    empty table gives an empty result. The file at ``tokenizer_path`` must be readable by executors; it
    has to be a word tokenizer: white space separates its pre-tokens and is dropped.
    """
    if capacity < 1 or capacity & (capacity - 1):
        raise ValueError("capacity must be a power of two")
    base = docs.select(
        F.col(f"`{id_col}`").cast("long").alias("id"),
        F.col(f"`{text_col}`").cast("string").alias("text"),
    )
    pack = partial(
        _pack, path=tokenizer_path, end_id=end_id, capacity=capacity, store_bytes=store_bytes
    )
    return base.mapInArrow(pack, _PIECES).withColumnRenamed("id", id_col)


class _Store:
    """Ids by string in two generations, so that what is used again outlives what is not."""

    def __init__(self, encode: Callable[[list], Iterator[bytes]]) -> None:
        self.encode = encode
        self.most = 0
        self.young: dict = {}
        self.old: dict = {}
        self.used = 0

    def of(self, texts: list[list]) -> Iterator[bytes]:
        """The ids of each text, given as its strings."""
        if self.used > self.most:
            self.young, self.old, self.used = {}, self.young, 0
        flat = list(chain.from_iterable(texts))
        found = list(map(self.young.get, flat))
        places = [i for i, ids in enumerate(found) if ids is None]
        missing = {flat[i] for i in places}
        known = {key: self.old[key] for key in missing if key in self.old}
        new = [key for key in missing if key not in known]
        for lo in range(0, len(new), _LINE * _LINES):
            part = new[lo : lo + _LINE * _LINES]
            known.update(zip(part, self.encode(part), strict=True))
        self.used += sum(map(len, known)) + sum(map(len, known.values()))
        self.used += _ENTRY_BYTES * len(known)
        self.young.update(known)
        for i in places:
            found[i] = known[flat[i]]
        lo = 0
        for text in texts:
            yield b"".join(found[lo : lo + len(text)])
            lo += len(text)


class _Ids:
    """Token ids of texts, as little-endian unsigned 32-bit numbers."""

    def __init__(self, path: str):
        from tokenizers import Tokenizer, pre_tokenizers

        self.whole = Tokenizer.from_file(path)
        # The same model for pre-tokens that are cut and in lower case already.
        self.cut = Tokenizer(self.whole.model)
        self.cut.pre_tokenizer = pre_tokenizers.Sequence(
            [
                pre_tokenizers.WhitespaceSplit(),
                pre_tokenizers.ByteLevel(add_prefix_space=False, use_regex=False),
            ]
        )
        vocab = self.whole.get_vocab()
        self.ends = np.zeros(max(vocab.values()) + 1, bool)
        self.ends[[i for token, i in vocab.items() if token.endswith("</w>")]] = True
        self.pre_tokens = _Store(self._encode_pre_tokens)
        self.words = _Store(self._encode_words)

    def of(self, texts: list[bytes | None]) -> list[bytes]:
        """The ids of each text."""
        plain, other = {}, {}
        for i, data in enumerate(texts):
            text = (data or b"").decode()
            if _PLAIN.fullmatch(text) and _SPECIAL not in text:
                plain[i] = _PRE_TOKENS.findall(text.lower())
            else:
                # The words of bytes.split() are those between blanks, tabs and line ends.
                other[i] = data.split()
        out = dict(zip(plain, self.pre_tokens.of(list(plain.values())), strict=True))
        out.update(zip(other, self.words.of(list(other.values())), strict=True))
        return [out[i] for i in range(len(texts))]

    def _encode_words(self, words: list[bytes]) -> Iterator[bytes]:
        texts = [x.decode() for x in words]
        for x in self.whole.encode_batch_fast(texts, add_special_tokens=False):
            yield np.array(x.ids, "<u4").tobytes()

    def _encode_pre_tokens(self, pre_tokens: list[str]) -> Iterator[bytes]:
        lines = [" ".join(pre_tokens[i : i + _LINE]) for i in range(0, len(pre_tokens), _LINE)]
        done = self.cut.encode_batch_fast(lines, add_special_tokens=False)
        ids = np.concatenate([np.array(x.ids, "<u4") for x in done])
        ends = (4 * np.flatnonzero(self.ends[ids]) + 4).tolist()
        if len(ends) != len(pre_tokens):
            raise ValueError("the tokenizer does not mark the ends of words")
        data, at = ids.tobytes(), 0
        for end in ends:
            yield data[at:end]
            at = end


def _worker_ids(path: str, store_bytes: int) -> _Ids:
    """The tokenizer of this worker process, which outlives a task."""
    os.environ["TOKENIZERS_PARALLELISM"] = "false"
    held = sys.modules.setdefault("_packing_tokenizers", types.ModuleType("_packing_tokenizers"))
    if path not in held.__dict__:
        held.__dict__[path] = _Ids(path)
    ids = held.__dict__[path]
    ids.pre_tokens.most = ids.words.most = store_bytes
    return ids


class _Classes:
    """The open sequence of each class, and the one that lacks ids."""

    def __init__(self, capacity: int, first: int):
        self.capacity = capacity
        self.next = first
        self.open: dict[int, list[tuple]] = {}
        self.short: list[tuple] = []
        self.lack = 0
        self.done: list[tuple] = []

    def add(self, key: int | None, data: bytes) -> None:
        """Place the ids of one document."""
        total, start = len(data) // 4, 0

        def piece(length: int) -> tuple:
            return key, start, length, data[4 * start : 4 * (start + length)], total

        if self.lack:
            taken = min(self.lack, total)
            self.short.append(piece(taken))
            self.lack -= taken
            start = taken
            if not self.lack:
                self.close(self.short)
        while total - start >= self.capacity:
            self.close([piece(self.capacity)])
            start += self.capacity
        if start < total:
            count = self.capacity // (total - start)
            row = self.open.setdefault(count, [])
            row.append(piece(total - start))
            if len(row) == count:
                self.full(self.open.pop(count))

    def full(self, row: list[tuple]) -> None:
        """A class has its number of rests; what the sequence lacks comes from the next document."""
        self.lack = self.capacity - sum(x[2] for x in row)
        if self.lack:
            self.short = row
        else:
            self.close(row)

    def close(self, pieces: list[tuple]) -> None:
        offset = 0
        for piece in pieces:
            self.done.append((*piece, self.next, offset))
            offset += piece[2]
        self.next += 1

    def finish(self) -> None:
        """All open pieces one after the other: full sequences, then powers of two."""
        rest = self.short if self.lack else []
        for count in sorted(self.open):
            rest = rest + self.open[count]
        left = sum(x[2] for x in rest)
        row, room = [], min(self.capacity, 1 << (left.bit_length() - 1)) if left else 0
        for key, start, length, data, total in rest:
            while length:
                taken = min(room, length)
                row.append((key, start, taken, data[: 4 * taken], total))
                start, length, data = start + taken, length - taken, data[4 * taken :]
                room, left = room - taken, left - taken
                if not room:
                    self.close(row)
                    row, room = [], min(self.capacity, 1 << (left.bit_length() - 1)) if left else 0
        self.open, self.short, self.lack = {}, [], 0


def _batch(rows: list[tuple]) -> pa.RecordBatch:
    ids, start, length, data, tokens, sequence, offset = zip(*rows, strict=True)
    kind = pa.int64()
    return pa.RecordBatch.from_arrays(
        [
            pa.array(ids, kind),
            pa.array(start, kind),
            pa.array(length, kind),
            pa.array(data, pa.binary()),
            pa.array(tokens, kind),
            pa.array(sequence, kind),
            pa.array(offset, kind),
        ],
        ["id", "start", "length", "ids", "doc_tokens", "sequence_id", "offset"],
    )


def _pack(
    batches: Iterator[pa.RecordBatch], path: str, end_id: int, capacity: int, store_bytes: int
):
    # A worker's sequences are numbered in a range of its own.
    classes = _Classes(capacity, TaskContext.get().partitionId() << 40)
    end = np.array([end_id], "<u4").tobytes()
    for batch in byte_slices(batches, "text", _SLICE_BYTES):
        texts = batch.column("text").cast(pa.binary()).to_pylist()
        keys = batch.column("id").to_pylist()
        for key, ids in zip(keys, _worker_ids(path, store_bytes).of(texts), strict=True):
            classes.add(key, ids + end)
            if len(classes.done) >= _ROWS:
                yield _batch(classes.done)
                classes.done = []
    classes.finish()
    for lo in range(0, len(classes.done), _ROWS):
        yield _batch(classes.done[lo : lo + _ROWS])
    pa.default_memory_pool().release_unused()
