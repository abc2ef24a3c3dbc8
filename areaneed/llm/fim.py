"""Fill-in-the-middle transformation by block rotation in place.

A text is cut twice, at code points drawn from a hash of its id. Its bytes go into one bytearray, the
three sentinels are inserted before their segments, and blocks of that array are exchanged by three
reversals (each block, then both together), which moves bytes within the array. The inverse
finds the sentinels, rotates the same blocks back and takes the sentinels out, so it needs
the output and its form alone. A text that holds a sentinel itself is left as it is: in all
others each sentinel occurs once, since it overlaps neither itself nor any text beside it.

Both directions are one pass over the rows, without a shuffle or any state between rows.
"""

from __future__ import annotations

import hashlib
import struct
from collections.abc import Iterator
from functools import partial

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from areaneed.llm.words import byte_slices

PREFIX, SUFFIX, MIDDLE = "<P>", "<S>", "<M>"
_NEW = "n long, form string, prefix_chars long, middle_chars long, output string"
_SLICE_BYTES = 2 << 20


def fill_in_middle(
    docs: DataFrame,
    id_col: str = "doc_id",
    text_col: str = "text",
    seed: int = 1,
    percent: int = 90,
    suffix_first_percent: int = 20,
) -> DataFrame:
    """``docs`` with ``n`` (code points), ``form``, ``prefix_chars``, ``middle_chars`` and ``output``.

    The numbers h1 to h4 are the first four 32-bit words of the SHA-256 of ``seed:id``. The prefix ends
    after the smaller of h1 and h2 modulo n + 1, the middle after the larger. ``form`` is ``plain``
    (the text as it is, no cuts) where h3 modulo 100 is not below ``percent``, ``spm`` (suffix,
    prefix, middle) where h4 modulo 100 is below ``suffix_first_percent``, else ``psm``.

    A null text is an empty one in ``output`` and ``n``; empty texts, texts that hold a sentinel and rows
    with a null id are ``plain``. Rows with equal ids are cut by the same numbers, each in its
    own text. Other columns pass through; input columns named like the new ones are replaced,
    so neither the id nor the text may have such a name. An empty table gives an empty result.
    """
    new = [x.split()[0] for x in _NEW.split(", ")]
    if id_col in new or text_col in new:
        raise ValueError(f"id and text may not be named like a new column: {new}")
    keep = [c for c in docs.columns if c not in new]
    base = docs.select(
        F.struct(*[F.col(f"`{c}`") for c in keep if c != text_col]).alias("other"),
        F.col(f"`{id_col}`").cast("string").alias("id"),
        F.col(f"`{text_col}`").cast("string").alias("text"),
    )
    kind = base.schema["other"].dataType.simpleString()
    work = partial(_transform, seed=seed, percent=percent, first=suffix_first_percent)
    done = base.mapInArrow(work, f"other {kind}, text string, {_NEW}")
    return done.select(
        *[
            F.col("text").alias(c) if c == text_col else F.col(f"other.`{c}`").alias(c)
            for c in keep
        ],
        *new,
    )


def restore_text(
    rows: DataFrame, form_col: str = "form", output_col: str = "output", name: str = "restored"
) -> DataFrame:
    """``rows`` with the text that each output was made from, told from output and form alone.

    An output of any form but ``psm`` and ``spm``, null among them, is its own text; a null output
    stays null. An output without its sentinels is an error. A column called ``name`` is replaced.
    """
    keep = [c for c in rows.columns if c != name]
    base = rows.select(
        F.struct(*[F.col(f"`{c}`") for c in keep]).alias("other"),
        F.col(f"`{form_col}`").alias("form"),
        F.col(f"`{output_col}`").alias("output"),
    )
    kind = base.schema["other"].dataType.simpleString()
    done = base.mapInArrow(_restore, f"other {kind}, restored string")
    return done.select(
        *[F.col(f"other.`{c}`").alias(c) for c in keep], F.col("restored").alias(name)
    )


def _reverse(view: np.ndarray, lo: int, hi: int) -> None:
    half = (hi - lo) // 2
    left, right = view[lo : lo + half], view[hi - half : hi][::-1]
    held = left.copy()
    left[:] = right
    right[:] = held


def rotate(data: bytearray, lo: int, mid: int, hi: int) -> None:
    """Exchange the blocks lo to mid and mid to hi of ``data`` by three reversals."""
    view = np.frombuffer(data, np.uint8)
    _reverse(view, lo, mid)
    _reverse(view, mid, hi)
    _reverse(view, lo, hi)


def arranged(text: bytes, x: int, y: int, form: str) -> bytes:
    """``text`` cut at the bytes ``x`` and ``y`` and put in the order of ``form``."""
    data = bytearray(text)
    data[y:y] = SUFFIX.encode()
    data[x:x] = MIDDLE.encode()
    data[0:0] = PREFIX.encode()
    middle = len(PREFIX) + x
    suffix = middle + len(MIDDLE) + y - x
    rotate(data, middle if form == "psm" else 0, suffix, len(data))
    return bytes(data)


def restored(output: bytes, form: str | None) -> bytes:
    """The text that ``arranged`` got."""
    if form not in ("psm", "spm"):
        return output
    data, size = bytearray(output), len(output)
    prefix, suffix, middle = (data.index(x.encode()) for x in (PREFIX, SUFFIX, MIDDLE))
    if form == "psm":  # prefix, suffix, middle -> prefix, middle, suffix
        rotate(data, suffix, middle, size)
        middle, suffix = suffix, suffix + size - middle
    else:  # suffix, prefix, middle -> prefix, middle, suffix
        rotate(data, 0, prefix, size)
        middle, suffix = middle - prefix, size - prefix
    for at, mark in ((suffix, SUFFIX), (middle, MIDDLE), (0, PREFIX)):
        del data[at : at + len(mark)]
    return bytes(data)


def _cut(key: str | None, text: bytes, seed: int, percent: int, first: int) -> tuple:
    """``n``, ``form``, ``prefix_chars``, ``middle_chars`` and ``output`` of one text."""
    starts = None  # the byte at which each code point starts
    if not text.isascii():
        data = np.frombuffer(text, np.uint8)
        starts = np.append(np.flatnonzero((data & 0xC0) != 0x80), len(text))
    n = len(text) if starts is None else len(starts) - 1
    if not n or key is None or any(x.encode() in text for x in (PREFIX, SUFFIX, MIDDLE)):
        return n, "plain", None, None, text
    digest = hashlib.sha256(f"{seed}:{key}".encode()).digest()
    h1, h2, h3, h4 = struct.unpack(">4I", digest[:16])
    if h3 % 100 >= percent:
        return n, "plain", None, None, text
    form = "spm" if h4 % 100 < first else "psm"
    a, b = sorted((h1 % (n + 1), h2 % (n + 1)))
    x, y = (a, b) if starts is None else (int(starts[a]), int(starts[b]))
    return n, form, a, b - a, arranged(text, x, y, form)


def _transform(
    batches: Iterator[pa.RecordBatch], seed: int, percent: int, first: int
) -> Iterator[pa.RecordBatch]:
    for batch in byte_slices(batches, "text", _SLICE_BYTES):
        texts = batch.column("text")
        keys = batch.column("id").to_pylist()
        rows = [
            _cut(key, text or b"", seed, percent, first)
            for key, text in zip(keys, texts.cast(pa.binary()).to_pylist(), strict=True)
        ]
        n, form, prefix, middle, output = zip(*rows, strict=True)
        yield pa.RecordBatch.from_arrays(
            [
                batch.column("other"),
                texts,
                pa.array(n, pa.int64()),
                pa.array(form, pa.string()),
                pa.array(prefix, pa.int64()),
                pa.array(middle, pa.int64()),
                pa.array(output, pa.binary()).cast(pa.string()),
            ],
            ["other", "text", "n", "form", "prefix_chars", "middle_chars", "output"],
        )


def _restore(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in byte_slices(batches, "output", _SLICE_BYTES):
        outputs = batch.column("output").cast(pa.binary()).to_pylist()
        forms = batch.column("form").to_pylist()
        texts = [
            None if output is None else restored(output, form)
            for output, form in zip(outputs, forms, strict=True)
        ]
        yield pa.RecordBatch.from_arrays(
            [batch.column("other"), pa.array(texts, pa.binary()).cast(pa.string())],
            ["other", "restored"],
        )
