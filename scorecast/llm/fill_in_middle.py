"""Fill-in-the-middle transformation with a piece table.

A document is a list of descriptors (buffer, start, end) over two immutable
buffers: its own text and the sentinels ``<P>``, ``<S>``, ``<M>``. Cutting
splits a descriptor, an arrangement permutes the three segments and sets a
sentinel before each, and the inverse permutation restores them. Texts are
never copied while they are cut and moved; hashes stream over descriptors, and
only the output column is written out.

Cuts fall between units: runs of A-Za-z, or single other code points. Where
they fall, and which form a document gets, is drawn from the sha256 of
``1:<document id>``, so the result does not depend on the table's layout.

Defined results
  * null or empty text: no unit, form ``plain``, empty output;
  * texts that hold a sentinel themselves are left plain, so an output can
    always be read back;
  * null document id: drawn like an id without digits;
  * repeated rows and ids: each row for itself, equal rows give equal results;
  * an empty table gives an empty result; all columns of the input are kept,
    columns named like the added ones are replaced.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator
from typing import NamedTuple

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import StringType, StructField, StructType

from scorecast.llm.common import arrow_map, free_name, utf8

# fixed values of the output format
SENTINELS = b"<P><S><M>"
MARK = {"prefix": (0, 3), "suffix": (3, 6), "middle": (6, 9)}
SEGMENTS = ("prefix", "middle", "suffix")
# places of the segments above in the output
ARRANGEMENTS = {"psm": (0, 2, 1), "spm": (2, 0, 1)}

ADDED = (StructType().add("n", "long").add("form", "string").add("prefix_chars", "long").add("middle_chars", "long")
         .add("fim_text", "string").add("output_sha256", "string").add("restored_sha256", "string"))
ARROW = (pa.int64(), pa.string(), pa.int64(), pa.int64(), pa.binary(), pa.string(), pa.string())
# outputs that a batch holds before it is handed on
BATCH_BYTES = 64 << 20

_LETTER = np.zeros(256, dtype=bool)
_LETTER[65:91] = _LETTER[97:123] = True


class Piece(NamedTuple):
    """Bytes ``start`` to ``end`` of an immutable buffer."""

    buffer: memoryview
    start: int
    end: int


def cut(piece: Piece, at: list[int]) -> list[Piece]:
    """The piece split at ascending places (relative to its start)."""
    ends = [0, *at, piece.end - piece.start]
    return [Piece(piece.buffer, piece.start + a, piece.start + b) for a, b in zip(ends, ends[1:])]


def arrange(segments: list[Piece], form: str) -> list[Piece]:
    """Prefix, middle and suffix in the order of ``form``, each behind its
    sentinel."""
    marks = memoryview(SENTINELS)
    return [p for i in ARRANGEMENTS[form] for p in (Piece(marks, *MARK[SEGMENTS[i]]), segments[i])]


def stream(pieces: list[Piece]) -> Iterator[memoryview]:
    return (p.buffer[p.start:p.end] for p in pieces)


def digest(pieces: list[Piece]) -> str:
    h = hashlib.sha256()
    for part in stream(pieces):
        h.update(part)
    return h.hexdigest()


def restore(output: bytes, form: str) -> list[Piece]:
    """The document's pieces over the output's bytes: sentinels are looked up
    and taken out, the segments put back in their order."""
    whole = Piece(memoryview(output), 0, len(output))
    if form == "plain":
        return [whole]
    order, at = ARRANGEMENTS[form], []
    for i in order:
        mark = SENTINELS[slice(*MARK[SEGMENTS[i]])]
        start = output.index(mark)
        at += [start, start + len(mark)]
    moved = cut(whole, at)[2::2]
    back = [order.index(i) for i in range(len(order))]
    return [moved[i] for i in back]


def draws(doc_id: int | None, seed: str) -> list[int]:
    """The first four 32-bit numbers of the sha256 of ``<seed>:<id>``."""
    h = hashlib.sha256(f"{seed}:{'' if doc_id is None else doc_id}".encode()).digest()
    return [int.from_bytes(h[4 * i:4 * i + 4], "big") for i in range(4)]


def unit_starts(text: bytes) -> tuple[np.ndarray, np.ndarray]:
    """Byte places where units start, and which bytes start a code point."""
    b = np.frombuffer(text, dtype=np.uint8)
    letter, first = _LETTER[b], (b & 0xC0) != 0x80
    start = first.copy()
    start[1:] &= ~(letter[1:] & letter[:-1])
    return np.flatnonzero(start), first


def transform(text: bytes, doc_id: int | None, seed: str = "1", plain_share: int = 10, spm_share: int = 20) -> tuple:
    """(n, form, prefix_chars, middle_chars, pieces) of one document. Of a
    hundred documents ``plain_share`` stay as they are; of the others
    ``spm_share`` get the suffix first."""
    whole = Piece(memoryview(text), 0, len(text))
    starts, first = unit_starts(text)
    n = len(starts)
    h1, h2, h3, h4 = draws(doc_id, seed)
    if not text or h3 % 100 >= 100 - plain_share or any(SENTINELS[slice(*m)] in text for m in MARK.values()):
        return n, "plain", None, None, [whole]
    lo, hi = (int(starts[k]) if k < n else len(text) for k in sorted((h1 % (n + 1), h2 % (n + 1))))
    form = "spm" if h4 % 100 < spm_share else "psm"
    chars = [int(np.count_nonzero(first[a:b])) for a, b in ((0, lo), (lo, hi))]
    return n, form, *chars, arrange(cut(whole, [lo, hi]), form)


def fill_in_middle(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", seed: str = "1",
                   plain_share: int = 10, spm_share: int = 20) -> DataFrame:
    """The input's columns with n (units), form, prefix_chars, middle_chars,
    fim_text (the output) and the sha256 of the output and of the text that is
    rebuilt from output and form."""
    added = ADDED.fieldNames()
    kept = [c for c in docs.columns if c.lower() not in added]
    src = docs.select(*kept, F.col(id_col).cast("long").alias(free_name(kept, "fim_id")),
                      utf8(text_col).alias(free_name(kept, "fim_raw")))

    def made(columns: list[pa.Array], rows: list[tuple]) -> pa.RecordBatch:
        cols = [pa.array(x, type=kind) for x, kind in zip(zip(*rows), ARROW)]
        cols[added.index("fim_text")] = cols[added.index("fim_text")].view(pa.string())
        return pa.RecordBatch.from_arrays(columns + cols, names=kept + added)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            ids, texts, rows, size, begin = b.column(len(kept)), b.column(len(kept) + 1), [], 0, 0
            for at in range(b.num_rows):
                n, form, prefix, middle, pieces = transform(texts[at].as_py(), ids[at].as_py(), seed, plain_share, spm_share)
                out = b"".join(stream(pieces))
                rows.append((n, form, prefix, middle, out, digest(pieces), digest(restore(out, form))))
                size += len(out)
                if size >= BATCH_BYTES or at == b.num_rows - 1:
                    yield made([c.slice(begin, len(rows)) for c in b.columns[:len(kept)]], rows)
                    rows, size, begin = [], 0, at + 1

    return arrow_map(src, StructType(docs.select(*kept).schema.fields + ADDED.fields), run)


def restored(docs: DataFrame, out_col: str = "fim_text", form_col: str = "form") -> DataFrame:
    """The table with ``text``, rebuilt from an output and its form alone."""
    kept = [c for c in docs.columns if c.lower() != "text"]
    src = docs.select(*kept, utf8(out_col).alias(free_name(kept, "fim_raw")), F.col(form_col).alias(free_name(kept, "fim_form")))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            for at in range(b.num_rows):
                back = b"".join(stream(restore(b.column(len(kept))[at].as_py(), b.column(len(kept) + 1)[at].as_py())))
                yield pa.RecordBatch.from_arrays([*(c.slice(at, 1) for c in b.columns[:len(kept)]),
                                                  pa.array([back], type=pa.binary()).view(pa.string())], names=[*kept, "text"])

    return arrow_map(src, StructType([*docs.select(*kept).schema.fields, StructField("text", StringType())]), run)
