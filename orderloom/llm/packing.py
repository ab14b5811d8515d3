"""Packing documents into fixed-length token sequences with a bounded number of open windows."""

from __future__ import annotations

import json
import os
from bisect import bisect_left, insort
from collections.abc import Iterator
from pathlib import Path

import numpy as np
import pandas as pd
import pyarrow as pa
import pyarrow.compute as pc
from pyspark import TaskContext
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import staged, text_of

LENGTH = 2048
END_ID = 1
OPEN_WINDOWS = 64  # per partition
TOLERATED = 16  # ids of padding with which a window counts as full
FAN_IN = 32  # partitions whose leftovers are merged together

_MERGED = 1 << 30  # sequence ids of merged leftovers start here, above every partition's
_LONGEST = 2000  # bytes without a border of spaces, beyond which the general encoder's time grows slower

#: Fixed value: how byte-level vocabularies of this kind split text before they merge bytes.
_PIECES = r"""'(?:[sdmt]|ll|ve|re)| ?\p{L}++| ?\p{N}++| ?[^\s\p{L}\p{N}]++|\s++$|\s+(?!\S)|\s"""
#: How byte-level vocabularies write bytes: printable ones as themselves, the others from U+0100 on.
_PRINTED = [*range(33, 127), *range(161, 173), *range(174, 256)]
_BYTES = {chr(b): b for b in _PRINTED} | {chr(256 + k): b for k, b in enumerate(b for b in range(256) if b not in _PRINTED)}


def _general(tokenizer_json: str):
    os.environ["TOKENIZERS_PARALLELISM"] = "false"
    from tokenizers import Tokenizer

    tokenizer = Tokenizer.from_str(tokenizer_json)
    tokenizer.encode_special_tokens = True
    return tokenizer


def merges_by_rank(tokenizer_json: str) -> bool:
    """Whether a tokenizer's ids are those of merging, over and over, the two neighbours that make the earliest token.

    So it is for a plain byte-level vocabulary where each token's bytes give that token: inside the bytes of a token, merges do not
    depend on what stands around them, so two neighbours that make a token are always the two it was made from.
    """
    told = json.loads(tokenizer_json)
    model, split = told["model"], told.get("pre_tokenizer") or {}
    plain = model["type"] == "BPE" and not any(model.get(k) for k in ("dropout", "continuing_subword_prefix", "end_of_word_suffix", "byte_fallback", "ignore_merges"))
    plain = plain and told.get("normalizer") is None and all(t["special"] for t in told.get("added_tokens") or [])
    plain = plain and split.get("type") == "ByteLevel" and not split.get("add_prefix_space") and split.get("use_regex", True)
    if not plain or any(c not in _BYTES for token in model["vocab"] for c in token) or any(c not in model["vocab"] for c in _BYTES):
        return False
    tokenizer = _general(tokenizer_json)
    return len(model["merges"]) + 256 == len(model["vocab"]) and all(len(tokenizer.model.tokenize(t)) == 1 for t in model["vocab"])


class Encoder:
    """Ids of texts, as little-endian 32-bit bytes: by rank where the vocabulary allows it, else by the tokenizer's own encoder.

    Merging by rank is several times faster, but quadratic in the length of a piece, so texts with very long ones go the other way.
    """

    def __init__(self, tokenizer_json: str, by_rank: bool):
        self.tokenizer, self.ranked = _general(tokenizer_json), None
        if by_rank:
            import tiktoken

            model = json.loads(tokenizer_json)["model"]
            pairs = [tuple(m.split(" ")) if isinstance(m, str) else tuple(m) for m in model["merges"]]
            tokens = [*sorted(_BYTES, key=_BYTES.get), *(a + b for a, b in pairs)]
            ranks = {bytes(_BYTES[c] for c in token): k for k, token in enumerate(tokens)}
            self.ids = np.array([model["vocab"][t] for t in tokens], "<u4")
            self.ranked = tiktoken.Encoding("ranked", pat_str=_PIECES, mergeable_ranks=ranks, special_tokens={})

    def _whole(self, texts: list[str]) -> list[bytes]:
        return [np.array(e.ids, "<u4").tobytes() for e in self.tokenizer.encode_batch_fast(texts, add_special_tokens=False)]

    def encode(self, texts: pa.Array) -> list[bytes]:
        rows = texts.to_pylist()
        if self.ranked is None:
            return self._whole(rows)
        encode, ids, long = self.ranked.encode_ordinary, self.ids, rows_with_long_pieces(texts)
        return [self._whole([t])[0] if k in long else ids.take(encode(t)).tobytes() for k, t in enumerate(rows)]


def rows_with_long_pieces(texts: pa.Array, longest: int = _LONGEST) -> set[int]:
    """Rows that have over ``longest`` bytes in a row that are all spaces or all none."""
    lengths = pc.binary_length(texts).to_numpy(zero_copy_only=False)
    if not len(lengths) or lengths.max() <= longest:
        return set()
    ends = np.cumsum(lengths, dtype=np.int64)
    wide = np.int64 if pa.types.is_large_string(texts.type) else np.int32
    begin = np.frombuffer(texts.buffers()[1], wide)[texts.offset]
    spaces = np.frombuffer(texts.buffers()[2], np.uint8)[begin : begin + ends[-1]] == 32
    border = np.ones(len(spaces) + 1, bool)
    np.not_equal(spaces[1:], spaces[:-1], out=border[1:-1])
    border[ends] = True
    borders = np.flatnonzero(border)
    starts = borders[:-1][np.diff(borders) > longest]
    return set(np.searchsorted(ends, starts, "right").tolist())


_ENCODERS: dict[str, Encoder] = {}


def _encoder(key: str, tokenizer_json: str, by_rank: bool) -> Encoder:
    if key not in _ENCODERS:
        _ENCODERS.clear()
        _ENCODERS[key] = Encoder(tokenizer_json, by_rank)
    return _ENCODERS[key]


class Packer:
    """Bounded-space best fit: pieces go to the fullest open window that has room; when none has, the fullest is emitted.

    A window is emitted as it is when at most TOLERATED ids are missing, and is otherwise filled up with the first part of
    the piece, as documents may be cut. ``out`` takes (sequence number, pieces), a piece being (document, start, ids).
    """

    def __init__(self, length: int = LENGTH, open_windows: int = OPEN_WINDOWS):
        self.length, self.open_windows = length, open_windows
        self.room: list[tuple[int, int]] = []  # of open windows, sorted: ids missing, window
        self.held: dict[int, list[tuple]] = {}
        self.out: list[tuple[int, list[tuple]]] = []
        self.opened = self.emitted = 0

    def emit(self, pieces: list[tuple]) -> None:
        self.out.append((self.emitted, pieces))
        self.emitted += 1

    def _put(self, at: int, piece: tuple) -> None:
        room, window = self.room.pop(at)
        self.held[window].append(piece)
        left = room - len(piece[2]) // 4
        if left:
            insort(self.room, (left, window))
        else:
            self.emit(self.held.pop(window))

    def add(self, doc, start: int, ids: bytes) -> None:
        at, n = 0, len(ids) // 4
        while n - at >= self.length:
            self.emit([(doc, start + at, ids[4 * at : 4 * (at + self.length)])])
            at += self.length
        while at < n:
            k = bisect_left(self.room, (n - at, -1))
            if k < len(self.room):
                self._put(k, (doc, start + at, ids[4 * at :]))
                return
            if len(self.room) < self.open_windows:
                self.held[self.opened] = []
                insort(self.room, (self.length, self.opened))
                self.opened += 1
            elif self.room[0][0] <= TOLERATED:
                self.emit(self.held.pop(self.room.pop(0)[1]))
            else:
                take = self.room[0][0]
                self._put(0, (doc, start + at, ids[4 * at : 4 * (at + take)]))
                at += take

    def leftovers(self) -> list[tuple]:
        """Pieces of the windows that are not nearly full, which are emitted; the windows are closed."""
        left = []
        for room, window in self.room:
            pieces = self.held.pop(window)
            if room <= TOLERATED:
                self.emit(pieces)
            else:
                left += pieces
        self.room = []
        return left

    def finish(self) -> None:
        """Empty the open windows into full ones, and what remains into sequences of a power of two, which need no padding."""
        left = self.leftovers()
        if not left:
            return
        sizes = [self.length] * (sum(len(p[2]) for p in left) // 4 // self.length)
        rest = sum(len(p[2]) for p in left) // 4 - sum(sizes)
        sizes += [1 << b for b in range(rest.bit_length() - 1, -1, -1) if rest >> b & 1]
        pieces = iter(left)
        doc, start, ids = next(pieces)
        for size in sizes:
            window = []
            while size:
                if not ids:
                    doc, start, ids = next(pieces)
                take = min(size, len(ids) // 4)
                window.append((doc, start, ids[: 4 * take]))
                start, ids, size = start + take, ids[4 * take :], size - take
            self.emit(window)

    def taken(self, prefix: int) -> list[list]:
        """Columns of what was emitted so far: document, start, ids, sequence id, offset."""
        rows: list[list] = [[], [], [], [], []]
        for number, pieces in self.out:
            offset = 0
            for doc, start, ids in pieces:
                for column, v in zip(rows, (doc, start, ids, (prefix << 32) + number, offset), strict=True):
                    column.append(v)
                offset += len(ids) // 4
        self.out = []
        return rows


def pack(
    docs: DataFrame,
    tokenizer_path: str,
    id_column: str = "doc_id",
    length: int = LENGTH,
    open_windows: int = OPEN_WINDOWS,
    end_id: int = END_ID,
) -> DataFrame:
    """One row per piece: the id, ``start`` (ids of the document before the piece), ``ids`` (little-endian 32-bit), ``doc_tokens``, ``sequence_id``, ``offset``.

    A document is its text's ids and ``end_id``. Every partition packs its documents as they come, with
    ``open_windows`` open windows; its leftovers are merged with those of FAN_IN - 1 other partitions, longest pieces first.
    Sequences hold ``length`` ids, at most TOLERATED fewer, or a power of two of them. The packed pieces are written to the
    shared folder, so that sequences are the same for every reader.

    Defined cases: null and empty texts are just ``end_id``; special tokens' strings are ordinary text; documents longer than a
    sequence fill sequences of their own and pack the rest; repeated rows and ids, null ids and all other
    columns are packed or passed over without a look; an empty table gives no rows.
    """
    spark = docs.sparkSession
    rows = docs.select(F.col(id_column).alias(id_column), text_of().alias("__text"))
    told = Path(tokenizer_path).read_text()
    tokenizer, by_rank = spark.sparkContext.broadcast(told), merges_by_rank(told)
    end = np.array([end_id], "<u4").tobytes()
    schema = rows.select(id_column).withColumns(
        {"start": F.lit(0).cast("long"), "ids": F.lit(b""), "doc_tokens": F.lit(0).cast("long"),
         "sequence_id": F.lit(0).cast("long"), "offset": F.lit(0).cast("long"), "left_by": F.lit(0)}
    ).schema

    def frame(columns: list[list], left_by: int, kind: pa.DataType) -> pa.RecordBatch:
        docs_, starts, ids, sequences, offsets = columns
        return pa.RecordBatch.from_arrays(
            [
                pa.array([d[0] for d in docs_], kind), pa.array(starts, pa.int64()), pa.array(ids, pa.binary()),
                pa.array([d[1] for d in docs_], pa.int64()), pa.array(sequences, pa.int64()), pa.array(offsets, pa.int64()),
                pa.array([left_by] * len(docs_), pa.int32()),
            ],
            [id_column, "start", "ids", "doc_tokens", "sequence_id", "offset", "left_by"],
        )

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        encoder, packer = _encoder(tokenizer_path, tokenizer.value, by_rank), Packer(length, open_windows)
        part, kind = TaskContext.get().partitionId(), pa.null()
        for b in batches:
            kind = b.column(0).type
            for k in range(0, b.num_rows, 512):
                some = b.slice(k, 512)
                for doc, ids in zip(some.column(0).to_pylist(), encoder.encode(some.column(1)), strict=True):
                    ids += end
                    packer.add((doc, len(ids) // 4), 0, ids)
                yield frame(packer.taken(part), -1, kind)
        left = packer.leftovers()
        yield frame(packer.taken(part), -1, kind)
        if left:
            yield frame([[p[0] for p in left], [p[1] for p in left], [p[2] for p in left], [-1] * len(left), [0] * len(left)], part, kind)

    packed = staged(rows.mapInArrow(run, schema), "packed")

    def merge(key: tuple, left: pd.DataFrame) -> pd.DataFrame:
        left = left.assign(n=left["ids"].str.len()).sort_values(["n", "left_by", "start"], ascending=[False, True, True], kind="stable")
        packer = Packer(length, open_windows)
        for r, (doc, start, ids, n) in enumerate(zip(left["row"], left["start"], left["ids"], left["doc_tokens"], strict=True)):
            packer.add((doc, n), start, ids)
        packer.finish()
        docs_, starts, ids, sequences, offsets = packer.taken(_MERGED + int(key[0]))
        return pd.DataFrame(
            {"row": [d[0] for d in docs_], "start": starts, "ids": ids, "doc_tokens": [d[1] for d in docs_], "sequence_id": sequences, "offset": offsets}
        )

    out = ["start", "ids", "doc_tokens", "sequence_id", "offset"]
    left = packed.where("left_by >= 0").select(F.floor(F.col("left_by") / FAN_IN).cast("int").alias("group"), F.col(id_column).alias("row"), *out, "left_by")
    merged = left.groupBy("group").applyInPandas(merge, left.select("row", *out).schema)
    return packed.where("left_by < 0").select(id_column, *out).unionByName(
        merged.select(F.col("row").cast(schema[id_column].dataType).alias(id_column), *out)
    )
