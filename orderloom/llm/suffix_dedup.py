"""Removal of repeated byte strings, found in a column-wise sorted collection of suffixes.

Every string of LENGTH bytes has an anchor: of the GRAM-byte strings in it the one with the least hash. Equal
strings have equal anchors at equal places, so only texts around a common anchor need sorting together. Runs of
strings with one anchor make a piece; pieces with one content count once, the earliest. Pieces that share an
anchor but differ are aligned by it, and their collection is built column by column from the right: a round puts
one symbol in front of every piece's suffix, and a stable sort by that symbol, the transform's next column, gives the order
of the longer suffixes and, with range minima over the previous ones, their common prefixes. Strings
of LENGTH bytes that are equal stand together in it.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from orderloom.operators.joins import join_per_key

from .common import numbered, staged, text_of
from .shingles import letter_sums, mix

LENGTH = 100
GRAM = 24
HOT_ANCHOR = 20_000  # differing pieces with one anchor from which their strings are compared by hash
COLLECTION = 1 << 22  # bytes sorted together
_BATCH = 1 << 21  # bytes anchored together
_ROWS = 256  # rows turned into Python values at a time
_REPEATED = 255  # in place of an anchor's offset: the whole piece is repeated
_ABSENT = 255  # a byte that UTF-8 does not use


def _pieces(buffer: np.ndarray, starts: np.ndarray, ends: np.ndarray, length: int, gram: int):
    """Of all strings inside the texts buffer[start:end]: pieces as (begin, bytes, anchor's offset, anchor's hash, piece's hash)."""
    empty = np.empty(0, np.int64)
    n = len(buffer)
    if n < length:
        return empty, empty, empty, empty.view(np.uint64), empty.view(np.uint64)
    sums, inverse = letter_sums(buffer)
    grams = mix((sums[gram:] - sums[:-gram]) * inverse[: n - gram + 1])
    low = np.uint64((1 << 24) - 1)
    least = (grams & ~low) | np.arange(len(grams), dtype=np.uint64)  # equal hashes: the leftmost
    width, reach = length - gram + 1, 1
    while 2 * reach <= width:
        least = np.minimum(least[:-reach], least[reach:])
        reach *= 2
    if reach < width:
        least = np.minimum(least[: len(least) - (width - reach)], least[width - reach :])
    inside = np.zeros(n + 1, np.int32)
    has = ends - starts >= length
    np.add.at(inside, starts[has], 1)
    np.add.at(inside, ends[has] - length + 1, -1)
    at = np.flatnonzero(np.cumsum(inside[:n]) > 0)
    if not len(at):
        return empty, empty, empty, empty.view(np.uint64), empty.view(np.uint64)
    anchor = (least[at] & low).astype(np.int64)
    new = np.flatnonzero(np.r_[True, anchor[1:] != anchor[:-1]])
    begin, last, anchor = at[new], at[np.r_[new[1:], len(at)] - 1], anchor[new]
    size, offset = last + length - begin, anchor - begin
    whole = (sums[begin + size] - sums[begin]) * inverse[begin]
    return begin, size, offset, grams[anchor], mix(whole + mix((size << 8 | offset).astype(np.uint64)))


def anchored(texts: DataFrame, length: int = LENGTH, gram: int = GRAM) -> DataFrame:
    """Pieces of all texts (``doc`` long, ``text`` binary): ``key``, ``piece`` (hashes), ``doc``, ``place``.

    ``place`` packs the first byte's number, the number of bytes and the anchor's offset. Of pieces alike in a
    batch all but the earliest come out as repeated, with a key of their own.
    """
    out = "key long, piece long, doc long, place long"

    def emit(docs: list[int], parts: list[bytes], shifts: list[int]) -> pa.RecordBatch:
        ends = np.cumsum([len(p) for p in parts])
        starts = ends - np.array([len(p) for p in parts])
        begin, size, offset, key, piece = _pieces(np.frombuffer(b"".join(parts), np.uint8), starts, ends, length, gram)
        of = np.searchsorted(ends, begin, "right")
        doc, first = np.array(docs, np.int64)[of], begin - starts[of] + np.array(shifts, np.int64)[of]
        order = np.lexsort((first, doc, piece, key))
        begin, size, offset, key, piece, doc, first = (x[order] for x in (begin, size, offset, key, piece, doc, first))
        again = np.r_[False, (key[1:] == key[:-1]) & (piece[1:] == piece[:-1])] if len(key) else np.empty(0, bool)
        key = np.where(again, mix(doc.view(np.uint64) + np.uint64(1)), key)
        place = first << 16 | size << 8 | np.where(again, _REPEATED, offset)
        return pa.RecordBatch.from_arrays([pa.array(x.view(np.int64)) for x in (key, piece, doc, place)], [c.split()[0] for c in out.split(", ")])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        docs, parts, shifts, held = [], [], [], 0
        for b in _slices(batches):
            for doc, text in zip(b.column(0).to_pylist(), b.column(1).to_pylist(), strict=True):
                for shift in range(0, max(len(text) - length + 1, 0), _BATCH):
                    part = text[shift : shift + _BATCH + length - 1]  # strings that begin in this stretch
                    docs.append(doc)
                    parts.append(part)
                    shifts.append(shift)
                    held += len(part)
                    if held >= _BATCH:
                        yield emit(docs, parts, shifts)
                        docs, parts, shifts, held = [], [], [], 0
        if parts:
            yield emit(docs, parts, shifts)

    return texts.select("doc", "text").mapInArrow(run, out)


def _slices(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for b in batches:
        for k in range(0, b.num_rows, _ROWS):
            yield b.slice(k, _ROWS)


def compare_hashes(pieces: DataFrame) -> DataFrame:
    """``doc``, ``place``, ``key``, ``differs``: repeated pieces, and the earliest of each content where an anchor has several contents.

    A task reads its sorted rows once and holds one batch, however many share an anchor; of the
    last anchor it remembers the first content, until a second one comes or the anchor ends.
    """
    names = ["doc", "place", "key", "differs"]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        last, waiting, contents = None, None, 0
        for b in batches:
            if not b.num_rows:
                continue
            key, piece, doc, place = (c.to_numpy(zero_copy_only=False) for c in b.columns)
            known = (place & 255) == _REPEATED
            goes_on, again = last is not None and key[0] == last[0], last is not None and piece[0] == last[1] and not last[2]
            same_key = np.r_[goes_on, key[1:] == key[:-1]]
            # known repeats sort into groups too, but count as no content
            first = ~(same_key & np.r_[again, (piece[1:] == piece[:-1]) & ~known[:-1]]) & ~known
            group = np.cumsum(~same_key)  # 0 is the anchor the batch before ended with
            found = np.bincount(group, first)
            found[0] += contents
            differs = first & (found[group] > 1)
            out = ~first | differs
            yield pa.RecordBatch.from_arrays(
                [pa.array(doc[out]), pa.array(np.where(differs, place, place | _REPEATED)[out]), pa.array(key[out]), pa.array(differs[out])], names
            )
            if waiting and found[0] > 1:
                yield pa.RecordBatch.from_arrays([pa.array([v]) for v in waiting], names)
            if group[-1] or found[0] > 1:
                waiting = None
            contents = min(int(found[-1]), 2)
            alone = np.flatnonzero(first & (group == group[-1])) if contents == 1 else []
            if len(alone):
                waiting = (doc[alone[0]], place[alone[0]], key[alone[0]], True)
            last = key[-1], piece[-1], known[-1]

    return (
        pieces.repartition("key").sortWithinPartitions("key", "piece", "doc", "place")
        .mapInArrow(run, "doc long, place long, key long, differs boolean")
    )


def equal_strings(parts: list[bytes], offsets: np.ndarray, doc: np.ndarray, first: np.ndarray, length: int) -> tuple[np.ndarray, np.ndarray]:
    """Strings that begin earlier in another part, as (part, place in it), of parts aligned by their anchors' offsets.

    A string's order is that of its document, then of its place there.
    """
    n, sizes = len(parts), np.array([len(p) for p in parts])
    begin = offsets.max() - offsets
    columns = int((begin + sizes).max())
    symbols = np.full((columns, n), _ABSENT, np.uint8)
    which = np.repeat(np.arange(n), sizes)
    inner = np.arange(sizes.sum()) - np.repeat(np.cumsum(sizes) - sizes, sizes)
    symbols[begin[which] + inner, which] = np.frombuffer(b"".join(parts), np.uint8)
    rank = np.unique(doc, return_inverse=True)[1].astype(np.int64) << 40
    order, common = np.arange(n), np.zeros(n, np.uint8)
    found_part, found_at = [], []
    for column in range(columns - 1, -1, -1):
        symbol = symbols[column][order]
        by = np.argsort(symbol, kind="stable")
        same = np.r_[False, (symbol[by[1:]] == symbol[by[:-1]]) & (symbol[by[1:]] != _ABSENT)]
        levels = [common]  # minima over 1, 2, 4, ... neighbours
        while 2 << (len(levels) - 1) <= n:
            reach = 1 << (len(levels) - 1)
            levels.append(np.minimum(levels[-1], np.r_[levels[-1][reach:], np.zeros(reach, np.uint8)]))
        table = np.concatenate(levels)
        k = np.flatnonzero(same)
        low, high = by[k - 1] + 1, by[k]
        level = np.frexp((high - low + 1).astype(np.float64))[1] - 1
        least = np.minimum(table[level * n + low], table[level * n + high - (1 << level) + 1])
        common = np.zeros(n, np.uint8)
        common[k] = np.minimum(least, 254) + 1
        order = order[by]
        if column + length <= columns:
            joined = common >= length
            run = np.flatnonzero(joined | np.r_[joined[1:], False])
            if len(run):
                part = order[run]
                at = column - begin[part]
                place = rank[part] + first[part] + at
                starts = np.flatnonzero(~joined[run])
                earliest = np.repeat(np.minimum.reduceat(place, starts), np.diff(np.r_[starts, len(run)]))
                later = place > earliest
                found_part.append(part[later])
                found_at.append(at[later])
    if not found_part:
        return np.empty(0, np.int64), np.empty(0, np.int64)
    return np.concatenate(found_part), np.concatenate(found_at)


def compare_texts(texts: DataFrame, spans: DataFrame, length: int) -> DataFrame:
    """``doc``, ``begin``, ``end`` of repeated strings among the pieces that share an anchor but differ."""
    differing = spans.where("differs").select("doc", "place", "key")
    hot = staged(differing.groupBy("key").count().where(F.col("count") > HOT_ANCHOR).select("key", F.lit(True).alias("hot")), "hot-anchors")
    of_hot = F.coalesce(F.col("hot"), F.lit(False))

    def pieces_of(some: DataFrame) -> DataFrame:
        wanted = some.groupBy("doc").agg(F.collect_list(F.struct("place", "key")).alias("pieces"))
        return texts.join(wanted, "doc").select("doc", "text", "pieces")

    out = "key long, doc long, first long, offset int, part binary"

    def cut(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in _slices(batches):
            rows: list[list] = [[], [], [], [], []]
            for doc, text, pieces in zip(*(c.to_pylist() for c in b.columns), strict=True):
                for p in pieces:
                    first, size, offset = p["place"] >> 16, p["place"] >> 8 & 255, p["place"] & 255
                    for column, v in zip(rows, (p["key"], doc, first, offset, text[first : first + size]), strict=True):
                        column.append(v)
            kinds = [pa.int64(), pa.int64(), pa.int64(), pa.int32(), pa.binary()]
            yield pa.RecordBatch.from_arrays([pa.array(c, k) for c, k in zip(rows, kinds, strict=True)], [c.split()[0] for c in out.split(", ")])

    def judged(held: list[tuple]) -> pa.RecordBatch:
        doc, first, offset, parts = (list(x) for x in zip(*held, strict=True))
        doc, first = np.array(doc, np.int64), np.array(first, np.int64)
        part, at = equal_strings(parts, np.array(offset, np.int64), doc, first, length)
        order = np.lexsort((at, part))
        part, at = part[order], at[order]
        new = np.r_[True, (part[1:] != part[:-1]) | (at[1:] != at[:-1] + 1)] if len(part) else np.empty(0, bool)
        last = np.r_[new[1:], True] if len(part) else new
        return pa.RecordBatch.from_arrays(
            [pa.array(doc[part[new]]), pa.array(first[part[new]] + at[new]), pa.array(first[part[last]] + at[last] + length)], ["doc", "begin", "end"]
        )

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held, size, key = [], 0, None
        for b in batches:
            for k, *row in zip(*(c.to_pylist() for c in b.columns), strict=True):
                if k != key and size >= COLLECTION:
                    yield judged(held)
                    held, size = [], 0
                key = k
                held.append(row)
                size += len(row[3])
        if held:
            yield judged(held)

    marked = differing.join(hot, "key", "left")
    parts = pieces_of(marked.where(~of_hot)).mapInArrow(cut, out)
    sorted_ = parts.repartition("key").sortWithinPartitions("key").mapInArrow(run, "doc long, begin long, end long")
    return sorted_ if hot.isEmpty() else sorted_.unionByName(compare_strings(pieces_of(marked.where(of_hot)), length))


def compare_strings(pieces: DataFrame, length: int) -> DataFrame:
    """``doc``, ``begin``, ``end`` of repeated strings among all strings of the ``pieces`` of ``doc`` and ``text``, however many share one.

    A row per string carries its hash. Where a hash first occurs is found by an aggregation, which combines before
    it shuffles, and put back on the rows by a join that can be split.
    """

    def hashed(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in _slices(batches):
            for doc, text, places in zip(*(c.to_pylist() for c in b.columns), strict=True):
                for k in range(0, len(places), _ROWS):
                    at = [
                        i
                        for p in places[k : k + _ROWS]
                        for i in range(p["place"] >> 16, (p["place"] >> 16) + (p["place"] >> 8 & 255) - length + 1)
                    ]
                    strings = [xxhash.xxh3_128_digest(text[i : i + length]) for i in at]
                    yield pa.RecordBatch.from_arrays([pa.array(strings, pa.binary()), pa.array([doc] * len(at), pa.int64()), pa.array(at, pa.int64())], ["string", "doc", "at"])

    strings = staged(pieces.mapInArrow(hashed, "string binary, doc long, at long"), "repeat-hot-strings")
    lows = strings.groupBy("string").agg(F.min("doc").alias("low_doc"), F.count(F.lit(1)).alias("n")).where("n > 1").select("string", "low_doc")
    shared = staged(join_per_key(strings, staged(lows, "repeat-hot-docs"), "string"), "repeat-hot-shared")
    inside = shared.where("doc = low_doc")  # of one document the earliest place counts
    places = inside.groupBy("string").agg(F.min("at").alias("low_at"))
    again = join_per_key(inside, places, "string").where("at > low_at")
    later = shared.where("doc > low_doc").select("doc", "at").unionByName(again.select("doc", "at"))

    def runs(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            doc, at = (c.to_numpy(zero_copy_only=False) for c in b.columns)
            new = np.r_[True, (doc[1:] != doc[:-1]) | (at[1:] != at[:-1] + 1)] if len(doc) else np.empty(0, bool)
            last = np.r_[new[1:], True] if len(doc) else new
            yield pa.RecordBatch.from_arrays([pa.array(doc[new]), pa.array(at[new]), pa.array(at[last] + length)], ["doc", "begin", "end"])

    return later.repartition("doc").sortWithinPartitions("doc", "at").mapInArrow(runs, "doc long, begin long, end long")


def remove_repeats(docs: DataFrame, id_column: str = "doc_id", length: int = LENGTH, gram: int = GRAM) -> DataFrame:
    """Cut every byte out of the documents that is covered by a string of ``length`` bytes which also begins earlier.

    Rows: the id, ``n_bytes``, ``spans`` (removed runs, as structs of ``begin`` and ``end``) and ``kept`` (the remaining
    bytes). Earlier means a smaller id, or an earlier place in the same document. All strings
    are judged on the input; matches do not cross documents.

    Defined cases: null text is empty; texts shorter than ``length`` bytes lose nothing; documents with one id are ordered
    by their text, null ids come last; very long texts are read whole, in overlapping stretches; an empty
    table gives no rows; other columns are not looked at. Ids are whole numbers. Pieces are told apart by two 64-bit hashes,
    strings within pieces by their bytes, or, where over HOT_ANCHOR pieces share an anchor, by a 128-bit hash.
    """
    rows = docs.select(F.col(id_column).cast("long").alias("id"), text_of().cast("binary").alias("text"))
    clash = rows.groupBy("id").count().where("count > 1 OR id IS NULL").limit(1).count()
    if clash:
        texts = staged(numbered(rows, [F.col("id").isNull(), F.col("id"), F.col("text")], "doc"), "repeat-docs")
    else:
        texts = rows.withColumn("doc", F.col("id"))
    spans = staged(compare_hashes(anchored(texts, length, gram)), "repeat-pieces")
    within = staged(compare_texts(texts, spans, length), "repeat-strings")
    known = spans.where("NOT differs").select(
        "doc", F.shiftright("place", 16).alias("begin"), (F.shiftright("place", 16) + F.shiftright("place", 8).bitwiseAND(255)).alias("end")
    )
    removed = known.unionByName(within).groupBy("doc").agg(F.collect_list(F.struct("begin", "end")).alias("spans"))
    out = "id long, n_bytes long, spans array<struct<begin:long,end:long>>, kept binary"

    def cut(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in _slices(batches):
            columns: list[list] = [[], [], [], []]
            for id_, text, spans_ in zip(*(c.to_pylist() for c in b.columns), strict=True):
                merged: list[list[int]] = []
                for s in sorted((s["begin"], s["end"]) for s in spans_ or ()):
                    if merged and s[0] <= merged[-1][1]:
                        merged[-1][1] = max(merged[-1][1], s[1])
                    else:
                        merged.append(list(s))
                edges = [0, *(e for s in merged for e in s), len(text)]
                kept = b"".join(text[a:z] for a, z in zip(edges[::2], edges[1::2], strict=True))
                for column, v in zip(columns, (id_, len(text), [{"begin": a, "end": z} for a, z in merged], kept), strict=True):
                    column.append(v)
            span = pa.list_(pa.struct([("begin", pa.int64()), ("end", pa.int64())]))
            kinds = [pa.int64(), pa.int64(), span, pa.binary()]
            yield pa.RecordBatch.from_arrays([pa.array(c, k) for c, k in zip(columns, kinds, strict=True)], ["id", "n_bytes", "spans", "kept"])

    found = texts.join(removed, "doc", "left").select("id", "text", "spans").mapInArrow(cut, out)
    return found.withColumnRenamed("id", id_column)
