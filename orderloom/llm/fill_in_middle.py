"""Fill-in-the-middle: texts cut at two line ranks and written prefix, suffix, middle or suffix, prefix, middle."""

from __future__ import annotations

import hashlib
from collections.abc import Iterator

import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from .common import text_of

PREFIX, SUFFIX, MIDDLE = "<P>", "<S>", "<M>"
SEED = 7
TRANSFORMED = 100  # of 100 documents
SUFFIX_FIRST = 50  # of 100 transformed documents
FANOUT = 16
_BATCH_BYTES = 8 << 20
OUT = "n long, form string, prefix_chars long, middle_chars long, output string"


class LineList:
    """An indexable skip list over the lines ``[^\\n]*\\n|[^\\n]+`` of a text.

    The lowest lane has a link for every line; each FANOUT-th node of a lane is also in the express lane above it. A link
    carries two widths, the lines and the code points it passes over. The texts do not change,
    so that the lanes are built in one go, from evenly spaced nodes instead of random heights.
    """

    def __init__(self, text: str):
        chars = [len(line) + 1 for line in text.split("\n")]
        chars[-1] -= 1  # no line end follows the last part
        if not chars[-1]:
            chars.pop()
        lines = [1] * len(chars)
        self.n = len(chars)
        self.lanes = [(lines, chars)]
        while len(chars) > FANOUT:
            starts = range(0, len(chars), FANOUT)
            lines, chars = ([sum(widths[k : k + FANOUT]) for k in starts] for widths in (lines, chars))
            self.lanes.append((lines, chars))

    def position(self, rank: int) -> int:
        """Code points in the first ``rank`` lines, by descending from the highest lane."""
        node = at = 0
        for lines, chars in reversed(self.lanes):
            node *= FANOUT
            while node < len(lines) and lines[node] <= rank:
                rank -= lines[node]
                at += chars[node]
                node += 1
        return at


def rearranged(text: str, key: str, seed: int = SEED, transformed: int = TRANSFORMED, suffix_first: int = SUFFIX_FIRST) -> tuple:
    """Number of lines, form, code points of prefix and middle (None if plain), and the output of one text."""
    lines = LineList(text)
    digest = hashlib.sha256(f"{seed}:{key}".encode()).hexdigest()
    h1, h2, h3, h4 = (int(digest[k : k + 8], 16) for k in range(0, 32, 8))
    if not text or h3 % 100 >= transformed or PREFIX in text or SUFFIX in text or MIDDLE in text:
        return lines.n, "plain", None, None, text
    first, second = sorted((h1 % (lines.n + 1), h2 % (lines.n + 1)))
    a, b = lines.position(first), lines.position(second)
    prefix, middle, suffix = text[:a], text[a:b], text[b:]
    if h4 % 100 < suffix_first:
        return lines.n, "spm", a, b - a, f"{SUFFIX}{suffix}{PREFIX}{prefix}{MIDDLE}{middle}"
    return lines.n, "psm", a, b - a, f"{PREFIX}{prefix}{SUFFIX}{suffix}{MIDDLE}{middle}"


def transform(
    docs: DataFrame, id_column: str = "doc_id", seed: int = SEED, transformed: int = TRANSFORMED, suffix_first: int = SUFFIX_FIRST
) -> DataFrame:
    """The id, ``n`` lines, ``form`` (plain, psm, spm), ``prefix_chars``, ``middle_chars`` and ``output`` of every document.

    Cuts and form depend on ``seed`` and id only, so reruns and lost tasks give the same rows. ``transformed`` of 100
    documents are rearranged, ``suffix_first`` of 100 of these with the suffix first.

    Defined cases: null and empty texts are plain, with 0 lines and an empty output; texts that contain one of the three marks
    stay plain; a null id counts as an empty one; repeated rows give equal rows; other columns, whatever
    their names, are passed over; an empty table gives no rows.
    """
    rows = docs.select(
        F.col(id_column).alias(id_column), F.coalesce(F.col(id_column).cast("string"), F.lit("")).alias("__key"), text_of().alias("__text")
    )
    schema = rows.select(id_column).schema
    for field in _fields():
        schema.add(field)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            ids, found, size, begin = b.column(0), [], 0, 0
            for k in range(b.num_rows):
                found.append(rearranged(b.column(2)[k].as_py(), b.column(1)[k].as_py(), seed, transformed, suffix_first))
                size += len(found[-1][4])
                if size >= _BATCH_BYTES or k == b.num_rows - 1:
                    yield _batch(id_column, ids.slice(begin, k + 1 - begin), found)
                    found, size, begin = [], 0, k + 1

    return rows.mapInArrow(run, schema)


def _fields():
    from pyspark.sql import types as T

    return T.StructType.fromDDL(OUT).fields


def _batch(id_column: str, ids: pa.Array, found: list[tuple]) -> pa.RecordBatch:
    n, form, prefix, middle, output = zip(*found, strict=True)
    columns = [pa.array(n, pa.int64()), pa.array(form), pa.array(prefix, pa.int64()), pa.array(middle, pa.int64()), pa.array(output, pa.string())]
    return pa.RecordBatch.from_arrays([ids, *columns], [id_column, "n", "form", "prefix_chars", "middle_chars", "output"])


def restored(output: Column, form: Column) -> Column:
    """The text that was transformed, from output and form alone: each mark occurs once in an output that is not plain."""
    parts = F.split(output, f"{PREFIX}|{SUFFIX}|{MIDDLE}", -1)
    first, second, middle = (F.get(parts, F.lit(k)) for k in (1, 2, 3))
    return F.when(form == "psm", F.concat(first, middle, second)).when(form == "spm", F.concat(second, middle, first)).otherwise(output)
