"""SimHash near-duplicates by a generalised pigeonhole search over bit partitions."""

from __future__ import annotations

from collections.abc import Iterator
from itertools import accumulate, combinations, repeat

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from orderloom.operators.joins import join_per_key

from .common import numbered, staged, text_of
from .components import components

BITS = 64
SHINGLE = 3
MAX_DISTANCE = 3
SEED = 42
HOT_GROUP = 2048  # larger groups are compared block by block
KEY_COST = 40.0  # what a shuffled key costs, in compared pairs
_CHUNK = 1 << 16


def fingerprint(text: bytes, shingle: int = SHINGLE) -> int:
    """Bit k is set if it is set in over half of the shingles' XXH64 values; 0 without words."""
    words = text.lower().split()  # of bytes: A-Z only, and white space is space and \x09-\x0D
    if not words:
        return 0
    line = b" ".join(words)
    ends = [e - 1 for e in accumulate(len(w) + 1 for w in words)]
    starts = [0, *(e + 1 for e in ends[:-1])]
    spans = list(zip(starts, ends[shingle - 1 :], strict=False)) or [(0, len(line))]
    counts = np.zeros(BITS, np.int64)
    for k in range(0, len(spans), _CHUNK):
        part = spans[k : k + _CHUNK]
        hashes = np.fromiter(map(xxhash.xxh64_intdigest, [line[a:b] for a, b in part], repeat(SEED)), np.uint64, len(part))
        counts += np.unpackbits(hashes.view(np.uint8).reshape(-1, 8), axis=1, bitorder="little").sum(0, dtype=np.int64)
    return int.from_bytes(np.packbits(2 * counts > len(spans), bitorder="little").tobytes(), "little", signed=True)


def fingerprints(docs: DataFrame, id_column: str = "doc_id", shingle: int = SHINGLE) -> DataFrame:
    """The id and the fingerprint ``fp``, a long, of every document's whole text."""
    rows = docs.select(F.col(id_column).alias(id_column), text_of().cast("binary").alias("__text"))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            fps = pa.array([fingerprint(t, shingle) for t in b.column(1).to_pylist()], pa.int64())
            yield pa.RecordBatch.from_arrays([b.column(0), fps], [id_column, "fp"])

    return rows.mapInArrow(run, rows.select(id_column, F.lit(0).cast("long").alias("fp")).schema)


def bit_counts(codes: DataFrame) -> tuple[int, np.ndarray]:
    """How many codes there are, and in how many each pair of bits is set; over all rows."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        total, n = np.zeros((BITS, BITS), np.int64), 0
        for b in batches:
            bits = _bits(b.column(0).to_numpy(zero_copy_only=False)).astype(np.float32)
            total += (bits.T @ bits).astype(np.int64)
            n += len(bits)
        cells = np.append(total.ravel(), n)
        yield pa.RecordBatch.from_arrays([pa.array(np.arange(len(cells))), pa.array(cells)], ["cell", "n"])

    sums = codes.select("fp").mapInArrow(run, "cell long, n long").groupBy("cell").agg(F.sum("n").alias("n")).collect()
    cells = np.zeros(BITS * BITS + 1, np.int64)
    for r in sums:
        cells[r["cell"]] = r["n"]
    return int(cells[-1]), cells[:-1].reshape(BITS, BITS)


def _bits(fps: np.ndarray) -> np.ndarray:
    raw = np.ascontiguousarray(fps, np.int64).view(np.uint8).reshape(-1, 8)
    return np.unpackbits(raw, axis=1, bitorder="little")


def group_bits(n: int, both: np.ndarray, parts: int) -> list[list[int]]:
    """Partition the bits so that correlated bits fall together: what repeats in one part then leaves the others apart."""
    share = both / max(n, 1)
    p = np.diag(share)
    spread = np.sqrt(np.maximum(p * (1 - p), 1e-9))
    corr = np.abs((share - np.outer(p, p)) / np.outer(spread, spread))
    np.fill_diagonal(corr, 0)
    left, groups = set(range(BITS)), []
    for k in range(parts):
        size = len(left) // (parts - k)
        group = [max(sorted(left), key=lambda b: corr[b, sorted(left)].sum())]
        left.discard(group[0])
        while len(group) < size:
            best = max(sorted(left), key=lambda b: corr[b, group].sum())
            group.append(best)
            left.discard(best)
        groups.append(sorted(group))
    return groups


def allocate(n: int, both: np.ndarray, max_distance: int = MAX_DISTANCE) -> list[tuple[list[int], int]]:
    """Parts of the bits and the distance to probe in each, at the least estimated cost.

    By the generalised pigeonhole principle, codes at most ``max_distance`` apart are within t of each other in some part
    when the parts' t + 1 add up to ``max_distance`` + 1; a part with t + 1 = 0 is not probed. For each number of parts,
    dynamic programming shares those units out by the estimated number of candidate pairs, from all
    codes' bit counts, and of keys.
    """
    p = np.diag(both) / max(n, 1)
    differ = 2 * p * (1 - p)
    best, plan = np.inf, []
    for parts in range(1, max_distance + 2):
        groups = group_bits(n, both, parts)
        costs = []
        for group in groups:
            at = np.zeros(max_distance + 2)
            at[0] = 1.0  # chance of each distance within the part
            for b in group:
                at[1:] = at[1:] * (1 - differ[b]) + at[:-1] * differ[b]
                at[0] *= 1 - differ[b]
            keys = [len(list(combinations(group, t))) for t in range(max_distance + 1)]
            costs.append([0.0] + [n * n / 2 * at[: t + 1].sum() * 2 + n * KEY_COST * keys[t] for t in range(max_distance + 1)])
        table = {0: (0.0, [])}
        for cost in costs:
            step: dict[int, tuple[float, list[int]]] = {}
            for used, (spent, units) in table.items():
                for u in range(max_distance + 2 - used):
                    if spent + cost[u] < step.get(used + u, (np.inf, []))[0]:
                        step[used + u] = (spent + cost[u], [*units, u])
            table = step
        spent, units = table.get(max_distance + 1, (np.inf, []))
        if spent < best:
            best, plan = spent, [(g, u - 1) for g, u in zip(groups, units, strict=True) if u]
    return plan


def _mix(x: np.ndarray) -> np.ndarray:
    x = (x ^ (x >> np.uint64(30))) * np.uint64(0xBF58476D1CE4E5B9)
    x = (x ^ (x >> np.uint64(27))) * np.uint64(0x94D049BB133111EB)
    return x ^ (x >> np.uint64(31))


def probe_keys(codes: DataFrame, plan: list[tuple[list[int], int]]) -> DataFrame:
    """``key``, ``fp``: codes within t in a part share the key of the part with some t of its bits left out."""
    masks = []
    for group, t in plan:
        whole = sum(1 << b for b in group)
        masks += [whole & ~sum(1 << b for b in out) for out in combinations(group, t)]
    masks = np.array(masks, np.uint64)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            fps = b.column(0).to_numpy(zero_copy_only=False).astype(np.int64)
            keys = _mix((fps.view(np.uint64)[:, None] & masks) ^ _mix(masks + np.uint64(1)))
            yield pa.RecordBatch.from_arrays([pa.array(keys.view(np.int64).ravel()), pa.array(np.repeat(fps, len(masks)))], ["key", "fp"])

    return codes.select("fp").mapInArrow(run, "key long, fp long")


def links_within(group: np.ndarray, max_distance: int) -> tuple[np.ndarray, np.ndarray]:
    """Links that connect the codes of a group as all its pairs within the distance do: at most one per code."""
    n = len(group)
    root = np.full(n, -1)
    for start in range(n):
        if root[start] >= 0:
            continue
        root[start], front = start, np.array([start])
        while len(front):
            rest = np.flatnonzero(root < 0)
            hit = np.zeros(len(rest), bool)
            for f in np.array_split(front, max(1, len(front) * len(rest) // 4_000_000)):
                hit |= (np.bitwise_count(group[rest][None, :] ^ group[f][:, None]) <= max_distance).any(0)
            front = rest[hit]
            root[front] = start
    linked = root != np.arange(n)
    return group[linked], group[root[linked]]


def link_codes(codes: DataFrame, max_distance: int = MAX_DISTANCE) -> DataFrame:
    """Links ``a``, ``b`` that connect distinct codes ``fp`` as all pairs within the distance do.

    Codes with a key in common are sorted together and compared in their task; of a group only connecting links come out.
    A group above HOT_GROUP codes is dealt into blocks, and each two blocks meet in a task of their own.
    """
    n, both = bit_counts(codes)
    keys = probe_keys(codes, allocate(n, both, max_distance))
    hot = staged(
        keys.groupBy("key").count().where(F.col("count") > HOT_GROUP)
        .select("key", F.ceil(F.col("count") / HOT_GROUP).cast("int").alias("blocks")),
        "hot-keys",
    )
    block = F.pmod(F.xxhash64("fp"), F.col("blocks")).cast("int")
    others = F.transform(F.sequence(F.lit(0), F.col("blocks") - 1), lambda d: F.least(d, block) * F.col("blocks") + F.greatest(d, block))
    dealt = keys.join(hot, "key", "left").select("key", "fp", F.explode(F.when(F.col("blocks").isNull(), F.array(F.lit(0))).otherwise(others)).alias("pair"))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held = np.empty((0, 3), np.int64)
        for b in batches:
            rows = np.column_stack([c.to_numpy(zero_copy_only=False).astype(np.int64) for c in b.columns])
            rows = np.concatenate([held, rows])
            last = np.flatnonzero((rows[:, :2] != rows[-1, :2]).any(1))
            cut = last[-1] + 1 if len(last) else 0
            held = rows[cut:]
            if cut:
                yield from _linked(rows[:cut], max_distance)
        if len(held):
            yield from _linked(held, max_distance)

    return (
        dealt.select("key", F.col("pair").cast("long").alias("pair"), "fp")
        .repartition("key", "pair")
        .sortWithinPartitions("key", "pair", "fp")
        .mapInArrow(run, "a long, b long")
    )


def _linked(rows: np.ndarray, max_distance: int) -> Iterator[pa.RecordBatch]:
    """Links of whole groups; ``rows`` are key, pair, code, sorted."""
    new = np.r_[True, (rows[1:, :2] != rows[:-1, :2]).any(1)]
    starts = np.r_[np.flatnonzero(new), len(rows)]
    sizes = np.diff(starts)
    codes, group = rows[:, 2], np.cumsum(new) - 1
    small = sizes <= 8
    found = []
    for d in range(1, int(sizes[small].max(initial=1))):
        near = (group[:-d] == group[d:]) & small[group[:-d]]
        near &= np.bitwise_count(codes[:-d] ^ codes[d:]) <= max_distance
        found.append((codes[:-d][near], codes[d:][near]))
    for g in np.flatnonzero(~small):
        found.append(links_within(codes[starts[g] : starts[g + 1]], max_distance))
    a, b = (np.concatenate([f[k] for f in found]) if found else np.empty(0, np.int64) for k in (0, 1))
    if len(a):
        yield pa.RecordBatch.from_arrays([pa.array(a), pa.array(b)], ["a", "b"])


def near_duplicates(docs: DataFrame, id_column: str = "doc_id", shingle: int = SHINGLE, max_distance: int = MAX_DISTANCE) -> DataFrame:
    """One row per document: the id, ``fp``, and ``component_id``, the smallest id it reaches over links.

    Documents link when their fingerprints differ in at most ``max_distance`` bits. Equal
    fingerprints are one code; links and components are found between distinct codes.

    Defined cases: null and empty texts have fingerprint 0, linked like any other; texts of fewer than
    ``shingle`` words are one shingle; very long texts are read whole, in chunks; repeated rows stay, each with
    its component; a null id never is a component's id unless all ids in it are null;
    an empty table gives no rows; other columns are not looked at.
    """
    coded = staged(fingerprints(docs, id_column, shingle), "simhash-codes")
    codes = staged(coded.groupBy("fp").agg(F.min(id_column).alias("low")), "simhash-distinct")
    roots = components(link_codes(codes, max_distance))
    rooted = codes.join(roots, codes["fp"] == roots["node"], "left").select(
        "fp", "low", F.coalesce("root", "fp").alias("root")
    )
    lowest = rooted.groupBy("root").agg(F.min("low").alias("component_id"))
    by_code = staged(join_per_key(rooted, lowest, "root").select("fp", "component_id"), "simhash-components")
    return join_per_key(coded, by_code, "fp")


def keep_one(docs: DataFrame, id_column: str = "doc_id", shingle: int = SHINGLE, max_distance: int = MAX_DISTANCE) -> DataFrame:
    """One document of each group of near-duplicates, the one with the smallest id, with all its columns.

    Where ids repeat or are null, the rows in order of id and text, nulls last, are numbered, and the number serves as id.
    """
    clash = docs.groupBy(F.col(id_column).alias("i")).count().where("count > 1 OR i IS NULL").limit(1).count()
    rows = docs.select(F.struct("*").alias("row"), F.col(id_column).alias("id"), F.col("text").cast("string").alias("text"))
    if clash:
        order = [F.col("id").isNull(), F.col("id"), F.col("text").isNull(), F.col("text")]
        rows = staged(numbered(rows, order, "number").select("row", F.col("number").alias("id"), "text"), "simhash-rows")
    kept = near_duplicates(rows.select("id", "text"), "id", shingle, max_distance).where("id = component_id").select("id")
    return rows.join(staged(kept, "simhash-kept"), "id", "left_semi").select("row.*")
