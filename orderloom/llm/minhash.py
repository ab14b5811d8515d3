"""Document fingerprints by MinHash."""

from __future__ import annotations

import hashlib
from collections.abc import Callable, Iterator

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from orderloom.operators.joins import join_per_key

from .common import partitions_for, staged, text_of
from .components import components
from .shingles import shingle_hashes

SHINGLE = 5
PERMUTATIONS = 128
SEED = 42
BANDS = 32  # of PERMUTATIONS / BANDS values: texts of similarity 0.8 share one but for 5 in 10^8
THRESHOLD = 0.8
HOT_BAND = 100  # texts with one band from which they are compared with representatives first
ROUNDS = 8  # of representatives
HOT_BLOCK = 1000  # texts of a hot band that are paired in one group
_BLOCK = 1 << 15  # shingles permuted at a time, so that they stay in the processor's cache
_TEXTS = 1 << 19  # characters of texts fingerprinted at a time
_ROWS = 256  # rows turned into Python values at a time


def _permutations(n: int, seed: int) -> np.ndarray:
    """Factors and summands of universal hash functions modulo 2^64, whose upper bits are used."""
    pairs = np.random.default_rng(seed).integers(0, 1 << 63, (n, 2), np.uint64)
    return pairs << np.uint64(1) | np.uint64(1)


def signatures(texts: list[bytes], permutations: int = PERMUTATIONS, shingle: int = SHINGLE, seed: int = SEED) -> np.ndarray:
    """For each text and permutation the upper 16 bits of the least hash of its shingles; all set without words."""
    hashes, counts = shingle_hashes(texts, shingle)
    least = np.full((permutations, len(texts)), np.iinfo(np.uint64).max, np.uint64)
    ends = np.cumsum(counts)
    pairs = _permutations(permutations, seed)
    work = np.empty(_BLOCK, np.uint64)
    for at in range(0, len(hashes), _BLOCK):
        part = hashes[at : at + _BLOCK]
        begin, end = np.searchsorted(ends, [at, at + len(part) - 1], "right")
        docs = begin + np.flatnonzero(counts[begin : end + 1])
        starts = np.maximum(ends[docs] - counts[docs] - at, 0)
        out = work[: len(part)]
        for k, (a, b) in enumerate(pairs):
            np.multiply(part, a, out=out)
            np.add(out, b, out=out)
            least[k, docs] = np.minimum(least[k, docs], np.minimum.reduceat(out, starts))
    return (least >> np.uint64(48)).astype(np.uint16).T


def likeness(a: np.ndarray, b: np.ndarray) -> np.ndarray:
    """Share of equal values of signatures, an estimate of the texts' Jaccard similarity."""
    return (a == b).mean(axis=1)


def as_text(signature: np.ndarray) -> str:
    return signature.astype(">u2").tobytes().hex()


def edited(text: str, following: str) -> str:
    """The last half of the code points replaced by the first as many, or all, of the next document."""
    half = len(text) // 2
    return text[: len(text) - half] + following[:half]


def _places(lows: list[tuple]) -> Callable[[np.ndarray, np.ndarray, np.ndarray], np.ndarray]:
    """A function from null marks, ids and turned hashes to the last range, of those with these least (id, turned hash), that begins at or before them."""
    of_null = np.array([h for i, h in lows if i is None], np.int64)
    ids, hashes = (np.array([low[k] for low in lows if low[0] is not None], np.int64) for k in (0, 1))

    def run(null: np.ndarray, i: np.ndarray, h: np.ndarray) -> np.ndarray:
        found = np.searchsorted(ids, i, "left")
        ends = np.searchsorted(ids, i, "right")
        for one in np.unique(i[ends > found]):  # ids at which a range begins: few, or hot
            lo, hi = np.searchsorted(ids, one, "left"), np.searchsorted(ids, one, "right")
            found[i == one] = lo + np.searchsorted(hashes[lo:hi], h[i == one], "right")
        return np.where(null, np.searchsorted(of_null, h, "right"), len(of_null) + found) - 1

    return run


def with_followers(docs: DataFrame, id_column: str = "doc_id") -> DataFrame:
    """Rows ``id``, ``text``, ``at``, ``copy`` such that in a partition's order every document is followed by the next one.

    The order is by descending id, then by text's hash and text, null ids last; after the last document comes the first. Documents
    are dealt into ranges of id and hash, one shuffle, so that many rows of one id, or without id, are several ranges (repeats of one text
    with one id stay together), and each range ends with a copy of the first document of the next range. Their number follows the size of the input, their limits
    come from Spark's range partitioning of the keys alone; what is collected is two keys for each range.
    """
    spark = docs.sparkSession
    n = partitions_for(docs)
    keyed = docs.select(F.col(id_column).cast("long").alias("id"), text_of().alias("text"))
    turned = F.bitwise_not(F.xxhash64("text"))  # so that within an id, too, the last key of a range is its first document
    key = [F.col("id").asc_nulls_first(), F.col("turned")]
    ranged = staged(keyed.select("id", turned.alias("turned")).repartitionByRange(n, *key).select("id", "turned", F.spark_partition_id().alias("range")), "minhash-ranges")
    whole = F.struct(F.col("id").isNotNull().alias("has"), F.coalesce("id", F.lit(0)).alias("id"), "turned")
    ends = ranged.groupBy("range").agg(F.min(whole).alias("low"), F.max(whole).alias("high")).orderBy("range").collect()
    pair = lambda k: (k["id"] if k["has"] else None, k["turned"])
    place = _places([pair(r["low"]) for r in ends])

    @F.pandas_udf("int")
    def range_of(null: pd.Series, id_: pd.Series, turned: pd.Series) -> pd.Series:
        return pd.Series(place(null.to_numpy(bool), id_.to_numpy(np.int64), turned.to_numpy(np.int64)), dtype="int32")

    firsts = [(k, *pair(r["high"]), (k + 1) % len(ends)) for k, r in enumerate(ends)]  # a range's first document also ends the range before
    table = spark.createDataFrame(firsts, "range int, first long, first_turned long, before int")  # one row per range
    places = F.array(
        F.struct(F.col("range").alias("at"), F.lit(0).alias("copy")),
        F.when(F.col("id").eqNullSafe(F.col("first")) & (F.col("turned") == F.col("first_turned")), F.struct(F.col("before").alias("at"), F.lit(1).alias("copy"))),
    )
    rows = keyed.select("*", turned.alias("turned")).select("*", range_of(F.col("id").isNull(), F.coalesce("id", F.lit(0)), "turned").alias("range"))
    dealt = rows.join(F.broadcast(table), "range").select("id", "text", F.explode(F.filter(places, lambda p: p.isNotNull())).alias("p"))
    return (
        dealt.select("id", "text", "p.at", "p.copy")
        .repartitionById(n, "at")
        .sortWithinPartitions("at", "copy", F.col("id").desc_nulls_last(), F.xxhash64("text"), "text")
    )


def fingerprint_documents(docs: DataFrame, id_column: str = "doc_id", permutations: int = PERMUTATIONS, shingle: int = SHINGLE) -> DataFrame:
    """Fingerprints of every document and of an edited text of it.

    Rows: the id, ``n_chars``, ``edited_sha256``, ``fingerprint``, ``edited_fingerprint``, ``near_edited``, ``near_next``.

    Defined cases: null text is empty; an empty text's fingerprint has all bits set and equals only
    those of texts without words; texts of fewer than ``shingle`` words are one shingle; very long texts are hashed
    whole, piece by piece; rows with equal ids are ordered by their text's hash; null ids come last; a single document follows
    itself; an empty table gives no rows; other columns are not looked at. Ids are whole numbers.
    """
    out = f"{id_column} long, n_chars long, edited_sha256 string, fingerprint string, edited_fingerprint string, near_edited double, near_next double"

    def judged(held: list[tuple], final: tuple) -> pa.RecordBatch:
        """One row per held document; the last one is followed by ``final``."""
        texts = [t for _, t in held] + [final[1]]
        changed = [edited(t, f).encode() for t, f in zip(texts, texts[1:], strict=False)]
        all_ = signatures([t.encode() for t in texts] + changed, permutations, shingle)
        own, new = all_[: len(texts)], all_[len(texts) :]
        columns = [
            pa.array([i for i, _ in held], pa.int64()), pa.array([len(t) for t in texts[:-1]], pa.int64()),
            pa.array([hashlib.sha256(c).hexdigest() for c in changed]), pa.array([as_text(s) for s in own[:-1]]),
            pa.array([as_text(s) for s in new]), pa.array(likeness(own[:-1], new)), pa.array(likeness(own[:-1], own[1:])),
        ]
        return pa.RecordBatch.from_arrays(columns, [c.split()[0] for c in out.split(", ")])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held, chars, ended = [], 0, None
        for b in batches:
            for k in range(0, b.num_rows, _ROWS):
                for id_, text, at, copy in zip(*(c.to_pylist() for c in b.slice(k, _ROWS).columns), strict=True):
                    if copy:
                        if ended != at:
                            yield judged(held, (id_, text))
                            held, chars, ended = [], 0, at
                        continue
                    if chars > _TEXTS:
                        yield judged(held, (id_, text))
                        held, chars = [], 0
                    held.append((id_, text))
                    chars += len(text)

    return with_followers(docs, id_column).mapInArrow(run, out)


def _verified(pairs: DataFrame, classes: DataFrame, threshold: float) -> DataFrame:
    """Pairs ``a``, ``b`` of classes whose shingle sets have a Jaccard similarity of at least ``threshold``."""
    left, right = (classes.select(F.col("node").alias(c), F.col("shingles").alias(f"of_{c}")) for c in "ab")
    common = F.size(F.array_intersect("of_a", "of_b"))
    jaccard = common / F.greatest(F.size("of_a") + F.size("of_b") - common, F.lit(1))
    return pairs.join(left, "a").join(right, "b").where(jaccard >= threshold).select("a", "b")


def _union(parts: list[DataFrame]) -> DataFrame:
    whole = parts[0]
    for more in parts[1:]:
        whole = whole.unionByName(more)
    return whole


def _pairs_apart(hot: DataFrame, roots: DataFrame) -> DataFrame:
    """Pairs ``a``, ``b`` of classes that share a ``key`` of ``hot`` but no root; each two blocks of a key meet in a group of their own."""
    rooted = staged(hot.join(roots, "node", "left").select("key", "node", F.coalesce("root", "node").alias("root")), "minhash-rooted")
    sizes = rooted.groupBy("key").agg(F.min("root").alias("low"), F.max("root").alias("high"), F.count(F.lit(1)).alias("n")).where("low <> high")
    open_ = join_per_key(rooted, sizes.select("key", F.ceil(F.col("n") / HOT_BLOCK).cast("long").alias("blocks")), "key")
    placed = open_.withColumn("block", F.pmod(F.xxhash64("node"), F.col("blocks")))
    pair = lambda d: F.least(d, F.col("block")) * F.col("blocks") + F.greatest(d, F.col("block"))
    dealt = placed.select("*", F.explode(F.transform(F.sequence(F.lit(0).cast("long"), F.col("blocks") - 1), pair)).alias("pair"))
    side = lambda c: dealt.select("key", "pair", "blocks", *[F.col(n).alias(f"{n}_{c}") for n in ("node", "root", "block")])
    own = F.col("block_a") * (F.col("blocks") + 1) == F.col("pair")  # a block's pair with itself
    met = side("a").join(side("b").drop("blocks"), ["key", "pair"]).where((F.col("node_a") < F.col("node_b")) & (F.col("root_a") != F.col("root_b")))
    return met.where((F.col("block_a") != F.col("block_b")) | own).select(F.col("node_a").alias("a"), F.col("node_b").alias("b")).distinct()


def near_duplicates(docs: DataFrame, id_column: str = "doc_id", threshold: float = THRESHOLD) -> DataFrame:
    """One row per document: the id and ``component_id``, the smallest id it reaches over texts of at least ``threshold`` similarity.

    Texts with equal sets of five-word shingles are one class. Classes that share a band of their signatures are candidates and are
    verified by the Jaccard similarity of their sets. Bands with more than HOT_BAND classes are compared with a
    representative, the smallest, for ROUNDS rounds, in which classes that match one leave. Then all pairs of such a band
    that are not connected yet are compared, block by block.

    Defined cases: null and empty texts are one class; null ids never are a component's id unless all in it are; repeated rows stay; an
    empty table gives no rows; other columns are not looked at.
    """
    rows = docs.select(F.col(id_column).alias(id_column), text_of().cast("binary").alias("__text"))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            for k in range(0, b.num_rows, _ROWS):
                some = b.slice(k, _ROWS)
                texts = some.column(1).to_pylist()
                hashes, counts = shingle_hashes(texts, SHINGLE)
                sets = [np.unique(h).view(np.int64) for h in np.split(hashes, np.cumsum(counts)[:-1])]
                prints = [s.tobytes() for s in signatures(texts)]
                yield pa.RecordBatch.from_arrays(
                    [some.column(0), pa.array(prints, pa.binary()), pa.array(sets, pa.list_(pa.int64()))], [id_column, "print", "shingles"]
                )

    schema = rows.select(id_column, F.lit(b"").alias("print"), F.array().cast("array<bigint>").alias("shingles")).schema
    printed = staged(rows.mapInArrow(run, schema).withColumn("node", F.xxhash64("shingles")), "minhash-prints")
    classes = staged(printed.groupBy("node").agg(F.min(id_column).alias("low"), F.first("print").alias("print"), F.first("shingles").alias("shingles")), "minhash-classes")
    width = 2 * PERMUTATIONS // BANDS
    keys = F.array(*[F.xxhash64(F.lit(k), F.substring("print", k * width + 1, width)) for k in range(BANDS)])
    members = staged(classes.select("node", F.explode(keys).alias("key")), "minhash-bands")
    sized = members.groupBy("key").count().where("count > 1")
    few = join_per_key(members, sized.where(F.col("count") <= HOT_BAND).select("key"), "key")
    pairs = few.select("key", F.col("node").alias("a")).join(few.select("key", F.col("node").alias("b")), "key").where("a < b")
    links = [staged(_verified(pairs.select("a", "b").distinct(), classes, threshold), "minhash-links")]
    open_ = staged(join_per_key(members, sized.where(F.col("count") > HOT_BAND).select("key"), "key"), "minhash-hot")
    hot = open_
    for _ in range(ROUNDS):
        if open_.isEmpty():
            break
        led = staged(join_per_key(open_, open_.groupBy("key").agg(F.min("node").alias("b")), "key").withColumnRenamed("node", "a").where("a <> b"), "minhash-led")
        found = staged(_verified(led.select("a", "b").distinct(), classes, threshold), "minhash-links")
        links.append(found)
        open_ = staged(led.join(found, ["a", "b"], "left_anti").select(F.col("a").alias("node"), "key"), "minhash-hot")
    if len(links) > 1:
        apart = _pairs_apart(hot, staged(components(_union(links)), "minhash-roots"))
        links.append(staged(_verified(apart, classes, threshold), "minhash-links"))
    roots = components(_union(links))
    rooted = classes.select("node", "low").join(roots, "node", "left").select("node", "low", F.coalesce("root", "node").alias("root"))
    lowest = rooted.groupBy("root").agg(F.min("low").alias("component_id"))
    by_class = staged(join_per_key(rooted, lowest, "root").select("node", "component_id"), "minhash-components")
    return join_per_key(printed.select(id_column, "node"), by_class, "node").select(id_column, "component_id")
