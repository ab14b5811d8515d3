"""Mixing sources to target weights by capped water-filling."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from .common import SPACES, n_words_of, numbered, staged, text_of

WEIGHTS = (3, 1, 2)
BUDGET = 1.5
MAX_EPOCHS = 2.0
SEED = 42

#: Documents of a source fall into so many buckets of their seeded order.
BUCKETS = 1 << 16
COARSE = 1 << 8  # buckets summed together first, so that a source's sums are few rows
SLICE = 48  # bits of a text's hash, of 64, that texts of one id in a slice need not share


def ranked_sources(sizes: DataFrame) -> DataFrame:
    """Number the sources by code point, null last, from 0; one row per source."""
    return numbered(sizes, [F.col("source").isNull(), F.col("source")], "rank")


def water_fill(sources: DataFrame, total: float, max_epochs: float) -> DataFrame:
    """Add ``target`` to sources with ``weight`` and ``source_size``.

    Every source gets its weight's share of ``total``; those above
    ``max_epochs`` times their size stop there, and what they leave is shared out by
    weight among the rest, until none is above. Each round moves two sums to the driver.
    """
    cap = F.col("source_size") * F.lit(float(max_epochs))
    level, clamped = 0.0, -1
    while True:
        stopped = (cap < F.col("weight") * F.lit(level)) if clamped >= 0 else F.lit(False)
        full, open_weight, n = sources.agg(
            F.sum(F.when(stopped, cap).otherwise(0.0)),
            F.sum(F.when(stopped, 0.0).otherwise(F.col("weight").cast("double"))),
            F.count(F.when(stopped, 1)),
        ).first()
        if n == clamped or not open_weight:
            break
        clamped, level = n, (total - full) / open_weight
    target = F.least(cap, F.col("weight") * F.lit(float(level))) if open_weight else cap
    return sources.select("*", target.cast("double").alias("target"))


def _order_of(id_column: str, seed: int) -> Column:
    digest = F.md5(F.concat(F.lit(f"{seed}:"), F.coalesce(F.col(id_column).cast("string"), F.lit(""))))
    return F.conv(F.substring(digest, 1, 15), 16, 10).cast("long")


def _crossing(sums: DataFrame, wanted: DataFrame) -> DataFrame:
    """The step of each source at which its ``words``, summed in the order of ``step``, pass ``rest``, and what is ``left`` for that step."""
    along = Window.partitionBy("source").orderBy("step").rowsBetween(Window.unboundedPreceding, 0)
    summed = sums.select("source", "step", "words", F.sum("words").over(along).alias("until")).alias("c")
    return (
        summed.join(wanted.alias("p"), F.col("c.source").eqNullSafe(F.col("p.source")))
        .where("c.until > p.rest and c.until - c.words <= p.rest")
        .select("c.source", "c.step", (F.col("p.rest") - F.col("c.until") + F.col("c.words")).alias("left"))
    )


def plan_mix(
    docs: DataFrame,
    weights: tuple[float, ...] = WEIGHTS,
    budget: float = BUDGET,
    max_epochs: float = MAX_EPOCHS,
    seed: int = SEED,
    id_column: str = "doc_id",
) -> DataFrame:
    """How often the mix takes each document.

    Rows: ``row`` (the document, all its columns), ``size`` (words), ``source_size``, ``target``
    (words the mix takes of its source), ``epochs`` (whole repetitions), ``extra``
    (words of one more, partial repetition).

    The sources by code point, null last, weigh ``weights`` in turn and share ``budget`` times
    all words. A source is repeated whole as often as its target allows; the
    rest comes from its documents in a seeded order, whole until the rest is used up; the last of
    them gives its first words only. So a source's words meet its target up to rounding, and no document
    is taken more than ``max_epochs`` times, rounded up.

    The cut in the seeded order is found from word counts per bucket of the order, summed
    before they are shuffled, then from those per id and text in the bucket with the cut; only rows with the id
    and text at the cut are put in one task, so no source, however large, and no id, however hot, is gathered.

    Defined cases: null text has no words and takes none; a null source is a source; repeated rows
    and ids are taken each on its own; an empty table gives no rows. Extra columns stay in ``row``,
    whatever their names.
    """
    order = _order_of(id_column, seed)
    rows = docs.select(
        F.struct("*").alias("row"),
        F.col(id_column).cast("string").alias("id"),
        F.col("source").cast("string").alias("source"),
        order.alias("place"),
        F.pmod(order, F.lit(BUCKETS)).alias("bucket"),
        text_of().alias("text"),
    )
    counted = staged(
        rows.select("source", "bucket", n_words_of(F.col("text")).alias("size"))
        .groupBy("source", "bucket")
        .agg(F.sum("size").alias("words")),
        "mix-buckets",
    )
    sizes = counted.groupBy("source").agg(F.sum("words").alias("source_size"))
    weight = F.element_at(F.array(*[F.lit(float(w)) for w in weights]), (F.pmod("rank", F.lit(len(weights))) + 1).cast("int"))
    sources = staged(ranked_sources(sizes).select("source", "source_size", weight.alias("weight")), "mix-weights")
    total = budget * (sources.agg(F.sum("source_size")).first()[0] or 0)
    filled = staged(water_fill(sources, total, max_epochs), "mix-targets").select("source", "source_size", "target")
    ratio = F.col("target") / F.col("source_size")
    planned = filled.select(
        "*",
        F.when(F.col("source_size") > 0, F.floor(ratio)).otherwise(0).cast("long").alias("epochs"),
    ).select("*", F.round(F.col("target") - F.col("epochs") * F.col("source_size")).cast("long").alias("rest"))
    same = F.col("c.source").eqNullSafe(F.col("p.source"))
    coarse = F.floor(F.col("bucket") / COARSE).cast("long")
    outer = _crossing(counted.groupBy("source", coarse.alias("step")).agg(F.sum("words").alias("words")), planned)
    inside = counted.alias("c").join(outer.alias("p"), same & (F.floor(F.col("c.bucket") / COARSE) == F.col("p.step")))
    crossing = _crossing(
        inside.select("c.source", F.col("c.bucket").alias("step"), "c.words"), outer.select("source", F.col("left").alias("rest"))
    ).select("source", F.col("step").alias("cut"), "left")
    bucket = staged(crossing, "mix-cuts")
    at_cut = rows.alias("c").join(bucket.alias("p"), same & (F.col("c.bucket") == F.col("p.cut")))
    keyed = staged(
        at_cut.select("c.source", "c.place", "c.id", F.xxhash64("c.text").alias("text_hash"), n_words_of(F.col("c.text")).alias("size"))
        .groupBy("source", "place", "id", "text_hash")
        .agg(F.sum("size").alias("words")),
        "mix-keys",
    )
    # an id's texts are many if the id is hot: first the sums of slices of their hashes, then those of the slice with the cut
    part = F.struct("place", "id", F.shiftright("text_hash", SLICE).alias("slice"))
    sliced = keyed.groupBy("source", part.alias("step")).agg(F.sum("words").alias("words"))
    outer = _crossing(sliced, bucket.select("source", F.col("left").alias("rest")))
    in_slice = keyed.select("*", part.alias("part")).alias("c").join(outer.alias("p"), same & (F.col("c.part") == F.col("p.step")))
    exact = _crossing(
        in_slice.select("c.source", F.struct("c.place", "c.id", "c.text_hash").alias("step"), "c.words"),
        outer.select("source", F.col("left").alias("rest")),
    )
    plan = staged(
        planned.alias("c")
        .join(bucket.alias("p"), same, "left")
        .select("c.source", "c.source_size", "c.target", "c.epochs", F.coalesce("p.cut", F.lit(BUCKETS)).alias("cut"))
        .alias("c")
        .join(exact.alias("p"), same, "left")
        .select("c.*", F.col("p.step").alias("cut_key"), F.coalesce("p.left", F.lit(0)).alias("left")),
        "mix-plan",
    )
    key = F.struct("c.place", "c.id", F.xxhash64("c.text").alias("text_hash"))
    met = rows.alias("c").join(plan.alias("p"), same).select(
        "c.row", "p.source", n_words_of(F.col("c.text")).alias("size"), "p.source_size", "p.target", "p.epochs", "p.left", key.alias("key"),
        ((F.col("c.bucket") == F.col("p.cut")) & (key == F.col("p.cut_key"))).alias("at_cut"),
        ((F.col("c.bucket") < F.col("p.cut")) | ((F.col("c.bucket") == F.col("p.cut")) & (key < F.col("p.cut_key")))).alias("before"),
    )
    out = ["row", "size", "source_size", "target", "epochs"]
    plain = met.where(~F.coalesce("at_cut", F.lit(False))).select(*out, F.when(F.col("before"), F.col("size")).otherwise(0).cast("long").alias("extra"))
    # rows with the cut's id and text, of one size: those in front are taken whole, the next in part
    ordered = Window.partitionBy("source", "key").orderBy(F.xxhash64(F.to_json("row")))
    repeats = met.where("at_cut").select("*", ((F.row_number().over(ordered) - 1) * F.col("size")).alias("used"))
    partial = repeats.select(*out, F.greatest(F.lit(0), F.least("size", F.col("left") - F.col("used"))).cast("long").alias("extra"))
    return plain.unionByName(partial)


def first_words(text: Column, n: Column) -> Column:
    """The text up to the end of its ``n``-th word."""
    gaps = F.regexp_extract_all(text, F.lit(f"[{SPACES}]*[^{SPACES}]+"), F.lit(0))
    return F.array_join(F.slice(gaps, F.lit(1), n.cast("int")), "")


def mix(docs: DataFrame, **options) -> DataFrame:
    """The mixed corpus: each document as often as ``plan_mix`` says, partial repetitions cut after their last word.

    The columns are those of ``docs``; ``n_chars``, where there is one, follows the cut text.
    """
    planned = plan_mix(docs, **options)
    cut = (F.col("extra") > 0) & (F.col("extra") < F.col("size"))
    times = F.col("epochs") + F.when((F.col("extra") > 0) & ~cut, 1).otherwise(0)
    whole = planned.select("row", F.explode(F.array_repeat(F.lit(False), times.cast("int"))).alias("cut")).select("row.*")
    parts = planned.where(cut).select("row", first_words(F.col("row.text").cast("string"), F.col("extra")).alias("__first_words"))
    kept = []
    for field in docs.schema:
        at = F.col("row").getField(field.name)
        if field.name == "text":
            at = F.col("__first_words")
        elif field.name == "n_chars":
            at = F.length("__first_words")
        kept.append(at.cast(field.dataType).alias(field.name))
    return whole.unionByName(parts.select(*kept))
