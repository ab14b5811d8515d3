"""Secret scans: candidate strings by pattern, false positives removed by a random forest.

Everything runs as DataFrame functions and Spark's own forest, without Python on the executors.
"""

from __future__ import annotations

from pyspark.ml.classification import RandomForestClassificationModel, RandomForestClassifier
from pyspark.ml.feature import VectorAssembler
from pyspark.ml.functions import vector_to_array
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from .common import let, staged, text_of

NEIGHBOURHOOD = 40  # characters looked at on either side

#: Words that name a secret or something harmless, folders of made-up data, formats of known issuers.
_NAMES = "token secret password passwd pwd api apikey key auth credential credentials private bearer access".split()
NAMES = "|".join(_NAMES)
HARMLESS = "phone|tel|isbn|order|invoice|card|sha\\d*|md5|commit|checksum|digest|hash|uuid|guid|version|serial|date|id"
MADE_UP = "(?i)(^|[/_.-])(tests?|examples?|samples?|mocks?|fixtures?|docs?)([/_.-]|$)"
ISSUED = (
    "(?<![A-Za-z0-9])(?:AKIA[0-9A-Z]{16}|gh[pousr]_[A-Za-z0-9]{36,}|sk_live_[A-Za-z0-9]{20,}|xox[abprs]-[A-Za-z0-9-]{20,}"
    "|AIza[A-Za-z0-9_-]{35})(?![A-Za-z0-9])"
)

#: Runs of key characters and the '=' that end them: of 16 and more with a digit or an issued format in them, or of
#: NAMED_CHARS and more that are assigned to a name. What stands before '=' or ':' is no part of them.
NAMED_CHARS = 8
_KEY = "A-Za-z0-9+/_-"
_WORD_START = "(?:(?<![A-Za-z])|(?<=[a-z])(?=[A-Z]))"
_BETWEEN = 6  # characters, no letters, between a name and its value
_ASSIGNED = "(?:(?<=[=:])|(?<=[=:][ \\t\"'])|(?<=[=:][ \\t>][ \\t\"'])|(?<=[=:][ \\t>][ \\t][ \\t\"']))"
_NAMED = "(?:" + "|".join(  # looking back takes a fixed width
    f"(?<={_WORD_START}(?i:{'|'.join(n for n in _NAMES if len(n) == size)})[\\x00-@\\[-`{{-\\x7f]{{{gap}}})"
    for size in sorted({len(n) for n in _NAMES}) for gap in range(1, _BETWEEN + 1)
) + ")"
CANDIDATE = (
    f"(?<![{_KEY}])(?:(?=[A-Za-z+/_-]*+[0-9]|[{_KEY}]*?{ISSUED})[{_KEY}]{{16,}}+|{_ASSIGNED}{_NAMED}[{_KEY}]{{{NAMED_CHARS},}}+)"
    f"(?:=++(?![{_KEY}]))?"
)

DICTIONARY_WORDS = 500
WORD = r"(?<![\p{L}\p{N}_])[a-z]{3,}+(?![\p{L}\p{N}_])"
TRAINING_ROWS = 20_000  # at most so many labelled findings train the forest
TREES, DEPTH, SEED = 20, 6, 42
MIN_SCORE = 0.5
MASK = "[SECRET]"

FEATURES = [
    "n_chars", "digit_share", "upper_share", "transitions", "distinct_share", "hex", "coverage",
    "named", "assigned", "quoted", "harmless", "made_up",
]


def _row_key(id_column: str) -> Column:
    """Id and text, a null id or text being none that can be written; only different texts of one id and length can meet by hash."""
    name, text = F.col(id_column).cast("string"), F.col("text").cast("string")
    return F.struct(F.coalesce(name, F.lit("")), name.isNull(), F.xxhash64(text), F.coalesce(F.octet_length(text), F.lit(-1)))


def _parts(text: Column) -> tuple[Column, Column]:
    """Candidates of a text, and what stands before, between and after them."""
    return F.regexp_extract_all(text, F.lit(CANDIDATE), F.lit(0)), F.split(text, CANDIDATE, -1)


def dictionary(docs: DataFrame) -> list[str]:
    """The most frequent whole words of three letters a-z and more, counted over all documents; words seen once do not count."""
    words = docs.select(F.explode(F.regexp_extract_all(F.lower(text_of()), F.lit(WORD), F.lit(0))).alias("word"))
    top = words.groupBy("word").count().where("count > 1").orderBy(F.col("count").desc(), "word").limit(DICTIONARY_WORDS)
    return sorted(r["word"] for r in top.collect())


def candidates(docs: DataFrame, id_column: str = "doc_id", path_column: str | None = None) -> DataFrame:
    """One row per candidate: ``row_key``, the id, ``nth`` in its text, ``start`` (code points), ``candidate``, ``before``, ``after``, ``path``."""
    path = F.col(path_column).cast("string") if path_column else F.lit(None).cast("string")
    rows = docs.select(_row_key(id_column).alias("row_key"), F.col(id_column).alias("id"), path.alias("path"), text_of().alias("text")).where(
        F.col("text").rlike(CANDIDATE)
    )
    found, gaps = _parts(F.col("text"))
    cut = rows.select("row_key", "id", "path", found.alias("found"), gaps.alias("gaps"))

    def starts(found: Column, gaps: Column) -> Column:
        begin = F.struct(F.lit(0).alias("end"), F.array().cast("array<int>").alias("starts"))
        sizes = F.zip_with(gaps, found, lambda g, c: F.struct(F.length(g).alias("gap"), F.coalesce(F.length(c), F.lit(0)).alias("own")))
        step = lambda acc, s: F.struct(
            (acc["end"] + s["gap"] + s["own"]).alias("end"), F.array_append(acc["starts"], acc["end"] + s["gap"]).alias("starts")
        )
        return F.aggregate(sizes, begin, step, lambda acc: acc["starts"])

    def before(gap: Column, k: Column) -> Column:  # a name can be a candidate itself
        earlier = [x for d in range(NEIGHBOURHOOD // NAMED_CHARS, 0, -1) for x in (F.get("gaps", k - d), F.get("found", k - d))]
        tails = [F.coalesce(F.right(x, F.lit(NEIGHBOURHOOD)), F.lit("")) for x in earlier]
        return F.right(F.concat(*tails, F.right(gap, F.lit(NEIGHBOURHOOD))), F.lit(NEIGHBOURHOOD))

    near = lambda side: F.transform(F.col("gaps"), side)
    zipped = F.arrays_zip(
        F.col("found").alias("candidate"),
        starts(F.col("found"), F.col("gaps")).alias("start"),
        near(before).alias("before"),
        F.slice(near(lambda g: F.left(g, F.lit(NEIGHBOURHOOD))), F.lit(2), F.size("found")).alias("after"),
    )
    return cut.select("row_key", "id", "path", F.posexplode(F.slice(zipped, F.lit(1), F.size("found"))).alias("nth", "c")).select(
        "row_key", "id", "path", "nth", "c.candidate", "c.start", "c.before", "c.after"
    )


def with_features(found: DataFrame, words: list[str]) -> DataFrame:
    """Add FEATURES: length, characters and their transitions, dictionary coverage, neighbouring words, path."""
    c, n = F.col("candidate"), F.length("candidate")
    share = lambda pattern: F.regexp_count(c, F.lit(pattern)) / n
    flag = lambda condition: F.coalesce(condition, F.lit(False)).cast("double")
    covered = n - F.length(F.regexp_replace(F.lower(c), "|".join(sorted(words, key=lambda w: (-len(w), w))), "")) if words else F.lit(0)
    last = f"[^A-Za-z]{{0,{_BETWEEN}}}$"
    return found.withColumns({
        "n_chars": n.cast("double"),
        "digit_share": share("[0-9]"),
        "upper_share": share("[A-Z]"),
        "transitions": share("(?<=[0-9])(?=[A-Za-z])|(?<=[A-Za-z])(?=[0-9])|(?<=[a-z])(?=[A-Z])|(?<=[A-Z])(?=[a-z])"),
        "distinct_share": F.size(F.array_distinct(F.split(c, ""))) / n,
        "hex": flag(c.rlike("^[0-9a-f]+$") & c.rlike("[a-f]")),
        "coverage": covered / n,
        "named": flag(F.col("before").rlike(f"{_WORD_START}(?i:{NAMES}){last}")),
        "assigned": flag(F.col("before").rlike(r"[=:]>?\s*[\"']?$")),
        "quoted": flag(F.col("before").rlike("[\"']$") & F.col("after").rlike("^[\"']")),
        "harmless": flag(F.col("before").rlike(f"(?i)(?:^|[^A-Za-z])(?:{HARMLESS}){last}")),
        "made_up": flag(F.col("path").rlike(MADE_UP)),
    })


def labelled(featured: DataFrame) -> DataFrame:
    """Findings that a rule can label: ``label`` 1 for issued formats and named, assigned keys, 0 for what cannot be a key."""
    long = F.col("n_chars") >= 16
    secret = F.col("candidate").rlike(ISSUED) | (
        (F.col("named") == 1) & (F.col("assigned") == 1) & (F.col("made_up") == 0) & (F.col("coverage") < 0.3)
        & (((F.col("transitions") >= 0.15) & ((F.col("digit_share") > 0) | long)) | ((F.col("quoted") == 1) & long))
    )
    harmless = (F.col("digit_share") == 1) | (F.col("coverage") > 0.5) | (F.col("distinct_share") < 0.15) | (F.col("harmless") == 1) | (
        (F.col("named") == 0) & (F.col("assigned") == 0)
    )
    return featured.withColumn("label", F.when(secret, 1.0).when(harmless, 0.0)).where("label IS NOT NULL")


def train(findings: DataFrame) -> RandomForestClassificationModel | None:
    """A forest fitted to labelled findings (FEATURES and ``label``), or None where one of the labels is missing.

    Findings that look alike are one training row. Of these at most TRAINING_ROWS per label are used, in the order of
    a seeded hash.
    """
    rows = findings.select(*FEATURES, F.col("label").cast("double").alias("label")).distinct()
    order = F.xxhash64(F.lit(SEED), *FEATURES)
    sample = None
    for label in (0.0, 1.0):
        part = rows.where(F.col("label") == label).orderBy(order, *FEATURES).limit(TRAINING_ROWS)
        sample = part if sample is None else sample.unionByName(part)
    sample = staged(sample.repartition(1).sortWithinPartitions(order, *FEATURES, "label"), "secret-training")
    if sample.select("label").distinct().count() < 2:
        return None
    forest = RandomForestClassifier(numTrees=TREES, maxDepth=DEPTH, seed=SEED, featuresCol="vector", labelCol="label")
    return forest.fit(_assembled(sample))


def _assembled(df: DataFrame) -> DataFrame:
    return VectorAssembler(inputCols=FEATURES, outputCol="vector", handleInvalid="keep").transform(df)


def scan(docs: DataFrame, findings: DataFrame | None = None, id_column: str = "doc_id", path_column: str | None = None) -> DataFrame:
    """One row per candidate in the whole texts: ``row_key``, the id, ``nth``, ``start``, ``length``, ``sha256``, ``score``, ``is_secret``.

    ``findings`` are labelled findings with FEATURES and ``label``; without them those findings train
    the forest that ``labelled`` can label in the documents themselves. Where a label is missing altogether the rule's labels stand.
    Issued formats are secrets whatever the forest says.

    Defined cases: null and empty texts have no candidates; very long texts are read whole, and very long candidates too;
    repeated rows are reported each; null paths and ids are as good as others; an empty table gives no rows;
    other columns are not looked at.
    """
    featured = staged(with_features(candidates(docs, id_column, path_column), dictionary(docs)), "secret-candidates")
    training = labelled(featured) if findings is None else findings
    model = train(training)
    if model is None:
        known = labelled(featured).select("row_key", "nth", "label").distinct()
        scored = featured.join(known, ["row_key", "nth"], "left").withColumn("score", F.coalesce("label", F.lit(0.0)))
    else:
        scored = model.transform(_assembled(featured)).withColumn("score", vector_to_array("probability")[1])
    scored = scored.withColumn("score", F.when(F.col("candidate").rlike(ISSUED), 1.0).otherwise(F.col("score")))
    return scored.select(
        "row_key", F.col("id").alias(id_column), "nth", "start", F.length("candidate").alias("length"),
        F.sha2(F.col("candidate").cast("binary"), 256).alias("sha256"), "score", (F.col("score") >= MIN_SCORE).alias("is_secret"),
    )


def redact(docs: DataFrame, findings: DataFrame | None = None, id_column: str = "doc_id", path_column: str | None = None) -> DataFrame:
    """The documents with each secret masked; ``n_chars``, where there is one, follows the text. All rows stay."""
    found = scan(docs, findings, id_column, path_column).where("is_secret")
    marked = staged(found.groupBy("row_key").agg(F.collect_set("nth").alias("nths")), "secret-places").alias("m")
    rows = docs.select(F.struct("*").alias("row"), _row_key(id_column).alias("row_key")).alias("d")
    joined = rows.join(marked, F.col("d.row_key") == F.col("m.row_key"), "left").select("d.row", "m.nths")

    def masked(text: Column) -> Column:
        found, gaps = _parts(text)

        def rebuilt(found: Column, gaps: Column) -> Column:
            piece = lambda c, k: F.concat(F.get(gaps, k), F.when(F.array_contains("nths", k), F.lit(MASK)).otherwise(c))
            return F.concat(F.array_join(F.transform(found, piece), ""), F.get(gaps, F.size(found)))

        return let(found, lambda f: let(gaps, lambda g: rebuilt(f, g)))

    new = joined.select("row", F.when(F.col("nths").isNotNull(), masked(F.col("row").getField("text"))).alias("new"))
    out = []
    for field in docs.schema:
        at = F.col("row").getField(field.name)
        if field.name == "text":
            at = F.coalesce("new", at)
        elif field.name == "n_chars":
            at = F.when(F.col("new").isNotNull(), F.length("new")).otherwise(at)
        out.append(at.cast(field.dataType).alias(field.name))
    return new.select(*out)
