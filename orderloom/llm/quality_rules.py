"""Quality rules: plain counts, and the divergence of a text's histograms from its language's."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from .common import SPACES, let, staged, text_of, words_of

#: Characters by class, as ranges; all others, mostly letters in lower case, make up one more class.
CLASSES = {
    "upper": "A-Z",
    "digit": "0-9",
    "space": SPACES,
    "stop": ".,;:'\"?()-",
    "symbol": "!#*$%&|<>@^~_=+/{}`",
}
SYMBOLS = "#*$%&|<>"

MIN_WORDS = 20  # texts with fewer fail the base rules
MAX_REPEATED = 30  # percent of words in repeated windows
WINDOW = 8

#: Frequent words of some languages. Other languages are compared by all of them.
COMMON_WORDS = {
    "de": "der die und in den von zu das mit sich des auf für ist im dem nicht ein eine als auch es an nach".split(),
    "en": "the of and to in a is that for it as was with be by on not are this or from at which have".split(),
    "es": "de la que el en y a los se del las un por con no una su para es al lo como más pero".split(),
    "fr": "de la le et les des en un du une que est pour qui dans par plus pas au sur ne se ce il".split(),
}
GUARD_CHARS = 200  # shorter texts are not compared by characters
GUARD_WORDS = 60  # nor by words
MAX_CLASS_DISTANCE = 0.29
MAX_WORD_DISTANCE = 0.3
ALL = "*"  # the reference of documents in other languages


def _count_of(text: Column, chars: str) -> Column:
    return F.regexp_count(text, F.lit(f"[{chars}]")).cast("long")


def _repeated_words(words: Column) -> Column:
    """Words inside windows of WINDOW words that occur twice or more in the list, the first occurrence included.

    A window's hash is made from the hashes of its halves, down to single words.
    """
    n = F.size(words)
    zero = F.lit(0).cast("long")

    def doubled(hashes: Column, width: int) -> Column:
        many = F.greatest(F.size(hashes) - width, F.lit(0))
        return F.zip_with(F.slice(hashes, F.lit(1), many), F.slice(hashes, F.lit(1 + width), many), lambda a, b: F.xxhash64(a, b))

    def covered(grams: Column) -> Column:
        def of_sorted(s: Column) -> Column:
            same = lambda x, k: F.get(s, k)["h"].eqNullSafe(x["h"])
            twice = F.filter(s, lambda x, k: same(x, k - 1) | same(x, k + 1))
            starts = F.sort_array(F.transform(twice, lambda x: x["i"]))
            begin = F.struct(F.lit(-WINDOW).alias("last"), F.lit(0).alias("n"))
            step = lambda acc, i: F.struct(
                i.alias("last"), (acc["n"] + F.least(F.lit(WINDOW), i - acc["last"])).alias("n")
            )
            return F.aggregate(starts, begin, step, lambda acc: acc["n"].cast("long"))

        index = F.sequence(F.lit(0), F.size(grams) - 1)
        pairs = F.zip_with(grams, index, lambda h, i: F.struct(h.alias("h"), i.alias("i")))
        return F.when(F.size(F.array_distinct(grams)) == F.size(grams), zero).otherwise(let(F.sort_array(pairs), of_sorted))

    pairs = let(F.transform(words, lambda w: F.xxhash64(w)), lambda h: doubled(h, 1))
    grams = let(let(pairs, lambda h: doubled(h, 2)), lambda h: doubled(h, 4))
    return F.when(n <= WINDOW, zero).otherwise(let(grams, covered))


def base_columns(text: Column, extra=None) -> Column:
    """A struct of the plain counts; ``extra(words)`` may add fields."""

    def of_words(words: Column) -> Column:
        lines = F.filter(F.split(text, "\n", -1), lambda x: x.rlike(f"[^{CLASSES['space']}]"))
        return F.struct(
            F.size(words).cast("long").alias("n_words"),
            (F.length(text) - _count_of(text, CLASSES["space"])).alias("word_chars"),
            _count_of(text, SYMBOLS).alias("n_symbols"),
            let(lines, lambda x: (F.size(x) - F.size(F.array_distinct(x))).cast("long")).alias("n_dup_lines"),
            _repeated_words(words).alias("n_repeat_words"),
            *(extra(words) if extra else []),
        )

    return let(words_of(text), of_words)


def class_counts(text: Column) -> Column:
    """Characters of each class, the remaining ones last."""
    known = F.array(*[_count_of(text, chars) for chars in CLASSES.values()])
    return let(known, lambda k: F.concat(k, F.array(F.length(text) - _sum(k))))


def listed_counts(words: Column, listed: list[str]) -> Column:
    """How often each listed word occurs, and how many words are not listed."""
    times = lambda found: F.array(*[F.size(found) - F.size(F.array_remove(found, w)) for w in listed], F.size(words) - F.size(found))
    return let(F.filter(words, lambda w: w.isin(listed)), times).cast("array<bigint>")


def _sum(counts: Column) -> Column:
    return F.aggregate(counts, F.lit(0).cast("long"), lambda x, y: x + y)


def _distance(counts: Column, reference: Column) -> Column:
    """Jensen-Shannon distance, 0 to 1, of two count arrays of one length."""
    sums = lambda a: F.aggregate(a, F.lit(0.0), lambda x, y: x + y)

    def of(p: Column, q: Column) -> Column:
        part = lambda x, m: F.when(x > 0, x * F.log2(x / m)).otherwise(F.lit(0.0))
        terms = F.zip_with(p, q, lambda x, y: (part(x, (x + y) / 2) + part(y, (x + y) / 2)) / 2)
        return F.sqrt(F.greatest(F.lit(0.0), sums(terms)))

    def shares(a: Column) -> Column:
        return let(sums(F.transform(a, lambda x: x.cast("double"))), lambda t: F.transform(a, lambda x: x / F.greatest(t, F.lit(1.0))))

    return let(shares(counts), lambda p: let(shares(reference), lambda q: of(p, q)))


def judge_quality(
    docs: DataFrame, common: dict[str, list[str]] = COMMON_WORDS, id_column: str = "doc_id", lang_column: str = "lang"
) -> DataFrame:
    """Base counts, divergences and a verdict for every document.

    Rows: the id, ``n_words``, ``word_chars``, ``n_symbols``, ``n_dup_lines``, ``n_repeat_words``, ``base_failed``,
    ``class_distance``, ``word_distance`` (null where the guard holds) and ``kept``.

    A text is dropped when it fails the base rules, or when the Jensen-Shannon distance between its histogram of
    character classes (or of its language's frequent words) and the same histogram over
    all documents of the language is above the limit. Texts below GUARD_CHARS characters or GUARD_WORDS words are
    too short for the respective histogram and are not judged by it.

    Defined cases: null text counts as empty and fails the base rules; documents of null or
    unlisted languages share one reference; very long texts are counted whole; repeated rows are
    judged alike; an empty table gives no rows; other columns are not looked at. Windows of words
    are compared by their 64-bit hash within one text.
    """
    lang, own = F.col(lang_column).cast("string"), list(common)
    pooled = sorted({w for words in common.values() for w in words})
    ref = F.when(lang.isin(own), lang).otherwise(F.lit(ALL))
    rows = docs.select(F.col(id_column).alias("id"), ref.alias("ref"), text_of().alias("text"))

    def by_language(words: Column) -> list[Column]:
        counts = listed_counts(words, pooled)
        for name, listed in common.items():
            counts = F.when(F.col("ref") == name, listed_counts(words, listed)).otherwise(counts)
        return [counts.alias("words")]

    measured = staged(
        rows.select("id", "ref", base_columns(F.col("text"), by_language).alias("b"), class_counts(F.col("text")).alias("classes")),
        "quality-counts",
    ).select("id", "ref", "b.*", "classes")
    longest = max([len(pooled), *map(len, common.values())]) + 1
    total_of = lambda c, n: F.array(*[F.coalesce(F.sum(F.get(c, F.lit(k))), F.lit(0).cast("long")) for k in range(n)])
    references = staged(
        measured.groupBy("ref").agg(
            total_of("classes", len(CLASSES) + 1).alias("class_ref"), total_of("words", longest).alias("word_ref")
        ),
        "quality-references",
    )
    compared = measured.join(references, "ref").select(
        "*",
        F.when(_sum(F.col("classes")) >= GUARD_CHARS, _distance(F.col("classes"), F.col("class_ref"))).alias("class_distance"),
        F.when(
            F.col("n_words") >= GUARD_WORDS, _distance(F.col("words"), F.slice("word_ref", F.lit(1), F.size("words")))
        ).alias("word_distance"),
    )
    far = (F.col("class_distance") > MAX_CLASS_DISTANCE) | (F.col("word_distance") > MAX_WORD_DISTANCE)
    failed = (F.col("n_words") < MIN_WORDS) | (100 * F.col("n_repeat_words") > MAX_REPEATED * F.col("n_words"))
    return compared.select(
        F.col("id").alias(id_column), "n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words",
        failed.alias("base_failed"),
        F.round("class_distance", 6).alias("class_distance"), F.round("word_distance", 6).alias("word_distance"),
        (~failed & ~F.coalesce(far, F.lit(False))).alias("kept"),
    )
