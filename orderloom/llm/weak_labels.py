"""A quality classifier from weak labels.

Overlapping heuristics vote on every document. Expectation-maximisation estimates from
the counts of vote patterns over all documents how far each heuristic can be trusted, and the resulting posteriors
of a sample of documents train a hashed linear scorer that judges all of them. Two axes are
modelled alike: quality, whose heuristics look at form, and toxicity, whose heuristics look for words that labelled
documents show to be toxic, each for other words.
"""

from __future__ import annotations

from collections.abc import Sequence
from dataclasses import dataclass

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from .common import staged, text_of
from .quality_rules import COMMON_WORDS
from .shingles import mix, word_hashes

NO, YES, ABSTAIN = 0, 1, 2
SAMPLED_DOCS = 3000  # the scorer is fitted on about so many documents' posteriors, at most twice as many,
SAMPLED_BYTES = 32 << 20  # of so many bytes together, and each of an eighth of that at most
SAMPLED_LABELS = 5000  # toxic words are learned from at most so many labelled documents
SEED = 42

FALSE_NO, TRUST = 0.002, 30.0
TOXIC_TRUST = 0.1  # the toxic heuristics look for one fault and so overlap: their agreement tells more than a prior

MIN_QUALITY, MAX_TOXICITY = 0.5, 0.5  # what is kept

BUCKETS = 1 << 17
STEPS = 12  # in which a share's square root counts
PREFIX = 6  # bytes of a word that are a feature of their own, for word families
MIN_TOXIC_DOCS = 3  # a toxic word or prefix occurs in so many toxic documents,
MIN_TOXIC_REACH = 0.02  # in so large a share of them,
MIN_TOXIC_SHARE = 0.8  # and so large a share of the labelled documents with it is toxic
RATE, PENALTY, ROUNDS = 0.2, 1e-3, 200
VOCABULARY = 1000  # words up to which different ones should come in proportion
_TEXTS = 1 << 21  # bytes measured at a time

_UPPER, _DIGIT = (np.isin(np.arange(256), list(s)) for s in (b"ABCDEFGHIJKLMNOPQRSTUVWXYZ", b"0123456789"))
_SIGNS = np.isin(np.arange(256), list(b"#*$%&|<>"))
_CALLS = np.isin(np.arange(256), list(b"!"))
_DROPPED = bytes(b for b in range(33, 127) if not chr(b).isalnum())
_SHAPES = bytes(ord("A") if _UPPER[b] else ord("0") if _DIGIT[b] else b if b < 127 and not chr(b).isalpha() else ord("a") for b in range(256))

STATS = ("listed", "upper", "signs", "calls", "again", "distinct", "digits")


@dataclass
class Measured:
    """Of some texts: words, their hashes by document, and shares by document (columns as in STATS)."""

    n_words: np.ndarray
    doc: np.ndarray  # of each distinct word of each document
    word: np.ndarray  # its hash, without case and punctuation
    word_prefix: np.ndarray  # that of its first bytes
    prefix_doc: np.ndarray
    prefix: np.ndarray  # hashes of distinct words' first bytes
    shape_doc: np.ndarray
    shape: np.ndarray  # hash of a word's shape
    shape_share: np.ndarray  # in the document
    stats: np.ndarray


def _plain(text: bytes) -> bytes:
    return text.lower().translate(None, _DROPPED)


def _listed() -> np.ndarray:
    words = sorted({w for ws in COMMON_WORDS.values() for w in ws})
    return np.sort(word_hashes([w.encode() for w in words])[0])


_LISTED = _listed()


def _distinct(doc: np.ndarray, value: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
    """Distinct (document, value) pairs, how often each occurs and one of its places."""
    order = np.lexsort((value, doc))
    doc, value = doc[order], value[order]
    new = np.flatnonzero(np.r_[True, (doc[1:] != doc[:-1]) | (value[1:] != value[:-1])]) if len(doc) else np.empty(0, int)
    return doc[new], value[new], np.diff(np.r_[new, len(doc)]), order[new]


def measure(texts: Sequence[bytes]) -> Measured:
    n = len(texts)
    plain = [_plain(t) for t in texts]
    words, counts = word_hashes(plain)
    doc = np.repeat(np.arange(n), counts)
    total = np.maximum(counts, 1)
    shares = {"listed": np.bincount(doc, np.isin(words, _LISTED), n) / total}
    same = np.r_[False, (words[1:] == words[:-1]) & (doc[1:] == doc[:-1])] if len(words) else np.empty(0, bool)
    shares["again"] = np.bincount(doc, same, n) / total
    prefixes = word_hashes(plain, PREFIX)[0]
    d, w, _, at = _distinct(doc, words)
    pd_, p, _, _ = _distinct(doc, prefixes)
    shares["distinct"] = np.bincount(d, minlength=n) / total

    shapes, shape_counts = word_hashes([_shape(t) for t in texts])
    full = np.maximum(shape_counts, 1)
    data = np.frombuffer(b"".join(texts), np.uint8)
    lengths = np.array([len(t) for t in texts], np.int64)
    of_byte = np.repeat(np.arange(n), lengths)
    for name, kind, per in (("upper", _UPPER, lengths), ("digits", _DIGIT, lengths), ("signs", _SIGNS, shape_counts), ("calls", _CALLS, shape_counts)):
        shares[name] = np.bincount(of_byte, kind[data], n) / np.maximum(per, 1)
    sd, s, times, _ = _distinct(np.repeat(np.arange(n), shape_counts), shapes)
    return Measured(shape_counts, d, w, prefixes[at], pd_, p, sd, s, times / full[sd], np.column_stack([shares[k] for k in STATS]))


def _shape(text: bytes) -> bytes:
    """Words as runs of character classes, each run once: ``Hello!!`` becomes ``Aa!``."""
    data = np.frombuffer(text.translate(_SHAPES), np.uint8)
    return data[np.r_[True, data[1:] != data[:-1]]].tobytes() if len(data) else b""


def quality_votes(m: Measured) -> np.ndarray:
    """Votes (columns: heuristics) of YES for good form, NO for bad, or ABSTAIN."""
    s = dict(zip(STATS, m.stats.T, strict=True))
    n = m.n_words

    def vote(no: np.ndarray, yes: np.ndarray) -> np.ndarray:
        return np.where(no, NO, np.where(yes, YES, ABSTAIN))

    enough = n >= 30
    return np.column_stack([
        vote((s["listed"] < 0.05) & enough, (s["listed"] > 0.15) & enough),
        vote(s["upper"] > 0.3, (s["upper"] < 0.1) & (n > 0)),
        vote(s["signs"] > 0.15, (s["signs"] < 0.05) & (n > 0)),
        vote(s["calls"] > 0.3, (s["calls"] < 0.1) & (n > 0)),
        vote(s["again"] > 0.2, (s["again"] < 0.1) & (n > 1)),
        # a text's vocabulary stops growing with its length: of long texts, a quarter of a thousand words is asked for
        vote((s["distinct"] * n < 0.25 * np.minimum(n, VOCABULARY)) & enough, (s["distinct"] > 0.55) & (n > 0)),
        vote(n < 1, n >= 60),
    ]).astype(np.int64)


def toxic_votes(m: Measured, lexicon: np.ndarray) -> np.ndarray:
    """Votes against documents with words from the sorted lexicon; YES is none.

    No word counts for two heuristics, so that they err apart: the listed words are dealt to two by a bit of their hash, and the
    third looks at words that are not listed but begin as toxic ones do.
    """
    n = len(m.n_words)
    listed, akin = np.isin(m.word, lexicon), np.isin(m.word_prefix, lexicon)
    first = (mix(m.word) >> np.uint64(63)).astype(bool)
    return np.column_stack([np.where(np.bincount(m.doc, e, n) > 0, NO, YES) for e in (listed & first, listed & ~first, akin & ~listed)]).astype(np.int64)


def pattern_of(votes: np.ndarray) -> np.ndarray:
    return votes @ 3 ** np.arange(votes.shape[1])


def votes_of(patterns: np.ndarray, heuristics: int) -> np.ndarray:
    return patterns[:, None] // 3 ** np.arange(heuristics) % 3


def fit_label_model(votes: np.ndarray, counts: np.ndarray, rounds: int = 100, trust: float = TRUST) -> tuple[float, np.ndarray]:
    """Share of YES, and chances [heuristic, truth] of a NO among the votes cast, by expectation-maximisation over vote patterns.

    Votes count as independent given the truth. Heuristics that look at different faults hardly ever reject the same
    documents, so agreement alone cannot tell a rare fault from a mistake: a prior, as heavy as ``trust`` times all
    documents, says that a heuristic rejects FALSE_NO of what it should not.
    """
    prior, chances = 0.9, np.tile([0.3, FALSE_NO], (votes.shape[1], 1))
    known = trust * counts.sum()
    for _ in range(rounds):
        good = posterior(votes, prior, chances)
        prior = ((counts * good).sum() + 1) / (counts.sum() + 2)
        for j in range(votes.shape[1]):
            no, cast = counts * (votes[:, j] == NO), counts * (votes[:, j] != ABSTAIN)
            chances[j, NO] = ((no * (1 - good)).sum() + 0.3) / ((cast * (1 - good)).sum() + 1)
            chances[j, YES] = ((no * good).sum() + known * FALSE_NO) / ((cast * good).sum() + known + 1e-9)
    return float(prior), chances


def posterior(votes: np.ndarray, prior: float, chances: np.ndarray) -> np.ndarray:
    """Chance of YES given the votes; abstentions say nothing."""
    odds = np.full(len(votes), np.log(prior / (1 - prior)))
    for j in range(votes.shape[1]):
        no, no_bad = np.clip(chances[j, [YES, NO]], 1e-6, 1 - 1e-6)
        odds += np.select([votes[:, j] == NO, votes[:, j] == YES], [np.log(no / no_bad), np.log((1 - no) / (1 - no_bad))], 0.0)
    return 1 / (1 + np.exp(-np.clip(odds, -30, 30)))


def hashed(m: Measured) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Features as (document, bucket, value): distinct words and prefixes, shares of word shapes, and steps of the shares in STATS."""
    bucket = lambda h, kind: ((h ^ np.uint64(0x9E37 * kind)) % np.uint64(BUCKETS)).astype(np.int64)
    steps = np.sqrt(m.stats)[:, :, None] * STEPS >= np.arange(1, STEPS + 1)  # how many are passed, so that neighbours share features
    doc, stat, step = np.nonzero(steps)
    passed = mix((stat * STEPS + step + 1).astype(np.uint64))
    return (
        np.concatenate([m.doc, m.prefix_doc, m.shape_doc, doc]),
        np.concatenate([bucket(m.word, 1), bucket(m.prefix, 4), bucket(m.shape, 2), bucket(passed, 3)]),
        np.concatenate([np.ones(len(m.doc)), np.ones(len(m.prefix)), m.shape_share, np.ones(len(doc))]),
    )


def train_scorer(
    doc: np.ndarray, bucket: np.ndarray, value: np.ndarray, target: np.ndarray, penalty: float = PENALTY, rounds: int = ROUNDS
) -> tuple[np.ndarray, float]:
    """Weights and offset of a logistic scorer fitted to soft targets, by proximal gradient steps, adapted to each feature.

    The penalty is on absolute weights, so that features that only tell single documents apart get none; both
    outcomes weigh alike.
    """
    n = len(target)
    share = min(max(target.mean(), 0.01), 0.99)
    balance = np.where(target > 0.5, 0.5 / share, 0.5 / (1 - share)) / n
    weights, squares, offset, offset_squares = np.zeros(BUCKETS), np.full(BUCKETS, 1e-10), 0.0, 1e-10
    for _ in range(rounds):
        e = (1 / (1 + np.exp(-np.clip(np.bincount(doc, weights[bucket] * value, n) + offset, -30, 30))) - target) * balance
        slope = np.bincount(bucket, e[doc] * value, BUCKETS)
        squares += slope**2
        offset_squares += e.sum() ** 2
        step = RATE / np.sqrt(squares)
        moved = weights - step * slope
        weights = np.sign(moved) * np.maximum(np.abs(moved) - step * penalty, 0)
        offset -= RATE * e.sum() / np.sqrt(offset_squares)
    return weights.astype(np.float32), float(offset)


@dataclass
class Classifier:
    """Weights and offsets of both axes; a document is kept if it is likely good and likely not toxic."""

    quality: tuple[np.ndarray, float]
    toxic: tuple[np.ndarray, float]

    def scores(self, texts: Sequence[bytes]) -> pd.DataFrame:
        found = []
        for part in _batches(texts):
            m = measure(part)
            doc, bucket, value = hashed(m)
            both = []
            for weights, offset in (self.quality, self.toxic):
                logit = np.bincount(doc, weights[bucket] * value, len(part)) + offset
                both.append(1 / (1 + np.exp(-np.clip(logit, -30, 30))))
            both[0][m.n_words == 0] = 0.0
            found.append(pd.DataFrame({"quality": both[0], "toxicity": both[1]}))
        return pd.concat(found, ignore_index=True) if found else pd.DataFrame({"quality": [], "toxicity": []}, dtype=float)

    def score(self, text: Column) -> Column:
        """A struct of ``quality`` and ``toxicity``, 0 to 1, for a text column."""
        scores = self.scores

        @F.pandas_udf("quality double, toxicity double")
        def run(texts: pd.Series) -> pd.DataFrame:
            return scores(texts.tolist())

        return run(text.cast("binary"))


def _batches(texts: Sequence[bytes]):
    part, size = [], 0
    for t in texts:
        part.append(t)
        size += len(t)
        if size > _TEXTS:
            yield part
            part, size = [], 0
    if part:
        yield part


def _sample(docs: DataFrame, id_column: str, most: int) -> list[bytes]:
    """Texts of about ``most`` documents by a hash of id and text, at most twice as many and SAMPLED_BYTES together."""
    share = most / max(docs.count(), 1)
    place = F.pmod(F.xxhash64(F.lit(SEED), F.col(id_column).cast("string"), F.col("text")), F.lit(1 << 30))
    text = text_of().cast("binary")
    fit = docs.where(F.octet_length(text) <= SAMPLED_BYTES // 8).select(place.alias("place"), text.alias("text"))
    fit = fit.where(F.col("place") < min(1.0, share) * (1 << 30))
    sizes = fit.select("place", F.octet_length("text").alias("n")).orderBy("place", "n").limit(2 * most).collect()
    ends = np.cumsum([r["n"] for r in sizes]) if sizes else np.zeros(0)
    within = int((ends <= SAMPLED_BYTES).sum())
    if not within:
        return []
    chosen = fit.where(F.col("place") <= sizes[within - 1]["place"]).orderBy("place").limit(within)
    return [bytes(r["text"]) for r in chosen.select("text").collect()]


def learn_toxic_words(docs: DataFrame, labels: DataFrame, id_column: str = "doc_id") -> np.ndarray:
    """Sorted hashes of words and prefixes that mark labelled documents as toxic, by the three limits above.

    At most SAMPLED_LABELS labelled rows are used, in the order of a seeded hash of their id.
    """
    labelled = labels.where(F.col("toxic").isNotNull() & F.col(id_column).isNotNull())
    chosen = labelled.orderBy(F.xxhash64(F.lit(SEED), F.col(id_column)), "toxic").limit(SAMPLED_LABELS)
    kind = labels.schema[id_column].dataType.simpleString()
    rows = [(i, int(bool(t))) for i, t in {r[id_column]: r["toxic"] for r in chosen.select(id_column, "toxic").collect()}.items()]
    table = docs.sparkSession.createDataFrame(rows, f"id {kind}, toxic int")  # at most SAMPLED_LABELS rows

    @F.pandas_udf("array<long>")
    def words(texts: pd.Series) -> pd.Series:
        plain = [[_plain(t)] for t in texts]
        return pd.Series([np.unique(np.concatenate([word_hashes(t)[0], word_hashes(t, PREFIX)[0]])).view(np.int64) for t in plain])

    here = docs.select(F.col(id_column).alias("id"), text_of().cast("binary").alias("text")).join(F.broadcast(table), "id")
    seen = here.select("toxic", words("text").alias("words")).withColumn("print", F.xxhash64("words"))
    seen = staged(seen.groupBy("print").agg(F.max("toxic").alias("toxic"), F.first("words").alias("words")), "toxic-words")  # copies show nothing new
    least = max(MIN_TOXIC_DOCS, MIN_TOXIC_REACH * (seen.agg(F.sum("toxic")).first()[0] or 0))
    marking = seen.select("toxic", F.explode("words").alias("word")).groupBy("word").agg(F.count(F.lit(1)).alias("n"), F.sum("toxic").alias("bad"))
    found = marking.where((F.col("bad") >= least) & (F.col("bad") >= MIN_TOXIC_SHARE * F.col("n"))).select("word").collect()
    return np.sort(np.array([r["word"] for r in found], np.int64).view(np.uint64))


def fit(docs: DataFrame, labels: DataFrame, id_column: str = "doc_id") -> Classifier:
    """Fit both label models on the vote patterns of all documents, and the scorers on a sample's posteriors."""
    lexicon = learn_toxic_words(docs, labels, id_column)
    n_quality, n_toxic = 7, 3  # heuristics

    @F.pandas_udf("quality long, toxic long")
    def patterns(texts: pd.Series) -> pd.DataFrame:
        found = [np.empty((0, 2), np.int64)]
        for part in _batches(texts.tolist()):
            m = measure(part)
            found.append(np.column_stack([pattern_of(quality_votes(m)), pattern_of(toxic_votes(m, lexicon))]))
        return pd.DataFrame(np.concatenate(found), columns=["quality", "toxic"])

    text = text_of().cast("binary")
    counted = docs.select(patterns(text).alias("p")).groupBy("p.quality", "p.toxic").count().toPandas()  # at most 3^10 rows
    models = []
    for axis, heuristics, trust in (("quality", n_quality, TRUST), ("toxic", n_toxic, TOXIC_TRUST)):
        by = counted.groupby(axis)["count"].sum()
        models.append(fit_label_model(votes_of(by.index.to_numpy(np.int64), heuristics), by.to_numpy(float), trust=trust))
    sample = _sample(docs.select(id_column, "text"), id_column, SAMPLED_DOCS) or [b""]
    parts, targets, base = [], [], 0
    for part in _batches(sample):
        m = measure(part)
        doc, bucket, value = hashed(m)
        parts.append(((doc + base).astype(np.int32), bucket.astype(np.int32), value.astype(np.float32)))
        targets.append([posterior(v, *model) for v, model in zip((quality_votes(m), toxic_votes(m, lexicon)), models, strict=True)])
        base += len(part)
    doc, bucket, value = (np.concatenate(x) for x in zip(*parts, strict=True))
    good, clean = (np.concatenate(x) for x in zip(*targets, strict=True))
    return Classifier(train_scorer(doc, bucket, value, good), train_scorer(doc, bucket, value, 1 - clean))


def judge(docs: DataFrame, classifier: Classifier, id_column: str = "doc_id") -> DataFrame:
    """Rows: the id, ``quality``, ``toxicity`` (0 to 1) and ``kept``, for every document.

    Defined cases: texts without words, null or empty, have quality 0 and are not kept; very long texts are measured
    whole; repeated rows are judged alike; without labels no word counts as toxic; an empty table gives no rows;
    other columns are not looked at.
    """
    scored = docs.select(F.col(id_column).alias(id_column), classifier.score(text_of()).alias("s"))
    return scored.select(id_column, "s.quality", "s.toxicity", ((F.col("s.quality") >= MIN_QUALITY) & (F.col("s.toxicity") < MAX_TOXICITY)).alias("kept"))


def keep(docs: DataFrame, classifier: Classifier) -> DataFrame:
    """The documents that ``judge`` keeps, with all their columns."""
    scored = docs.select(F.struct("*").alias("row"), classifier.score(text_of()).alias("s"))
    return scored.where((F.col("s.quality") >= MIN_QUALITY) & (F.col("s.toxicity") < MAX_TOXICITY)).select("row.*")
