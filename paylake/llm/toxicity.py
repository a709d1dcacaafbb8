"""Toxic passages by maximum-scoring segments.

Fit.  A bounded sample of labelled documents (``sample``) gives, for each word
and each class, the number of documents that hold it; equal texts count once.
Word counts over all documents shape the prior: a word's rate in a class is the
mean of a Dirichlet posterior whose prior mass ``prior`` is spread as the corpus
spreads words, times the rate of the word's stem (its longest known prefix of
``STEMS`` letters, whose prior is the next shorter one).  The log-odds are the
logarithm of the ratio of both rates, positive or negative; a word or stem that
fewer than two documents of the sample hold has the score of the stem above it.

Scan.  A word scores its log-odds where a text has it first (documents are what
is counted, so a repeat says nothing new: it keeps only a negative score), less
``drift``.  One linear pass finds all maximal-scoring segments (those that no
extension and no part of which scores better; of parts that score as much, the
shortest).

Calibration.  The best segment of n clean words follows an extreme-value law,
P(S < s) = exp(-K n exp(-lambda s)).  lambda solves E[exp(lambda score)] = 1 under
the clean word frequencies; K is its maximum-likelihood value on the sample's
clean documents.  A segment's evidence is lambda s - ln(K n), a text's evidence
is the sum of what its significant segments (evidence above 0) have, and a logistic
curve turns it into a probability.  K and the curve are fitted on evidence out of
fold: each document of the sample is scanned with a lexicon that was fitted
without its fold.
"""

from __future__ import annotations

import string
import zlib
from collections import Counter
from itertools import accumulate
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from . import common

#: Prefix lengths, without a gap, that are stems of longer words.
STEMS = (4, 5, 6, 7, 8)
FOLDS = 4
#: Words of which a worker remembers the score.
REMEMBERED = 300_000


def word_of(raw: str) -> str:
    """Lower case, without what is no letter or digit at both ends."""
    w = raw.strip(string.punctuation)
    while w and not w[0].isalnum():
        w = w[1:]
    while w and not w[-1].isalnum():
        w = w[:-1]
    return w.lower()


def held_out(doc_id: int) -> bool:
    return zlib.crc32(str(doc_id).encode()) % 5 == 0


def training_labels(labels: DataFrame, sample: int) -> DataFrame:
    """doc_id, toxic: at most ``sample`` labels that may be learned from, the rows
    whose hash is smallest.  A document with several labels is toxic if one says
    so; null labels and ids are left out."""
    return (labels.select(F.col("doc_id").cast("long").alias("doc_id"), F.col("toxic").cast("int").alias("toxic"))
            .where("doc_id is not null and toxic in (0, 1)")
            .where(F.crc32(F.col("doc_id").cast("string").cast("binary")) % 5 != 0)
            .groupBy("doc_id").agg(F.max("toxic").alias("toxic"))
            .orderBy(F.xxhash64("doc_id"), "doc_id").limit(sample))


def training_texts(docs: DataFrame, known: DataFrame) -> DataFrame:
    """text, toxic, fold of the sample: equal texts are one (toxic if one of them
    is) and share a fold."""
    rows = docs.join(F.broadcast(known), "doc_id")  # bounded by the sample
    fold = F.pmod(F.xxhash64("text"), F.lit(FOLDS)).cast("int")
    return rows.groupBy("text").agg(F.max("toxic").alias("toxic")).withColumn("fold", fold)


class _Folded(dict):
    """Raw word -> word."""

    def __missing__(self, raw: str) -> str:
        w = word_of(raw)
        if len(self) < REMEMBERED:
            self[raw] = w
        return w


COUNTS = pa.schema([("word", pa.string()), ("n", pa.int64())])
CLASS_COUNTS = pa.schema([("word", pa.string()), ("fold", pa.int32()), ("toxic", pa.int32()), ("n", pa.int64())])


def word_counts(docs: DataFrame) -> DataFrame:
    """word, n: documents that hold it, added up within each task."""

    def run(batches):
        seen, fold = Counter(), _Folded()

        def out():
            words = [w for w in seen if w]
            for at in range(0, len(words), 50_000):
                part = words[at:at + 50_000]
                yield common.table_batch(COUNTS, word=part, n=[seen[w] for w in part])
            seen.clear()

        for b in common.row_slices(batches):
            for text in b.column("text").to_pylist():
                seen.update(set(map(fold.__getitem__, text.split())))
            if len(seen) > 300_000:
                yield from out()
        yield from out()

    return docs.mapInArrow(run, "word string, n long").groupBy("word").agg(F.sum("n").alias("n"))


def class_counts(texts: DataFrame) -> DataFrame:
    """word, fold, toxic, n of the sample's texts."""

    def run(batches):
        seen, fold = Counter(), _Folded()
        for b in common.row_slices(batches):
            for text, y, f in zip(*(b.column(c).to_pylist() for c in ("text", "toxic", "fold"))):
                seen.update((w, f, y) for w in set(map(fold.__getitem__, text.split())) if w)
        keys = list(seen)
        for at in range(0, len(keys), 50_000):
            part = keys[at:at + 50_000]
            yield common.table_batch(CLASS_COUNTS, word=[k[0] for k in part], fold=[k[1] for k in part],
                                     toxic=[k[2] for k in part], n=[seen[k] for k in part])

    return (texts.mapInArrow(run, "word string, fold int, toxic int, n long")
            .groupBy("word", "fold", "toxic").agg(F.sum("n").alias("n")))


@dataclass
class Lexicon:
    """Log-odds of words and stems, and the extreme-value scale."""

    words: dict[str, float]
    stems: dict[str, float]
    drift: float
    scale: float

    def score(self, word: str) -> float:
        found = self.words.get(word)
        if found is None:
            for q in range(min(STEMS[-1], len(word) - 1), STEMS[0] - 1, -1):
                found = self.stems.get(word[:q])
                if found is not None:
                    return found
            return 0.0
        return found


class Vocabulary:
    """Words and their stems, numbered once for all fits: ``chain`` and ``above`` number
    each word's and each stem's stems.  If ``stems`` (with all stems of each word) are given,
    they may be stems of further words, too."""

    def __init__(self, words: list[str], stems: list[str] | None = None):
        if stems is None:
            stems = list(dict.fromkeys(w[:q] for q in STEMS for w in words if len(w) > q))
        self.words, self.stems = words, stems
        number = {s: k for k, s in enumerate(stems)}
        self.chain: list[tuple[np.ndarray, np.ndarray]] = []  # by length: words that have such a stem, its number
        for q in STEMS:
            at = [k for k, w in enumerate(words) if len(w) > q]
            codes = [number[words[k][:q]] for k in at]
            self.chain.append((np.array(at, np.int64), np.array(codes, np.int64)))
        self.above = np.array([number.get(s[:-1], -1) for s in self.stems], np.int64)
        self.length = np.array([len(s) for s in self.stems], np.int64)


def fit_lexicon(vocabulary: Vocabulary, counts: np.ndarray, share: np.ndarray, prior: float, drift: float,
                of_stem: np.ndarray | None = None, size: np.ndarray | None = None) -> Lexicon:
    """``counts``: documents that hold each word, clean and toxic; ``share``: a word's share of
    all documents' words; ``of_stem``, ``size``: the sums of ``counts`` over the words of each stem,
    and over all words, if there are words that the vocabulary does not name."""
    v = vocabulary
    if of_stem is None:
        of_stem = np.zeros((len(v.stems), 2))
        for at, codes in v.chain:
            for k in range(2):
                of_stem[:, k] += np.bincount(codes, counts[at, k], len(v.stems))
    n = np.maximum(1.0, counts.sum(axis=0) if size is None else size)

    def rates(c, part, above):
        return (c + prior * above) / (n * part[:, None] + prior)

    known = of_stem.sum(axis=1) > 1
    rate = np.ones((len(v.stems) + 1, 2))  # the last one: no stem
    stem_of = np.full(len(v.words), len(v.stems))  # the longest known stem of each word
    for q, (at, codes) in zip(STEMS, v.chain):
        own = np.flatnonzero(v.length == q)
        rate[own] = rate[v.above[own]] if q > STEMS[0] else 1.0
        own = own[known[own]]
        rate[own] = rates(of_stem[own], of_stem[own].sum(axis=1) / n.sum(), rate[own])
        stem_of[at[known[codes]]] = codes[known[codes]]
    total = counts.sum(axis=1)
    kept = np.flatnonzero(total > 1)
    part = np.maximum(share[kept], total[kept] / n.sum())
    of_word = rates(counts[kept], part, rate[stem_of[kept]])
    score = np.log(of_word[:, 1] / of_word[:, 0])
    stems = np.flatnonzero(known)
    return Lexicon(dict(zip([v.words[k] for k in kept], score.tolist())),
                   dict(zip([v.stems[k] for k in stems], np.log(rate[stems, 1] / rate[stems, 0]).tolist())),
                   drift, extreme_value_scale(score - drift, part * of_word[:, 0], drift))


def extreme_value_scale(s: np.ndarray, p: np.ndarray, drift: float) -> float:
    """The lambda > 0 with E[exp(lambda score)] = 1 over clean words with scores
    ``s`` and frequencies ``p``; other words score -drift."""
    rest = max(1e-9, 1 - p.sum())

    def excess(x):
        return float(np.log(rest * np.exp(-x * drift) + (p * np.exp(np.minimum(x * s, 700))).sum()))

    low, high = 0.0, 1.0
    while excess(high) < 0 and high < 64:
        low, high = high, high * 2
    if excess(high) < 0:
        return high
    for _ in range(60):
        mid = (low + high) / 2
        low, high = (mid, high) if excess(mid) < 0 else (low, mid)
    return max(low, 0.05)


def fit_lexicons(counted: DataFrame, corpus: DataFrame, prior: float, drift: float) -> list[Lexicon]:
    """One lexicon without each fold, and the one of the whole sample.  What is
    collected are the words and stems that more than one document of the sample
    holds; the others (most) have no score and count in the sums only, which Spark makes."""
    counted = common.cut(counted, "counted")
    total = float(corpus.agg(F.sum("n")).head()[0] or 1)
    cells = [F.sum(F.when((F.col("fold") == f) & (F.col("toxic") == y), F.col("n")).otherwise(0)).alias(f"c{f}{y}")
             for f in range(FOLDS) for y in (0, 1)]
    shared = F.sum("n") > 1
    of_words = (counted.groupBy("word").agg(*cells, shared.alias("_shared")).where("_shared").drop("_shared")
                .join(corpus.withColumnRenamed("n", "_all"), "word", "left").toArrow())
    stems = F.explode(F.array_compact(F.array(*[
        F.when(F.length("word") > q, F.substring("word", 1, q)) for q in STEMS]))).alias("stem")
    of_stems = (counted.select(stems, "fold", "toxic", "n").groupBy("stem").agg(*cells, shared.alias("_shared"))
                .where("_shared").drop("_shared").toArrow())
    of_all = counted.agg(*cells).toArrow()

    def by_fold(rows: pa.Table) -> np.ndarray:
        return np.stack([np.stack([_numbers(rows, f"c{f}{y}") for y in (0, 1)], axis=1) for f in range(FOLDS)])

    tables = [by_fold(rows) for rows in (of_words, of_stems, of_all)]
    share = _numbers(of_words, "_all") / total
    # a word's stems and a stem's shorter ones are held by as many documents, so they are all there
    words = Vocabulary(of_words.column("word").to_pylist(), of_stems.column("stem").to_pylist())
    return [fit_lexicon(words, counts, share, prior, drift, of_stem, size[0]) for counts, of_stem, size in
            ([t.sum(axis=0) - (0 if f is None else t[f]) for t in tables] for f in [*range(FOLDS), None])]


def _numbers(rows: pa.Table, column: str) -> np.ndarray:
    return rows.column(column).fill_null(0).to_numpy().astype(float)


def maximal_segments(scores: list[float], drift: float = 0.0) -> list[tuple[int, int, float]]:
    """All maximal-scoring segments of ``scores`` less ``drift`` each, as (first,
    last, score).

    Linear: a stack of candidates with the sums before (``low``) and after
    (``high``) each; a new one swallows those that it improves on.  Only
    positions that score above 0 need a look."""
    at = [k for k, v in enumerate(scores) if v > drift]
    if not at:
        return []
    before = list(accumulate(scores, initial=0.0))
    stack: list[list] = []  # first, last, low, high, index of the nearest candidate with a smaller low
    for p in at:
        low, high, first = before[p] - drift * p, before[p + 1] - drift * (p + 1), p
        while True:
            k = len(stack) - 1
            while k >= 0 and stack[k][2] >= low:
                k = stack[k][4]
            if k < 0 or stack[k][3] >= high:
                stack.append([first, p, low, high, k])
                break
            first, low = stack[k][0], stack[k][2]
            del stack[k:]
    return [(a, z, high - low) for a, z, low, high, _ in stack]


class _Scores(dict):
    """Word -> log-odds."""

    def __init__(self, lexicon: Lexicon):
        super().__init__({"": 0.0})
        self.lexicon = lexicon

    def __missing__(self, word: str) -> float:
        v = self.lexicon.score(word)
        if len(self) < REMEMBERED:
            self[word] = v
        return v


def word_scores(words: list[str], score) -> list[float]:
    """Score of each word of a text: log-odds at its first place, only their
    negative part after it."""
    out, seen = list(map(score, words)), set()
    for k in [k for k, v in enumerate(out) if v > 0.0]:
        if words[k] in seen:
            out[k] = 0.0
        else:
            seen.add(words[k])
    return out


SEGMENT = T.ArrayType(T.StructType([T.StructField("first", T.LongType()), T.StructField("last", T.LongType()),
                                    T.StructField("score", T.DoubleType())]))
ARROW_SEGMENT = pa.list_(pa.struct([("first", pa.int64()), ("last", pa.int64()), ("score", pa.float64())]))


def scan(rows: DataFrame, lexicons, keep: list[str], fold: str) -> DataFrame:
    """The columns ``keep``, n_words, segments: array of struct<first, last, score>
    (word numbers) of every whole ``text``, by the lexicon that the column ``fold`` numbers."""
    rows = rows.select(*dict.fromkeys((*keep, "text", fold)))
    out = T.StructType([*rows.select(*keep).schema, T.StructField("n_words", T.LongType()),
                        T.StructField("segments", SEGMENT)])

    def run(batches):
        lex = lexicons.value
        folded, memo = _Folded(), {k: _Scores(x) for k, x in lex.items()}
        for b in common.row_slices(batches):
            n_words, found = [], []
            for text, f in zip(b.column("text").to_pylist(), b.column(fold).to_pylist()):
                words = list(map(folded.__getitem__, (text or "").split()))
                n_words.append(len(words))
                found.append([{"first": a, "last": z, "score": s} for a, z, s in maximal_segments(
                    word_scores(words, memo[f].__getitem__), lex[f].drift)])
            yield pa.RecordBatch.from_arrays(
                [*(b.column(c) for c in keep), pa.array(n_words, pa.int64()), pa.array(found, ARROW_SEGMENT)],
                names=[*keep, "n_words", "segments"])

    return rows.mapInArrow(run, out)


@dataclass
class Calibration:
    log_k: float
    intercept: float
    slope: float


def significant(scale: float, log_k: float):
    """Columns: the segments whose evidence is above 0, and the sum of theirs."""
    space = F.lit(log_k) + F.log(F.greatest(F.col("n_words"), F.lit(1)).cast("double"))
    real = F.filter("segments", lambda s: F.lit(scale) * s["score"] > space)
    total = F.aggregate(real, F.lit(0.0), lambda a, s: a + F.lit(scale) * s["score"] - space)
    return real, total


def fit_logistic(x: np.ndarray, y: np.ndarray, steps: int = 50) -> tuple[float, float]:
    """Intercept and slope by Newton steps, with a weak pull of the slope to 0."""
    a, b = 0.0, 0.0
    for _ in range(steps):
        p = 1 / (1 + np.exp(-np.clip(a + b * x, -30, 30)))
        w = p * (1 - p) + 1e-9
        g = np.array([(y - p).sum(), ((y - p) * x).sum() - 0.1 * b])
        h = np.array([[w.sum(), (w * x).sum()], [(w * x).sum(), (w * x * x).sum() + 0.1]])
        da, db = np.linalg.solve(h + 1e-6 * np.eye(2), g)
        a, b = a + float(np.clip(da, -5, 5)), b + float(np.clip(db, -5, 5))
        if abs(da) + abs(db) < 1e-9:
            break
    return a, b


def extreme_value_k(best: np.ndarray, n_words: np.ndarray, scale: float) -> float:
    """ln K of largest likelihood from the best segments of clean texts."""
    if not len(best):
        return 0.0
    return float(np.log(len(best) / (n_words * np.exp(-scale * best)).sum()))


def calibrate(scanned: DataFrame, scale: float) -> Calibration:
    """``scanned``: toxic and the segments out of fold of the sample (bounded by
    its size); fitted on the driver."""
    best = F.coalesce(F.array_max(F.transform("segments", lambda s: s["score"])), F.lit(0.0))
    rows = scanned.where("n_words > 0").select("toxic", "n_words", best.alias("best")).toArrow().to_pandas()
    clean = rows[rows["toxic"] == 0]
    log_k = extreme_value_k(clean["best"].to_numpy(), clean["n_words"].to_numpy().astype(float), scale)
    seen = scanned.select("toxic", significant(scale, log_k)[1].alias("evidence")).toArrow().to_pandas()
    if not len(seen):
        return Calibration(log_k, 0.0, 0.0)
    return Calibration(log_k, *fit_logistic(np.minimum(seen["evidence"].to_numpy(float), CEILING),
                                            seen["toxic"].to_numpy(float)))


#: Evidence beyond which a text is not more likely toxic.
CEILING = 50.0


def toxicity(docs: DataFrame, labels: DataFrame, sample: int = 20_000, prior: float = 2.0, drift: float = 0.8,
             id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """Score of every whole text.

    Columns: doc_id, held_out, score, predicted, evidence, n_segments and
    segments (significant ones, as word numbers and scores).  Learned only from
    labels of rows that are not held out, at most ``sample`` of them; word counts
    cover all documents.  ``prior`` and ``drift`` were chosen on folds of the rows
    that may be learned from.

    A null or empty text has no segment and gets the score of such texts; a null id
    gives null held_out; rows that repeat an id are scored one by one, each by its
    own text, and an empty table gives an empty result.  Without labels of both kinds
    every score is that of the prior share of toxic rows (0.5 without labels).
    """
    rows = docs.select(F.col(id_col).cast("long").alias("doc_id"), F.col(text_col).cast("string").alias("text"))
    out_of = F.crc32(F.col("doc_id").cast("string").cast("binary")) % 5 == 0
    return score_rows(rows, labels, ["doc_id"], sample, prior, drift).select(
        "doc_id", out_of.alias("held_out"), "score", "predicted", "evidence", "n_segments", "segments")


def score_rows(docs: DataFrame, labels: DataFrame, keep: list[str], sample: int = 20_000, prior: float = 2.0,
               drift: float = 0.8) -> DataFrame:
    """The columns ``keep`` of each row, then score, predicted, evidence, n_segments
    and segments, by the row's own text; ``docs`` has doc_id, text and ``keep``."""
    spark: SparkSession = docs.sparkSession
    common.ship(spark)
    rows = common.texts(docs)
    texts = common.cut(training_texts(rows, training_labels(labels, sample)), "sample")
    lexicons = fit_lexicons(class_counts(texts), common.cut(word_counts(rows), "words"), prior, drift)
    final = lexicons.pop()
    of_fold = spark.sparkContext.broadcast(dict(enumerate(lexicons)))
    fit = calibrate(common.cut(scan(texts, of_fold, ["toxic"], "fold"), "out-of-fold"), final.scale)
    seen = scan(docs.withColumn("_whole", F.lit(-1)), spark.sparkContext.broadcast({-1: final}), keep, "_whole")
    real, total = significant(final.scale, fit.log_k)
    score = 1 / (1 + F.exp(-(F.lit(fit.intercept) + F.lit(fit.slope) * F.least(F.col("evidence"), F.lit(CEILING)))))
    return (seen.withColumn("evidence", total).withColumn("segments", real)
            .select(*keep, score.alias("score"), (score >= 0.5).cast("int").alias("predicted"), "evidence",
                    F.size("segments").cast("long").alias("n_segments"), "segments"))
