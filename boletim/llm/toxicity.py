"""Toxicity by class-conditional Kneser-Ney models.

Two bigram models, of toxic and of ordinary labelled documents, score a text; the score is the
difference of their log-likelihoods per word, turned into a probability on labelled documents that
the models scoring them have not seen. Bigrams back off to continuation counts (how many words a
word follows), and these to continuation counts shared by both classes.

The classes differ in size, so all is class-wise normalised: a discount is in proportion to a class's
total, the mass it frees is pooled, and the shared counts are the mean of both classes' shares. What
is rare in both is then equally likely in both, whatever their sizes, and tells nothing. The discount
is estimated from the numbers of counts 1 to 4 in the smaller class.

The models are fitted on a bounded sample of labelled rows (``LABELLED_ROWS``), counted in Spark;
what leaves Spark are the words and bigrams that tell, with their values. Every document is scored
from its whole text.
"""

from __future__ import annotations

from collections.abc import Iterable, Iterator
from dataclasses import dataclass, replace

import numpy as np
import pandas as pd
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from boletim.llm.common import let_workers_import, shuffles_removed, whole_text
from boletim.storage import shared_folder

#: Labelled rows, in the order of their hash, that a fit takes at most.
LABELLED_ROWS = 9000
THRESHOLD = 0.3
#: Differences up to this are topic and language rather than toxicity, and count for nothing.
SLACK = 1.2
#: A bigram has a value of its own from this many discounts; a rarer one has that of its word.
STABLE = 8
#: Share that a context leaves to the order below at least.
LEAST_BACKOFF = 0.05
#: Folds with labels to learn from; each is scored by a model of the others for the probabilities.
FOLDS = (0, 1, 3)
BEGIN = "\x02"
#: Characters of the texts that are scored at a time.
CHARACTERS = 1_000_000
_WORD = r"[\p{L}\p{N}_]+"
_GAP = r"[^\p{L}\p{N}_]+"


def fold(doc_id: Column) -> Column:
    return F.pmod(F.crc32(doc_id.cast("string").cast("binary")), F.lit(4)).cast("int")


@dataclass(frozen=True)
class Model:
    """Values of the words and bigrams that tell; a bigram's key is ``before * len(words) + word``
    in places of ``words``, where the place 0 stands for any other word."""

    words: list[str]
    word: np.ndarray
    bigrams: np.ndarray
    bigram: np.ndarray
    slope: float = 1.0
    intercept: float = 0.0

    def per_word(self, texts: Iterable[str]) -> np.ndarray:
        """The mean value per word of each text; 0 without words."""
        texts, found = list(texts), []
        sizes = np.cumsum([len(t) for t in texts]) // CHARACTERS
        cuts = [0, *np.flatnonzero(np.diff(sizes)) + 1, len(texts)]
        for begin, end in zip(cuts, cuts[1:]):
            if begin < end:
                found.append(self._means(pa.array(texts[begin:end], pa.large_string())))
        pa.default_memory_pool().release_unused()
        return np.concatenate([np.zeros(0), *found])

    def _means(self, texts: pa.Array) -> np.ndarray:
        split = pc.split_pattern_regex(pc.utf8_lower(texts), _GAP)
        words = split.flatten().dictionary_encode()
        kept = np.array(words.indices)
        known = pc.index_in(words.dictionary, value_set=pa.array(self.words, pa.large_string()))
        places = known.fill_null(0).to_numpy()[kept]
        # Nothing stands before a gap at the beginning, and after one at the end.
        blank = pc.equal(words.dictionary, "").to_numpy(zero_copy_only=False)[kept]
        of = np.repeat(np.arange(len(texts)), np.diff(split.offsets.to_numpy()))[~blank]
        places = places[~blank]
        value = self.word[places]
        if len(self.bigrams) and len(places):
            before = np.empty_like(places)
            before[1:] = places[:-1]
            before[np.flatnonzero(np.diff(of, prepend=-1))] = self.words.index(BEGIN)
            key = before.astype(np.int64) * len(self.words) + places
            at = np.minimum(np.searchsorted(self.bigrams, key), len(self.bigrams) - 1)
            value = np.where(self.bigrams[at] == key, self.bigram[at], value)
        sums = np.bincount(of, weights=value, minlength=len(texts))
        return sums / np.maximum(np.bincount(of, minlength=len(texts)), 1)

    def probability(self, per_word: np.ndarray) -> np.ndarray:
        return 1 / (1 + np.exp(-np.clip(self.slope * per_word + self.intercept, -50, 50)))


def labelled_sample(docs: DataFrame, labels: DataFrame, rows: int = LABELLED_ROWS) -> DataFrame:
    """``fold, toxic, weight, text`` of at most ``rows`` labelled documents outside fold 2.

    All of them where they are no more; else toxic ones fill half at most and ordinary ones the rest,
    and ``weight`` is how many labelled documents of its class a row stands for. Null labels and null
    ids take no part; a document labelled more than once is toxic if one of its labels says so. The
    sample's ids are few by their bound, so they are broadcast.
    """
    known = (
        labels.where("toxic IS NOT NULL AND doc_id IS NOT NULL")
        .groupBy("doc_id").agg((F.max("toxic") == 1).alias("toxic"))
        .withColumn("fold", fold(F.col("doc_id"))).where("fold <> 2")
    )
    counts = {r["toxic"]: r["count"] for r in known.groupBy("toxic").count().collect()}
    toxic, others = counts.get(True, 0), counts.get(False, 0)
    taken = min(toxic, max(rows // 2, rows - others))
    by_hash = [F.xxhash64(F.col("doc_id").cast("string")), F.col("doc_id")]
    parts = []
    for which, total, limit in (("toxic", toxic, taken), ("NOT toxic", others, rows - taken)):
        weight = F.lit(total / max(min(total, limit), 1)).alias("weight")
        parts.append(known.where(which).orderBy(*by_hash).limit(limit).select("*", weight))
    texts = docs.select("doc_id", whole_text().alias("text"))
    return texts.join(F.broadcast(parts[0].union(parts[1])), "doc_id").select(
        "fold", "toxic", "weight", "text"
    )


def _class(label: str, folds: Iterable[int]) -> list[str]:
    return [f"{label}{k}" for k in folds]


def bigram_counts(sample: DataFrame) -> DataFrame:
    """``v, w`` and per class (``t``, ``o``) and fold how many documents have ``w`` after ``v``.

    A document counts once for a bigram, however often it repeats it.
    """
    words = F.regexp_extract_all(F.lower("text"), F.lit(_WORD), F.lit(0))
    chains = sample.select("toxic", "fold", words.alias("w")).where(F.size("w") > 0)
    chain = F.arrays_zip(F.concat(F.array(F.lit(BEGIN)), "w").alias("v"), F.col("w"))
    once = F.array_distinct(F.slice(chain, F.lit(1), F.size("w")))
    cells = [
        F.count_if((F.col("toxic") == (label == "t")) & (F.col("fold") == k)).alias(f"{label}{k}")
        for label in "to" for k in FOLDS
    ]
    return (
        chains.select("toxic", "fold", F.explode(once).alias("pair"))
        .groupBy(F.col("pair.v").alias("v"), F.col("pair.w").alias("w")).agg(*cells)
    )


@dataclass(frozen=True)
class Smoothing:
    """Totals and discounts of the classes, and the share of mass that these free."""

    total: dict[str, int]
    discount: dict[str, float]
    freed: float

    @classmethod
    def of(cls, counts: DataFrame) -> Smoothing:
        """From columns ``t`` and ``o``. What comes to the driver has a row per count that occurs,
        and no count exceeds the labelled rows times the distinct words before a word."""
        both = F.explode(F.array(*[F.struct(F.lit(k).alias("k"), F.col(k).alias("c")) for k in "to"]))
        rows = counts.select(both.alias("x")).where("x.c > 0").groupBy("x.k", "x.c").count().collect()
        times = {k: {r["c"]: r["count"] for r in rows if r["k"] == k} for k in "to"}
        total = {k: max(sum(c * n for c, n in times[k].items()), 1) for k in "to"}
        small = min("to", key=lambda k: total[k])
        n1, n2, n3, n4 = (times[small].get(c, 0) for c in (1, 2, 3, 4))
        # Kneser and Ney's discount of counts from 3 on; a class too small for it has a fixed one.
        base = max(0.5, 3 - 4 * n1 / (n1 + 2 * n2) * n4 / n3) if n1 and n2 and n3 else 2.0
        discount = {k: base * total[k] / total[small] for k in "to"}
        shares = [sum(min(c, discount[k]) * n for c, n in times[k].items()) / total[k] for k in "to"]
        return cls(total, discount, sum(shares) / 2)

    def share(self, k: str, count: str) -> Column:
        """A class's discounted share of a count."""
        return F.greatest(F.col(count) - self.discount[k], F.lit(0.0)) / self.total[k]

    def reaches(self, discounts: float) -> Column:
        return (F.col("t") >= discounts * self.discount["t"]) | (
            F.col("o") >= discounts * self.discount["o"]
        )


def _cut(value: Column) -> Column:
    return F.signum(value) * F.greatest(F.abs(value) - SLACK, F.lit(0.0))


def build(counts: DataFrame, folds: Iterable[int]) -> Model:
    """The models of the documents of ``folds``, from all :func:`bigram_counts` of them.

    Only words and bigrams that are more frequent than their discounts are collected, and of these
    only such as change the score.
    """
    folds = list(folds)
    sums = [F.expr(" + ".join(_class(k, folds))).alias(k) for k in "to"]
    pairs = counts.select("v", "w", *sums).where("t + o > 0")
    words = pairs.groupBy("w").agg(*[F.count_if(F.col(k) > 0).alias(k) for k in "to"])
    by_word, by_pair = Smoothing.of(words), Smoothing.of(pairs)
    shared = sum(F.col(k) / by_word.total[k] for k in "to") / 2 * by_word.freed
    lower = words.select(
        "w", *[(by_word.share(k, k) + shared).alias(f"lower_{k}") for k in "to"],
        by_word.reaches(1).alias("reaches"),
    )
    lower = lower.withColumn("word", _cut(F.log("lower_t") - F.log("lower_o")))
    telling = lower.where("reaches AND word <> 0").select("w", "word").toPandas()

    stable = pairs.where(by_pair.reaches(STABLE))
    rate = F.greatest(*[F.sum(k) / by_pair.total[k] for k in "to"])
    freed = sum(F.sum(F.least(F.col(k), F.lit(by_pair.discount[k]))) / by_pair.total[k] for k in "to") / 2
    contexts = pairs.join(stable.select("v").distinct(), "v", "left_semi").groupBy("v").agg(
        rate.alias("rate"), F.greatest(freed / rate, F.lit(LEAST_BACKOFF)).alias("left")
    )
    placed = stable.join(contexts, "v").join(lower, "w")
    likely = {k: by_pair.share(k, k) / F.col("rate") + F.col("left") * F.col(f"lower_{k}") for k in "to"}
    value = _cut(F.log(likely["t"]) - F.log(likely["o"])).alias("value")
    own = placed.select("v", "w", value, "word").where("value <> word").toPandas()
    return _model(telling, own)


def _model(telling: pd.DataFrame, own: pd.DataFrame) -> Model:
    named = {*telling["w"], *own["w"], *own["v"]} - {"", BEGIN}
    # A text has no empty word, so the first place is never found.
    words = ["", BEGIN, *sorted(named)]
    place = {w: i for i, w in enumerate(words)}
    word = np.zeros(len(words), "float32")
    word[[place[w] for w in telling["w"]]] = telling["word"]
    key = [place[v] * len(words) + place[w] for v, w in zip(own["v"], own["w"])]
    order = np.argsort(np.array(key, np.int64))
    return Model(
        words,
        word,
        np.array(key, np.int64)[order],
        own["value"].to_numpy("float32")[order],
    )


def _calibrated(model: Model, per_word: np.ndarray, toxic: np.ndarray, weight: np.ndarray) -> Model:
    """Slope and intercept of a logistic regression by Newton's method, slightly shrunk.

    With one label only, the score is the share of that label, smoothed.
    """
    share = ((toxic * weight).sum() + 1) / (weight.sum() + 2)
    fitted = np.array([0.0, np.log(share / (1 - share))])
    if 0 < toxic.sum() < len(toxic):
        scale = per_word.std() or 1.0
        x = np.column_stack([per_word / scale, np.ones(len(per_word))])
        for _ in range(50):
            p = 1 / (1 + np.exp(-np.clip(x @ fitted, -30, 30)))
            slack = np.diag([0.01, 0.0])
            slope = x.T @ ((toxic - p) * weight) - slack @ fitted
            bend = (x * (p * (1 - p) * weight)[:, None]).T @ x + slack + 1e-9 * np.eye(2)
            step = np.linalg.solve(bend, slope)
            fitted = fitted + np.clip(step, -2, 2)
        fitted = fitted / [scale, 1.0]
    return replace(model, slope=float(fitted[0]), intercept=float(fitted[1]))


def fit(
    docs: DataFrame, labels: DataFrame, rows: int = LABELLED_ROWS, folder: str | None = None
) -> Model:
    """The models from all folds with labels, the probabilities from scores of each fold by models of
    the others. The sample and its counts are written once, to ``folder`` in the shared space."""
    spark = docs.sparkSession
    let_workers_import(spark)
    with shuffles_removed(spark):
        return _fitted(docs, labels, rows, folder or shared_folder(spark, "toxicity"))


def _fitted(docs: DataFrame, labels: DataFrame, rows: int, folder: str) -> Model:
    spark = docs.sparkSession
    labelled_sample(docs, labels, rows).write.parquet(f"{folder}/sample")
    sample = spark.read.parquet(f"{folder}/sample")
    bigram_counts(sample).write.parquet(f"{folder}/counts")
    counts = spark.read.parquet(f"{folder}/counts")
    seen = []
    for k in FOLDS:
        model = build(counts, [f for f in FOLDS if f != k])

        def score(batches: Iterator[pd.DataFrame], model=model) -> Iterator[pd.DataFrame]:
            for batch in batches:
                found = model.per_word(batch["text"])
                yield pd.DataFrame({"s": found, "toxic": batch["toxic"], "weight": batch["weight"]})

        held = sample.where(F.col("fold") == k).select("text", "toxic", "weight")
        seen.append(held.mapInPandas(score, "s double, toxic boolean, weight double").toPandas())
    held = pd.concat(seen)
    return _calibrated(
        build(counts, FOLDS),
        held["s"].to_numpy("float64"),
        held["toxic"].to_numpy("float64"),
        held["weight"].to_numpy("float64"),
    )


def toxicity(text: Column, model: Model) -> Column:
    @F.pandas_udf("double")
    def score(batches: Iterator[pd.Series]) -> Iterator[pd.Series]:
        for texts in batches:
            yield pd.Series(model.probability(model.per_word(texts)))

    return score(text)


def judge(
    docs: DataFrame,
    labels: DataFrame,
    rows: int = LABELLED_ROWS,
    threshold: float = THRESHOLD,
) -> DataFrame:
    """``docs`` with ``held_out, score, predicted``, in place of columns of those names.

    A null text counts as empty; an empty text has the score of no evidence. Repeated rows score
    alike; a null id is not held out. An empty label table gives every text one half.
    """
    model = fit(docs, labels, rows)
    return (
        docs.withColumn("held_out", F.coalesce(fold(F.col("doc_id")) == 2, F.lit(False)))
        .withColumn("score", toxicity(whole_text(), model))
        .withColumn("predicted", (F.col("score") >= threshold).cast("int"))
    )


def ordinary(
    docs: DataFrame,
    labels: DataFrame,
    rows: int = LABELLED_ROWS,
    threshold: float = THRESHOLD,
) -> DataFrame:
    """The rows of ``docs`` that score below the threshold, as they are."""
    return docs.where(toxicity(whole_text(), fit(docs, labels, rows)) < threshold)
