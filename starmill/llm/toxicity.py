"""Toxicity learned from confirmed toxic texts and unlabelled ones, by non-negative risk."""

import re
import zlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from starmill.llm.common import batch, map_arrow, row_key, ship, sole, table

SLOTS = 1 << 20  # slots of hashed features; the last weight is the bias
PREFIXES = (3, 4, 5, 6, 7)  # characters of a word's beginnings that are features as well
LEVELS = (2, 3, 5)  # numbers of words that begin alike which are features of their own
MOST_POSITIVE = 4_000  # expected bound of the sample of confirmed toxic texts
MOST_UNLABELLED = 12_000  # expected bound of the sample of unlabelled texts
LEAST_TEXTS = 3  # sampled toxic texts a feature must occur in to carry weight
CAUTION = 1.5  # standard errors by which a feature's toxic texts are counted lower
LEAST_SHARE = 0.6  # share of toxic texts among those with a feature that carries weight
ROUNDS = 200
RATE = 0.05
DECAY = 1e-5
CUT = 0.3
HELD_OUT = 2  # remainder of crc32(id) modulo 4 whose labels are never learned from
MOST_KEPT = 300_000  # words a worker remembers before it starts afresh

WORD = re.compile(r"\w+")
_kept: dict[str, tuple[int, ...]] = {}


def word_slots(word: str) -> tuple[int, ...]:
    """Slots of a word and of its beginnings."""
    names = [f"={word}", *(f"{n}{word[:n]}" for n in PREFIXES if len(word) >= n)]
    return tuple(zlib.crc32(x.encode("utf-8", "replace")) % SLOTS for x in names)


def level_slot(slot, level: int):
    """Slot of the feature that ``level`` words of a text share a slot."""
    return (slot * 40_503 + level * 7_919) % SLOTS


def features(text: str) -> np.ndarray:
    """The distinct feature slots of a whole text: its words, their beginnings, and how
    many of its words begin alike."""
    if len(_kept) > MOST_KEPT or not _kept:
        sole(_kept).clear()
    words = set(WORD.findall(text.lower()))
    _kept.update((w, word_slots(w)) for w in words if w not in _kept)
    found = [s for word in words for s in _kept[word]]
    slots, counts = np.unique(np.array(found, np.int64), return_counts=True)
    levels = [level_slot(slots[counts >= n], n) for n in LEVELS]
    return np.unique(np.concatenate([slots, *levels])).astype(np.int32)


def sums(slots: np.ndarray, sizes: np.ndarray, weights: np.ndarray) -> np.ndarray:
    """Sum of the weights of each text's slots, and the bias."""
    ends = np.cumsum(sizes)
    total = np.concatenate([[0.0], np.cumsum(weights[slots])])
    return total[ends] - total[ends - sizes] + weights[-1]


def sigmoid(z: np.ndarray) -> np.ndarray:
    return 1 / (1 + np.exp(-np.clip(z, -40, 40)))


def telling(positive: np.ndarray, unlabelled: np.ndarray, n: int, m: int, prior: float) -> np.ndarray:
    """Slots whose texts are toxic more often than not, as far as the prior tells.

    The share of toxic texts among those with a feature follows from the prior
    and the feature's rates in both samples; the count of toxic texts is lowered
    by ``CAUTION`` of its standard errors. Features of ordinary language, which
    would add noise in proportion to a text's length, get no weight.
    """
    p = np.bincount(positive, minlength=SLOTS).astype(float)
    u = np.bincount(unlabelled, minlength=SLOTS) + 1.0
    share = prior * ((p - CAUTION * np.sqrt(p)) / n) / (u / m)
    return (p >= LEAST_TEXTS) & (share >= LEAST_SHARE)


def risk_slope(p: np.ndarray, n: int, prior: float) -> np.ndarray:
    """Slope of the risk by each text's logit; the first ``n`` texts are confirmed, the others unlabelled.

    Where the risk estimated for clean texts is negative, its slope alone is followed, upwards.
    """
    m = len(p) - n
    clean_loss = -np.log(np.clip(1 - p, 1e-12, 1))
    if clean_loss[n:].mean() - prior * clean_loss[:n].mean() >= 0:
        return np.r_[prior * (p[:n] - 1) / n - prior * p[:n] / n, p[n:] / m]
    return np.r_[prior * p[:n] / n, -p[n:] / m]


def train(positive: list[np.ndarray], unlabelled: list[np.ndarray], prior: float) -> np.ndarray:
    """Weights that minimise the non-negative positive-unlabelled risk of a logistic classifier.

    The risk of calling a toxic text clean is averaged over the confirmed ones
    and weighted by the class prior. The risk of calling a clean text toxic is
    that over unlabelled texts less the share the prior says is toxic; where
    this estimate turns negative, which is overfitting, its gradient is turned
    back. Without positive texts every weight but a very low bias is zero.
    """
    weights = np.zeros(SLOTS + 1)
    if not positive or not unlabelled:
        weights[-1] = -6.0
        return weights
    n, m = len(positive), len(unlabelled)
    prior = min(max(prior, 1e-4), 0.9)
    texts = positive + unlabelled
    sizes = np.array([len(t) for t in texts])
    slots = np.concatenate(texts).astype(np.int64)
    cut = sizes[:n].sum()
    kept = telling(slots[:cut], slots[cut:], n, m, prior)[slots]
    owner, slots = np.repeat(np.arange(n + m), sizes)[kept], slots[kept]
    sizes = np.bincount(owner, minlength=n + m)
    weights[-1] = np.log(prior / (1 - prior))
    first, second = np.zeros(SLOTS + 1), np.zeros(SLOTS + 1)
    mean = np.zeros(SLOTS + 1)
    for step in range(1, ROUNDS + 1):
        slope = risk_slope(sigmoid(sums(slots, sizes, weights)), n, prior)
        gradient = np.append(
            np.bincount(slots, np.repeat(slope, sizes), minlength=SLOTS), slope.sum()
        )
        gradient[:-1] += DECAY * weights[:-1]
        first += 0.1 * (gradient - first)
        second += 0.001 * (gradient**2 - second)
        weights -= RATE * (first / (1 - 0.9**step)) / (np.sqrt(second / (1 - 0.999**step)) + 1e-8)
        if step > ROUNDS // 2:  # the turned-back steps swing around the end; their mean does not
            mean += weights / (ROUNDS - ROUNDS // 2)
    return mean


class Scorer:
    """Scores texts by trained weights; a word met before is looked up."""

    def __init__(self, weights: np.ndarray):
        self.weights = {int(s): float(weights[s]) for s in np.flatnonzero(weights[:-1])}
        self.bias = float(weights[-1])
        slots = np.arange(SLOTS)
        used = weights[:-1] != 0
        for n in LEVELS:
            used = used | (weights[:-1] != 0)[level_slot(slots, n)]
        self.used = set(np.flatnonzero(used).tolist())
        self._kept: dict[str, tuple[int, ...]] = sole({})

    def _useful(self, word: str) -> tuple[int, ...]:
        if len(self._kept) > MOST_KEPT:
            self._kept.clear()
        found = self._kept[word] = tuple(s for s in word_slots(word) if s in self.used)
        return found

    def score(self, texts: list[str]) -> np.ndarray:
        totals = np.empty(len(texts))
        kept = self._kept
        for i, text in enumerate(texts):
            counts: dict[int, int] = {}
            for word in set(WORD.findall(text.lower())):
                for slot in kept[word] if word in kept else self._useful(word):
                    counts[slot] = counts.get(slot, 0) + 1
            found = set(counts)
            for slot, n in counts.items():
                found.update(level_slot(slot, level) for level in LEVELS if n >= level)
            totals[i] = sum(self.weights.get(slot, 0.0) for slot in sorted(found)) + self.bias
        return sigmoid(totals)


def _sample(rows: DataFrame, most: int) -> DataFrame:
    """About ``most`` rows at most, chosen by a hash of their contents."""
    n = rows.count()
    steps = 1 << 20
    chosen = F.pmod(F.xxhash64(F.lit(7), row_key(*rows.columns)), F.lit(steps))
    return rows.where(chosen < steps * min(1.0, most / max(n, 1)))


def learn(
    docs: DataFrame, labels: DataFrame, id_col: str = "doc_id", text_col: str = "text",
    label_col: str = "toxic", most_positive: int = MOST_POSITIVE, most_unlabelled: int = MOST_UNLABELLED,
) -> np.ndarray:
    """Weights learned from documents that labels confirm as toxic, and from documents as they are.

    Neither labels nor texts of the held-out quarter are used. Labels of clean
    texts count for the class prior only. Both samples are bounded by the
    parameters; their features are extracted where the texts are read, copies
    count once, and one task trains on them. Null texts are empty, null ids are never learned from.
    """
    spark = docs.sparkSession
    learnable = F.expr(f"pmod(crc32(cast(cast(id as string) as binary)), 4) <> {HELD_OUT}")
    texts = docs.select(
        F.col(id_col).alias("id"), F.coalesce(F.col(text_col), F.lit("")).alias("text")
    ).where(learnable)
    marks = labels.select(F.col(id_col).alias("id"), F.col(label_col).alias("mark")).where(learnable)
    positives, labelled = marks.agg(F.count_if(F.col("mark") == 1), F.count("mark")).first()
    # One toxic label in ten is assumed beforehand, so that a few labels cannot make a high prior.
    prior = (positives + 1) / (labelled + 10)
    # Ids are sampled before texts, so that no text is shuffled to find out whether it is toxic.
    ids = _sample(marks.where("mark = 1").select("id").distinct(), most_positive)
    toxic = texts.join(F.broadcast(ids), "id", "left_semi")
    chosen = _sample(toxic, most_positive).withColumn("positive", F.lit(True)).unionByName(
        _sample(texts, most_unlabelled).withColumn("positive", F.lit(False))
    )
    schema = pa.schema([("positive", pa.bool_()), ("slots", pa.binary())])

    def extract(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for x in batches:
            slots = [features(t).tobytes() for t in x.column("text").to_pylist()]
            yield batch(schema, positive=x.column("positive"), slots=slots)

    def fit(rows: pa.Table) -> pa.Table:
        lists = {True: [], False: []}
        for positive, slots in sorted(set(zip(rows["positive"].to_pylist(), rows["slots"].to_pylist()))):
            lists[positive].append(np.frombuffer(slots, np.int32))
        weights = train(lists[True], lists[False], prior)
        heavy = np.flatnonzero(weights)
        return pa.table({"slot": pa.array(heavy, pa.int64()), "weight": pa.array(weights[heavy])})

    ship(spark)
    sample = map_arrow(chosen.select("positive", "text"), extract, "positive boolean, slots binary")
    found = sample.groupBy().applyInArrow(fit, "slot long, weight double").collect()
    weights = np.zeros(SLOTS + 1)
    weights[-1] = -6.0 if not found else 0.0
    for slot, weight in found:
        weights[slot] = weight
    return weights


def score_documents(
    docs: DataFrame, weights: np.ndarray, id_col: str = "doc_id", text_col: str = "text"
) -> DataFrame:
    """(doc_id, held_out, score, predicted) of every whole text; a null text is empty.

    A score depends on the text alone. Nothing is shuffled; the weights, a
    fixed number of slots, travel with the tasks. A null id counts as not held out.
    """
    schema = pa.schema([
        ("doc_id", pa.int64()), ("held_out", pa.bool_()), ("score", pa.float64()), ("predicted", pa.int32()),
    ])
    sent = docs.sparkSession.sparkContext.broadcast(weights.astype(np.float32))

    def task(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        scorer = Scorer(sent.value.astype(np.float64))
        for x in batches:
            ids = x.column("id").to_pylist()
            scores = scorer.score(x.column("text").to_pylist())
            held = [i is not None and zlib.crc32(str(i).encode()) % 4 == HELD_OUT for i in ids]
            yield batch(
                schema, doc_id=x.column("id"), held_out=held, score=scores,
                predicted=(scores >= CUT).astype(np.int32),
            )

    rows = docs.select(
        F.col(id_col).alias("id"), F.coalesce(F.col(text_col), F.lit("")).alias("text")
    )
    return map_arrow(rows, task, "doc_id long, held_out boolean, score double, predicted int")


def drop_toxic(docs: DataFrame, weights: np.ndarray, text_col: str = "text") -> DataFrame:
    """The documents whose predicted label is 0; all columns stay."""
    sent = docs.sparkSession.sparkContext.broadcast(weights.astype(np.float32))
    place = docs.columns.index(text_col)

    def task(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        scorer = Scorer(sent.value.astype(np.float64))
        for x in batches:
            scores = scorer.score([t or "" for t in x.column(place).to_pylist()])
            yield x.filter(pa.array(scores < CUT))

    return map_arrow(docs, task, docs.schema)


def op7_toxicity(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Every document's score, learned from the labels outside the held-out quarter."""
    docs = table(spark, sf_dir, "documents")
    return score_documents(docs, learn(docs, table(spark, sf_dir, "labels")))


QUERIES = {"op7_toxicity": (op7_toxicity, None)}
