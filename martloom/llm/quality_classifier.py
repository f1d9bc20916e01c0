"""A quality classifier of subword embeddings: hashed n-gram vectors, averaged, and a softmax.

The features of a text are its words, its pairs of neighbouring words, and the character
n-grams of every word with marks at its ends, each hashed to one of ``BUCKETS`` vectors. A
text is the mean of its features' vectors; a softmax over two classes is learned with the
vectors, by stochastic gradient descent in numpy.

As everything after the mean is linear, a trained model needs one number per bucket to score:
what the bucket's vector adds to the log odds. So scoring looks up each word's sum once.
"""

from __future__ import annotations

import zlib
from collections import Counter
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from martloom.llm.common import let_go, own, sliced, whole_text

BUCKETS = 1 << 17
DIMENSIONS = 8
NGRAMS = (3, 4, 5)
EPOCHS = 5
RATE = 0.4
#: The model is fitted on about so many labelled documents at most, chosen by a hash; a larger
#: sample of a corpus would not change it. Every document is scored.
TRAINING_DOCUMENTS = 4_000
#: One document in so many is held out, by the checksum of its id.
FOLDS = 5
THRESHOLD = 0.3
#: Score of all texts where there is nothing to learn from.
UNKNOWN = 0.5

#: Words that a worker keeps at once.
ENTRIES = 400_000
#: Letters that are cut into words at once.
LETTERS = 2_000_000
MIX = np.uint64(0x9E3779B97F4A7C15)
DITTO = 0
SHIFT = np.uint64(64 - BUCKETS.bit_length() + 1)


def bucket(hashes: np.ndarray) -> np.ndarray:
    return (hashes * MIX >> SHIFT).astype(np.int64)


def gram_features(words: list[bytes]) -> tuple[np.ndarray, np.ndarray]:
    """Buckets of the words and their character n-grams, and which word each belongs to."""
    letters = np.frombuffer(b"".join([b"<%b>" % word for word in words]), np.uint8)
    letters = letters.astype(np.uint64)
    of = np.repeat(np.arange(len(words)), [len(word) + 2 for word in words])
    whole = np.array([zlib.crc32(word) for word in words], np.uint64)
    buckets, owners = [bucket(whole)], [np.arange(len(words))]
    rolled = letters
    for n in range(2, max(NGRAMS) + 1):
        rolled = (rolled[:-1] * MIX) ^ letters[n - 1 :]
        if n in NGRAMS:
            inside = of[: len(rolled)] == of[n - 1 :]
            buckets.append(bucket(rolled[inside]))
            owners.append(of[: len(rolled)][inside])
    return np.concatenate(buckets), np.concatenate(owners)


def pair_features(hashes: np.ndarray) -> np.ndarray:
    """The buckets of neighbouring words, from the words' checksums in order.

    A word that repeats the one before it is written as a ditto mark: all such pairs are one
    feature, so that text that stutters is known by it whatever the words are.
    """
    pairs = bucket(hashes[:-1] * MIX + hashes[1:])
    pairs[hashes[:-1] == hashes[1:]] = DITTO
    return pairs


def features(text: str) -> tuple[np.ndarray, np.ndarray]:
    """The distinct buckets of a whole text, and the share of its features in each."""
    words = text.encode().split()
    if not words:
        return np.zeros(0, np.int32), np.zeros(0, np.float32)
    held = Counter(words)
    buckets, owners = gram_features([*held])
    pairs = pair_features(np.array([zlib.crc32(w) for w in words], np.uint64))
    weights = np.concatenate([np.array([*held.values()])[owners], np.ones(len(pairs), np.int64)])
    distinct, place = np.unique(np.concatenate([buckets, pairs]), return_inverse=True)
    shares = (np.bincount(place, weights) / weights.sum()).astype(np.float32)
    return distinct.astype(np.int32), shares


def train(examples: list[tuple[str, int]], seed: int = 1) -> np.ndarray:
    """Log odds of label 1 that each bucket adds, the constant last.

    With examples of one label only, a constant; with none, zeros: ``UNKNOWN`` for all.
    """
    labels = np.array([label for _, label in examples])
    if len(set(labels.tolist())) < 2:
        out = np.zeros(BUCKETS + 1, np.float32)
        out[-1] = 0 if not len(labels) else 2 if labels[0] else -2
        return out
    bags = [features(text) for text, _ in examples]
    draw = np.random.default_rng(seed)
    vectors = draw.uniform(-1 / DIMENSIONS, 1 / DIMENSIONS, (BUCKETS, DIMENSIONS))
    vectors = vectors.astype(np.float32)
    outputs, constants = np.zeros((2, DIMENSIONS), np.float32), np.zeros(2, np.float32)
    steps, done = EPOCHS * len(bags), 0
    for _ in range(EPOCHS):
        for at in draw.permutation(len(bags)):
            rate, done = RATE * (1 - done / steps), done + 1
            ids, shares = bags[at]
            mean = shares @ vectors[ids]
            scores = outputs @ mean + constants
            odds = np.exp(scores - scores.max())
            error = (odds / odds.sum()).astype(np.float32)
            error[labels[at]] -= 1
            back = error @ outputs
            outputs -= rate * np.outer(error, mean)
            constants -= rate * error
            # The vectors' step is spread over the features as the mean is, but not thinned
            # by their number: each takes a part of the document's whole step.
            vectors[ids] -= (rate * shares / shares.max())[:, None] * back
    return np.append(vectors @ (outputs[1] - outputs[0]), constants[1] - constants[0]).astype(
        np.float32
    )


class Scorer:
    """Scores whole texts, with a table of words that is emptied when full."""

    def __init__(self, odds: np.ndarray):
        self.odds, self.constant = odds[:-1].astype(np.float64), float(odds[-1])
        self.clear()

    def clear(self) -> None:
        self.numbers: dict[bytes, int] = {}
        self.sums, self.sizes = np.zeros(0), np.zeros(0, np.int64)
        self.hashes = np.zeros(0, np.uint64)

    def learn(self, words: list[bytes]) -> None:
        """Take words into the table: what each adds, its features, its checksum."""
        buckets, owners = gram_features(words)
        sums = np.bincount(owners, self.odds[buckets], len(words))
        self.numbers.update(zip(words, range(len(self.sums), len(self.sums) + len(words))))
        self.sums = np.append(self.sums, sums)
        self.sizes = np.append(self.sizes, np.bincount(owners, minlength=len(words)))
        checks = np.array([zlib.crc32(word) for word in words], np.uint64)
        self.hashes = np.append(self.hashes, checks)

    def score_all(self, texts: list[str]) -> list[float]:
        """Scores of the texts, some at a time."""
        out, some, letters = [], [], 0
        for text in texts:
            if some and letters + len(text) > LETTERS:
                out += self.score_some(some)
                some, letters = [], 0
            some.append(text)
            letters += len(text)
        return out + self.score_some(some)

    def score_some(self, texts: list[str]) -> list[float]:
        if len(self.numbers) > ENTRIES:
            self.clear()
        split = [text.encode().split() for text in texts]
        if new := set().union(*split).difference(self.numbers):
            self.learn(sorted(new))
        out = []
        for words in split:
            at = np.fromiter(map(self.numbers.__getitem__, words), np.int64, len(words))
            pairs = pair_features(self.hashes[at])
            total = self.sums[at].sum() + self.odds[pairs].sum()
            count = max(1, int(self.sizes[at].sum()) + len(pairs))
            out.append(float(1 / (1 + np.exp(-(total / count + self.constant)))))
        return out


def held_out(key: Column) -> Column:
    """Whether a document is held out; a null id counts as an empty one."""
    return F.crc32(F.coalesce(key.cast("string"), F.lit(""))) % FOLDS == 0


def sampled_labels(labels: DataFrame, bound: int = TRAINING_DOCUMENTS) -> DataFrame:
    """(doc_id, label) to learn from: not held out, of one opinion, ``bound`` or fewer."""
    known = (
        labels.select("doc_id", "quality")
        .where(F.col("doc_id").isNotNull() & F.col("quality").isin(0, 1))
        .where(~held_out(F.col("doc_id")))
        .groupBy("doc_id")
        .agg(F.min("quality").alias("label"), F.max("quality").alias("other"))
        .where(F.col("label") == F.col("other"))
        .select("doc_id", "label")
    )
    fraction = min(1.0, bound / max(1, known.count()))
    grain = 1 << 20
    chosen = F.pmod(F.xxhash64("doc_id"), F.lit(grain)) < int(fraction * grain)
    return known.where(chosen).limit(bound)


def fit(docs: DataFrame, labels: DataFrame, bound: int = TRAINING_DOCUMENTS) -> np.ndarray:
    """Train on the labelled documents that are not held out, in one task of bounded size.

    The sample of labels is broadcast: ``bound`` rows of two numbers at most.
    """
    sample = F.broadcast(sampled_labels(labels, bound))
    rows = (
        docs.select(own(docs, "doc_id").alias("doc_id"), whole_text(own(docs, "text")).alias("text"))
        .join(sample, "doc_id")
        .select("doc_id", "text", "label")
        .limit(2 * bound)
    )

    def trained(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        found = [row for batch in batches for row in batch.to_pylist()]
        found.sort(key=lambda row: (row["doc_id"], row["text"]))
        odds = train([(row["text"], row["label"]) for row in found])
        yield pa.RecordBatch.from_arrays([pa.array([odds.tobytes()], pa.binary())], ["odds"])

    model = rows.coalesce(1).mapInArrow(trained, "odds binary").collect()
    return np.frombuffer(model[0].odds, np.float32) if model else train([])


def score_column(batches: Iterator[pa.RecordBatch], odds: np.ndarray) -> Iterator[pa.RecordBatch]:
    scorer = Scorer(odds)
    for batch in batches:
        scores = scorer.score_all(batch["text"].to_pylist())
        yield pa.RecordBatch.from_arrays(
            [*batch.columns, pa.array(scores, pa.float64())], [*batch.schema.names, "score"]
        )


def classify(docs: DataFrame, odds: np.ndarray) -> DataFrame:
    """One row per row of ``docs``: doc_id, held_out, score, predicted.

    The text alone is scored, whole; null texts count as empty and get the model's constant.
    Rows with a null id count as held out; repeated rows get equal scores; no rows, no scores.
    """
    rows = docs.select(
        own(docs, "doc_id").alias("doc_id"), whole_text(own(docs, "text")).alias("text")
    )
    scored = rows.mapInArrow(
        lambda batches: (
            pa.RecordBatch.from_arrays([b["doc_id"], b["score"]], ["doc_id", "score"])
            for b in score_column(batches, odds)
        ),
        f"doc_id {docs.schema['doc_id'].dataType.simpleString()}, score double",
    )
    return scored.select(
        "doc_id",
        held_out(F.col("doc_id")).alias("held_out"),
        "score",
        (F.col("score") >= THRESHOLD).cast("int").alias("predicted"),
    )


def keep_good(docs: DataFrame, odds: np.ndarray) -> DataFrame:
    """The rows of ``docs``, with all their columns, that the classifier doesn't reject."""
    names = docs.columns
    plain = docs.toDF(*[f"c{i}" for i in range(len(names))])
    text = f"c{names.index('text')}"

    def kept(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        let_go()
        scorer = Scorer(odds)
        for batch in sliced(batches):
            texts = [t or "" for t in batch[text].to_pylist()]
            keep = np.array(scorer.score_all(texts), np.float64) >= THRESHOLD
            yield batch.filter(pa.array(keep, pa.bool_()))

    return plain.mapInArrow(kept, plain.schema).toDF(*names)


def read_labels(spark: SparkSession, folder: str) -> DataFrame:
    return spark.read.parquet(f"{folder}/labels.parquet")
