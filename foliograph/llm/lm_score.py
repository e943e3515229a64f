"""Hashed maximum-entropy language model with a class-factored softmax.

log10 P(word | before) = log10 P(class | before) + log10 P(word | class).

* The class is a softmax over hashed features of the words before: the last
  one, the last two, and two skips.  Classes are clusters of frequent words by
  the words they follow, the end of a text, and all other words.
* Inside a class words are a softmax of their log counts and of features of the
  pair of the last word and the word, with one share for words never seen.  The
  pairs' weights are a table over shards that grows with the corpus (see
  ``word_pairs``); only for the ``FOLLOWED`` most frequent last words, and for
  the beginning of a text, the model of all tasks holds them, with the
  ``CLUSTERED`` most frequent words.  Words beyond the ``HEAD`` most frequent
  ones have no pairs.
* The classes' weights are trained by synchronous gradient ascent: every
  training text takes part in each of ``ROUNDS`` updates; tasks send sums of
  gradients in blocks, which are added on the way, and the driver holds nothing
  but the model (bounded by ``BUCKETS``, ``CLASSES``, ``HEAD`` and ``FOLLOWED``).
* Counts of all words stay distributed.  The ``HEAD`` most frequent ones go to
  the tasks, the rest of a text's words are joined with their counts; none of
  these is frequent, so no key is hot.

Words are known by 64-bit hashes.
"""

from __future__ import annotations

import math
from collections.abc import Iterator
from dataclasses import dataclass, field

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame, functions as F

from foliograph.llm import word_pairs
from foliograph.llm.textbytes import hash_spans, lower_ascii, mix, split_words, text_slices
from foliograph.session import scratch_path

HEAD = 1 << 18
CLUSTERED = 1 << 14
CLASSES = 24
BUCKETS = 1 << 14
FOLLOWED = 64
ROUNDS = 2
RATE = 0.5
CHUNK = 32_768
SHARD_TOKENS = 1 << 21
_BLOCK = 256
_CACHED = 2_048  # tokens whose classes fit a processor cache
_END, _START = np.uint64(0x5EED0E2D), np.uint64(0x5EED057A)
_ROW_BITS = 33
_TAIL, _LAST = 0, 1  # classes of rare words and of the end of a text


def tokens(data: np.ndarray, offsets: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Word hashes of all texts, each text closed by an end; and the number of its first token."""
    data = lower_ascii(data)
    starts, ends, first = split_words(data, offsets)
    at = first + np.arange(len(first))
    out = np.full(int(at[-1]), _END, np.uint64)
    word = np.ones(len(out), np.bool_)
    word[at[1:] - 1] = False
    out[word] = hash_spans(data, starts, ends)
    return out, at


def contexts(words: np.ndarray, at: np.ndarray) -> list[np.ndarray]:
    """The three tokens before each token of the same text; before a text stand starts."""
    place = np.arange(len(words)) - np.repeat(at[:-1], np.diff(at))
    before = []
    for back in (1, 2, 3):
        w = np.full(len(words), _START, np.uint64)
        w[back:] = words[:-back]
        w[place < back] = _START
        before.append(w)
    return before


def feature_buckets(before: list[np.ndarray]) -> np.ndarray:
    """Buckets (features x tokens): last word, last two, and skips over one and two words."""
    one, two, three = before
    shift = np.uint64(64 - (BUCKETS - 1).bit_length())
    keys = (one + np.uint64(11), mix(one) * np.uint64(3) + two, two + np.uint64(22), three + np.uint64(33))
    return np.stack([(mix(k) >> shift).astype(np.int64) for k in keys])


# Sums of matrices over tasks.


def _blocks(matrix: np.ndarray) -> pa.RecordBatch:
    rows = [matrix[i : i + _BLOCK].astype(np.float32).tobytes() for i in range(0, len(matrix), _BLOCK)]
    return pa.RecordBatch.from_arrays([pa.array(range(len(rows)), pa.int32()), pa.array(rows, pa.binary())], names=["block", "v"])


def _added(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    total: dict[int, np.ndarray] = {}
    for batch in batches:
        for block, raw in zip(batch.column(0).to_pylist(), batch.column(1).to_pylist()):
            values = np.frombuffer(raw, np.float32).astype(np.float64)
            total[block] = total[block] + values if block in total else values
    blocks = sorted(total)
    yield pa.RecordBatch.from_arrays(
        [pa.array(blocks, pa.int32()), pa.array([total[b].tobytes() for b in blocks], pa.binary())], names=["block", "v"]
    )


def summed(parts: DataFrame, shape: tuple[int, int]) -> np.ndarray:
    """The sum of all tasks' matrices, added block by block in tasks; the result has a fixed size."""
    rows = parts.repartition("block").mapInArrow(_added, "block int, v binary").collect()
    out = np.zeros(shape)
    for row in rows:
        own = np.frombuffer(row["v"], np.float64).reshape(-1, shape[1])
        out[row["block"] * _BLOCK : row["block"] * _BLOCK + len(own)] += own
    return out


# Counts.


def _counted(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        for _, _, data, offsets in text_slices(batch.column(0)):
            words, _ = tokens(data, offsets)
            distinct, count = np.unique(words, return_counts=True)
            yield pa.RecordBatch.from_arrays([pa.array(distinct.view(np.int64)), pa.array(count)], names=["word", "n"])


def word_counts(texts: DataFrame) -> DataFrame:
    """``word, n`` of all words and ends, in the shared folder."""
    path = scratch_path(texts.sparkSession, "lm-counts")
    counted = texts.select("text").mapInArrow(_counted, "word bigint, n bigint")
    counted.groupBy("word").agg(F.sum("n").alias("n")).write.parquet(path)
    return texts.sparkSession.read.parquet(path)


@dataclass
class Model:
    """Frequent words in hash order with count and class, masses of classes, and weights."""

    words: np.ndarray
    counts: np.ndarray
    classes: np.ndarray
    mass: np.ndarray  # sum of count + 1 per class; the class of rare words holds one more
    prior: np.ndarray  # log share of each class
    weights: np.ndarray
    train_tokens: int
    distinct: int
    leaders: np.ndarray = field(default_factory=lambda: np.empty(0, np.uint64))  # last words whose pairs are in ``hot``
    hot: word_pairs.Pairs | None = None

    def __post_init__(self) -> None:
        bits = max(1, len(self.words).bit_length())
        self.shift = np.uint64(64 - bits)
        starts = np.arange(1 << bits, dtype=np.uint64) << self.shift
        self.begin = np.minimum(np.searchsorted(self.words, starts), max(0, len(self.words) - 1))
        order = np.lexsort((np.arange(len(self.words)), self.classes))
        self.place = np.empty(len(order), np.int64)
        self.place[order] = np.arange(len(order))
        owner = self.classes[order]
        self.inside = word_pairs.Classes(
            ((self.counts + 1) / self.mass[self.classes])[order], np.searchsorted(owner, owner)
        )

    def find(self, words: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """Row of each word and whether it is a frequent one."""
        if not len(self.words):
            return np.zeros(len(words), np.int64), np.zeros(len(words), np.bool_)
        row = self.begin.take((words >> self.shift).astype(np.int64))
        ahead = np.flatnonzero(self.words.take(row) < words)
        while len(ahead):  # hashes are spread evenly, so few steps are left
            row[ahead] += 1
            ahead = ahead[self.words.take(row[ahead], mode="clip") < words[ahead]]
            ahead = ahead[row[ahead] < len(self.words)]
        row = np.minimum(row, len(self.words) - 1)
        return row, self.words.take(row) == words

    def class_of(self, row: np.ndarray, known: np.ndarray) -> np.ndarray:
        return np.where(known, self.classes[row], _TAIL) if len(self.classes) else np.zeros(len(row), np.int64)

    def log_classes(self, buckets: np.ndarray) -> np.ndarray:
        """Natural log probabilities (tokens x classes)."""
        logits = self._logits(buckets)
        logits -= np.log(np.exp(logits) @ np.ones(logits.shape[1], np.float32))[:, None]
        return logits

    def class_shares(self, buckets: np.ndarray) -> np.ndarray:
        """Probabilities (tokens x classes)."""
        shares = np.exp(self._logits(buckets))
        shares /= (shares @ np.ones(shares.shape[1], np.float32))[:, None]
        return shares

    def _logits(self, buckets: np.ndarray) -> np.ndarray:
        # Steps are clipped, so no logit comes near the range of a float's exponential.
        logits = self.weights.take(buckets[0], axis=0)
        logits += self.prior
        for row in buckets[1:]:
            logits += self.weights.take(row, axis=0)
        return logits

    def led(self, last: np.ndarray) -> np.ndarray:
        """Whether the pairs of each last word are in the model itself."""
        if not len(self.leaders):
            return np.zeros(len(last), np.bool_)
        return self.leaders[np.minimum(np.searchsorted(self.leaders, last), len(self.leaders) - 1)] == last


def _following(batches: Iterator[pa.RecordBatch], words: np.ndarray, leaders: np.ndarray) -> Iterator[pa.RecordBatch]:
    """How often each clustered word follows each of the leading words."""
    total = np.zeros(len(words) * len(leaders))
    for batch in batches:
        for _, _, data, offsets in text_slices(batch.column(0)):
            own, at = tokens(data, offsets)
            before = contexts(own, at)[0]
            i = np.minimum(np.searchsorted(leaders, before), len(leaders) - 1)
            hit = leaders[i] == before
            own, i = own[hit], i[hit]
            j = np.minimum(np.searchsorted(words, own), len(words) - 1)
            hit = words[j] == own
            total += np.bincount(j[hit] * len(leaders) + i[hit], minlength=len(total))
    yield _blocks(total.reshape(len(words), len(leaders)))


def _clusters(follow: np.ndarray, weight: np.ndarray, count: int) -> np.ndarray:
    """Cluster of each row by what it follows: weighted k-means on square roots of shares."""
    share = np.sqrt((follow + 0.1) / (follow + 0.1).sum(axis=1, keepdims=True))
    order = np.argsort(-weight, kind="stable")
    centre = share[order[:1]]
    while len(centre) < count:  # start from rows far from all chosen ones, heavy rows first
        far = (1 - (share @ centre.T).max(axis=1)) * np.sqrt(weight)
        centre = np.concatenate([centre, share[[int(far.argmax())]]])
    for _ in range(12):
        own = (share @ centre.T).argmax(axis=1)
        for k in range(count):
            rows = own == k
            if rows.any():
                mean = (share[rows] * weight[rows, None]).sum(axis=0)
                centre[k] = mean / np.sqrt((mean**2).sum())
    return (share @ centre.T).argmax(axis=1)


def _gradients(batches: Iterator[pa.RecordBatch], model: Model) -> Iterator[pa.RecordBatch]:
    """Per bucket the sum of (seen - expected) over classes, and the number of tokens."""
    total = np.zeros((CLASSES + 1, BUCKETS))
    for batch in batches:
        for _, _, data, offsets in text_slices(batch.column(0)):
            words, at = tokens(data, offsets)
            owner = model.class_of(*model.find(words))
            buckets = feature_buckets(contexts(words, at))
            for lo in range(0, len(words), CHUNK):
                part = buckets[:, lo : lo + CHUNK]
                step = np.empty((CLASSES, part.shape[1]))
                for i in range(0, part.shape[1], _CACHED):
                    step[:, i : i + _CACHED] = model.class_shares(part[:, i : i + _CACHED]).T
                step[owner[lo : lo + CHUNK], np.arange(step.shape[1])] -= 1
                for row in part:
                    for k in range(CLASSES):
                        total[k] -= np.bincount(row, step[k], minlength=BUCKETS)
                    total[CLASSES] += np.bincount(row, minlength=BUCKETS)
    yield _blocks(np.ascontiguousarray(total.T))


def trained(texts: DataFrame, counts: DataFrame, head: int = HEAD) -> Model:
    """The model of ``texts`` (column ``text``)."""
    spark = texts.sparkSession
    whole = counts.agg(F.coalesce(F.sum("n"), F.lit(0)), F.count("*")).first()
    end = int(_END.view(np.int64))
    top = counts.filter(F.col("word") != end).orderBy(F.desc("n"), "word").limit(head).toArrow()
    words = top.column("word").to_numpy().view(np.uint64)
    number = top.column("n").to_numpy()
    ends = counts.filter(F.col("word") == end).first()
    if ends:
        words, number = np.append(words, _END), np.append(number, ends["n"])
    classes = np.full(len(words), _TAIL)
    leaders = np.empty(0, np.uint64)
    clustered = np.arange(min(CLUSTERED, len(top)))
    if len(clustered):
        own = np.sort(words[clustered])
        leaders = np.sort(np.append(words[: min(FOLLOWED, len(top))], _START))
        follow = summed(
            texts.select("text").mapInArrow(lambda b: _following(b, own, leaders), "block int, v binary"), (len(own), len(leaders))
        )
        order = np.argsort(words[clustered], kind="stable")
        found = _clusters(follow, number[clustered][order].astype(np.float64), min(CLASSES - 2, len(own)))
        classes[clustered[order]] = found + 2
    if ends:
        classes[-1] = _LAST
    order = np.argsort(words, kind="stable")
    words, number, classes = words[order], number[order], classes[order]
    seen = np.bincount(classes, number, minlength=CLASSES)
    mass = seen + np.bincount(classes, minlength=CLASSES)
    # What the head leaves over belongs to the class of rare words.
    seen[_TAIL] += whole[0] - number.sum()
    mass[_TAIL] += whole[0] - number.sum() + whole[1] - len(words) + 1
    prior = np.log((seen + 1) / (seen + 1).sum())
    model = Model(words, number, classes, mass, prior.astype(np.float32), np.zeros((BUCKETS, CLASSES), np.float32), int(whole[0]), int(whole[1]))
    if len(leaders):
        row, _ = model.find(own)
        j, i = np.nonzero(follow)
        keys = word_pairs.pair_keys(leaders[i], model.place[row[j]])
        order = np.argsort(keys)
        model.leaders = leaders
        model.hot = word_pairs.fitted(keys[order], follow[j, i][order], model.inside)
    share = np.exp(prior)
    for _ in range(ROUNDS if whole[0] else 0):
        sent = spark.sparkContext.broadcast(model)
        part = texts.select("text").mapInArrow(
            lambda b, sent=sent: _gradients(b, sent.value), "block int, v binary"
        )
        total = summed(part, (BUCKETS, CLASSES + 1))
        curve = total[:, -1:] * (share * (1 - share)) + 2
        model.weights = model.weights + np.clip(RATE * total[:, :-1] / curve, -1.5, 1.5).astype(np.float32)
    return model


# Scores.

_SCORES = (
    "row_key bigint, key_a bigint, key_b bigint, id {kind}, held_out boolean, n_tokens bigint, n_known bigint, "
    "log_counts double, log_model double, rare array<bigint>"
)


def _scores(batches: Iterator[pa.RecordBatch], model: Model) -> Iterator[pa.RecordBatch]:
    """Per text all that the model and the frequent words give, and its other words."""
    key = TaskContext.get().partitionId() << _ROW_BITS
    log_mass = np.log10(np.maximum(model.mass, 1))
    log_count = np.log10(model.counts + 1) if len(model.counts) else np.zeros(1)
    for batch in batches:
        for first, last, data, offsets in text_slices(batch.column("text")):
            words, at = tokens(data, offsets)
            row, known = model.find(words)
            owner = model.class_of(row, known)
            counted = np.where(known, log_count[row], 0.0)
            before = contexts(words, at)
            buckets = feature_buckets(before)
            score = np.empty(len(words))
            for lo in range(0, len(words), _CACHED):
                own = owner[lo : lo + _CACHED]
                score[lo : lo + _CACHED] = model.log_classes(buckets[:, lo : lo + _CACHED])[np.arange(len(own)), own]
            if model.hot is not None:
                led = np.flatnonzero(known & model.led(before[0]))
                keys = word_pairs.pair_keys(before[0][led], model.place[row[led]])
                score[led] += model.hot.log_ratio(keys, model.inside)
            score = score / np.log(10) + counted - log_mass[owner]
            rare = np.concatenate([[0], np.cumsum(~known)])[at].astype(np.int32)
            n = last - first
            yield pa.RecordBatch.from_arrays(
                [
                    pa.array(np.arange(key, key + n)),
                    *(batch.column(c).slice(first, n) for c in ("key_a", "key_b", "id", "held_out")),
                    pa.array(np.diff(at)),
                    pa.array(np.diff(at) - np.diff(rare).astype(np.int64)),
                    pa.array(np.add.reduceat(counted, at[:-1])),
                    pa.array(np.add.reduceat(score, at[:-1])),
                    pa.ListArray.from_arrays(pa.array(rare), pa.array(words[~known].view(np.int64))),
                ],
                names=["row_key", "key_a", "key_b", "id", "held_out", "n_tokens", "n_known", "log_counts", "log_model", "rare"],
            )
            key += n


def _pairs(batches: Iterator[pa.RecordBatch], model: Model, shards: int) -> Iterator[pa.RecordBatch]:
    """Blocks of the pairs whose last word is none of the model's own."""
    number = TaskContext.get().partitionId() << _ROW_BITS
    for batch in batches:
        for first, last, data, offsets in text_slices(batch.column("text")):
            words, at = tokens(data, offsets)
            row, known = model.find(words)
            before = contexts(words, at)[0]
            used = np.flatnonzero(known & (model.class_of(row, known) != _LAST) & ~model.led(before))
            text = np.repeat(np.arange(last - first), np.diff(at))[used]
            names = np.stack([batch.column(c).slice(first, last - first).to_numpy() for c in ("key_a", "key_b")], axis=1)
            held = batch.column("held_out").slice(first, last - first).to_numpy(zero_copy_only=False)
            keys = word_pairs.pair_keys(before[used], model.place[row[used]])
            yield from word_pairs.blocks(number, keys, text, ~held[text], names, shards)
            number += 1


def scored(
    docs: DataFrame,
    *,
    folds: int = 7,
    held_fold: int = 2,
    id_col: str = "doc_id",
    text_col: str = "text",
    head: int = HEAD,
) -> DataFrame:
    """``<id_col>, held_out, n_tokens, n_known, train_tokens, base_score, score`` per row.

    Training texts are those whose id, as text, has a CRC-32 that leaves
    another rest than ``held_fold`` by ``folds``; a null id is never held out.
    A null text is empty: one end.  Repeated rows count and are scored as often
    as they occur; rows of equal id and text share one score, the larger where
    rounding tells their sums apart.  Without training texts both scores rest on nothing: every
    token has probability one in the base, and a uniform class in the model.
    """
    spark = docs.sparkSession
    rest = F.crc32(F.col(f"`{id_col}`").cast("string")) % folds
    rows = docs.select(
        F.col(f"`{id_col}`").alias("id"),
        F.coalesce(rest == held_fold, F.lit(False)).alias("held_out"),
        F.coalesce(F.col(f"`{text_col}`"), F.lit("")).alias("text"),
    ).select("*", F.xxhash64("id", "text").alias("key_a"), F.xxhash64("text", "id", F.lit(1)).alias("key_b"))
    training = rows.filter(~F.col("held_out"))
    counts = word_counts(training)
    model = trained(training, counts, head)
    sent = spark.sparkContext.broadcast(model)
    path = scratch_path(spark, "lm-scores")
    kind = docs.schema[id_col].dataType.simpleString()
    rows.mapInArrow(lambda b: _scores(b, sent.value), _SCORES.format(kind=kind)).write.parquet(path)
    stored = spark.read.parquet(path)
    rare = stored.select("row_key", F.explode("rare").alias("word")).join(counts, "word").groupBy("row_key").agg(
        F.count("*").alias("seen"), F.sum(F.log10(F.col("n") + 1)).alias("more")
    )
    shards = max(1, model.train_tokens // SHARD_TOKENS)
    inside = (
        rows.mapInArrow(lambda b: _pairs(b, sent.value, shards), word_pairs.BLOCKS)
        .repartition("shard")
        .sortWithinPartitions("shard", "kind")
        .mapInArrow(lambda b: word_pairs.shard_sums(b, sent.value.inside), word_pairs.SUMS)
        .repartition("slice")
        .sortWithinPartitions("slice", F.desc("kind"))
        .mapInArrow(word_pairs.per_text, "key_a bigint, key_b bigint, inside double")
        .groupBy("key_a", "key_b")
        .agg(F.max("inside").alias("inside"))  # equal rows have equal sums but for rounding
    )
    more = F.coalesce("more", F.lit(0.0))
    base = F.log10(F.lit(float(model.train_tokens + model.distinct + 1)))
    return stored.drop("rare").join(rare, "row_key", "left").join(inside, ["key_a", "key_b"], "left").select(
        F.col("id").alias(id_col),
        "held_out",
        "n_tokens",
        (F.col("n_known") + F.coalesce("seen", F.lit(0))).alias("n_known"),
        F.lit(model.train_tokens).cast("bigint").alias("train_tokens"),
        (F.col("log_counts") + more - F.col("n_tokens") * base).alias("base_score"),
        (F.col("log_model") + more + F.coalesce("inside", F.lit(0.0)) / math.log(10)).alias("score"),
    )
