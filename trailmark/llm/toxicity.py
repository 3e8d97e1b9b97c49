"""Toxicity scores from a factorization machine over hashed terms.

A text is the set of its hashed terms. The score is
    sigmoid(b + sum_i w_i + sum_{i<j} <v_i, v_j>)
over the terms present: the w alone is a linear model, the v let a pair of terms say what
neither says by itself. The pair sum takes linear time: half of |sum v_i|^2 - sum |v_i|^2.
"""

from __future__ import annotations

import pickle
import re
from collections.abc import Iterator
from dataclasses import dataclass
from zlib import crc32

import numpy as np
import pyarrow as pa
import pyarrow.compute  # noqa: F401
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from trailmark.llm.common import crc_of, drop_held, hash_sample, stored, text_of

_WORD = re.compile(r"[^\W_]+")


@dataclass(frozen=True)
class Settings:
    """``sample`` bounds the labelled texts the model is fitted on: those with the
    smallest hashes, so the choice depends on the rows alone. A term gets a weight if
    ``least`` of them hold it and either the labels' shares among those differ by
    ``signal`` standard errors, or it is ``common``, or it makes a pair with another term
    in which the labels' shares are ``pair_signal`` off from what either term says."""

    bits: int = 18
    factors: int = 4
    sample: int = 20_000
    least: int = 5
    signal: float = 4.0
    common: float = 0.3
    pair_signal: float = 7.0
    epochs: int = 12
    rate: float = 0.1
    decay: float = 1e-4
    batch: int = 256
    stem: int = 4
    seed: int = 7


@dataclass(frozen=True)
class Model:
    """``kept`` are the hashes with weights, sorted; row i of the tables is theirs."""

    settings: Settings
    kept: np.ndarray
    bias: float
    linear: np.ndarray
    pairs: np.ndarray

    def scores(self, texts: list[list[int]]) -> np.ndarray:
        return self.scores_of(*_packed(texts))

    def scores_of(self, flat: np.ndarray, starts: np.ndarray) -> np.ndarray:
        """Scores of texts whose hashes stand one after another, each text's sorted."""
        rows, starts = self.rows(flat, starts)
        return _sigmoid(_forward(rows, starts, self.bias, self.linear, self.pairs)[0])

    def rows(self, flat: np.ndarray, starts: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """Table rows of the hashes that have a weight, and where each text's start."""
        if not len(self.kept):
            return np.zeros(0, np.int64), np.zeros_like(starts)
        found = np.minimum(np.searchsorted(self.kept, flat), len(self.kept) - 1)
        held = self.kept[found] == flat
        upto = np.zeros(len(flat) + 1, np.int64)
        np.cumsum(held, out=upto[1:])
        return found[held], upto[starts]


def terms(text: str, settings: Settings) -> list[int]:
    """Distinct hashed terms: lower-case words, and the stems of longer words."""
    words = set(_WORD.findall(text.lower()))
    stem, mask = settings.stem, (1 << settings.bits) - 1
    stems = {word[:n] for word in words for n in (stem, stem + 1) if len(word) > n}
    hashed = {crc32(word.encode()) & mask for word in words}
    hashed.update(crc32(b"^" + one.encode()) & mask for one in stems)
    return sorted(hashed)


def _packed(lists: list[list[int]]) -> tuple[np.ndarray, np.ndarray]:
    """Lists one after another, and where each starts."""
    starts = np.zeros(len(lists) + 1, np.int64)
    np.cumsum([len(one) for one in lists], out=starts[1:])
    return np.fromiter((h for one in lists for h in one), np.int32, starts[-1]), starts


def _sums(values: np.ndarray, starts: np.ndarray) -> np.ndarray:
    """Sums of consecutive runs, empty runs included."""
    total = np.zeros((len(values) + 1, *values.shape[1:]))
    np.cumsum(values, axis=0, out=total[1:])
    return total[starts[1:]] - total[starts[:-1]]


def _forward(flat, starts, bias, linear, pairs):
    v = pairs[flat]
    joint = _sums(v, starts)
    both = 0.5 * ((joint**2).sum(1) - _sums((v**2).sum(1), starts))
    return bias + _sums(linear[flat], starts) + both, joint, v


def _sigmoid(x: np.ndarray) -> np.ndarray:
    return 1 / (1 + np.exp(-np.clip(x, -35, 35)))


def _chosen(flat, starts, positive: np.ndarray, settings: Settings) -> np.ndarray:
    """Sorted hashes of the terms that get a weight."""
    size, n = 1 << settings.bits, len(positive)
    counts = np.bincount(flat, minlength=size)
    hits = np.bincount(flat[np.repeat(positive, np.diff(starts))], minlength=size)
    share = float(positive.mean()) if n else 0.0
    spread = np.sqrt(np.maximum(counts * share * (1 - share), 1e-12))
    telling = np.abs(hits - counts * share) >= settings.signal * spread
    often = counts >= settings.least
    chosen = often & (telling | (counts >= settings.common * n))
    if 0 < share < 1:
        often = np.flatnonzero(often)
        chosen[_paired(flat, starts, positive, often, counts, hits, share, settings)] = True
    return np.flatnonzero(chosen)


def _deviance(hits, counts, share):
    """Twice the log likelihood ratio of ``hits`` in ``counts`` against a share."""
    with np.errstate(divide="ignore", invalid="ignore"):
        yes = np.where(hits > 0, hits * np.log(hits / (counts * share)), 0.0)
        no = counts - hits
        rest = np.where(no > 0, no * np.log(no / (counts * (1 - share))), 0.0)
    return 2 * (yes + rest)


def _paired(flat, starts, positive, often, counts, hits, share, settings: Settings) -> np.ndarray:
    """Hashes of the terms in a pair that holds label 1 more often than the term of the two
    that holds it most, or less often than the one that holds it least.

    Only pairs count that have texts enough for their deviance to reach the square of
    ``pair_signal``. To speak for label 1, enough of its texts must hold both terms, which
    is counted for all pairs; for label 0, every eighth of its texts says which pairs have
    half of what they need. The deviance of those that are left is taken over all texts.
    """
    least = settings.pair_signal**2
    misses = counts - hits
    hits_needed, misses_needed = least / (-2 * np.log(share)), least / (-2 * np.log(1 - share))
    more, less = hits[often] >= hits_needed, misses[often] >= misses_needed
    found = often[more | less]
    shares = hits[found] / counts[found]
    place = np.full(1 << settings.bits, -1, np.int32)
    place[found] = np.arange(len(found))
    n, yes = len(positive), int(positive.sum())
    # Texts of label 1 first, then every eighth of the others.
    line = np.empty(n, np.int64)
    eighth = np.cumsum(~positive) % 8
    line[np.lexsort((eighth, ~positive))] = np.arange(n)
    upto = yes + int((~positive & (eighth == 0)).sum())
    flat = place[flat]
    row = np.repeat(line, np.diff(starts))[flat >= 0]
    flat = flat[flat >= 0]
    order = np.argsort(flat, kind="stable")
    flat, row = flat[order], row[order]
    step = 512
    cuts = np.searchsorted(flat, np.arange(0, len(found) + step, step))
    bits = np.zeros((len(found), -(-n // 64)), np.uint64)
    first = np.empty((len(found), upto), np.uint8)
    for k in range(len(cuts) - 1):
        own = slice(cuts[k], cuts[k + 1])
        made = np.zeros((min(step, len(found) - k * step), bits.shape[1] * 64), np.uint8)
        made[flat[own] - k * step, row[own]] = 1
        bits[k * step : k * step + step] = np.packbits(made, axis=1).view(np.uint64)
        first[k * step : k * step + step] = made[:, :upto]
    chosen = np.zeros(len(found), bool)
    for low in range(0, len(found), step):
        left = first[low : low + step].astype(np.float32)
        for right in range(low, len(found), step):
            others = left if right == low else first[right : right + step].astype(np.float32)
            both = left[:, :yes] @ others[:, :yes].T
            seen = left[:, yes:] @ others[:, yes:].T
            at = np.flatnonzero((both >= hits_needed) | (16 * seen >= misses_needed))
            x, y = np.unravel_index(at, both.shape)
            x, y, both = x + low, y + right, both.ravel()[at].astype(float)
            held = np.concatenate([np.zeros(0), *(
                np.bitwise_count(bits[x[i : i + 2048]] & bits[y[i : i + 2048]]).sum(1)
                for i in range(0, len(at), 2048)
            )])
            high = np.maximum(np.maximum(shares[x], shares[y]), share)
            under = np.minimum(np.minimum(shares[x], shares[y]), share)
            for told, to in ((both > held * high, high), (both < held * under, under)):
                told &= held >= settings.least
                told[told] = _deviance(both[told], held[told], to[told]) >= least
                chosen[x[told]] = True
                chosen[y[told]] = True
    return found[chosen]


def fit(texts: list[list[int]], labels: np.ndarray, settings: Settings) -> Model:
    """A model from texts given as sorted hashes, one list each."""
    return fit_flat(*_packed(texts), labels, settings)


def fit_flat(flat: np.ndarray, starts: np.ndarray, labels: np.ndarray, settings: Settings) -> Model:
    """Mini-batch AdaGrad on the logistic loss; the same input gives the same model."""
    kept = _chosen(flat, starts, np.asarray(labels) == 1, settings)
    share = float(np.mean(labels)) if len(labels) else 0.0
    share = min(max(share, 1e-3), 1 - 1e-3)
    random = np.random.default_rng(settings.seed)
    linear = np.zeros(len(kept))
    pairs = random.normal(0, 0.01, (len(kept), settings.factors))
    bias = np.log(share / (1 - share))
    if not len(kept) or len(set(labels.tolist())) < 2:
        return Model(settings, kept, bias, linear, np.zeros_like(pairs))
    told, cuts = Model(settings, kept, bias, linear, pairs).rows(flat, starts)
    rows = np.split(told, cuts[1:-1])
    past, past_pairs = np.full(len(kept), 1e-8), np.full(pairs.shape, 1e-8)
    for _ in range(settings.epochs):
        order = random.permutation(len(rows))
        for low in range(0, len(order), settings.batch):
            chosen = order[low : low + settings.batch]
            flat = np.concatenate([rows[i] for i in chosen])
            starts = np.cumsum([0, *(len(rows[i]) for i in chosen)])
            score, joint, v = _forward(flat, starts, bias, linear, pairs)
            error = _sigmoid(score) - labels[chosen]
            bias -= settings.rate * error.mean()
            used, place = np.unique(flat, return_inverse=True)
            each = np.repeat(np.arange(len(chosen)), np.diff(starts))
            grad = np.bincount(place, error[each], len(used)) / len(chosen)
            grad += settings.decay * linear[used]
            past[used] += grad**2
            linear[used] -= settings.rate * grad / np.sqrt(past[used])
            slope = error[each, None] * (joint[each] - v)
            for k in range(settings.factors):
                grad = np.bincount(place, slope[:, k], len(used)) / len(chosen)
                grad += settings.decay * pairs[used, k]
                past_pairs[used, k] += grad**2
                pairs[used, k] -= settings.rate * grad / np.sqrt(past_pairs[used, k])
    return Model(settings, kept, bias, linear, pairs)


def labelled_terms(
    docs: DataFrame,
    labels: DataFrame,
    settings: Settings = Settings(),
    id_col: str = "doc_id",
    text_col: str = "text",
    label_col: str = "toxic",
) -> DataFrame:
    """(id, label, terms) of the texts a model is fitted on, ``settings.sample`` at most.

    Of rows that repeat an id one teaches. Rows without an id, a label or a text teach
    nothing.
    """
    marked = labels.select(
        labels[id_col].alias("id"), labels[label_col].cast("double").alias("label")
    ).where("id is not null and label is not null")
    place = F.xxhash64(F.col("id").cast("string"), F.lit(settings.seed))
    wanted = hash_sample(marked, place, settings.sample, "id", "label")
    texts = docs.select(docs[id_col].alias("id"), docs[text_col].alias("text"))
    texts = texts.where("text is not null")

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        drop_held()
        for batch in batches:
            made = [terms(text.as_py(), settings) for text in batch.column("text")]
            keep = ["id", "label"]
            columns = [batch.column(name) for name in keep]
            columns.append(pa.array(made, pa.list_(pa.int32())))
            yield pa.RecordBatch.from_arrays(columns, [*keep, "terms"])

    # At most ``sample`` rows of an id and a label: a size bound that a broadcast may have.
    labelled = texts.join(F.broadcast(wanted), "id").select("id", "label", "text")
    kind = labelled.schema["id"].dataType.simpleString()
    hashed = labelled.mapInArrow(run, f"id {kind}, label double, terms array<int>")
    # Ids may repeat: of each id and label the text with the smallest hash stays.
    told = F.struct(F.xxhash64("terms"), "terms")
    found = hashed.groupBy("id", "label").agg(F.min(told).alias("told"))
    return found.select("id", "label", F.col("told.terms").alias("terms"))


def train(
    docs: DataFrame,
    labels: DataFrame,
    settings: Settings = Settings(),
    id_col: str = "doc_id",
    text_col: str = "text",
    label_col: str = "toxic",
) -> Model:
    """A model from labelled texts (all rows given; hold rows out before).

    The sample of ``labelled_terms`` has a fixed bound, so one task fits the model, on an
    executor and in the order of the ids: run again, it gives the same model. The driver
    gets the weights alone. Without labelled texts the model knows no term.
    """

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        drop_held()
        marks, sizes, flat = [np.zeros(0)], [np.zeros(0, np.int64)], [np.zeros(0, np.int32)]
        for batch in batches:
            lists = batch.column("terms")
            marks.append(batch.column("label").to_numpy())
            sizes.append(pa.compute.list_value_length(lists).to_numpy().astype(np.int64))
            flat.append(lists.flatten().to_numpy())
        if len(marks) > 1:
            starts = np.append(0, np.cumsum(np.concatenate(sizes)))
            model = fit_flat(np.concatenate(flat), starts, np.concatenate(marks), settings)
            yield pa.RecordBatch.from_arrays([pa.array([pickle.dumps(model)], pa.binary())], ["model"])

    found = labelled_terms(docs, labels, settings, id_col, text_col, label_col)
    ordered = found.repartition(1).sortWithinPartitions("id", "label")
    fitted = stored(ordered.mapInArrow(run, "model binary"), "toxicity-model").first()
    return pickle.loads(fitted.model) if fitted else fit([], np.zeros(0), settings)


# Texts scored at a time.
_BATCH = 500


def _scored(texts: pa.Array, model: Model) -> np.ndarray:
    made = [np.zeros(0)]
    for low in range(0, len(texts), _BATCH):
        part = texts.slice(low, _BATCH)
        made.append(model.scores([terms(text.as_py() or "", model.settings) for text in part]))
    return np.concatenate(made)


def score(
    docs: DataFrame, model: Model, id_col: str = "doc_id", text_col: str = "text"
) -> DataFrame:
    """(id, score) of every whole text: 0 to 1, higher for label 1.

    Null and empty texts hold no term and get the score of the bias alone. Null ids and
    repeated rows stay rows of their own. The model is a few MB of fixed bound
    (2^bits terms) and goes out with the tasks; nothing is shuffled.
    """
    sent = docs.sparkSession.sparkContext.broadcast(model)
    kind = docs.schema[id_col].dataType.simpleString()

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        drop_held()
        fitted = sent.value
        for batch in batches:
            made = _scored(batch.column("text"), fitted)
            yield pa.RecordBatch.from_arrays(
                [batch.column("id"), pa.array(made, pa.float64())], ["id", "score"]
            )

    chosen = docs.select(docs[id_col].alias("id"), text_of(text_col).alias("text"))
    return chosen.mapInArrow(run, f"id {kind}, score double").withColumnRenamed("id", id_col)


def without_toxic(
    docs: DataFrame, model: Model, threshold: float = 0.5, text_col: str = "text"
) -> DataFrame:
    """``docs`` without the rows whose score reaches ``threshold``, all columns as they
    were. Null and empty texts hold no term and stay unless the bias alone rejects them.
    """
    sent = docs.sparkSession.sparkContext.broadcast(model)
    place = docs.columns.index(text_col)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        drop_held()
        fitted = sent.value
        for batch in batches:
            yield batch.filter(pa.array(_scored(batch.column(place), fitted) < threshold))

    return docs.mapInArrow(run, docs.schema)


def held_out(id_col: str = "doc_id", folds: int = 5):
    """Rows kept from training: crc32 of the id's text divides by ``folds``."""
    return crc_of(id_col) % folds == 0
