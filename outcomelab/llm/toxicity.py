"""Toxicity scores from class-conditional Kneser-Ney language models.

Two models of the bytes of words, one of toxic and one of ordinary training
texts, score every text.  The mean difference of their log-likelihoods per
byte, through a logistic curve fitted on training rows that the models have
not seen, is the score.

A model is an interpolated Kneser-Ney model of bytes.  It gives the next byte of
a word from up to ``ORDER - 1`` bytes before it, back to the blank before the
word.  The longest context uses the class's counts; the shorter ones, down to order
``CLASS_FROM``, use the class's continuation counts (after how many different bytes a
sequence was seen).  Below them stand the continuation counts of all documents, labelled
or not, of orders ``SHARED`` to 1, which both models share: what a class discounts it leaves to
what the whole corpus says after the same bytes.  Every order hands the mass of its
discounts down by its context's back-off weight, so the probabilities of the 256 next bytes
sum to one, and a context that a class has not seen leaves it all to the order
below.  Inflected and rare expressions so keep the evidence of their stems,
while a string neither class has seen gets the same probability from both and
pulls the score to neither side.

Words do not depend on each other, so a task computes each distinct word's
difference once and sums a bounded table of answers along the text.

Bounds.  The class counts come from at most ``PER_CLASS`` labelled texts per
class (those with the smallest id hash), all sequences of them.  The shared counts
come from all words of all documents and are one number for each sequence of
``SHARED`` bytes, so fewer than 256 ** SHARED (2 ** 24, two 8-byte numbers each) ever reach the
driver and the tasks, whatever the input; in valid UTF-8 words far fewer occur.
Scoring and the shared counts read every whole text, in narrow passes; only byte
sequences are shuffled, at most one row per distinct sequence and task.

Labels are read only from rows with crc32(id as text) mod 5 other than 0; of
these, remainder 1 fits the curve and the rest fits the models.  Scores use
the text alone.

Defined results.  A null text counts as empty; a text without words gets the
curve's value at a difference of zero.  Labels other than 0 and 1, null ids in
``labels`` and labels of unknown documents are ignored; of contradicting
labels of a document 1 counts.  Without labels of both classes the score is
their share of ones (0 without any).  Repeated rows and null ids of documents
are kept, one result row each; extra columns are ignored.  An empty table
gives an empty result.
"""

from __future__ import annotations

import uuid
from dataclasses import dataclass, field

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from outcomelab.llm.common import materialize, text_or_empty, worker_cache
from outcomelab.llm.labelled import fit_logistic, fold, prior_shift, training_draw

PER_CLASS = 6_000
ORDER = 4
SHARED = 3
CLASS_FROM = 2
DISCOUNT = 0.75
CACHE_WORDS = 250_000

_LOWER = bytes(b + 32 if 65 <= b <= 90 else b if b >= 128 or chr(b).isalnum() else 32 for b in range(256))


def words(text: str | None) -> list[bytes]:
    """Runs of ASCII letters, digits and non-ASCII bytes, A-Z in lower case."""
    return text.encode("utf-8", "replace").translate(_LOWER).split() if text else []


def grams(found: list[bytes]) -> tuple[np.ndarray, np.ndarray]:
    """(key, word number) of every byte of the words and of the blank after
    each: the byte with up to ORDER - 1 before it, from the word's blank on,
    packed into an integer."""
    if not found:
        return np.zeros(0, np.int64), np.zeros(0, np.int64)
    b = np.frombuffer(b" " + b" ".join(found) + b" ", np.uint8).astype(np.int64)
    size = np.fromiter(map(len, found), np.int64, len(found)) + 1
    owner = np.repeat(np.arange(len(found)), size)
    inside = np.arange(len(b) - 1) - np.repeat(np.cumsum(size) - size, size) + 1  # bytes since the blank
    key = np.zeros(len(b), np.int64)
    for i in range(ORDER):
        key[i:] |= b[:len(b) - i] << (8 * i)
    return key[1:] & ((np.int64(1) << (8 * np.minimum(inside + 1, ORDER))) - 1), owner


def _mask(size: int) -> int:
    return (1 << (8 * size)) - 1


def lengths(keys: np.ndarray) -> np.ndarray:
    """Bytes of each packed sequence (no byte of a word is zero)."""
    return sum((keys >> (8 * i) > 0).astype(np.int64) for i in range(ORDER))


def _look_up(keys: np.ndarray, wanted: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """(index into sorted ``keys``, found)."""
    if not len(keys):
        return np.zeros(len(wanted), np.int64), np.zeros(len(wanted), bool)
    at = np.searchsorted(keys, wanted)
    at[at == len(keys)] = 0
    return at, keys[at] == wanted


def _discounted(keys: np.ndarray, n: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """(share of each sequence in its context after the discount, the contexts, their back-off weights)."""
    contexts, where = np.unique(keys >> 8, return_inverse=True)
    total = np.bincount(where, n, minlength=len(contexts))
    seen = np.bincount(where, minlength=len(contexts))
    return (n - DISCOUNT) / total[where], contexts, DISCOUNT * seen / total


@dataclass
class Order:
    """One order of one or both classes: discounted shares of sequences and
    back-off weights of contexts, a column per class."""
    keys: np.ndarray
    share: np.ndarray
    contexts: np.ndarray
    back: np.ndarray

    @classmethod
    def of(cls, classes: list[tuple[np.ndarray, np.ndarray]]) -> Order:
        parts = [_discounted(k, n) for k, n in classes]
        keys = np.unique(np.concatenate([k for k, _ in classes]))
        contexts = np.unique(np.concatenate([c for _, c, _ in parts]))
        share, back = np.zeros((len(keys), len(classes))), np.ones((len(contexts), len(classes)))
        for i, ((k, _), (s, c, b)) in enumerate(zip(classes, parts)):
            share[np.searchsorted(keys, k), i] = s
            back[np.searchsorted(contexts, c), i] = b
        return cls(keys, share, contexts, back)

    def over(self, wanted: np.ndarray, below: np.ndarray) -> np.ndarray:
        """Probabilities of ``wanted`` given those of the order below."""
        at, known = _look_up(self.contexts, wanted >> 8)
        rows = np.flatnonzero(known)
        p = below.copy()
        p[rows] *= self.back[at[rows]]
        at, hit = _look_up(self.keys, wanted[rows])
        p[rows[hit]] += self.share[at[hit]]
        return p


@dataclass
class Model:
    """Both classes' orders, ordinary first."""
    key: str
    top: Order | None = None          # the longest contexts, by counts
    middle: dict[int, Order] = field(default_factory=dict)   # class continuation counts by order
    shared: dict[int, Order] = field(default_factory=dict)   # corpus continuation counts by order
    single: np.ndarray | None = None  # probability of each byte
    slope: float = 1.0
    offset: float = 0.0
    constant: float | None = None

    def probabilities(self, keys: np.ndarray) -> np.ndarray:
        """[n, 2] probability of each sequence's last byte after the rest of it."""
        size = lengths(keys)
        p = self.single[keys & 255][:, None].repeat(2, axis=1)
        for order, at in [*sorted(self.shared.items()), *sorted(self.middle.items())]:
            rows = np.flatnonzero(size > order)
            p[rows] = at.over(keys[rows] & _mask(order), p[rows])
        return self.top.over(keys, p)

    def of_words(self, found: list[bytes]) -> np.ndarray:
        """Summed log-likelihood difference of each word."""
        keys, owner = grams(found)
        if not len(keys):
            return np.zeros(len(found))
        distinct, at = np.unique(keys, return_inverse=True)
        logs = np.log(self.probabilities(distinct))
        return np.bincount(owner, (logs[:, 1] - logs[:, 0])[at], minlength=len(found))

    def difference(self, text: str | None) -> float:
        """Mean difference per byte."""
        found = words(text)
        if not found or self.constant is not None:
            return 0.0
        cache = worker_cache(f"toxicity_{self.key}", dict)
        fresh = [w for w in set(found) if w not in cache]
        if len(cache) + len(fresh) > CACHE_WORDS:
            cache.clear()
            fresh = list(set(found))
        for i in range(0, len(fresh), 1 << 14):
            part = fresh[i:i + (1 << 14)]
            cache.update(zip(part, self.of_words(part).tolist()))
        return sum(map(cache.__getitem__, found)) / (sum(map(len, found)) + len(found))


def _count_grams(train: DataFrame) -> pd.DataFrame:
    """(gram, n0, n1) over the training texts, of bounded number."""
    def run(batches):
        for b in batches:
            y = b.column(1).to_numpy(zero_copy_only=False)
            for c in (0, 1):
                keys = [np.zeros(0, np.int64)]
                keys += [grams(words(b.column(0)[int(i)].as_py()))[0] for i in np.flatnonzero(y == c)]
                k, n = np.unique(np.concatenate(keys), return_counts=True)
                yield pa.RecordBatch.from_arrays([pa.array(np.full(len(k), c), pa.int32()), pa.array(k, pa.int64()),
                                                  pa.array(n, pa.int64())], names=["y", "gram", "n"])

    by_class = [F.sum(F.when(F.col("y") == c, F.col("n")).otherwise(0)).alias(f"n{c}") for c in (0, 1)]
    return train.select("text", "y").mapInArrow(run, "y int, gram long, n long").groupBy("gram").agg(*by_class).toPandas()


def shared_continuations(docs: DataFrame, text_col: str) -> dict[int, tuple[np.ndarray, np.ndarray]]:
    """For every order up to SHARED: (sequences, after how many different bytes each occurs
    in all documents), the blank before a word being one of them.  Each task
    sends its distinct sequences of SHARED + 1 bytes, and the shorter ones that begin a word."""
    def run(batches):
        seen, mine = set(), np.zeros(0, np.int64)
        for b in batches:
            fresh = set()
            for t in b.column(0):
                fresh.update(words(t.as_py()))
            new = list(fresh - seen)
            seen |= fresh
            if len(seen) > CACHE_WORDS:
                seen = set()
            mine = np.union1d(mine, grams(new)[0] & _mask(SHARED + 1))
        yield pa.RecordBatch.from_arrays([pa.array(mine, pa.int64())], names=["gram"])

    rows = docs.select(text_or_empty(text_col).alias("text")).mapInArrow(run, "gram long").distinct()
    full = F.col("gram") > _mask(SHARED)
    last = F.when(full, F.col("gram").bitwiseAND(F.lit(_mask(SHARED)).cast("long"))).otherwise(F.col("gram"))
    # fewer than 256 ** SHARED rows of either kind
    got = rows.groupBy(full.alias("full"), last.alias("last")).agg(F.count(F.lit(1)).alias("n")).toPandas()
    inner = got[got["full"]].sort_values("last")
    level = inner["last"].to_numpy(np.int64), inner["n"].to_numpy(np.int64)
    begins = got[~got["full"]]["last"].to_numpy(np.int64)
    size = lengths(begins)
    out = {SHARED: level}
    for order in range(SHARED - 1, 0, -1):
        longer = np.union1d(out[order + 1][0], begins[size == order + 1])
        out[order] = np.unique(longer & _mask(order), return_counts=True)
    return out


def build_model(counts: pd.DataFrame, shared: dict[int, tuple[np.ndarray, np.ndarray]], key: str = "model") -> Model:
    """The model from the classes' sequence counts and the shared continuation counts."""
    counts = counts.sort_values("gram")
    every = counts["gram"].to_numpy(np.int64)
    classes = []
    for c in (0, 1):
        n = counts[f"n{c}"].to_numpy(np.int64)
        classes.append((every[n > 0], n[n > 0]))
    model = Model(key, top=Order.of(classes))
    longer = [k for k, _ in classes]           # distinct sequences of the order above, begins of words among them
    for order in range(ORDER - 1, CLASS_FROM - 1, -1):
        size = [lengths(k) for k in longer]
        model.middle[order] = Order.of([np.unique(k[s > order] & _mask(order), return_counts=True)
                                        for k, s in zip(longer, size)])
        longer = [np.unique(np.where(s > order, k & _mask(order), k)) for k, s in zip(longer, size)]
    for order in range(2, SHARED + 1):
        one = Order.of([shared[order]])
        model.shared[order] = Order(one.keys, one.share.repeat(2, axis=1), one.contexts, one.back.repeat(2, axis=1))
    single = np.full(256, 0.5)
    single[shared[1][0]] += shared[1][1]
    model.single = single / single.sum()
    return model


def fit(docs: DataFrame, labels: DataFrame, id_col: str = "doc_id", text_col: str = "text",
        label_id: str = "doc_id", label: str = "toxic", per_class: int = PER_CLASS) -> Model:
    """The model from the labelled texts (see the module's bounds).  The curve
    weighs the classes as they occur among all training labels."""
    key = uuid.uuid4().hex
    sample, known = training_draw(labels, label_id, label, per_class)
    sample = materialize(sample, "toxicity-sample")
    named = docs.select(F.col(id_col).alias("__doc"), text_or_empty(text_col).alias("text"))
    train = materialize(named.join(F.broadcast(sample), F.col("__doc") == F.col("__id")).select(
        "text", "y", "part"), "toxicity-train")
    sizes = {r["y"]: r["n"] for r in train.where("part > 1").groupBy("y").agg(F.count(F.lit(1)).alias("n")).collect()}
    if len(sizes) < 2:
        return Model(key, constant=float(sizes.get(1, 0) / max(1, sum(sizes.values()))))
    model = build_model(_count_grams(train.where("part > 1")), shared_continuations(docs, text_col), key)
    held = with_difference(train.where("part = 1"), model, "text").select("__difference", "y").toPandas()
    if held["y"].nunique() == 2:
        (model.slope,), model.offset = fit_logistic(held[["__difference"]].to_numpy(float), held["y"].to_numpy(float))
        model.offset += prior_shift(known, per_class)
    return model


def with_difference(docs: DataFrame, model: Model, text_col: str, out: str = "__difference") -> DataFrame:
    @F.pandas_udf("double")
    def difference(texts: pd.Series) -> pd.Series:
        return texts.map(model.difference, na_action=None).astype("float64")
    return docs.withColumn(out, difference(text_or_empty(text_col)))


def _free(docs: DataFrame, name: str) -> str:
    """``name``, or a longer one where ``docs`` has such a column."""
    while name.lower() in [c.lower() for c in docs.columns]:
        name += "_"
    return name


def with_score(docs: DataFrame, model: Model, text_col: str = "text", out: str = "score") -> DataFrame:
    """``docs`` with the score of each whole text, 0 to 1."""
    if model.constant is not None:
        return docs.withColumn(out, F.lit(model.constant))
    at = _free(docs, "__difference")
    z = F.lit(model.slope) * F.col(at) + F.lit(model.offset)
    return with_difference(docs, model, text_col, at).withColumn(out, 1 / (1 + F.exp(-z))).drop(at)


def score_toxicity(docs: DataFrame, labels: DataFrame, id_col: str = "doc_id", text_col: str = "text",
                   label_id: str = "doc_id", label: str = "toxic") -> DataFrame:
    """One row per document: id, held_out, score, predicted."""
    model = fit(docs, labels, id_col, text_col, label_id, label)
    slim = docs.select(F.col(id_col), F.col(text_col).alias("__text"))
    scored = with_score(slim, model, "__text")
    return scored.select(id_col, F.coalesce(fold(id_col) == 0, F.lit(False)).alias("held_out"), "score",
                         F.when(F.col("score") >= 0.5, 1).otherwise(0).alias("predicted"))


def keep_ordinary(docs: DataFrame, labels: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """The documents that score below 0.5, with all their columns."""
    model = fit(docs, labels, id_col, text_col)
    at = _free(docs, "__score")
    return with_score(docs, model, text_col, at).where(F.col(at) < 0.5).drop(at)
