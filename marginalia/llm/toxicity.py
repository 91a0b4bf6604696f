"""Toxicity by weak supervision.

1. *Voters.* Words, word beginnings, beginnings several words share and beginnings dense in a text,
   that are far more frequent in texts labelled toxic, make a lexicon each; every lexicon is a voter, and so
   are a public list of insults, patterns (insults addressed to someone, shouting, runs of
   exclamation marks) and the annotator. Each says toxic, clean or nothing about a text.
2. *Label model.* A generative model, in which a hidden class makes each voter speak and say what
   it says, is fitted by expectation maximisation from the voters' majority, without the annotator, who
   is a voter among the others and no more. Voters that agree more than the class explains
   (correlation of what is left once the class is known) share one vote's weight.
3. *Classifier.* A sparse logistic regression on words and word beginnings is trained on the
   label model's posterior, and gives the score of every whole text.

Fitted on a bounded sample of labelled rows (``TEXTS_PER_CLASS`` of each class); the share of the
classes among all labelled rows is counted. Scoring needs neither labels nor a shuffle.

Defined cases: NULL and empty texts have the score of a text without any sign; without labels
of both classes every text has score 0; rows that repeat score alike; an empty table gives no rows;
other columns are not looked at.
"""

from __future__ import annotations

import math
import re
from collections import Counter
from collections.abc import Callable, Iterator
from dataclasses import dataclass
from zlib import crc32

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from marginalia.llm.batches import pieces, texts_of
from marginalia.llm.samples import per_class

# Bound of the training sample, and of the model.
TEXTS_PER_CLASS = 2500
FEATURES = 4096
# Kinds of signs: a word, its beginning, one that several words have, one dense in the text.
KINDS = ("", "*", "**", "%")
BEGINNINGS = (4, 5, 6, 7, 8)
LEAST_TEXTS = 3
LEAST_EVIDENCE = 18.0
SKETCH = 16
DENSE = 120
# Voters that the hidden class explains but for less than this have nothing left to correlate.
LEAST_SPREAD = 0.05
THRESHOLD = 0.7

_WORD = re.compile(r"[^\W\d_]+")
_SHOUTED = re.compile(r"\b[A-Z]{3,}\b(?:\W+[A-Z]{3,}\b){2,}")
_EXCLAIMED = re.compile(r"[!?]{3,}")
_ADDRESSED = re.compile(r"\byou(?:'re| are)? (?:an? |such an? |all )?(\w+)", re.IGNORECASE)
_CALLED = re.compile(r"\b(?:is|are|was|were) (?:an? )?(\w+)", re.IGNORECASE)

# A small public list of insults, used as one voter.
INSULTS = [
    "asshole", "bastard", "bitch", "clown", "coward", "cretin", "disgusting", "dumb", "fool", "garbage",
    "idiot", "imbecile", "jerk", "loser", "moron", "pathetic", "pig", "scum", "stupid", "trash",
    "ugly", "vermin", "worthless",
]
_INSULTS = frozenset(crc32(word.encode()) for word in INSULTS)


def signs(text: str, stems: frozenset[str] | None = None) -> set[str]:
    """Lower-cased words, and their beginnings: ``x*`` if there is one, ``x**`` if there are
    several words that begin so, ``x%`` if at least one in DENSE words does.

    ``stems``, if given, are the only beginnings that are looked at.
    """
    words = Counter(_WORD.findall(text.lower()))
    found = set(words)
    begun: Counter[str] = Counter()
    if stems is None or not stems.isdisjoint(w[:n] for n in BEGINNINGS for w in found):
        for word, n_times in words.items():
            for n in BEGINNINGS:
                if len(word) > n and (stems is None or word[:n] in stems):
                    begun[word[:n]] += n_times
    least = words.total() / DENSE
    for stem, n_times in begun.items():
        found.add(stem + "*")
        if n_times > 1:
            found.add(stem + "**")
        if n_times >= least:
            found.add(stem + "%")
    return found


def hashed(found: set[str]) -> np.ndarray:
    """Signs as sorted numbers: what is kept of a text while training."""
    return np.unique(np.fromiter((crc32(s.encode()) for s in found), np.uint32, len(found)))


def _distinct(found: list[np.ndarray]) -> list[int]:
    """Rows of the sample that are no near copy of an earlier one.

    Two texts count as copies if they share half of the SKETCH least hashes of their signs. A
    text that was copied a hundred times would otherwise make evidence of all its words.
    """
    holders: dict[int, list[int]] = {}
    kept = []
    for i, own in enumerate(found):
        sketch = own[:SKETCH].tolist()
        shared = Counter(j for h in sketch for j in holders.get(h, ()))
        if sketch and max(shared.values(), default=0) * 2 >= len(sketch):
            continue
        kept.append(i)
        for h in sketch:
            holders.setdefault(h, []).append(i)
    return kept


def _pick(found: list[np.ndarray], toxic: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Signs whose counts tell the classes apart beyond chance, and their log odds.

    Evidence is the likelihood ratio statistic of a sign's two counts; among the
    many signs of a sample, LEAST_EVIDENCE is hardly reached by accident.
    """
    of = [np.concatenate([f for f, t in zip(found, toxic) if t == which]) for which in (True, False)]
    n1, n0 = int(toxic.sum()), int((~toxic).sum())
    seen, total = np.unique(np.concatenate(of), return_counts=True)
    seen = seen[total >= LEAST_TEXTS]
    counts = []
    for part in of:
        some, n = np.unique(part, return_counts=True)
        at = np.searchsorted(some, seen).clip(max=len(some) - 1)
        counts.append(np.where(some[at] == seen, n[at], 0).astype(float))
    a, b = counts
    evidence = np.zeros(len(seen))
    for part, size, both in ((a, n1, a + b), (b, n0, a + b), (n1 - a, n1, n1 + n0 - a - b), (n0 - b, n0, n1 + n0 - a - b)):
        share = size * both / (n1 + n0)
        evidence += 2 * np.where(part > 0, part * np.log(np.maximum(part, 1) / np.maximum(share, 1e-9)), 0)
    odds = np.log((a + 0.5) / (n1 - a + 0.5)) - np.log((b + 0.5) / (n0 - b + 0.5))
    order = np.lexsort((seen, -evidence))
    order = order[evidence[order] >= LEAST_EVIDENCE][:FEATURES]
    return seen[order], odds[order]


def _kind(sign: str) -> str:
    return sign[len(sign.rstrip("*%")) :]


@dataclass(frozen=True)
class Voters:
    """Lexicons of toxic signs (hashed), one for each kind of sign, and patterns."""

    lexicons: list[frozenset[int]]
    known: frozenset[int]

    @classmethod
    def of(cls, chosen: np.ndarray, odds: np.ndarray, names: dict[int, str]) -> Voters:
        toxic = chosen[odds > 1.5].tolist()
        return cls([frozenset(h for h in toxic if _kind(names[h]) == kind) for kind in KINDS], frozenset(toxic))

    def votes(self, text: str, own: np.ndarray) -> list[int]:
        """1 toxic, -1 clean, 0 no opinion."""
        signs_here = set(own.tolist())
        said_of_someone = {
            crc32(m.lower().encode()) for pattern in (_ADDRESSED, _CALLED) for m in pattern.findall(text)
        }
        return [
            *(1 if signs_here & lexicon else -1 for lexicon in self.lexicons),
            1 if signs_here & _INSULTS else 0,
            1 if said_of_someone & _INSULTS or said_of_someone & self.known else 0,
            1 if _SHOUTED.search(text) else 0,
            1 if _EXCLAIMED.search(text) else 0,
            -1 if not signs_here & _INSULTS else 0,
        ]


def label_model(
    votes: np.ndarray, prior: float, start: np.ndarray | None = None, rounds: int = 15
) -> tuple[np.ndarray, np.ndarray]:
    """Posterior of toxic for each row, and each voter's accuracy.

    ``votes`` holds 1, -1 or 0 for each text and voter. A voter says each of the three with a
    probability that depends on the hidden class alone; correlated voters are weighed down.
    ``start`` is a first guess of the posterior. Correlations are taken once, given that guess, or
    given the classes of a first fit that starts from the majority.
    """
    n, m = votes.shape
    said = np.stack([votes == v for v in (-1, 0, 1)]).astype(float)
    posterior = start if start is not None else np.clip(prior * 0.5 + 0.5 * (votes.sum(axis=1) > 0), 0.02, 0.98)
    settled = 0 if start is not None else rounds
    weight = np.ones(m)
    for step in range(settled + rounds):
        classes = np.stack([1 - posterior, posterior])
        chance = (np.einsum("cn,vnm->cvm", classes, said) + 0.5) / (classes.sum(axis=1)[:, None, None] + 1.5)
        if step == settled:
            rest = votes - np.einsum("cn,cm->nm", classes, chance[:, 2] - chance[:, 0])
            rest -= rest.mean(axis=0)
            rest /= np.maximum(rest.std(axis=0), LEAST_SPREAD)
            correlation = np.abs(rest.T @ rest / n)
            np.fill_diagonal(correlation, 0)
            weight = 1 / (1 + np.where(correlation > 0.2, correlation, 0).sum(axis=1))
        evidence = np.einsum("vnm,vm,m->n", said, np.log(chance[1] / chance[0]), weight)
        posterior = 1 / (1 + np.exp(-np.clip(evidence + math.log(prior / (1 - prior)), -30, 30)))
    right = (votes > 0) * posterior[:, None] + (votes < 0) * (1 - posterior)[:, None]
    return posterior, right.sum(axis=0) / np.maximum((votes != 0).sum(axis=0), 1)


def believed(votes: np.ndarray, toxic: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Posterior of toxic and the voters' accuracies, the annotator's last.

    The first guess is what most voters say; ``toxic``, the annotator's answers, only speaks beside
    them and sets the share of toxic texts.
    """
    most = np.where(votes.sum(axis=1) > 0, 0.98, 0.02)
    return label_model(np.column_stack([votes, 2 * toxic.astype(int) - 1]), float(toxic.mean()), most)


@dataclass(frozen=True)
class Classifier:
    weights: dict[str, float]
    bias: float
    accuracies: list[float]

    def scorer(self) -> Callable[[str], float]:
        known = self.weights.keys()
        stems = frozenset(s.rstrip("*%") for s in known if s[-1] in "*%")

        def score(text: str) -> float:
            total = self.bias + sum(map(self.weights.__getitem__, sorted(known & signs(text, stems))))
            return 1 / (1 + math.exp(-max(-30.0, min(30.0, total))))

        return score


def _regression(rows: list[list[int]], width: int, target: np.ndarray, weight: np.ndarray) -> tuple[np.ndarray, float]:
    """Logistic regression with a ridge by full-batch Adam on sparse presence features."""
    column = np.array([c for r in rows for c in r], np.int64)
    row = np.repeat(np.arange(len(rows)), [len(r) for r in rows])
    w, bias = np.zeros(width + 1), 0.0
    m, v = np.zeros(width + 1), np.zeros(width + 1)
    weight = weight / weight.sum()
    for step in range(1, 301):
        z = np.bincount(row, w[column], len(rows)) + w[width]
        error = weight * (1 / (1 + np.exp(-np.clip(z, -30, 30))) - target)
        grad = np.bincount(column, error[row], width + 1) + 1e-5 * w
        grad[width] = error.sum()
        m = 0.9 * m + 0.1 * grad
        v = 0.99 * v + 0.01 * grad * grad
        w = w - 0.1 * (m / (1 - 0.9**step)) / (np.sqrt(v / (1 - 0.99**step)) + 1e-7)
    bias = float(w[width])
    return w[:width], bias


def train(texts: list[str], toxic: np.ndarray, class_sizes: np.ndarray) -> Classifier | None:
    """``class_sizes``: for each text, how many labelled rows there are of its class."""
    found = [hashed(signs(t)) for t in texts]
    kept = _distinct(found)
    texts, found = [texts[i] for i in kept], [found[i] for i in kept]
    toxic, class_sizes = toxic[kept], class_sizes[kept]
    if not toxic.any() or toxic.all():
        return None
    chosen, odds = _pick(found, toxic)
    number = {h: i for i, h in enumerate(chosen.tolist())}
    rows = [[number[h] for h in own[np.isin(own, chosen)].tolist()] for own in found]
    names: dict[int, str] = {}
    for text, own in zip(texts, rows):
        if not names.keys() >= {int(chosen[i]) for i in own}:
            names |= {h: s for s in signs(text) if (h := crc32(s.encode())) in number}
    voters = Voters.of(chosen, odds, names)
    posterior, accuracies = believed(np.array([voters.votes(t, f) for t, f in zip(texts, found)]), toxic)
    sampled = np.where(toxic, toxic.sum(), (~toxic).sum())
    weights, bias = _regression(rows, len(chosen), posterior, class_sizes / sampled)
    kept_weights = {names[h]: float(weights[i]) for h, i in number.items() if abs(weights[i]) > 1e-3}
    return Classifier(kept_weights, bias, accuracies.tolist())


def fit(docs: DataFrame, labels: DataFrame, label: str = "toxic", key: str = "doc_id") -> Classifier | None:
    """``labels`` has the ids and classes (0 or 1) to learn from; NULL classes do not count.

    Of rows that repeat an id the least text counts, so the driver gets one text for each label.
    """
    known = labels.select(F.col(key), F.col(label).cast("int").alias("label")).filter(F.col("label").isin(0, 1))
    sampled = per_class(known, "label", key, TEXTS_PER_CLASS)
    texts = docs.select(F.col(key), F.coalesce("text", F.lit("")).alias("text")).join(F.broadcast(sampled), key)
    rows = texts.groupBy(key, "label", "class_size").agg(F.min("text").alias("text")).collect()
    rows = sorted(rows, key=lambda r: (str(r[key]), r["label"], r["text"]))
    return train(
        [r["text"] for r in rows],
        np.array([r["label"] == 1 for r in rows], bool),
        np.array([r["class_size"] for r in rows], float),
    )


def score(docs: DataFrame, model: Classifier | None, key: str = "doc_id", text: str = "text") -> DataFrame:
    """key, score (0 to 1) of every whole text."""
    key_type = docs.schema[key].dataType.simpleString()

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        of = model.scorer() if model else lambda _: 0.0
        for piece in pieces(batches):
            found = pa.array([of(t) for t in texts_of(piece)], pa.float64())
            yield pa.RecordBatch.from_arrays([piece.column("key"), found], names=["key", "score"])

    out = docs.select(F.col(key).alias("key"), F.col(text).alias("text")).mapInArrow(run, f"key {key_type}, score double")
    return out.withColumnRenamed("key", key)


def keep_clean(docs: DataFrame, model: Classifier | None, threshold: float = THRESHOLD) -> DataFrame:
    """Documents, with all their columns, that score below ``threshold``."""

    @F.pandas_udf("double")
    def scores(batches: Iterator[pd.Series]) -> Iterator[pd.Series]:
        of = model.scorer() if model else lambda _: 0.0
        for texts in batches:
            yield pd.Series([of(t or "") for t in texts], dtype=float)

    return docs.filter(scores(F.col("text")) < threshold)
