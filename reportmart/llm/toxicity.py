"""Toxic spans by a linear-chain conditional random field.

Labels come by document, the chain needs them by token. So features that nearly only
toxic documents have - words and beginnings of words - are found first, and the tokens
that have one in a toxic document are labelled. A chain with two states is then fitted to
these tokens. Forward and backward passes give each token's probability of being toxic;
likely ones that follow each other are a span. A document's score is a logistic function
of its largest probability, their sum, and its length.

Fitting happens on the driver, on a bounded sample of labelled documents (``ROWS`` of each
class, of at most ``CHARS`` characters, chosen by a hash of their id). Scoring reads whole
texts in tasks, without a shuffle.

With two states, a forward message is one ratio r, and a step of the pass is
r' = exp(e) (t01 + r t11) / (t00 + r t10). Many documents take the same step at once.
"""

from __future__ import annotations

import re
from collections import Counter
from collections.abc import Iterable, Iterator
from dataclasses import dataclass, field

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, functions as F

from .common import text_of
from .words import Kept

ROWS = 2000
CHARS = 10_000
CHAIN_ROWS = 1000
THRESHOLD = 0.3
TOKEN = re.compile(r"\S+")
PREFIXES = (4, 5, 6)
MOST = 30.0


def tokens_of(text: str) -> Iterator[list[str]]:
    """The tokens of a text between white space, in parts of about a megabyte."""
    at = 0
    while at < len(text):
        stop = at + (1 << 20)
        while stop < len(text) and not text[stop].isspace():
            stop += 1
        yield text[at:stop].split()
        at = stop


def features(token: str) -> list[str]:
    """The word of a token and its beginnings."""
    word = token.strip(".,;:!?|()[]\"'").lower()
    return ["=" + word, *["^" + word[:n] for n in PREFIXES if len(word) >= n]]


class Steps:
    """Places of all tokens of several documents when these are sorted by falling length
    and read step by step: step t has the token t of all documents that have one."""

    def __init__(self, lengths: np.ndarray) -> None:
        order = np.argsort(-lengths, kind="stable")
        rank = np.empty(len(lengths), np.int64)
        rank[order] = np.arange(len(lengths))
        falling = lengths[order]
        longest = int(falling[0]) if len(falling) else 0
        self.active = np.searchsorted(-falling, -np.arange(longest), side="left")
        self.base = np.concatenate([[0], np.cumsum(self.active)]).astype(np.int64)
        starts = np.cumsum(lengths) - lengths
        step = np.arange(int(lengths.sum())) - np.repeat(starts, lengths)
        self.place = self.base[step] + np.repeat(rank, lengths)

    def spans(self) -> Iterator[tuple[int, int]]:
        return zip(self.base[:-1].tolist(), self.base[1:].tolist())


def passes(
    odds: np.ndarray, steps: Steps, start: float, move: np.ndarray
) -> tuple[np.ndarray, np.ndarray]:
    """Forward and backward ratios; ``odds`` are exp(e) in the order of ``steps``."""
    (t00, t01), (t10, t11) = move
    forward, backward = np.empty_like(odds), np.ones_like(odds)
    spans = list(steps.spans())
    r = None
    for low, high in spans:
        now = odds[low:high]
        if r is None:
            r = now * start
        else:
            r = r[: high - low]
            r = now * (t01 + r * t11) / (t00 + r * t10)
        forward[low:high] = r
    for (low, _), (next_low, next_high) in zip(reversed(spans[:-1]), reversed(spans[1:])):
        x = odds[next_low:next_high] * backward[next_low:next_high]
        backward[low : low + next_high - next_low] = (t10 + t11 * x) / (t00 + t01 * x)
    return forward, backward


@dataclass
class ToxicityModel:
    """A fitted chain and the logistic function on top of it."""

    weights: dict[str, float] = field(default_factory=dict)
    bias: float = -MOST
    start: float = 1.0
    move: np.ndarray = field(default_factory=lambda: np.ones((2, 2)))
    document: np.ndarray = field(default_factory=lambda: np.zeros(4))

    def evidence(self, token: str) -> float:
        return self.bias + sum(self.weights.get(f, 0.0) for f in features(token))

    def probabilities(self, evidence: list[np.ndarray]) -> list[np.ndarray]:
        """Each token's probability of being toxic, by document."""
        lengths = np.array([len(e) for e in evidence], np.int64)
        if not lengths.sum():
            return evidence
        steps = Steps(lengths)
        odds = np.empty(int(lengths.sum()))
        odds[steps.place] = np.exp(np.clip(np.concatenate(evidence), -MOST, MOST))
        forward, backward = passes(odds, steps, self.start, self.move)
        both = (forward * backward)[steps.place]
        return np.split(both / (1 + both), np.cumsum(lengths)[:-1])

    def scores(self, probabilities: list[np.ndarray]) -> np.ndarray:
        return 1 / (1 + np.exp(-np.clip(document_features(probabilities) @ self.document, -50, 50)))


def document_features(probabilities: list[np.ndarray]) -> np.ndarray:
    rows = [
        (
            1.0,
            np.log(1e-4 + (p.max() if len(p) else 0.0)),
            np.log1p(p.sum()),
            np.log1p(len(p)),
        )
        for p in probabilities
    ]
    return np.array(rows).reshape(-1, 4)


def telling_features(
    texts: list[str], toxic: np.ndarray, weight_clean: float
) -> tuple[set[str], list[str]]:
    """Features that at least one in a hundred toxic documents has, and hardly any other:
    at least four in five of the documents with it are toxic. And the commonest words."""

    def count(label: bool, wanted: Counter | None = None) -> Counter:
        found: Counter = Counter()
        for text, own in zip(texts, toxic):
            if own == label:
                bag = {f for part in tokens_of(text) for t in set(part) for f in features(t)}
                found.update(bag if wanted is None else bag & wanted.keys())
        return found

    with_it = count(True)
    common = [f for f, _ in with_it.most_common(8000) if f[0] == "="][:2000]
    least = max(3, 0.01 * toxic.sum())
    with_it = Counter({f: n for f, n in with_it.items() if n >= least})
    without = count(False, with_it)
    telling = {
        f
        for f, n in with_it.items()
        if (n + 0.5) / (n + 1 + weight_clean * without[f]) >= 0.8
    }
    return telling, common


def fit(texts: list[str], toxic: np.ndarray, weight_clean: float = 1.0) -> ToxicityModel:
    """A model of whole texts and their labels. A clean text stands for ``weight_clean`` of
    them. With one class only, every score is the share of toxic texts."""
    n_toxic = int(toxic.sum())
    clean = weight_clean * (len(toxic) - n_toxic)
    share = (n_toxic + 0.5) / (n_toxic + clean + 1)
    if not n_toxic or n_toxic == len(toxic):
        return ToxicityModel(document=np.array([np.log(share / (1 - share)), 0.0, 0.0, 0.0]))
    telling, common = telling_features(texts, toxic, weight_clean)
    names = sorted(telling.union(common))
    number = {f: k for k, f in enumerate(names)}

    # The chain is fitted to some documents of each class, the shortest of them first.
    by_length = [i for i in sorted(range(len(texts)), key=lambda i: len(texts[i])) if texts[i].split()]
    own = [i for i in by_length if toxic[i]][:CHAIN_ROWS]
    own += [i for i in by_length if not toxic[i]][:CHAIN_ROWS]
    known: list[list[list[int]]] = []
    labels: list[list[bool]] = []
    for i in own:
        found = [features(t) for part in tokens_of(texts[i]) for t in part]
        known.append([[number[f] for f in fs if f in number] for fs in found])
        labels.append([bool(toxic[i]) and any(f in telling for f in fs) for fs in found])
    weights, bias, start, move = fit_chain(known, labels, len(names))
    model = ToxicityModel(dict(zip(names, weights.tolist())), bias, start, move)
    evidence = Kept(model.evidence, limit=100_000)
    found = model.probabilities(
        [np.array([evidence[t] for part in tokens_of(text) for t in part], float) for text in texts]
    )
    importance = np.where(toxic, 1.0, weight_clean)
    model.document = fit_logistic(document_features(found), toxic.astype(float), importance)
    return model


def fit_chain(
    token_features: list[list[list[int]]], labels: list[list[bool]], n_features: int
) -> tuple[np.ndarray, float, float, np.ndarray]:
    """Weights, bias, start ratio and transitions of largest regularised likelihood."""
    lengths = np.array([len(ts) for ts in token_features], np.int64)
    steps = Steps(lengths)
    flat = [fs for ts in token_features for fs in ts]
    of_token = np.repeat(np.arange(len(flat)), [len(fs) for fs in flat])
    of_feature = np.array([f for fs in flat for f in fs], np.int64)
    label = np.array([x for ls in labels for x in ls], float)
    first = np.cumsum(lengths) - lengths
    later = np.ones(len(flat), bool)
    later[first] = False
    later = np.flatnonzero(later)
    pair = (2 * label[later - 1] + label[later]).astype(int)
    seen = np.bincount(pair, minlength=4).astype(float)

    parameters = np.zeros(n_features + 6)  # weights, bias, start, transitions
    mean, square = np.zeros_like(parameters), np.zeros_like(parameters)
    for round_ in range(1, 81):
        weights, bias = parameters[:n_features], parameters[n_features]
        evidence = np.bincount(of_token, weights[of_feature], len(flat)) + bias
        odds = np.empty(len(flat))
        odds[steps.place] = np.exp(np.clip(evidence, -MOST, MOST))
        start, move = np.exp(parameters[-5]), np.exp(parameters[-4:]).reshape(2, 2)
        forward, backward = passes(odds, steps, start, move)
        forward, backward = forward[steps.place], backward[steps.place]
        both = forward * backward
        residual = label - both / (1 + both)
        into = odds[steps.place][later] * backward[later]
        r = forward[later - 1]
        expected = np.stack(
            [np.full(len(later), move[0, 0]), move[0, 1] * into, r * move[1, 0], r * move[1, 1] * into]
        )
        expected = (expected / expected.sum(axis=0)).sum(axis=1)
        gradient = np.concatenate(
            [
                np.bincount(of_feature, residual[of_token], n_features) - 0.1 * weights,
                [residual.sum(), residual[first].sum()],
                seen - expected,
            ]
        )
        mean = 0.9 * mean + 0.1 * gradient
        square = 0.99 * square + 0.01 * gradient**2
        rate = 0.3 / (1 + round_ / 40)
        scaled = mean / (1 - 0.9**round_) / (np.sqrt(square / (1 - 0.99**round_)) + 1e-8)
        parameters = np.clip(parameters + rate * scaled, -12, 12)
    start, move = np.exp(parameters[-5]), np.exp(parameters[-4:]).reshape(2, 2)
    return parameters[:n_features], float(parameters[n_features]), float(start), move


def fit_logistic(x: np.ndarray, y: np.ndarray, importance: np.ndarray) -> np.ndarray:
    """Weights of a lightly regularised logistic regression, by Newton's method."""
    weights = np.zeros(x.shape[1])
    for _ in range(30):
        p = 1 / (1 + np.exp(-np.clip(x @ weights, -30, 30)))
        gradient = x.T @ (importance * (y - p)) - 0.1 * weights
        hessian = (x * (importance * p * (1 - p) + 1e-9)[:, None]).T @ x
        weights = weights + np.linalg.solve(hessian + 0.1 * np.eye(len(weights)), gradient)
    return weights


def held_out(doc_id: Column) -> Column:
    """Whether labels of the document must not be learnt from."""
    return F.coalesce(F.crc32(doc_id.cast("string")) % 4 == 2, F.lit(False))


def train(
    docs: DataFrame,
    labels: DataFrame,
    *,
    id_col: str = "doc_id",
    text_col: str = "text",
    label_col: str = "toxic",
    rows: int = ROWS,
    chars: int = CHARS,
) -> ToxicityModel:
    """Fit on at most ``rows`` documents of each class with at most ``chars`` characters.

    Rows with a null id, text or label, or with ids held out, are not learnt from; a
    document with several labels is toxic if one says so."""
    known = labels.select(labels[id_col].alias("id"), labels[label_col].alias("label"))
    known = known.where("id is not null and label is not null").where(~held_out(F.col("id")))
    known = known.groupBy("id").agg((F.max("label") > 0).alias("toxic"))
    texts = docs.select(docs[id_col].alias("id"), docs[text_col].alias("text"))
    fits = texts.where("text is not null").select("id", F.length("text").alias("n"))
    fits = fits.where(F.col("n") <= chars).select("id").distinct()
    usable = known.join(fits, "id")
    n = {r["toxic"]: r["count"] for r in usable.groupBy("toxic").count().collect()}
    order = [F.xxhash64("id"), F.col("id")]
    chosen = [usable.where(F.col("toxic") == c).orderBy(*order).limit(rows) for c in (True, False)]
    # At most 2 * rows ids, whatever the size of the tables.
    chosen = F.broadcast(chosen[0].union(chosen[1]))
    sample = texts.join(chosen, "id").where(F.length("text") <= chars)
    sample = sample.groupBy("id").agg(F.max("text").alias("text"), F.max("toxic").alias("toxic"))
    found = sorted(((r["id"], r["text"], r["toxic"]) for r in sample.collect()))
    weight = max(1.0, n.get(False, 0) / max(1, min(rows, n.get(False, 0))))
    toxic_weight = max(1.0, n.get(True, 0) / max(1, min(rows, n.get(True, 0))))
    return fit(
        [text for _, text, _ in found],
        np.array([toxic for _, _, toxic in found], bool),
        weight / toxic_weight,
    )


def toxic_spans(text: str, probabilities: np.ndarray, least: float = 0.5) -> list[dict]:
    """Start, end and largest probability of runs of likely tokens, in code points."""
    likely = probabilities >= least
    if not likely.any():
        return []
    spans: list[dict] = []
    previous = -2
    for at, found in enumerate(TOKEN.finditer(text)):
        if not likely[at]:
            continue
        p = float(probabilities[at])
        if at == previous + 1:
            spans[-1]["end"] = found.end()
            spans[-1]["probability"] = max(p, spans[-1]["probability"])
        else:
            spans.append({"start": found.start(), "end": found.end(), "probability": p})
        previous = at
    return spans


def scored(
    model: ToxicityModel, evidence: Kept, texts: Iterable[str], tokens: int = 1_000_000
) -> Iterator[tuple[float, list[dict]]]:
    """Score and spans of each text; chains of up to ``tokens`` tokens run together.
    ``evidence`` keeps what the model says of a token."""
    waiting: list[str] = []
    found: list[np.ndarray] = []
    n = 0

    def results() -> Iterator[tuple[float, list[dict]]]:
        probabilities = model.probabilities(found)
        for text, p, score in zip(waiting, probabilities, model.scores(probabilities)):
            yield float(score), toxic_spans(text, p)

    for text in texts:
        parts = [np.array([*map(evidence.__getitem__, part)], float) for part in tokens_of(text)]
        waiting.append(text)
        found.append(np.concatenate(parts) if parts else np.zeros(0))
        n += len(found[-1])
        if n >= tokens:
            yield from results()
            waiting, found, n = [], [], 0
    if waiting:
        yield from results()


def score(
    docs: DataFrame,
    model: ToxicityModel,
    *,
    id_col: str = "doc_id",
    text_col: str = "text",
    threshold: float = THRESHOLD,
) -> DataFrame:
    """Per row: ``id_col``, ``held_out``, ``score`` from 0 to 1, ``predicted``, and ``spans`` with
    their offsets in code points.

    Null text counts as empty and gets the score of a text without words. Rows that repeat
    an id are scored one by one; a null id is not held out; other columns are not read."""
    id_type = docs.schema[id_col].dataType
    rows = docs.select(docs[id_col].cast("string").alias("id"), text_of(docs, text_col).alias("t"))
    span = pa.struct([("start", pa.int64()), ("end", pa.int64()), ("probability", pa.float64())])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        evidence = Kept(model.evidence)
        for whole in batches:
            for at in range(0, whole.num_rows, 2048):
                part = whole.slice(at, 2048)
                found = list(scored(model, evidence, part.column(1).to_pylist()))
                yield pa.RecordBatch.from_arrays(
                    [
                        part.column(0),
                        pa.array([s for s, _ in found], pa.float64()),
                        pa.array([spans for _, spans in found], pa.list_(span)),
                    ],
                    names=["id", "score", "spans"],
                )

    found = rows.mapInArrow(
        run, "id string, score double, spans array<struct<start:long,end:long,probability:double>>"
    )
    return found.select(
        F.col("id").cast(id_type).alias(id_col),
        held_out(F.col("id")).alias("held_out"),
        "score",
        F.when(F.col("score") >= threshold, 1).otherwise(0).alias("predicted"),
        "spans",
    )


def without_toxic(
    docs: DataFrame, model: ToxicityModel, *, text_col: str = "text", threshold: float = THRESHOLD
) -> DataFrame:
    """The rows of ``docs`` with a score below ``threshold``, with all their columns."""
    at = docs.columns.index(text_col)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        evidence = Kept(model.evidence)
        for whole in batches:
            for start in range(0, whole.num_rows, 2048):
                part = whole.slice(start, 2048)
                texts = (text or "" for text in part.column(at).to_pylist())
                kept = [s < threshold for s, _ in scored(model, evidence, texts)]
                yield part.filter(pa.array(kept, pa.bool_()))

    return docs.mapInArrow(run, docs.schema)
