"""Toxic spans by a linear-chain conditional random field, and document scores.

Fitting (driver, numpy) sees a bounded sample of labelled rows: `most_toxic` and
`most_clean` rows by least digest of their id, and has `most_features` weights at
most, those of the features that tell most; all three are parameters of train(). A token of a toxic document is
labelled toxic when one of its features (the word, its beginnings, its ends)
occurs in toxic documents more often than chance allows; all other tokens are
labelled clean. The field has two states, weights for the selected features and
for the transitions, and is fitted to these token labels by its gradient, from
forward-backward marginals. A logistic curve over the largest marginal and their
sum, fitted to the documents' labels, gives the score.

Scoring runs where the rows lie. Tokens of many documents lie in one flat array;
the forward and backward messages are prefix products of 2x2 matrices, where a
document's first matrix has equal rows and so forgets what came before it.

Defined results: null and empty texts get the score of a text without toxic
tokens; without labels of both classes the score is the share of toxic ones (0
if there are none); null ids and null labels are never fitted to; repeated rows
repeat; very long texts are scored whole; an empty table gives an empty table.
Ties: of ids with equal digests the lesser is sampled first, of rows of one id the
least text; a score equal to the threshold is toxic. Columns of the caller named
score or toxic_spans give way, all other names are free.
"""

from __future__ import annotations

import re
import zlib
from collections import Counter
from collections.abc import Iterator
from dataclasses import dataclass, field
from functools import partial
from hashlib import sha256

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

WORD = re.compile(r"\w+")
THRESHOLD = 0.7
MOST_TOXIC, MOST_CLEAN, MOST_FEATURES = 1200, 2400, 4000
FALSE_SHARE = 0.01
KEPT_WORDS = 100_000
SLICE_CHARS = 1 << 20
STEPS = 40


def features(word: str) -> list[str]:
    """The word, its beginnings of 3 to 9 letters and its ends of 4 and 5."""
    w = word.lower()
    return [f"={w}", *(f"<{w[:n]}" for n in range(3, 10) if len(w) >= n), *(f">{w[-n:]}" for n in (4, 5) if len(w) >= n)]


@dataclass
class Model:
    prior: float = 0.0
    fitted: bool = False
    weights: dict[str, float] = field(default_factory=dict)
    bias: float = 0.0
    #: log-potentials of the transitions, clean first
    trans: np.ndarray = field(default_factory=lambda: np.zeros((2, 2)))
    #: of 1, the largest marginal, and log(1 + their sum)
    curve: np.ndarray = field(default_factory=lambda: np.zeros(3))

    #: tells fitted models apart
    mark: str = ""

    def odds(self, word: str) -> float:
        get = self.weights.get
        return self.bias + sum(get(f, 0.0) for f in features(word))


def marginals(emit: np.ndarray, starts: np.ndarray, trans: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """P(toxic) of each token and the expected transitions, summed.

    emit: log-odds of each token, documents end to end; starts: where they begin.
    """
    n = len(emit)
    width = max(1, int(np.sqrt(n)))
    rows = -(-n // width)
    # step j of all rows lies together: [j, row] for each entry (0, 0), (0, 1), (1, 0), (1, 1)
    pot = np.exp(trans)
    odds = np.exp(np.clip(emit, -30, 30))
    flat = np.zeros((4, rows * width))
    scale = 1 / (1 + odds)
    for q, (i, j) in enumerate(((0, 0), (0, 1), (1, 0), (1, 1))):
        first = scale * (odds if j else 1.0)
        flat[q, :n] = pot[i, j] * first
        flat[q, starts] = first[starts]
    flat[0, n:] = flat[3, n:] = 1.0
    m = np.ascontiguousarray(flat.reshape(4, rows, width).transpose(0, 2, 1))

    def times(a: np.ndarray, b: np.ndarray) -> np.ndarray:
        out = np.stack([a[0] * b[0] + a[1] * b[2], a[0] * b[1] + a[1] * b[3], a[2] * b[0] + a[3] * b[2], a[2] * b[1] + a[3] * b[3]])
        return out / out.sum(axis=0)

    pre, suf = np.empty_like(m), np.empty_like(m)
    pre[:, 0] = m[:, 0]
    suf[:, -1] = np.array([1.0, 0.0, 0.0, 1.0])[:, None]
    for j in range(1, width):
        pre[:, j] = times(pre[:, j - 1], m[:, j])
        suf[:, width - 1 - j] = times(m[:, width - j], suf[:, width - j])
    into, back = np.empty((2, rows)), np.empty((2, rows))
    last, whole = pre[:, -1].T.tolist(), times(m[:, 0], suf[:, 0]).T.tolist()
    x, y = 0.5, 0.5
    for r, (a, b, c, d) in enumerate(last):
        into[:, r] = x, y
        x, y = x * a + y * c, x * b + y * d
        x, y = x / (x + y), y / (x + y)
    x, y = 0.5, 0.5
    for r in range(rows - 1, -1, -1):
        a, b, c, d = whole[r]
        back[:, r] = x, y
        x, y = a * x + b * y, c * x + d * y
        x, y = x / (x + y), y / (x + y)

    def line(v: np.ndarray) -> np.ndarray:
        return v.T.reshape(-1)[:n]

    alpha = line(into[0] * pre[0] + into[1] * pre[2]), line(into[0] * pre[1] + into[1] * pre[3])
    beta = line(suf[0] * back[0] + suf[1] * back[1]), line(suf[2] * back[0] + suf[3] * back[1])
    p = alpha[1] * beta[1] / (alpha[0] * beta[0] + alpha[1] * beta[1])
    inner = np.ones(n, bool)
    inner[starts] = False
    at = np.flatnonzero(inner)
    pair = np.stack([alpha[i][at - 1] * flat[2 * i + j, at] * beta[j][at] for i in (0, 1) for j in (0, 1)])
    return p, (pair / pair.sum(axis=0)).sum(axis=1).reshape(2, 2)


def summary(p: np.ndarray, starts: np.ndarray) -> np.ndarray:
    """Of each document: 1, the largest marginal, log(1 + their sum)."""
    return np.stack([np.ones(len(starts)), np.maximum.reduceat(p, starts), np.log1p(np.add.reduceat(p, starts))], axis=1)


def distinct(docs: list[list[str]], most_shared: float = 0.3) -> list[int]:
    """Places of the documents most of whose word triples no earlier one has: copies would pass for evidence."""
    seen: set[int] = set()
    out = []
    for i, d in enumerate(docs):
        own = {zlib.crc32(" ".join(x).encode("utf-8", "surrogatepass")) for x in zip(d, d[1:], d[2:])} or {zlib.crc32(" ".join(d).encode("utf-8", "surrogatepass"))}
        if len(own & seen) <= most_shared * len(own):
            out.append(i)
        seen |= own
    return out


def token_features(docs: list[list[str]], toxic: np.ndarray, most: int) -> dict[str, float]:
    """Features more frequent in toxic documents than chance allows, with their log-odds."""
    bad, all_ = Counter(), Counter()
    for words, t in zip(docs, toxic):
        if t:
            bad.update({f for w in set(words) for f in features(w)})
    tests = sum(n > 1 for n in bad.values())
    bad = Counter({f: n for f, n in bad.items() if n > 2})
    for words in docs:
        all_.update({f for w in set(words) for f in features(w) if f in bad})
    rate = toxic.mean()
    names = list(bad)
    if not names:
        return {}
    k, n = np.array([bad[f] for f in names], float), np.array([all_[f] for f in names], float)
    q = k / n
    with np.errstate(divide="ignore", invalid="ignore"):
        gain = n * (np.where(q > 0, q * np.log(q / rate), 0) + np.where(q < 1, (1 - q) * np.log((1 - q) / (1 - rate)), 0))
    # Benjamini-Hochberg: of the features taken, chance gives FALSE_SHARE at most
    by_gain = -np.sort(-gain)
    passing = np.flatnonzero(-by_gain <= np.log(FALSE_SHARE * np.arange(1, len(gain) + 1) / tests))
    good = (q > 0.8) & (gain >= by_gain[passing[-1]]) if len(passing) else np.zeros(len(gain), bool)
    order = [i for i in np.argsort(-gain) if good[i]][:most]
    return {names[i]: float(np.log((k[i] + 0.5) / (n[i] - k[i] + 0.5))) for i in order}


def _transitions(theta: np.ndarray) -> np.ndarray:
    return np.array([[0.0, theta[-3]], [theta[-2], theta[-1]]])


def _batches(held: list, most: int = 200_000) -> Iterator[list]:
    """Runs of documents of about `most` tokens, so that fitting needs little memory."""
    own, size = [], 0
    for doc in held:
        own.append(doc)
        size += len(doc[0])
        if size >= most:
            yield own
            own, size = [], 0
    if own:
        yield own


class _Part:
    """Tokens of some documents end to end: where their features are, and their labels."""

    def __init__(self, held: list, column: dict[str, int]):
        sizes = [len(d) for d, _ in held]
        self.size, self.starts = sum(sizes), np.cumsum([0, *sizes])[:-1]
        known: dict[str, list[int]] = {}
        row, col, at = [], [], 0
        for d, _ in held:
            for w in d:
                own = known.get(w)
                if own is None:
                    own = known[w] = [column[f] for f in features(w) if f in column]
                row += [at] * len(own)
                col += own
                at += 1
        self.row, self.col, self.width = np.array(row, np.int64), np.array(col, np.int64), len(column)
        tag = np.zeros(self.size, bool)
        tag[self.row] = True
        tag &= np.repeat([bool(t) for _, t in held], sizes)
        inner = np.ones(self.size, bool)
        inner[self.starts] = False
        pairs = np.zeros((2, 2))
        np.add.at(pairs, (tag[:-1][inner[1:]].astype(int), tag[1:][inner[1:]].astype(int)), 1)
        self.want = np.r_[self.sums(tag.astype(float)), tag.sum(), pairs.ravel()[1:]]

    def sums(self, p: np.ndarray) -> np.ndarray:
        return np.bincount(self.col, weights=p[self.row], minlength=self.width)

    def marginals(self, theta: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        emit = theta[-4] + np.bincount(self.row, weights=theta[:-4][self.col], minlength=self.size)
        return marginals(emit, self.starts, _transitions(theta))

    def gradient(self, theta: np.ndarray) -> np.ndarray:
        p, moves = self.marginals(theta)
        return self.want - np.r_[self.sums(p), p.sum(), moves.ravel()[1:]]


def fit(texts: list[str | None], labels: list[int], most_features: int = MOST_FEATURES) -> Model:
    """Fits the field and the curve to labelled texts."""
    toxic = np.array(labels, bool)
    model = Model(prior=float(toxic.mean()) if len(toxic) else 0.0)
    if not toxic.any() or toxic.all():
        return model
    docs = [WORD.findall(t or "") for t in texts]
    use = distinct(docs)
    docs, toxic = [docs[i] for i in use], toxic[use]
    if not toxic.any() or toxic.all():
        return model
    names = token_features(docs, toxic, most_features)
    held = [(d, t) for d, t in zip(docs, toxic) if d]
    if not names or not held:
        return model
    column = {f: i for i, f in enumerate(names)}
    parts = [_Part(own, column) for own in _batches(held)]
    # Adam on the log-likelihood with a weak Gaussian prior
    theta = np.r_[np.zeros(len(names)), -2.0, 0.0, 0.0, 0.0]
    mean, var = np.zeros_like(theta), np.zeros_like(theta)
    for step in range(1, STEPS + 1):
        grad = sum(part.gradient(theta) for part in parts) - 0.05 * theta
        mean, var = 0.9 * mean + 0.1 * grad, 0.99 * var + 0.01 * grad**2
        theta = theta + 0.3 * (mean / (1 - 0.9**step)) / (np.sqrt(var / (1 - 0.99**step)) + 1e-8)
    model.weights = {f: float(theta[i]) for f, i in column.items()}
    model.bias = float(theta[-4])
    model.trans = _transitions(theta)
    x = np.concatenate([summary(part.marginals(theta)[0], part.starts) for part in parts])
    y = np.array([t for _, t in held], float)
    c = np.zeros(3)
    for _ in range(40):  # Newton steps with a weak prior
        s = 1 / (1 + np.exp(-np.clip(x @ c, -30, 30)))
        hess = (x * (s * (1 - s))[:, None]).T @ x + 0.02 * np.eye(3)
        c = c + np.clip(np.linalg.solve(hess, x.T @ (y - s) - 0.02 * c), -3, 3)
    model.curve, model.fitted = c, True
    model.mark = sha256(repr((model.bias, model.trans.tolist(), sorted(model.weights.items()))).encode()).hexdigest()
    return model


#: Odds of words met by this Python worker, of one model only.
_odds: dict[str, float] = {}
_odds_of: list[str] = [""]


def _known_odds(model: Model) -> dict[str, float]:
    if _odds_of[0] != model.mark or len(_odds) > KEPT_WORDS:
        _odds.clear()
        _odds_of[0] = model.mark
    return _odds


def score_texts(model: Model, texts: list[str | None]) -> tuple[np.ndarray, list[list[tuple[int, int]]]]:
    """Score and toxic spans (code points, end exclusive) of each text."""
    score = np.full(len(texts), 1 / (1 + np.exp(-model.curve[0])) if model.fitted else model.prior)
    spans: list[list[tuple[int, int]]] = [[] for _ in texts]
    if not model.fitted:
        return score, spans
    docs = [WORD.findall(t) if t else [] for t in texts]
    has = [i for i, d in enumerate(docs) if d]
    if not has:
        return score, spans
    odds = _known_odds(model)
    flat = [w for i in has for w in docs[i]]
    for w in set(flat).difference(odds):
        odds[w] = model.odds(w)
    emit = np.fromiter(map(odds.__getitem__, flat), float, len(flat))
    ends = np.cumsum([len(docs[i]) for i in has])
    starts = np.r_[0, ends[:-1]]
    p, _ = marginals(emit, starts, model.trans)
    score[has] = 1 / (1 + np.exp(-np.clip(summary(p, starts) @ model.curve, -30, 30)))
    hit = np.flatnonzero(p > 0.5)
    owner = np.searchsorted(ends, hit, side="right")
    for o in np.unique(owner):
        wanted = set((hit[owner == o] - starts[o]).tolist())
        for k, m in enumerate(WORD.finditer(texts[has[o]])):
            if k in wanted:
                if spans[has[o]] and k - 1 in wanted:
                    spans[has[o]][-1] = (spans[has[o]][-1][0], m.end())
                else:
                    spans[has[o]].append(m.span())
    return score, spans


def _score(batches: Iterator[pa.RecordBatch], model: Model, text_at: int, names: list[str]) -> Iterator[pa.RecordBatch]:
    from siltbed.llm.bpe import slices

    for b in batches:
        texts = b.column(text_at).to_pylist()
        for i, j in slices([t or "" for t in texts], SLICE_CHARS):
            score, spans = score_texts(model, texts[i:j])
            text = pa.array([",".join(f"{a}:{z}" for a, z in s) for s in spans], pa.string())
            yield pa.RecordBatch.from_arrays([*b.slice(i, j - i).columns, pa.array(score), text], names)


def held_out(id_col: str) -> Column:
    """Whether labels of this row are never learned from: crc32 of the id as text leaves 1 by 3."""
    return F.coalesce(F.crc32(F.col(f"`{id_col}`").cast("string").cast("binary")) % 3 == 1, F.lit(False))


def train(docs: DataFrame, labels: DataFrame, id_col: str = "doc_id", text_col: str = "text", label_col: str = "toxic", most_toxic: int = MOST_TOXIC, most_clean: int = MOST_CLEAN, most_features: int = MOST_FEATURES) -> Model:
    """Fits to a bounded sample of the labelled rows that are not held out.

    The driver holds most_toxic + most_clean texts and most_features weights at most;
    of rows that share an id, the one with the least text is read.
    """
    known = labels.where(F.col(f"`{id_col}`").isNotNull() & F.col(f"`{label_col}`").isNotNull() & ~held_out(id_col)).groupBy(F.col(f"`{id_col}`").alias("_id")).agg(F.max(f"`{label_col}`").alias("_y"))
    pick = [known.where(F.col("_y") == y).orderBy(F.xxhash64("_id"), "_id").limit(n) for y, n in ((1, most_toxic), (0, most_clean))]
    ids = pick[0].union(pick[1])  # most_toxic + most_clean rows at most
    rows = docs.select(F.col(f"`{id_col}`").alias("_id"), F.col(f"`{text_col}`").alias("_text")).join(F.broadcast(ids), "_id")
    rows = rows.groupBy("_id", "_y").agg(F.min("_text").alias("_text")).collect()  # a row for each id of the sample
    rows.sort(key=lambda r: r._id)
    return fit([r._text for r in rows], [r._y for r in rows], most_features)


def score(docs: DataFrame, model: Model, text_col: str = "text", keep: list[str] | None = None) -> DataFrame:
    """The kept columns (all if None), score and toxic_spans; columns of these names give way."""
    names = [c for c in docs.columns if c.lower() not in ("score", "toxic_spans")] if keep is None else keep
    # internal names, so that no column of docs can clash
    rows = docs.select(*[F.col(f"`{c}`").alias(f"_c{i}") for i, c in enumerate(names)], F.col(f"`{text_col}`").alias("_text"))
    kind = T.StructType([*rows.schema.fields, T.StructField("score", T.DoubleType()), T.StructField("toxic_spans", T.StringType())])
    found = rows.mapInArrow(partial(_score, model=model, text_at=len(rows.columns) - 1, names=kind.names), kind)
    return found.drop("_text").toDF(*names, "score", "toxic_spans")


def predictions(docs: DataFrame, labels: DataFrame, id_col: str = "doc_id", text_col: str = "text", threshold: float = THRESHOLD) -> DataFrame:
    """Per row: id, held_out, score, predicted, toxic_spans."""
    scored = score(docs, train(docs, labels, id_col, text_col), text_col, [id_col])
    return scored.select(F.col(f"`{id_col}`"), held_out(id_col).alias("held_out"), "score", (F.col("score") >= threshold).cast("int").alias("predicted"), "toxic_spans")


def drop_toxic(docs: DataFrame, labels: DataFrame, id_col: str = "doc_id", text_col: str = "text", threshold: float = THRESHOLD) -> DataFrame:
    """The rows of docs below the threshold; columns as given."""
    names = [f"_c{i}" for i in range(len(docs.columns))]
    rows = docs.toDF(*names)
    at = {c.lower(): n for c, n in zip(docs.columns, names)}
    scored = score(rows, train(docs, labels, id_col, text_col), at[text_col.lower()])
    return scored.where(F.col("score") < threshold).select(*names).toDF(*docs.columns)
