"""Toxicity by weak supervision.

Voters: a fixed lexicon of insults, and word-start patterns and words found in a
bounded sample of labelled rows (by the G-test on document counts). A generative
label model estimates, over the vote patterns of *all* documents, each voter's
rate among toxic and other documents (expectation maximisation, labelled rows
held at their labels) and the voters' correlations among toxic documents; a
voter that repeats others counts the less, 1 / (1 + sum of its correlations).
The posterior labels train a sparse linear classifier on a bounded sample of
rows, labelled ones first; its scores are calibrated on all rows of the labelled
sample, and it scores every whole text.

Only rows that ``trains`` accepts give labels or classifier rows. Labels, lang,
source and doc_id are never inputs of a score.

Bounds (parameters): ``max_labelled`` labelled rows, ``max_rows`` classifier
rows, ``max_voters`` induced voters. Everything that the driver gets is bounded
by them.

Defined results: null and empty texts get the score of a text without any
evidence; null labels and labels of unknown documents are not used, several
labels of a document count as toxic if one is; without labels (or toxic ones)
the fixed lexicon votes with its prior rates; repeated rows give repeated rows;
extra columns are not read; empty tables give an empty result.
"""

from __future__ import annotations

import re
from collections import Counter
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from haze.llm.common import share, written

MAX_LABELLED, MAX_ROWS, MAX_VOTERS, MAX_FEATURES = 50_000, 24_000, 96, 4096
THRESHOLD = 0.7

# Insults that vote from the start.
LEXICON = (
    "idiot idiots stupid moron morons loser losers pathetic worthless scum trash clown clowns disgusting dumb "
    "dumbass imbecile retard retarded bastard bitch asshole jerk creep filth filthy garbage vermin freak ugly "
    "hate kill shut fool fools lowlife coward bigot swine maggot "
    "dummkopf arschloch trottel abschaum idioten schwein hure wichser "
    "connard connasse salaud imbécile abruti débile ordure crétin "
    "imbécil estúpido estúpida idiota basura escoria payaso cabrón pendejo").split()

_LETTERS = re.compile(r"[^\W\d_]+")


class _Grams(dict):
    """Raw word -> its features: ``=word`` and its first 4, 5 and 6 letters as ``^lett``.
    keep: the features to look for and what stands for them. Emptied when full."""

    SIZE = 300_000

    def __init__(self, keep: dict[str, int] | None = None):
        super().__init__()
        self.keep = keep

    def __missing__(self, raw: str) -> tuple:
        if len(self) >= self.SIZE:
            self.clear()
        found = []
        for w in _LETTERS.findall(raw.lower()):
            n = len(w)
            if n <= 40:
                found.append("=" + w)
            if n >= 4:
                found += ["^" + w[:k] for k in range(4, min(n, 6) + 1)]
        if self.keep is not None:
            found = [self.keep[f] for f in found if f in self.keep]
        out = self[raw] = tuple(found)
        return out

    def __reduce__(self):  # travels empty
        return _Grams, (self.keep,)


def _features(grams: _Grams, text: str | None) -> set:
    return set().union(*map(grams.__getitem__, set(text.split()))) if text else set()


def held_out(doc_id: Column) -> Column:
    return F.coalesce(F.crc32(doc_id.cast("string").cast("binary")) % 3 == 1, F.lit(False))


# -- features and voters -----------------------------------------------------

def _g_test(a: Column, b: Column, pos: float, neg: float) -> Column:
    """G statistic of a feature that a of pos toxic and b of neg other documents have."""
    share = (a + b) / F.lit(pos + neg)

    def part(seen: Column, expected: Column) -> Column:
        return F.when(seen > 0, seen * F.log(seen / expected)).otherwise(0.0)
    return 2 * (part(a, pos * share) + part(b, neg * share)
                + part(F.lit(pos) - a, pos * (1 - share)) + part(F.lit(neg) - b, neg * (1 - share)))


def _induced(docs: DataFrame, sample: DataFrame, max_voters: int, max_features: int) -> tuple[list[str], list[str]]:
    """(voters, features): the features that tell the labelled rows apart best, and
    of those the ones that speak for toxic strongly."""
    rows = docs.join(F.broadcast(sample), "doc_id").select("text", "toxic")  # the sample is bounded

    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        grams = _Grams()
        for batch in batches:
            sides = (Counter(), Counter())
            for text, toxic in zip(batch.column(0).to_pylist(), batch.column(1).to_pylist()):
                sides[toxic][None] += 1
                sides[toxic].update(_features(grams, text))
            names = list(sides[0].keys() | sides[1].keys())
            yield pa.RecordBatch.from_arrays(
                [pa.array(names, pa.string()), pa.array([sides[1][i] for i in names], pa.int64()),
                 pa.array([sides[0][i] for i in names], pa.int64())], names=["gram", "pos", "neg"])
    counts = written(rows.mapInArrow(count, "gram string, pos long, neg long").groupBy("gram").agg(
        F.sum("pos").alias("pos"), F.sum("neg").alias("neg")), "tox-grams")
    total = counts.filter("gram is null").first()
    if total is None or not total.pos or not total.neg:
        return [], []
    p, n = float(total.pos), float(total.neg)
    top = (counts.filter("gram is not null and pos + neg >= 3").withColumn("g", _g_test(F.col("pos"), F.col("neg"), p, n))
           .filter("g > 15").orderBy(F.col("g").desc(), "gram").limit(max_features).collect())  # a top-k report
    strong = [r for r in top if r.g > 18 and r.pos >= 3 and (r.pos + 0.5) / (p + 1) > 8 * (r.neg + 0.5) / (n + 1)]
    return [r.gram for r in strong[:max_voters]], [r.gram for r in top]


def _featured(docs: DataFrame, features: list[str]) -> DataFrame:
    """(doc_id, features): the indices of each whole text's features, 2 bytes each."""
    shared = share(docs.sparkSession, {f: i for i, f in enumerate(features)})

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        grams = _Grams(shared())
        for batch in batches:
            found = [np.array(sorted(_features(grams, t)), np.uint16).tobytes() for t in batch.column(1).to_pylist()]
            yield pa.RecordBatch.from_arrays([batch.column(0), pa.array(found, pa.binary())], names=["doc_id", "features"])
    return written(docs.select("doc_id", "text").mapInArrow(run, "doc_id long, features binary"), "tox-features")


# -- label model -------------------------------------------------------------

class LabelModel:
    """prior, the voters' rates among toxic (a) and other (b) documents, and weights
    from their correlations. A voter that does not vote abstains and says nothing;
    the last column stands for a document on which all abstain."""

    def __init__(self, prior: float, a: np.ndarray, b: np.ndarray):
        self.prior, self.a, self.b, self.weight = prior, a, b, np.ones(len(a))

    def posterior(self, votes: np.ndarray) -> np.ndarray:
        """P(toxic) of each row of the 0/1 vote matrix."""
        z = np.log(self.prior / (1 - self.prior)) + votes @ (self.weight * np.log(self.a / self.b))
        return 1 / (1 + np.exp(-np.clip(z, -40, 40)))

    def refit(self, toxic: float, other: float, a_sum, b_sum, pairs) -> None:
        """From expected counts: documents, votes and vote pairs of toxic ones."""
        self.prior = min(max((toxic + 1) / (toxic + other + 10), 1e-6), 0.9)
        self.a = (a_sum + 1.0) / (toxic + 20.0)
        self.b = np.minimum((b_sum + 0.5) / (other + 5000.0), self.a / 2)  # a voter never speaks for the other class
        self.a[-1], self.b[-1] = (a_sum[-1] + 1) / (toxic + 20), (b_sum[-1] + 20) / (other + 20)
        rate = np.clip(a_sum / max(toxic, 1e-9), 0, 1)
        sd = np.sqrt(np.maximum(rate * (1 - rate), 1e-6))
        rho = np.clip((pairs / max(toxic, 1e-9) - np.outer(rate, rate)) / np.outer(sd, sd), 0, 1)
        np.fill_diagonal(rho, 0)
        sure = max(0.3, 3 / np.sqrt(toxic + 1.0))  # weaker ones may be chance
        self.weight = 1 / (1 + np.where(rho > sure, rho, 0).sum(axis=1))


def _votes(found: list[bytes], voters: int) -> np.ndarray:
    """Vote matrix of documents' feature lists, the last column where nobody votes."""
    m = np.zeros((len(found), voters + 1), np.float32)
    for i, p in enumerate(found):
        ids = np.frombuffer(p, np.uint16)
        m[i, ids[ids < voters]] = 1
    m[:, -1] = m[:, :-1].sum(axis=1) == 0
    return m


def _vote_patterns(featured: DataFrame, voters: int, labelled: dict[int, int]) -> DataFrame:
    """(pattern, n, pos, neg): the sets of voters (the first features) that documents
    show, over all documents, counted in each batch first. labelled is bounded."""
    shared = share(featured.sparkSession, labelled)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        known = shared()
        for batch in batches:
            n, pos, neg = Counter(), Counter(), Counter()
            for i, found in zip(batch.column(0).to_pylist(), batch.column(1).to_pylist()):
                ids = np.frombuffer(found, np.uint16)
                label = known.get(i)
                (n if label is None else pos if label else neg)[ids[ids < voters].tobytes()] += 1
            keys = list(n.keys() | pos.keys() | neg.keys())
            yield pa.RecordBatch.from_arrays(
                [pa.array(keys, pa.binary()), *(pa.array([c[k] for k in keys], pa.int64()) for c in (n, pos, neg))],
                names=["pattern", "n", "pos", "neg"])
    rows = featured.mapInArrow(run, "pattern binary, n long, pos long, neg long")
    return written(rows.groupBy("pattern").agg(*(F.sum(c).alias(c) for c in ("n", "pos", "neg"))), "tox-patterns")


def _expectations(patterns: DataFrame, model: LabelModel, unlabelled: float) -> dict[tuple[int, int], float]:
    """Expected counts over all patterns, summed in Spark: (-1,-1) toxic, (-2,-2) other
    documents, (j,-1) votes of toxic, (j,-2) of other ones, (j,k) vote pairs of toxic ones."""
    voters = len(model.a)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        toxic = other = 0.0
        a, b, pairs = np.zeros(voters), np.zeros(voters), np.zeros((voters, voters))
        for batch in batches:
            v = _votes(batch.column(0).to_pylist(), voters - 1)
            n, pos, neg = (np.array(batch.column(k).to_pylist(), float) for k in (1, 2, 3))
            p = model.posterior(v)
            t, o = unlabelled * n * p + pos, unlabelled * n * (1 - p) + neg
            toxic, other, a, b = toxic + t.sum(), other + o.sum(), a + t @ v, b + o @ v
            pairs += (v * t[:, None]).T @ v
        j, k = np.nonzero(pairs)
        every = np.arange(voters)
        yield pa.RecordBatch.from_arrays([
            pa.array(np.concatenate(([-1, -2], every, every, j)).astype(np.int32)),
            pa.array(np.concatenate(([-1, -2], np.full(voters, -1), np.full(voters, -2), k)).astype(np.int32)),
            pa.array(np.concatenate(([toxic, other], a, b, pairs[j, k])).astype(float))], names=["j", "k", "v"])
    sums = patterns.mapInArrow(run, "j int, k int, v double").groupBy("j", "k").agg(F.sum("v").alias("v"))
    return {(r.j, r.k): r.v for r in sums.collect()}  # at most voters**2 + 2 voters + 2 rows


def fit_label_model(patterns: DataFrame, voters: int, given: int, rounds: int = 4) -> LabelModel:
    """given: the first so many voters are the fixed lexicon. The first round uses
    labelled rows only, the others all documents."""
    prior = 0.1
    voters += 1  # and the column of those on which all abstain
    model = LabelModel(prior, np.full(voters, 0.2), np.full(voters, 0.002))
    model.a[-1], model.b[-1] = 0.1, 0.95
    for step in range(rounds):
        got = _expectations(patterns, model, 0.0 if step == 0 else 1.0)
        if step == 0 and not got.get((-1, -1)):
            continue  # no toxic labels: the prior rates start
        pairs = np.zeros((voters, voters))
        for (j, k), v in got.items():
            if j >= 0 and k >= 0:
                pairs[j, k] = v
        col = lambda k: np.array([got.get((j, k), 0.0) for j in range(voters)])
        seen = col(-1) + col(-2)
        model.refit(got[-1, -1], got[-2, -2], col(-1), col(-2), pairs)
        if step:
            model.prior = prior  # as the labelled rows have it
        else:  # a fixed voter that no labelled row shows keeps its prior rate
            prior = model.prior
            unseen = (np.arange(voters) < given) & (seen == 0)
            model.a[unseen], model.b[unseen] = 0.05, 0.0005
    return model


# -- classifier --------------------------------------------------------------

def _train(rows: list[tuple[float, float, np.ndarray]], features: int, penalty: float = 1e-4, steps: int = 1500) -> tuple[np.ndarray, float]:
    """Logistic regression on (posterior, row weight, feature indices), by gradient
    steps that shrink per weight; returns the weights and the bias."""
    y, weight = np.array([p for p, _, _ in rows]), np.array([w for _, w, _ in rows])
    w, acc, acc0 = np.zeros(features), np.full(features, 1e-8), 1e-8
    if not len(rows):
        return w, -3.0
    weight = weight / weight.sum()
    share = float(y @ weight)
    bias = float(np.log((share + 1e-3) / (1 - share + 1e-3)))
    lens = np.array([len(f) for _, _, f in rows])
    idx = np.concatenate([f for _, _, f in rows]).astype(np.int64)
    row = np.repeat(np.arange(len(rows)), lens)
    for _ in range(steps):
        z = bias + np.bincount(row, w[idx], minlength=len(rows))
        d = (1 / (1 + np.exp(-np.clip(z, -40, 40))) - y) * weight
        grad = np.bincount(idx, d[row], minlength=features) + penalty * w
        acc, acc0 = acc + grad ** 2, acc0 + d.sum() ** 2
        w -= 0.5 * grad / np.sqrt(acc)
        bias -= 0.1 * d.sum() / np.sqrt(acc0)
    return w, float(bias)


def _labelled_scores(featured: DataFrame, labelled: dict[int, int], w: np.ndarray, bias: float) -> list[tuple[float, float, float]]:
    """(label, score, rows) of every labelled document, by id: bounded like labelled."""
    shared = share(featured.sparkSession, (labelled, w, bias))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        known, weights, shift = shared()
        for batch in batches:
            rows = [(i, known[i], shift + float(weights[np.frombuffer(f, np.uint16)].sum()))
                    for i, f in zip(batch.column(0).to_pylist(), batch.column(1).to_pylist()) if i in known]
            ids, label, z = zip(*rows) if rows else ((), (), ())
            yield pa.RecordBatch.from_arrays([pa.array(ids, pa.int64()), pa.array(label, pa.float64()), pa.array(z, pa.float64())],
                                             names=["doc_id", "label", "z"])
    scored = (featured.select("doc_id", "features").mapInArrow(run, "doc_id long, label double, z double")
              .groupBy("doc_id").agg(F.max("label").alias("label"), F.avg("z").alias("z"), F.count(F.lit(1)).alias("n")))
    return [(r.label, r.z, float(r.n)) for r in sorted(scored.collect(), key=lambda r: r.doc_id)]


def _calibrated(known: list[tuple[float, float, float]], w: np.ndarray, bias: float) -> tuple[np.ndarray, float]:
    """Scale and shift of the scores that fit the labelled documents (label, score,
    rows) best, by Newton steps of a ridged logistic fit."""
    y, z, k = (np.array(c) for c in zip(*known)) if known else (np.zeros(0),) * 3
    if not 0 < y.sum() < len(y):
        return w, bias
    x, at = np.stack([z, np.ones_like(z)], 1), np.array([1.0, 0.0])
    for _ in range(50):
        p = 1 / (1 + np.exp(-np.clip(x @ at, -40, 40)))
        ridge = np.diag([0.1, 0.1])
        step = np.linalg.solve((x * (k * p * (1 - p))[:, None]).T @ x + ridge, x.T @ (k * (p - y)) + ridge @ (at - [1.0, 0.0]))
        at = at - np.clip(step, -1, 1)
    return (w * at[0], bias * at[0] + float(at[1])) if at[0] > 0 else (w, bias)


class ToxicityModel:
    """A weight for each feature and a bias."""

    def __init__(self, features: list[str], weights: np.ndarray, bias: float):
        self.features, self.weights, self.bias = features, weights, bias
        self._grams: _Grams | None = None

    def score_features(self, found) -> float:
        z = self.bias + float(self.weights[found].sum())
        return float(1 / (1 + np.exp(-min(max(z, -40.0), 40.0))))

    def score(self, text: str | None) -> float:
        if self._grams is None:
            self._grams = _Grams({f: i for i, f in enumerate(self.features)})
        return self.score_features(sorted(_features(self._grams, text)))


def _fitted(docs: DataFrame, labels: DataFrame, max_labelled: int = MAX_LABELLED, max_rows: int = MAX_ROWS,
            max_voters: int = MAX_VOTERS, max_features: int = MAX_FEATURES) -> tuple[ToxicityModel, DataFrame]:
    """The model, and (doc_id, features) of all documents."""
    docs = docs.select(F.col("doc_id").cast("long").alias("doc_id"), F.col("text").cast("string").alias("text"))
    known = (labels.select(F.col("doc_id").cast("long").alias("doc_id"), F.col("toxic").cast("int").alias("toxic"))
             .filter("doc_id is not null and toxic is not null").filter(~held_out(F.col("doc_id")))
             .groupBy("doc_id").agg(F.max(F.when(F.col("toxic") > 0, 1).otherwise(0)).alias("toxic")))
    sample = written(known.orderBy(F.xxhash64("doc_id"), "doc_id").limit(max_labelled), "tox-labels")
    labelled = {r.doc_id: r.toxic for r in sample.collect()}  # at most max_labelled
    fixed = ["=" + w for w in dict.fromkeys(LEXICON)]
    strong, others = _induced(docs, sample, max_voters, max_features)
    voters = list(dict.fromkeys(fixed + strong))
    features = list(dict.fromkeys(voters + others))
    featured = _featured(docs, features)
    patterns = _vote_patterns(featured, len(voters), labelled)
    model = fit_label_model(patterns, len(voters), len(fixed))

    # classifier rows: half of the bound for likely toxic, half for other documents, by a hash of the id; of each
    # half, labelled rows may take at least half and what the others leave
    total = _expectations(patterns, model, 1.0)
    counts = [float(n or 0) for n in patterns.agg(F.sum("pos"), F.sum("neg")).first()]
    rates = []  # toxic, other: (unlabelled, labelled)
    for k, n in zip(((-1, -1), (-2, -2)), counts):
        others = max(total.get(k, 0.0) - n, 0.0)
        rate = min(1.0, max(max_rows / 4, max_rows / 2 - others) / max(n, 1.0))
        rates.append((min(1.0, (max_rows / 2 - rate * n) / max(others, 1.0)), rate))
    shared = share(docs.sparkSession, (len(voters), labelled, model))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        voters, known, label_model = shared()
        for batch in batches:
            ids, found, place = (batch.column(k).to_pylist() for k in range(3))
            p = label_model.posterior(_votes(found, voters))
            given = [known.get(i) for i in ids]
            p = np.array([v if g is None else float(g) for v, g in zip(p.tolist(), given)])
            rate = np.array([rates[0 if v >= 0.5 else 1][g is not None] for v, g in zip(p.tolist(), given)])
            take = np.flatnonzero(np.array(place) < rate)
            yield pa.RecordBatch.from_arrays(
                [pa.array(p[take]), pa.array(1 / rate[take]), pa.array([place[k] for k in take], pa.float64()),
                 pa.array([found[k] for k in take], pa.binary())], names=["p", "w", "u", "features"])
    place = (F.shiftrightunsigned(F.xxhash64(F.lit(7), "doc_id"), 11) / F.lit(float(1 << 53))).alias("u")
    taken = (featured.filter(~held_out(F.col("doc_id"))).select("doc_id", "features", place)
             .mapInArrow(run, "p double, w double, u double, features binary").limit(2 * max_rows).collect())
    rows = [(r.p, r.w, np.frombuffer(r.features, np.uint16)) for r in sorted(taken, key=lambda r: (r.u, r.features))]
    w, bias = _train(rows, len(features))
    return ToxicityModel(features, *_calibrated(_labelled_scores(featured, labelled, w, bias), w, bias)), featured


def score_documents(docs: DataFrame, labels: DataFrame, **bounds) -> DataFrame:
    """(doc_id, held_out, score, predicted) of every row."""
    fitted, featured = _fitted(docs, labels, **bounds)
    model = share(docs.sparkSession, fitted)  # at most max_features weights

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            s = [model().score_features(np.frombuffer(f, np.uint16)) for f in batch.column(1).to_pylist()]
            yield pa.RecordBatch.from_arrays([batch.column(0), pa.array(s, pa.float64())], names=["doc_id", "score"])
    return (featured.mapInArrow(run, "doc_id long, score double")
            .select("doc_id", held_out(F.col("doc_id")).alias("held_out"), "score",
                    (F.col("score") >= THRESHOLD).cast("int").alias("predicted")))


def drop_toxic(docs: DataFrame, labels: DataFrame, **bounds) -> DataFrame:
    """``docs`` without the rows that score ``THRESHOLD`` or more; same columns, no shuffle."""
    model = share(docs.sparkSession, _fitted(docs, labels, **bounds)[0])
    text_at = docs.columns.index("text")

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            yield batch.filter(pa.array([model().score(t) < THRESHOLD for t in batch.column(text_at).to_pylist()], pa.bool_()))
    return docs.mapInArrow(run, docs.schema)
