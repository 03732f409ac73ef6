"""Toxicity by nearest labelled examples under exact TF-IDF cosine.

The terms of a text are its words (letters and digits, A-Z lower-cased) and
word beginnings of ``PREFIXES`` bytes. The vocabulary holds the terms whose
document shares in the two classes of the examples differ by at least
``MIN_Z`` standard errors and a factor of ``MIN_RATIO`` (the ``MAX_TERMS``
strongest). Examples and texts
are TF-IDF vectors over it, of unit length.

The examples are kept in an inverted index of blocks of ``BLOCK`` examples:
per block the impacts of the terms that occur in it, and per (term, block)
the largest impact. A text's bound of a block is the sum of its weights
times these maxima; blocks are scored exactly in falling order of bounds
until no bound reaches the k-th best similarity. So the k nearest examples
are exact, ties going to the example of smaller position.

The vote is the share of toxic neighbours weighted by similarity; a
logistic curve fitted on the leave-one-out votes of the examples, weighted
to the label shares of the whole label table, turns it into a probability.
``score`` also returns the evidence: the nearest examples and similarities.

Learning reads at most ``PER_CLASS`` labelled documents of each class (their
term counts, not their texts, reach the driver); the index is broadcast.

Defined results: a text without vocabulary terms (null and empty ones too)
has no neighbours and its vote is the share of toxic ones among examples
without terms; without labels of both classes every text gets the share of
label 1, or 0.5 without labels; repeated rows are scored one by one; other
columns are ignored.
"""

from __future__ import annotations

from dataclasses import dataclass, field

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from marquee.llm.common import labelled_sample, ship
from marquee.llm.quality import fit_logistic

PER_CLASS = 1500
PREFIXES = (4, 5, 6, 7)
MAX_TERMS = 2048
MIN_Z = 4.0
MIN_RATIO = 3.0
BLOCK = 64
NEIGHBOURS = 15


def terms(column, wanted=None):
    """(distinct term hashes, counts) of every text of an Arrow column;
    ``wanted`` (a sorted array) keeps only these terms."""
    import numpy as np

    from marquee.llm.shingles import NOT_ALPHANUMERIC, chunks, text_bytes, word_hashes

    if wanted is not None:
        bits = np.zeros(1 << 20, bool)
        bits[(wanted & np.uint64((1 << 20) - 1)).astype(np.int64)] = True
    data, offsets = text_bytes(column)
    for a, b in chunks(offsets):
        words, first, cut = word_hashes(data, offsets[a:b + 1], NOT_ALPHANUMERIC, PREFIXES)
        every, owner = [words], [np.arange(len(words))]
        for hashes, of in cut:
            every.append(hashes)
            owner.append(of)
        hashes, at = np.concatenate(every), np.concatenate(owner)
        if wanted is not None:
            keep = bits[(hashes & np.uint64((1 << 20) - 1)).astype(np.int64)]
            hashes, at = hashes[keep], at[keep]
            keep = wanted[np.minimum(np.searchsorted(wanted, hashes), max(0, len(wanted) - 1))] == hashes \
                if len(wanted) else np.zeros(len(hashes), bool)
            hashes, at = hashes[keep], at[keep]
        doc = np.searchsorted(first, at, "right") - 1
        order = np.argsort(doc, kind="stable")
        hashes, edge = hashes[order], np.searchsorted(doc[order], np.arange(b - a + 1))
        for i in range(b - a):
            part = hashes[edge[i]:edge[i + 1]]
            yield np.unique(part, return_counts=True) if len(part) else (part, np.zeros(0, np.int64))


@dataclass
class Index:
    """Block-max inverted index of the examples."""
    vocabulary: object
    idf: object
    ids: list = field(default_factory=list)
    labels: object = None
    slots: list = field(default_factory=list)    # per block: row of each term, -1 if absent
    impacts: list = field(default_factory=list)  # per block: (terms in it, BLOCK)
    bounds: object = None                        # (terms, blocks)

    def vector(self, hashes, counts):
        """Positions and unit-length weights of the vocabulary terms."""
        import numpy as np

        at = np.searchsorted(self.vocabulary, hashes)
        weight = (1 + np.log(counts)) * self.idf[at]
        return at, weight / np.sqrt((weight * weight).sum()) if len(at) else weight

    def build(self, rows):
        """rows: (id, label, positions, weights)."""
        import numpy as np

        n, v = len(rows), len(self.vocabulary)
        self.ids = [r[0] for r in rows]
        self.labels = np.array([r[1] for r in rows], np.int64)
        n_blocks = -(-n // BLOCK)
        self.bounds = np.zeros((v, n_blocks))
        for j in range(n_blocks):
            part = rows[j * BLOCK:(j + 1) * BLOCK]
            here = np.unique(np.concatenate([r[2] for r in part]))
            slot = np.full(v, -1, np.int32)
            slot[here] = np.arange(len(here))
            impact = np.zeros((len(here), len(part)))
            for k, (_, _, at, weight) in enumerate(part):
                impact[slot[at], k] = weight
            self.slots.append(slot)
            self.impacts.append(impact)
            if len(here):
                self.bounds[here, j] = impact.max(axis=1)
        return self

    def nearest(self, at, weight, k: int = NEIGHBOURS, leave: int = -1):
        """The k examples of highest cosine above 0: (positions, cosines)."""
        import numpy as np

        best, where = np.zeros(0), np.zeros(0, np.int64)
        if not len(at) or self.bounds is None or not self.bounds.shape[1]:
            return where, best
        bound = weight @ self.bounds[at]
        for j in np.argsort(-bound, kind="stable"):
            floor = best[k - 1] if len(best) >= k else 0.0
            if bound[j] <= 0 or bound[j] < floor - 1e-9:
                break
            rows = self.slots[j][at]
            got = rows >= 0
            sims = weight[got] @ self.impacts[j][rows[got]]
            if 0 <= leave - j * BLOCK < len(sims):
                sims[leave - j * BLOCK] = 0.0
            new = np.flatnonzero((sims > 0) & (sims >= floor))
            best = np.concatenate([best, sims[new]])
            where = np.concatenate([where, new + j * BLOCK])
            order = np.lexsort((where, -best))[:k]
            best, where = best[order], where[order]
        return where, best


def vote(index: Index, where, sims, none: float, prior: float) -> float:
    """Similarity-weighted share of toxic neighbours, shrunk to the prior."""
    if not len(where):
        return none
    return float(((sims * index.labels[where]).sum() + 0.1 * prior) / (sims.sum() + 0.1))


@dataclass
class Model:
    index: Index | None
    none: float = 0.5
    prior: float = 0.5
    slope: float = 0.0
    offset: float = 0.0

    def score(self, hashes, counts):
        """(probability, positions of the neighbours, cosines)."""
        import math

        import numpy as np

        if self.index is None:
            return 1 / (1 + math.exp(-self.offset)), np.zeros(0, np.int64), np.zeros(0)
        at, weight = self.index.vector(hashes, counts)
        where, sims = self.index.nearest(at, weight)
        share = vote(self.index, where, sims, self.none, self.prior)
        z = self.slope * _logit(share) + self.offset
        return 1 / (1 + math.exp(-max(-40.0, min(40.0, z)))), where, sims


def _logit(p):
    import numpy as np

    p = np.clip(p, 0.01, 0.99)
    return np.log(p / (1 - p))


def learn(docs: DataFrame, labels: DataFrame, label_col: str = "toxic", id_col: str = "doc_id",
          text_col: str = "text", per_class: int = PER_CLASS) -> Model:
    """The index of at most ``per_class`` examples of each class."""
    import numpy as np

    ship(docs.sparkSession)
    share = labels.where(F.col(label_col).isin(0, 1)).agg(
        F.sum(F.col(label_col)).alias("ones"), F.count("*").alias("n")).first()
    ones, n = (share["ones"] or 0), share["n"]
    prior = (ones + 0.5) / (n + 1) if n else 0.5

    def run(batches):
        import pyarrow as pa

        for batch in batches:
            found = list(terms(batch.column(1)))
            yield pa.RecordBatch.from_arrays(
                [batch.column(0).cast(pa.string()), batch.column(2).cast(pa.int32()),
                 pa.array([h.tobytes() for h, _ in found], pa.binary()),
                 pa.array([c.astype(np.int32).tobytes() for _, c in found], pa.binary())],
                ["id", "label", "hashes", "counts"])

    rows = labelled_sample(docs, labels, label_col, per_class, id_col, text_col).select("id", "text", "label") \
        .mapInArrow(run, "id string, label int, hashes binary, counts binary").collect()
    rows.sort(key=lambda r: (r["id"], r["hashes"]))
    y = np.array([r["label"] for r in rows], np.int64)
    if len(set(y.tolist())) < 2:
        return Model(None, offset=float(np.log(prior / (1 - prior))))
    bags = [(np.frombuffer(r["hashes"], np.uint64), np.frombuffer(r["counts"], np.int32)) for r in rows]
    # document shares of every term in the two classes
    every, back = np.unique(np.concatenate([h for h, _ in bags]), return_inverse=True)
    label_of = np.repeat(y, [len(h) for h, _ in bags])
    df = [np.bincount(back[label_of == k], minlength=len(every)) for k in (0, 1)]
    size = [max(1, int((y == k).sum())) for k in (0, 1)]
    pooled = (df[0] + df[1]) / (size[0] + size[1])
    error = np.sqrt(pooled * (1 - pooled) * (1 / size[0] + 1 / size[1])) + 1e-12
    z = np.abs(df[1] / size[1] - df[0] / size[0]) / error
    ratio = (df[1] + 0.5) / size[1] / ((df[0] + 0.5) / size[0])
    top = np.flatnonzero((z >= MIN_Z) & (np.maximum(ratio, 1 / ratio) >= MIN_RATIO))
    top = np.sort(top[np.lexsort((top, -z[top]))[:MAX_TERMS]])
    index = Index(every[top], np.log((len(y) + 1) / (df[0][top] + df[1][top] + 1)) + 1)
    kept = []
    for r, label, (h, c) in zip(rows, y, bags, strict=True):
        at = np.searchsorted(index.vocabulary, h)
        hit = index.vocabulary[np.minimum(at, len(top) - 1)] == h if len(top) else np.zeros(len(h), bool)
        kept.append((r["id"], int(label), *index.vector(h[hit], c[hit])))
    # examples without terms cannot be near anything: their share is kept
    bare = [x for x in kept if not len(x[2])]
    weight = {1: prior / (y == 1).mean(), 0: (1 - prior) / (y == 0).mean()}
    mass = {k: weight[k] * sum(x[1] == k for x in bare) for k in (0, 1)}
    none = (mass[1] + prior) / (mass[0] + mass[1] + 1)
    index.build([x for x in kept if len(x[2])])
    votes, truth = [none] * len(bare), [x[1] for x in bare]
    for i, (_, label, at, w) in enumerate(x for x in kept if len(x[2])):
        votes.append(vote(index, *index.nearest(at, w, leave=i), none, prior))
        truth.append(label)
    truth = np.array(truth)
    slope, offset = fit_logistic(_logit(np.array(votes)), truth, np.where(truth == 1, weight[1], weight[0]))
    return Model(index, none, prior, slope, offset)


def score(docs: DataFrame, model: Model, id_col: str = "doc_id", text_col: str = "text",
          evidence: int = 3) -> DataFrame:
    """id_col, score, and the ``evidence`` nearest examples (ids as text) with
    their cosines, of every text."""
    ship(docs.sparkSession)
    shared = docs.sparkSession.sparkContext.broadcast(model)
    id_type = docs.schema[id_col].dataType.simpleString()

    def run(batches):
        import numpy as np
        import pyarrow as pa

        m = shared.value
        wanted = m.index.vocabulary if m.index is not None else np.zeros(0, np.uint64)
        for batch in batches:
            scores, ids, sims = [], [], []
            for hashes, counts in terms(batch.column(1), wanted):
                p, where, near = m.score(hashes, counts)
                scores.append(p)
                ids.append([m.index.ids[i] for i in where[:evidence]])
                sims.append(near[:evidence].tolist())
            yield pa.RecordBatch.from_arrays(
                [batch.column(0), pa.array(scores, pa.float64()), pa.array(ids, pa.list_(pa.string())),
                 pa.array(sims, pa.list_(pa.float64()))], [id_col, "score", "evidence", "cosines"])

    return docs.select(id_col, F.col(text_col).cast("string").alias("__text")).mapInArrow(
        run, f"`{id_col}` {id_type}, score double, evidence array<string>, cosines array<double>")
