"""Quality classifier: Naive Bayes support vectors.

A text is a set of n-gram indicators: byte trigrams, word unigrams and
bigrams, and four-grams of repeat distances (how many words ago a word last
occurred, up to ``REACH``), each hashed into a table. Every indicator is
scaled by the log-count ratio of the two classes, and a linear hinge-loss
model is fitted on the scaled indicators by dual coordinate descent. The
margin becomes a probability by a logistic curve fitted on margins of
documents that the fitting fold had not seen, weighted to the label shares
of the whole label table.

Learning reads at most ``PER_CLASS`` labelled documents of each class (their
distinct indicators, not their texts, reach the driver). Scoring is one pass
without a shuffle; the model is one table of ``SPACE`` numbers.

Defined results: null and empty texts have no indicators and get the score
of the intercept, like any text; without labels of both classes every
text gets the share of label 1, or 0.5 without labels; repeated rows are
scored one by one; other columns are ignored.
"""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from marquee.llm.common import labelled_sample, ship

PER_CLASS = 2000
REACH = 24
BITS = 17
SPACE = 4 << BITS  # trigrams, unigrams, bigrams, repeat distances
COST = 0.05
EPOCHS = 12


def indicators(column):
    """The distinct indicator codes of every text of an Arrow column."""
    import numpy as np

    from marquee.llm.shingles import chunks, mix, text_bytes, word_hashes

    u = np.uint64
    mask, shift = u((1 << BITS) - 1), u(64 - BITS)
    seen = np.zeros(SPACE, np.int32)
    data, offsets = text_bytes(column)
    for a, b in chunks(offsets):
        at = offsets[a:b + 1]
        words, first = word_hashes(data, at)
        pair = mix(words[:-1] * u(3) + words[1:]) if len(words) > 1 else words[:0]
        gap = np.zeros(len(words), np.uint64)
        for k in range(REACH, 0, -1):
            if len(words) > k:
                gap[k:][words[k:] == words[:-k]] = k
        # distances that reach into the text before are not this text's
        place = (np.arange(len(words)) - np.repeat(first[:-1], np.diff(first))).astype(np.uint64)
        gap[gap > place] = 0
        run = gap[:-3] * u(29791) + gap[1:-2] * u(961) + gap[2:-1] * u(31) + gap[3:] if len(words) > 3 else gap[:0]
        for i in range(b - a):
            raw = data[at[i]:at[i + 1]].astype(np.uint64)
            w0, w1 = int(first[i]), int(first[i + 1])
            tri = (raw[:-2] << u(16)) | (raw[1:-1] << u(8)) | raw[2:] if len(raw) > 2 else raw[:0]
            codes = np.concatenate([
                (tri * u(0x9E3779B97F4A7C15)) >> shift,
                (words[w0:w1] & mask) + u(1 << BITS),
                (pair[w0:max(w0, w1 - 1)] & mask) + u(2 << BITS),
                (mix(run[w0:max(w0, w1 - 3)]) & mask) + u(3 << BITS)]).astype(np.int64)
            order = np.arange(len(codes), dtype=np.int32)
            seen[codes] = order
            yield codes[seen[codes] == order]


def log_count_ratio(codes, labels):
    """Log ratio of the smoothed shares of every indicator in the classes."""
    import numpy as np

    count = np.ones((2, SPACE))
    for c, y in zip(codes, labels, strict=True):
        count[y][c] += 1
    return np.log(count[1] / count[1].sum()) - np.log(count[0] / count[0].sum())


def fit_hinge(codes, labels, ratio, cost: float = COST, epochs: int = EPOCHS):
    """Weights and intercept of the L2-regularised hinge-loss model of the
    scaled indicators, by dual coordinate descent. Rows are scaled to unit
    length, so that long texts weigh no more than short ones."""
    import numpy as np

    weight, bias = np.zeros(SPACE), 0.0
    rows = []
    for c in codes:
        x = ratio[c]
        rows.append(x / max(np.sqrt((x * x).sum()), 1e-12) * 10)
    sign = np.where(np.asarray(labels) == 1, 1.0, -1.0)
    cap = cost * len(sign) / np.maximum(1, np.array([(sign < 0).sum(), (sign > 0).sum()])) / 2
    alpha = np.zeros(len(rows))
    norm = np.array([(x * x).sum() + 1.0 for x in rows])
    rng = np.random.default_rng(5)
    for _ in range(epochs):
        for i in rng.permutation(len(rows)):
            c, x, y = codes[i], rows[i], sign[i]
            gradient = y * (weight[c] @ x + bias) - 1
            new = min(max(alpha[i] - gradient / norm[i], 0.0), cap[int(y > 0)])
            step = (new - alpha[i]) * y
            if step:
                weight[c] += step * x
                bias += step
                alpha[i] = new
    return weight * ratio * 10, bias


def margin(c, ratio2, scaled, bias) -> float:
    import numpy as np

    return float(scaled[c].sum() / max(np.sqrt(ratio2[c].sum()), 1e-12) + bias)


def fit_logistic(x, y, weights):
    """Slope and intercept of a logistic curve, by Newton steps."""
    import numpy as np

    a, b = 1.0, 0.0
    # smoothed targets keep the curve finite on separable margins
    n1, n0 = max(1, int((y == 1).sum())), max(1, int((y == 0).sum()))
    target = np.where(y == 1, (n1 + 1) / (n1 + 2), 1 / (n0 + 2))
    for _ in range(50):
        p = 1 / (1 + np.exp(-np.clip(a * x + b, -30, 30)))
        g = weights * (p - target)
        h = weights * p * (1 - p) + 1e-9
        m = np.array([[(h * x * x).sum() + 1e-3, (h * x).sum()], [(h * x).sum(), h.sum() + 1e-3]])
        step = np.linalg.solve(m, [(g * x).sum() + 1e-3 * (a - 1), g.sum()])
        a, b = a - step[0], b - step[1]
        if abs(step).max() < 1e-9:
            break
    return float(a), float(b)


@dataclass
class Model:
    scaled: object = None
    ratio2: object = None
    bias: float = 0.0
    slope: float = 0.0
    offset: float = 0.0

    def score(self, c) -> float:
        import math

        z = self.offset
        if self.scaled is not None:
            z += self.slope * margin(c, self.ratio2, self.scaled, self.bias)
        return 1 / (1 + math.exp(-max(-40.0, min(40.0, z))))


def learn(docs: DataFrame, labels: DataFrame, label_col: str = "quality", id_col: str = "doc_id",
          text_col: str = "text", per_class: int = PER_CLASS) -> Model:
    """Fit on at most ``per_class`` labelled documents of each class."""
    import numpy as np

    ship(docs.sparkSession)
    share = labels.where(F.col(label_col).isin(0, 1)).agg(
        F.sum(F.col(label_col)).alias("ones"), F.count("*").alias("n")).first()
    ones, n = (share["ones"] or 0), share["n"]

    def run(batches):
        import pyarrow as pa

        for batch in batches:
            yield pa.RecordBatch.from_arrays(
                [batch.column(0).cast(pa.string()), batch.column(2).cast(pa.int32()),
                 pa.array([c.astype(np.int32).tobytes() for c in indicators(batch.column(1))], pa.binary())],
                ["id", "label", "codes"])

    rows = labelled_sample(docs, labels, label_col, per_class, id_col, text_col).select("id", "text", "label") \
        .mapInArrow(run, "id string, label int, codes binary").collect()
    rows.sort(key=lambda r: (r["id"], r["codes"]))
    codes = [np.frombuffer(r["codes"], np.int32) for r in rows]
    y = np.array([r["label"] for r in rows], np.int64)
    prior = (ones + 0.5) / (n + 1) if n else 0.5
    if len(set(y.tolist())) < 2:
        return Model(offset=float(np.log(prior / (1 - prior))))
    # margins of rows that the fit has not seen, for the logistic curve
    fold = np.arange(len(y)) % 3
    unseen = np.zeros(len(y))
    for f in range(3):
        train = np.flatnonzero(fold != f)
        if len(set(y[train].tolist())) < 2:
            continue
        ratio = log_count_ratio([codes[i] for i in train], y[train])
        scaled, bias = fit_hinge([codes[i] for i in train], y[train], ratio)
        for i in np.flatnonzero(fold == f):
            unseen[i] = margin(codes[i], ratio * ratio, scaled, bias)
    weights = np.where(y == 1, prior / (y == 1).mean(), (1 - prior) / (y == 0).mean())
    slope, offset = fit_logistic(unseen, y, weights)
    ratio = log_count_ratio(codes, y)
    scaled, bias = fit_hinge(codes, y, ratio)
    return Model(scaled.astype(np.float32), (ratio * ratio).astype(np.float32), float(bias), slope, offset)


def score(docs: DataFrame, model: Model, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """id_col and score, the probability of label 1, of every text."""
    ship(docs.sparkSession)
    shared = docs.sparkSession.sparkContext.broadcast(model)
    id_type = docs.schema[id_col].dataType.simpleString()

    def run(batches):
        import pyarrow as pa

        m = shared.value
        for batch in batches:
            yield pa.RecordBatch.from_arrays(
                [batch.column(0), pa.array([m.score(c) for c in indicators(batch.column(1))], pa.float64())],
                [id_col, "score"])

    return docs.select(id_col, F.col(text_col).cast("string").alias("__text")).mapInArrow(
        run, f"`{id_col}` {id_type}, score double")
