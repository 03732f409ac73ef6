"""Personal data: fixed patterns plus a character-level bidirectional LSTM
with CRF transitions, in numpy.

The base patterns (email, ip, card, phone) always stand. Their spans in a
bounded sample of the texts are the training labels; variants of these
spans with other separators, prefixes and blanks teach the tagger forms that
the patterns miss. A span that the tagger adds must have odds of at least
``ODDS`` against "no span", hold an anchor character (a digit or ``@``),
pass the checks of its kind (checksum, ranges, number of digits) and touch
no base span.

Texts are covered by windows of ``WINDOW`` characters that overlap by half.
The emission scores of overlapping windows are averaged, each weighted by
its distance from the window's edge, and one Viterbi path is decoded over
each whole run of windows: spans may cross windows, and a position has one
label. Since a span needs an anchor, a window without one cannot hold a
span and is not scored; that changes no result.

Learning reads at most ``SAMPLE`` texts and ``TRAIN_WINDOWS`` windows; the
fitted arrays (some 20 kB) are broadcast. Finding spans is one pass without
a shuffle, whole texts, rows independent of each other.

Defined results: null and empty texts have no spans; without any base span
in the sample nothing is added to the patterns; repeated rows are treated
one by one; other columns are kept by ``mask`` and ignored by ``find``.
Offsets are code points, ends exclusive.
"""

from __future__ import annotations

import hashlib
import re
from dataclasses import dataclass

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from marquee.llm.common import held, ship

KINDS = ("email", "ip", "card", "phone")
WINDOW, STRIDE = 64, 32
HIDDEN = 16
SAMPLE = 500
TRAIN_WINDOWS = 1600
STEPS = 220
BATCH = 64
ODDS = 50.0

# characters with a class of their own; the rest fall into five more classes
OWN = "@.-+() :/_%\"=#*$&!|,\n'<>[]"
N_CLASSES = 2 + len(OWN) + 5
TAGS = 1 + 2 * len(KINDS)  # O, then B and I of each kind

_LOCAL = frozenset("ABCDEFGHIJKLMNOPQRSTUVWXYZabcdefghijklmnopqrstuvwxyz0123456789._%+-")
_DOMAIN = re.compile(r"[A-Za-z0-9-]+(?:\.[A-Za-z0-9-]+)+")
# a match may only begin a run of digits: from within the run it would be
# the same or fail the same
_IP = re.compile(r"(?<![0-9])([0-9]++)\.([0-9]++)\.([0-9]++)\.([0-9]++)")
_CARD = re.compile(r"[0-9](?:[\x20-]?[0-9])+")
_PHONE = re.compile(r"\+[0-9][\x20().0-9-]+[0-9]")
_NOT_DIGIT = re.compile(r"[^0-9]+")


def luhn(digits: str) -> bool:
    total = 0
    for i, c in enumerate(reversed(digits)):
        d = ord(c) - 48
        total += d if i % 2 == 0 else d * 2 - 9 * (d > 4)
    return total % 10 == 0


def base_spans(text: str) -> list[tuple[int, int, int]]:
    """(kind, start, end) of the base patterns, by kind, then start."""
    out = []
    done, at = 0, text.find("@")
    while at >= 0:
        start = at
        while start > done and text[start - 1] in _LOCAL:
            start -= 1
        if start < at and (m := _DOMAIN.match(text, at + 1)):
            out.append((0, start, m.end()))
            done = m.end()
        at = text.find("@", max(at + 1, done))
    for m in _IP.finditer(text):
        if all(len(p.lstrip("0")) <= 3 and int(p) <= 255 for p in m.groups()):
            out.append((1, *m.span()))
    for m in _CARD.finditer(text):
        digits = _NOT_DIGIT.sub("", m.group())
        if 16 <= len(digits) <= 19 and luhn(digits):
            out.append((2, *m.span()))
    for m in _PHONE.finditer(text):
        if 8 <= len(_NOT_DIGIT.sub("", m.group())) <= 15:
            out.append((3, *m.span()))
    return out


def plausible(kind: int, part: str) -> bool:
    """The checks that an added span of a kind must pass."""
    digits = _NOT_DIGIT.sub("", part)
    if kind == 0:
        name, _, host = part.partition("@")
        return bool(name.strip()) and "." in host and len(part) <= 80
    if kind == 1:
        parts = re.findall(r"[0-9]+", part)
        return len(parts) == 4 and all(len(p) <= 3 and int(p) <= 255 for p in parts) and len(part) <= 24
    if kind == 2:
        return 13 <= len(digits) <= 19 and luhn(digits) and len(part) <= 2 * len(digits)
    return 8 <= len(digits) <= 15 and len(part) <= 2 * len(digits) + 4


def classes(text: str):
    """Class of every character: 0 is padding."""
    import numpy as np

    points = np.frombuffer(text.encode("utf-32-le"), np.uint32)
    return _table()[np.minimum(points, 0x2FF)]


def _table():
    import numpy as np

    global _TABLE
    if _TABLE is None:
        table = np.full(0x300, N_CLASSES - 1, np.uint8)  # other characters
        for c in range(0x300):
            if chr(c) in OWN:
                table[c] = 2 + OWN.index(chr(c))
            elif chr(c).isascii() and chr(c).isdigit():
                table[c] = 1
            elif chr(c) in "abcdef":
                table[c] = N_CLASSES - 2
            elif chr(c).isascii() and chr(c).islower():
                table[c] = N_CLASSES - 3
            elif chr(c).isascii() and chr(c).isupper():
                table[c] = N_CLASSES - 4
            elif chr(c).isalpha():
                table[c] = N_CLASSES - 5
        _TABLE = table
    return _TABLE


_TABLE = None


def _sigmoid(x):
    import numpy as np

    return 0.5 * (np.tanh(0.5 * x) + 1)


class Tagger:
    """Bidirectional LSTM with CRF transitions. Arrays: ``x`` (2, classes,
    4H) input weights, ``u`` (2, H, 4H) recurrent weights, ``o`` (2H, tags)
    and ``c`` (tags) emissions, ``t`` (tags, tags) transitions."""

    def __init__(self, seed: int = 3, hidden: int = HIDDEN, dtype: str = "float32"):
        import numpy as np

        rng = np.random.default_rng(seed)
        h = hidden
        self.h = h
        self.w = {"x": rng.normal(0, 0.3, (2, N_CLASSES, 4 * h)), "u": rng.normal(0, 0.5 / h**0.5, (2, h, 4 * h)),
                  "o": rng.normal(0, 0.3, (2 * h, TAGS)), "c": np.zeros(TAGS), "t": np.zeros((TAGS, TAGS))}
        self.w["x"][:, :, h:2 * h] += 0.5  # remember at first
        self.w = {k: v.astype(dtype) for k, v in self.w.items()}
        # an inside tag only follows a tag of its own kind
        self.ban = np.zeros((TAGS, TAGS), dtype)
        for k in range(len(KINDS)):
            inside = 2 + 2 * k
            self.ban[:, inside] = -1e4
            self.ban[[inside - 1, inside], inside] = 0
        self.first = np.where(np.arange(TAGS) % 2 == 0, -1e4, 0.0)
        self.first[0] = 0.0
        self.first = self.first.astype(dtype)

    def forward(self, ids, keep: bool = False):
        """ids (T, B) -> emissions (T, B, tags), and what ``backward`` needs."""
        import numpy as np

        steps, n = ids.shape
        h, w = self.h, self.w
        both = np.stack([ids, ids[::-1]])
        dtype = w["u"].dtype
        state, cell = np.zeros((2, n, h), dtype), np.zeros((2, n, h), dtype)
        out = np.empty((2, steps, n, h), dtype)
        saved = []
        for s in range(steps):
            z = state @ w["u"]
            z[0] += w["x"][0][both[0, s]]
            z[1] += w["x"][1][both[1, s]]
            gate = _sigmoid(z[:, :, :3 * h])
            new = np.tanh(z[:, :, 3 * h:])
            before, prior = cell, state
            cell = gate[:, :, h:2 * h] * before + gate[:, :, :h] * new
            top = np.tanh(cell)
            state = gate[:, :, 2 * h:] * top
            out[:, s] = state
            if keep:
                saved.append((gate, new, before, prior, top))
        joined = np.concatenate([out[0], out[1, ::-1]], axis=2)
        return joined @ w["o"] + w["c"], (both, joined, saved)

    def backward(self, grad, kept):
        """Gradients of all arrays from the gradient of the emissions."""
        import numpy as np

        both, joined, saved = kept
        h, w = self.h, self.w
        steps, n = grad.shape[:2]
        g = {"o": np.tensordot(joined, grad, ([0, 1], [0, 1])), "c": grad.sum((0, 1)),
             "x": np.zeros_like(w["x"]), "u": np.zeros_like(w["u"])}
        top = grad @ w["o"].T
        back = np.stack([top[:, :, :h], top[::-1, :, h:]])
        ds, dc = np.zeros((2, n, h), grad.dtype), np.zeros((2, n, h), grad.dtype)
        one_hot = np.eye(N_CLASSES, dtype=grad.dtype)[both]
        for s in range(steps - 1, -1, -1):
            gate, new, before, prior, tanh = saved[s]
            ds = ds + back[:, s]
            i, f, o = gate[:, :, :h], gate[:, :, h:2 * h], gate[:, :, 2 * h:]
            dc = dc + ds * o * (1 - tanh * tanh)
            dz = np.concatenate([dc * new * i * (1 - i), dc * before * f * (1 - f), ds * tanh * o * (1 - o),
                                 dc * i * (1 - new * new)], axis=2)
            g["u"] += prior.transpose(0, 2, 1) @ dz
            g["x"] += one_hot[:, s].transpose(0, 2, 1) @ dz
            ds, dc = dz @ w["u"].transpose(0, 2, 1), dc * f
        return g

    def loss(self, emissions, tags):
        """Mean negative log-likelihood of the tag paths, and its gradients
        with respect to emissions and transitions."""
        import numpy as np

        steps, n, _ = emissions.shape
        t = self.w["t"] + self.ban
        alpha, beta = np.empty_like(emissions), np.zeros_like(emissions)
        alpha[0] = emissions[0] + self.first
        for s in range(1, steps):
            alpha[s] = _logsum(alpha[s - 1][:, :, None] + t, 1) + emissions[s]
        for s in range(steps - 2, -1, -1):
            beta[s] = _logsum(t + (beta[s + 1] + emissions[s + 1])[:, None, :], 2)
        total = _logsum(alpha[-1], 1)
        grad = np.exp(alpha + beta - total[:, None])
        here = np.arange(n)
        gold = emissions[0, here, tags[0]] + self.first[tags[0]]
        grad[0, here, tags[0]] -= 1
        dt = np.zeros_like(t)
        for s in range(1, steps):
            gold = gold + emissions[s, here, tags[s]] + t[tags[s - 1], tags[s]]
            grad[s, here, tags[s]] -= 1
            dt += np.exp(alpha[s - 1][:, :, None] + t + (emissions[s] + beta[s])[:, None, :]
                         - total[:, None, None]).sum(0)
            np.add.at(dt, (tags[s - 1], tags[s]), -1)
        return float((total - gold).mean()), grad / n, dt / n

    def fit(self, ids, tags, steps: int = STEPS, batch: int = BATCH, rate: float = 0.02, seed: int = 11):
        """Adam on random batches of the windows (N, T)."""
        import numpy as np

        rng = np.random.default_rng(seed)
        m = {k: np.zeros_like(v) for k, v in self.w.items()}
        v = {k: np.zeros_like(x) for k, x in self.w.items()}
        for step in range(1, steps + 1):
            pick = rng.integers(0, len(ids), min(batch, len(ids)))
            emissions, kept = self.forward(ids[pick].T, keep=True)
            _, grad, dt = self.loss(emissions, tags[pick].T)
            g = self.backward(grad, kept) | {"t": dt}
            norm = sum(float((x * x).sum()) for x in g.values())**0.5
            lr = rate * min(1.0, 3 * (1 - step / (steps + 1)))
            for k in self.w:
                x = g[k] * min(1.0, 5 / (norm + 1e-9))
                m[k] = 0.9 * m[k] + 0.1 * x
                v[k] = 0.99 * v[k] + 0.01 * x * x
                self.w[k] -= lr * (m[k] / (1 - 0.9**step)) / (np.sqrt(v[k] / (1 - 0.99**step)) + 1e-8)
        return self

    def path(self, emissions):
        """Viterbi path of one run of emissions (T, tags)."""
        import numpy as np

        t = self.w["t"] + self.ban
        best = emissions[0] + self.first
        came = []
        for e in emissions[1:]:
            step = best[:, None] + t
            came.append(step.argmax(0))
            best = step.max(0) + e
        tag = int(best.argmax())
        out = [tag]
        for c in reversed(came):
            tag = int(c[tag])
            out.append(tag)
        return np.array(out[::-1])

    def odds(self, emissions, tags, start: int, end: int) -> float:
        """Log odds of a decoded span against no span at its place."""
        t = self.w["t"] + self.ban
        yes = no = 0.0
        for s in range(start, end):
            yes += emissions[s, tags[s]]
            no += emissions[s, 0]
        for s in range(max(1, start), min(end + 1, len(tags))):
            a, b = tags[s - 1], tags[s]
            yes += t[a, b]
            no += t[a if s == start else 0, b if s == end else 0]
        return float(yes - no) if no > -1e3 else 100.0


def _logsum(x, axis):
    import numpy as np

    top = x.max(axis=axis, keepdims=True)
    return np.squeeze(top, axis) + np.log(np.exp(x - top).sum(axis=axis))


def anchored(ids) -> list[int]:
    """Starts of the windows of a text that hold a digit or ``@``."""
    import numpy as np

    at = np.flatnonzero((ids == 1) | (ids == 2 + OWN.index("@")))
    if not len(at):
        return []
    last = at // STRIDE
    starts = np.unique(np.concatenate([last, last - 1])) * STRIDE
    return [int(s) for s in starts if s >= 0 or len(ids) > 0 and s == 0]


def window(ids, start: int):
    import numpy as np

    part = ids[start:start + WINDOW]
    return np.concatenate([part, np.zeros(WINDOW - len(part), np.uint8)]) if len(part) < WINDOW else part


def variant(kind: int, part: str, rng) -> str:
    """Another way to write a labelled span."""
    digits = _NOT_DIGIT.sub("", part)
    pick = int(rng.integers(0, 4))
    if kind == 0:
        name, _, host = part.partition("@")
        return (f"{name} @ {host}", f"{name}@{host}", f"{name} @{host}", f"{name}@ {host}")[pick]
    if kind == 1:
        return part.replace(".", (" . ", ".", "-", ",")[pick])
    if kind == 2:
        return (".", "/", "_", "")[pick].join(digits[i:i + 4] for i in range(0, len(digits), 4))
    cut = (digits[:-10] or "0", digits[-10:-7], digits[-7:-4], digits[-4:])
    return (f"00{cut[0]} {cut[1]} {cut[2]} {cut[3]}", f"({cut[1]}) {cut[2]}-{cut[3]}",
            f"{cut[1]}-{cut[2]}-{cut[3]}", f"+{cut[0]}/{cut[1]}/{cut[2]}/{cut[3]}")[pick]


def training_set(texts: list[str], limit: int = TRAIN_WINDOWS):
    """Windows (N, WINDOW) and their tags: anchored windows of the texts as
    they are, and with every labelled span rewritten."""
    import numpy as np

    rng = np.random.default_rng(17)
    ids, tags = [], []
    spans_seen = 0
    for text in texts:
        spans = sorted((s, e, k) for k, s, e in base_spans(text))
        clear = [x for i, x in enumerate(spans) if i == 0 or x[0] >= max(y[1] for y in spans[:i])]
        spans_seen += len(clear)
        for rewrite in (False, True):
            out, marks, done = [], [], 0
            for s, e, k in clear:
                part = variant(k, text[s:e], rng) if rewrite else text[s:e]
                out += [text[done:s], part]
                marks.append((k, sum(map(len, out)) - len(part), sum(map(len, out))))
                done = e
            whole = "".join([*out, text[done:]])
            if rewrite and not clear:
                continue
            line = classes(whole)
            tag = np.zeros(len(line) + WINDOW, np.uint8)
            for k, s, e in marks:
                tag[s], tag[s + 1:e] = 1 + 2 * k, 2 + 2 * k
            starts = anchored(line)
            for s in (starts if len(starts) <= 6 else [starts[i] for i in sorted(rng.choice(len(starts), 6, False))]):
                # a span cut by the window's edge would begin inside
                part = tag[s:s + WINDOW].copy()
                run = 0
                while run < WINDOW and part[run] and part[run] % 2 == 0:
                    run += 1
                part[:1] -= 1 if run else 0
                ids.append(window(line, s))
                tags.append(part)
        if len(ids) >= limit:
            break
    return (np.array(ids[:limit]), np.array(tags[:limit])) if spans_seen else (None, None)


def learn(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", sample: int = SAMPLE) -> Tagger | None:
    """Fit the tagger on at most ``sample`` texts that hold an anchor,
    chosen by a hash of their ids. None where they hold no base span."""
    text = F.col(text_col).cast("string")
    ids = [r["id"] for r in docs.where(text.rlike("[0-9@]")).select(F.col(id_col).alias("id")).distinct()
           .orderBy(F.xxhash64(F.col("id").cast("string")), "id").limit(sample).collect()]
    if not ids:
        return None
    rows = docs.where(F.col(id_col).isin(ids) & text.rlike("[0-9@]")).select(
        F.col(id_col).alias("id"), text.alias("text")).dropDuplicates().limit(2 * sample).collect()
    ids, tags = training_set([r["text"] for r in sorted(rows, key=lambda r: (str(r["id"]), r["text"]))])
    return None if ids is None else Tagger().fit(ids, tags)


def added_spans(texts: list[str], bases: list[list], tagger: Tagger) -> list[list]:
    """The spans that the tagger adds to the base spans of each text."""
    import numpy as np

    jobs, lines = [], []
    for j, text in enumerate(texts):
        lines.append(classes(text))
        jobs += [(j, s) for s in anchored(lines[-1])]
    out: list[list] = [[] for _ in texts]
    if not jobs:
        return out
    shares = np.minimum(np.arange(WINDOW) + 1, WINDOW - np.arange(WINDOW)).astype(float)
    scored = []
    for a in range(0, len(jobs), 512):
        part = np.array([window(lines[j], s) for j, s in jobs[a:a + 512]])
        scored.append(tagger.forward(part.T)[0].transpose(1, 0, 2))
    scored = np.concatenate(scored)
    at = 0
    while at < len(jobs):
        # one run: windows of one text, each beginning inside the one before
        j, start = jobs[at]
        to = at + 1
        while to < len(jobs) and jobs[to][0] == j and jobs[to][1] <= jobs[to - 1][1] + STRIDE:
            to += 1
        end = min(len(lines[j]), jobs[to - 1][1] + WINDOW)
        total, mass = np.zeros((end - start, TAGS)), np.zeros(end - start)
        for k in range(at, to):
            b = jobs[k][1] - start
            n = min(WINDOW, end - start - b)
            total[b:b + n] += scored[k, :n] * shares[:n, None]
            mass[b:b + n] += shares[:n]
        emissions = total / mass[:, None]
        tags = tagger.path(emissions)
        s = 0
        while s < len(tags):
            if not tags[s] % 2:
                s += 1
                continue
            e = s + 1
            while e < len(tags) and tags[e] == tags[s] + 1:
                e += 1
            kind, b, f = int(tags[s]) // 2, s + start, e + start
            if (tagger.odds(emissions, tags, s, e) >= np.log(ODDS)
                    and plausible(kind, texts[j][b:f])
                    and all(f <= x[1] or x[2] <= b for x in bases[j])):
                out[j].append((kind, b, f))
            s = e
        at = to
    return out


@dataclass
class Found:
    base: list
    spans: list


def find_batch(column, tagger: Tagger | None) -> dict[int, Found]:
    """Spans of the texts of an Arrow column that hold an anchor."""
    import numpy as np

    from marquee.llm.shingles import text_bytes

    data, offsets = text_bytes(column)
    some: set[int] = set()
    low, high = int(offsets[0]), int(offsets[-1])
    for a in range(low, high, 1 << 22):
        part = data[a:min(high, a + (1 << 22))]
        hits = np.flatnonzero(((part >= 48) & (part <= 57)) | (part == 64)) + a
        some.update(np.unique(np.searchsorted(offsets, hits, "right") - 1).tolist())
    rows = sorted(some)
    texts = [column[i].as_py() for i in rows]
    bases = [base_spans(t) for t in texts]
    more = added_spans(texts, bases, tagger) if tagger is not None else [[] for _ in rows]
    return {i: Found(b, sorted(b + m)) for i, b, m in zip(rows, bases, more, strict=True)}


def _joined(spans) -> str:
    return ",".join(f"{KINDS[k]}:{s}:{e}" for k, s, e in spans)


def find(docs: DataFrame, tagger: Tagger | None, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """id_col, the counts and digest of the base spans, and all spans."""
    ship(docs.sparkSession)
    shared = docs.sparkSession.sparkContext.broadcast(tagger)
    id_type = docs.schema[id_col].dataType.simpleString()
    names = [id_col, *(f"n_{k}" for k in KINDS), "base_sha256", "spans"]

    def run(batches):
        import pyarrow as pa

        none = Found([], [])
        for batch in batches:
            got = find_batch(batch.column(1), shared.value)
            rows = [got.get(i, none) for i in range(batch.num_rows)]
            yield pa.RecordBatch.from_arrays(
                [batch.column(0),
                 *(pa.array([sum(x[0] == k for x in r.base) for r in rows], pa.int64()) for k in range(len(KINDS))),
                 pa.array([hashlib.sha256(_joined(r.base).encode()).hexdigest() for r in rows], pa.string()),
                 pa.array([_joined(r.spans) for r in rows], pa.string())], names)

    return docs.select(id_col, F.col(text_col).cast("string").alias("__text")).mapInArrow(
        run, f"`{id_col}` {id_type}, " + ", ".join(f"n_{k} bigint" for k in KINDS)
        + ", base_sha256 string, spans string")


def mask(docs: DataFrame, tagger: Tagger | None, text_col: str = "text") -> DataFrame:
    """``docs`` with every span replaced by its kind in angle brackets.
    Spans that overlap are replaced together, by the kind of the first."""
    ship(docs.sparkSession)
    shared = docs.sparkSession.sparkContext.broadcast(tagger)
    place = docs.columns.index(text_col)

    def run(batches):
        import pyarrow as pa

        from marquee.llm.shingles import small_parts

        held(None)  # what the worker did before
        for batch in small_parts(batches, place):
            got = find_batch(batch.column(place), shared.value)
            if got:
                texts = batch.column(place).to_pylist()
                for i, found in got.items():
                    out, done = [], 0
                    for s, e, k in sorted((s, e, k) for k, s, e in found.spans):
                        if s >= done:
                            out += [texts[i][done:s], f"<{KINDS[k].upper()}>"]
                        done = max(done, e)
                    texts[i] = "".join([*out, texts[i][done:]])
                columns = list(batch.columns)
                columns[place] = pa.array(texts, pa.string())
                batch = pa.RecordBatch.from_arrays(columns, batch.schema.names)
            yield batch

    return docs.mapInArrow(run, docs.schema)
