"""Language identification by cross-parsing entropy.

For every language a suffix automaton is built over labelled text. A text is
parsed greedily against each automaton: the longest match ends a phrase, the
next phrase begins at the character that did not fit. The fewer phrases per
character, the better the language explains the text; a language's count is
normalised by the phrase rate its own held-back text needs, so that
languages learned from unlike amounts of text stay comparable.

Texts are lower-cased, every run of characters that are not letters becomes
one space, and letters beyond the alphabet (the ``LETTERS`` most frequent of
the learned text) become one symbol. Each text is parsed whole, in segments
of ``SEGMENT`` characters that are parsed side by side (numpy gathers over
all segments of a batch); every segment starts a phrase, in every language
alike.

Learning reads at most ``DOCS_PER_LANG`` documents and ``CHARS_PER_LANG``
characters of each of the ``MAX_LANGS`` most frequent languages, whole
documents chosen by a hash of their ids: a bounded sample, at most
2 * MAX_LANGS * CHARS_PER_LANG characters on the driver. The automata are
broadcast (at most 2 * (TABLE_CHARS + MAX_LANGS * CHECK_CHARS) states in
all, so many languages share that room).

Defined results: null texts and texts without a letter give ``und`` and
score 0; ties go to the language first in alphabetical order; without any
learned language every text gives ``und``; texts without language label and
languages without letters teach nothing; repeated rows are predicted one by
one; other columns are ignored.
"""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from marquee.llm.common import ship

UNKNOWN = "und"
LETTERS = 60
SEGMENT = 400
CHARS_PER_LANG = 24_000
DOCS_PER_LANG = 64
MAX_LANGS = 64
TABLE_CHARS = 400_000
CHECK_CHARS = 6_000


def sample(docs: DataFrame, id_col: str, text_col: str, lang_col: str) -> DataFrame:
    """The bounded sample to learn from: lang, text. Ids are chosen without
    reading any text; only the chosen rows' texts are read."""
    narrow = docs.where(F.col(lang_col).isNotNull()).select(
        F.col(id_col).alias("id"), F.col(lang_col).cast("string").alias("lang"))
    common = narrow.groupBy("lang").count().orderBy(F.desc("count"), "lang").limit(MAX_LANGS).select("lang")
    order = Window.partitionBy("lang").orderBy(F.xxhash64(F.col("id").cast("string")), "id")
    chosen = (narrow.join(common, "lang").withColumn("k", F.row_number().over(order))
              .where(F.col("k") <= DOCS_PER_LANG).select("id").distinct())
    ids = [r["id"] for r in chosen.collect()]  # at most MAX_LANGS * DOCS_PER_LANG
    return docs.where(F.col(id_col).isin(ids) & F.col(lang_col).isNotNull()).select(
        F.col(id_col).alias("id"), F.col(lang_col).cast("string").alias("lang"),
        F.col(text_col).cast("string").alias("text")).where("text IS NOT NULL")


def normal(text: str) -> str:
    """Lower case; runs of other characters than letters become a space."""
    import regex

    return regex.sub(r"[^\p{L}]+", " ", text.lower()).strip()


def automaton(symbols: list[int], size: int):
    """Suffix automaton of a symbol sequence as a dense transition table
    (states x size, -1: no such substring)."""
    import numpy as np

    n = 2 * len(symbols) + 2
    to = np.full((n, size), -1, np.int32)
    link, length = [-1] * n, [0] * n
    count, last = 1, 0
    for c in symbols:
        new = count
        count += 1
        length[new] = length[last] + 1
        p = last
        while p >= 0 and to[p, c] < 0:
            to[p, c] = new
            p = link[p]
        if p < 0:
            link[new] = 0
        else:
            q = int(to[p, c])
            if length[p] + 1 == length[q]:
                link[new] = q
            else:
                clone = count
                count += 1
                length[clone], to[clone], link[clone] = length[p] + 1, to[q], link[q]
                while p >= 0 and to[p, c] == q:
                    to[p, c] = clone
                    p = link[p]
                link[q] = link[new] = clone
        last = new
    return to[:count]


def parser(to):
    """Table of the greedy parse: entry 2 * next state + (1 if a phrase
    ended). A symbol unknown to the language is a phrase of its own."""
    import numpy as np

    root = np.where(to[0] < 0, 0, to[0])
    return np.where(to >= 0, 2 * to, 2 * root + 1).astype(np.int32)


@dataclass
class Model:
    langs: list[str]
    letters: str
    tables: list
    rates: list[float]

    def symbols(self, text: str):
        """Symbol array of a normalised text."""
        import numpy as np

        points = np.frombuffer(text.encode("utf-32-le"), np.uint32)
        return self.lookup()[np.minimum(points, 0xFFFF)]

    def lookup(self):
        import numpy as np

        if not hasattr(self, "_lookup"):
            table = np.ones(0x10000, np.uint8)  # 1: another letter
            table[32] = 0
            for i, c in enumerate(self.letters):
                table[ord(c)] = i + 2
            self._lookup = table
        return self._lookup

    def phrases(self, parts):
        """Phrases of every part (equal length or padded with 255) in every
        language: an array (languages, parts)."""
        import numpy as np

        parts = np.ascontiguousarray(parts.T)
        width = len(self.letters) + 2
        out = np.zeros((len(self.tables), parts.shape[1]), np.int64)
        for k, table in enumerate(self.tables):
            flat, state = table.reshape(-1), np.zeros(parts.shape[1], np.int32)
            count = np.zeros(parts.shape[1], np.int32)
            for row in parts:
                live = int(np.searchsorted(row == 255, True)) if row[-1] == 255 else len(row)
                step = flat[state[:live] * width + row[:live]]
                state[:live] = step >> 1
                count[:live] += step & 1
            out[k] = count + 1
        return out


def learn(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", lang_col: str = "lang") -> Model:
    """The automata of all languages, from the bounded sample of ``docs``."""
    import collections

    texts: dict[str, list[str]] = collections.defaultdict(list)
    size: dict[str, int] = collections.Counter()
    rows = sample(docs, id_col, text_col, lang_col).withColumn("n", F.length("text")).where(
        F.col("n") <= CHARS_PER_LANG + CHECK_CHARS)
    found = rows.collect()
    room = min(CHARS_PER_LANG, TABLE_CHARS // max(1, len({r["lang"] for r in found})))
    for r in sorted(found, key=lambda r: (r["lang"], r["n"] > 4000, str(r["id"]))):
        text = normal(r["text"])
        if text and size[r["lang"]] + len(text) <= room + CHECK_CHARS:
            texts[r["lang"]].append(text)
            size[r["lang"]] += len(text)
    seen = collections.Counter(c for ts in texts.values() for t in ts for c in t if c != " " and ord(c) < 0x10000)
    letters = "".join(sorted(c for c, _ in sorted(seen.items(), key=lambda x: (-x[1], x[0]))[:LETTERS]))
    model = Model([], letters, [], [])
    for lang in sorted(texts):
        joined = " ".join(sorted(set(texts[lang]), key=texts[lang].index))
        held = max(1, min(CHECK_CHARS, len(joined) // 5))
        learned, check = joined[held:], joined[:held]
        if not learned:
            learned = check
        model.langs.append(lang)
        model.tables.append(parser(automaton([int(c) for c in model.symbols(learned)], len(letters) + 2)))
        single = Model([lang], letters, [model.tables[-1]], [1.0])
        parts, _ = cut([single.symbols(check)])
        model.rates.append(float(single.phrases(parts)[0].sum()) / len(check))
    return model


def cut(texts):
    """Segments of all texts, longest first and padded with 255, and the
    text each one belongs to."""
    import numpy as np

    n = np.array([len(t) for t in texts])
    per = -(-n // SEGMENT)
    owner = np.repeat(np.arange(len(texts)), per)
    start = (np.arange(len(owner)) - np.repeat(np.cumsum(per) - per, per)) * SEGMENT
    length = np.minimum(SEGMENT, n[owner] - start) if len(owner) else np.zeros(0, np.int64)
    order = np.argsort(-length, kind="stable")
    flat = np.concatenate([*texts, np.full(SEGMENT, 255, np.uint8)]) if len(owner) else np.zeros(SEGMENT, np.uint8)
    at = (np.cumsum(n) - n)[owner] + start
    parts = flat[at[order][:, None] + np.arange(SEGMENT)] if len(owner) else np.zeros((0, SEGMENT), np.uint8)
    parts[np.arange(SEGMENT)[None, :] >= length[order][:, None]] = 255
    return parts, owner[order]


def predict(docs: DataFrame, model: Model, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """id_col, lang_pred, score, phrase_rate (phrases per character of the
    chosen language, over its own rate)."""
    ship(docs.sparkSession)
    shared = docs.sparkSession.sparkContext.broadcast(model)
    id_type = docs.schema[id_col].dataType.simpleString()

    def run(batches):
        import numpy as np
        import pyarrow as pa

        m = shared.value
        for batch in batches:
            langs, scores, rates = [], [], []
            texts = [normal(t or "") for t in batch.column(1).to_pylist()]
            # groups of about half a million characters bound the memory
            begin = 0
            while begin < len(texts):
                end, chars = begin, 0
                while end < len(texts) and (end == begin or chars + len(texts[end]) <= 500_000):
                    chars += len(texts[end])
                    end += 1
                group = [m.symbols(t) for t in texts[begin:end]]
                begin = end
                size = np.array([len(t) for t in group])
                total = np.zeros((len(m.langs), len(group)))
                if m.langs and chars:
                    parts, owner = cut(group)
                    for a in range(0, len(parts), 4096):
                        found = m.phrases(parts[a:a + 4096])
                        for k in range(len(m.langs)):
                            total[k] += np.bincount(owner[a:a + 4096], found[k], len(group))
                for j, n in enumerate(size):
                    if not n or not m.langs:
                        langs.append(UNKNOWN), scores.append(0.0), rates.append(0.0)
                        continue
                    # a few characters cannot show a language's own rate
                    own = np.array(m.rates)
                    rate = total[:, j] / n / (own ** (n / (n + 200)) * own.mean() ** (200 / (n + 200)))
                    best = int(rate.argmin())
                    odds = np.exp(-(rate - rate[best]) * min(n, 2000) / 20)
                    langs.append(m.langs[best]), scores.append(float(1 / odds.sum())), rates.append(float(rate[best]))
            yield pa.RecordBatch.from_arrays(
                [batch.column(0), pa.array(langs, pa.string()), pa.array(scores, pa.float64()),
                 pa.array(rates, pa.float64())], [id_col, "lang_pred", "score", "phrase_rate"])

    return docs.select(id_col, F.col(text_col).cast("string").alias("__text")).mapInArrow(
        run, f"`{id_col}` {id_type}, lang_pred string, score double, phrase_rate double")
