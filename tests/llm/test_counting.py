"""Count transducers, phrase mining and the divergence audit."""

import random
import re
import time
from collections import Counter, defaultdict

import duckdb
import numpy as np
import pyarrow as pa
import pytest
from hypothesis import given, settings
from hypothesis import strategies as st

from marquee.llm import common, divergence, phrases
from marquee.llm.oracle import statements
from marquee.llm.queries import queries
from marquee.llm.terms import Words, blocks, classes
from marquee.llm.transducer import Counts, Tree, union
from tests.llm.helpers import ODD, documents

# transducers


def listed(tree):
    rows, counts = tree.rows()
    return [(tuple(int(x) for x in a if x), int(b)) for a, b in zip(rows, counts, strict=True)]


def sequence(seed):
    rnd = random.Random(seed)
    size, n, order = rnd.choice([2, 3, 6]), rnd.choice([1, 5, 60]), rnd.choice([1, 2, 4])
    symbols = np.sort(np.array(rnd.sample(range(1, 2**63), size + 2), np.uint64))
    items = np.array([rnd.randrange(2, size + 2) for _ in range(n)])
    heads = np.array([rnd.randrange(2) for _ in range(n)])
    room = np.array([min(order, n - i, rnd.randrange(0, order + 2)) for i in range(n)])
    counts = Counter((int(symbols[heads[i]]), *(int(symbols[x]) for x in items[i:i + room[i]]))
                     for i in range(n) if room[i])
    return symbols, heads, items, room, order, counts


@pytest.mark.parametrize("seed", range(40))
def test_transducers_hold_the_counts(seed):
    symbols, heads, items, room, order, counts = sequence(seed)
    want = sorted(counts.items())
    tree = Tree.of_sequence(symbols, heads, items, room, order)
    rows, own = tree.rows()
    assert listed(tree) == listed(Tree.of_rows(rows, own)) == want
    automaton = Counts.load(Counts.of(tree).dump())
    assert listed(automaton.tree()) == want
    asked = np.concatenate([rows, np.random.default_rng(seed).choice(symbols, (9, order + 1))])
    assert automaton.compose(asked).tolist() == [counts.get(tuple(int(x) for x in a if x), 0) for a in asked]
    half = len(rows) // 2
    parts = [Tree.of_rows(rows[a:b], own[a:b]) for a, b in ((0, half), (half // 2, len(rows)), (0, 0))]
    total = Counter()
    for part in parts:
        total.update(dict(listed(part)))
    assert listed(union(parts)) == sorted(total.items())


def test_equal_states_are_shared():
    # every first label is followed by the same two n-grams
    rows = np.array([[a, b, c] for a in range(1, 60) for b, c in ((5, 6), (7, 8))], np.uint64)
    automaton = Counts.of(Tree.of_rows(rows, np.ones(len(rows), np.int64)))
    assert [len(f) - 1 for f in automaton.first] == [1, 1, 2]
    assert listed(automaton.tree()) == [(tuple(r), 1) for r in rows.tolist()]


# words

GAPS = classes(" \t.,")


@settings(max_examples=50, deadline=None)
@given(st.lists(st.text(alphabet="aB é.\t", max_size=30), max_size=6))
def test_words_of_texts(texts):
    from marquee.llm.shingles import text_bytes

    words = Words(*text_bytes(pa.array(texts, pa.string())), GAPS)
    want = [(i, w) for i, t in enumerate(texts) for w in re.findall(r"[^ \t.,]+", t.replace("B", "b"))]
    assert list(zip(words.doc.tolist(), words.strings(np.arange(len(words))).to_pylist(), strict=True)) == want
    brk = words.breaks(classes("."))
    pieces = [(i, w) for i, t in enumerate(texts) for p in t.replace("B", "b").split(".")
              for w in re.findall(r"[^ \t,]+", p)[:1]]
    assert int(brk.sum()) == len(pieces)


def test_long_texts_are_divided_at_cuts():
    text = "ab cd. " * 50
    parts = [(bytes(d[o[0]:o[-1]]), w.tolist()) for d, o, w in blocks(pa.array(["x", text, None, "y"]), classes("."), 40)]
    assert b"".join(p for p, _ in parts) == b"x" + text.encode() + b"y"
    assert all(len(p) <= 41 for p, _ in parts)
    assert sorted({i for _, w in parts for i in w}) == [0, 1, 2, 3]
    whole = [(bytes(d[o[0]:o[-1]])) for d, o, _ in blocks(pa.array(["z" * 100]), classes("."), 40)]
    assert whole == [b"z" * 100]


# phrases


def mined(rows, least, top=2000):
    """Brute force over (lang, text) rows."""
    f, n = Counter(), Counter()
    lower = str.maketrans("ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz")
    for lang, text in rows:
        lang = "und" if lang is None else lang
        for piece in re.split(r"[.,;:!?\n-\r]", (text or "").translate(lower)):
            w = re.findall(r"[^ \t]+", piece)
            n[lang] += len(w)
            f.update((lang, *w[i:i + m]) for m in range(1, 5) for i in range(len(w) - m + 1))
    cand = {p: a for p, a in f.items() if len(p) > 2 and a >= least}
    longer = defaultdict(int)
    for p, a in cand.items():
        w = p[1:]
        for m in range(2, len(w)):
            for i in range(len(w) - m + 1):
                longer[(p[0], *w[i:i + m])] = max(longer[(p[0], *w[i:i + m])], a)
    out = defaultdict(list)
    for p, a in cand.items():
        if 100 * longer[p] >= 80 * a:
            continue
        score, _, left, right = min((2000000 * a // (f[p[:k + 1]] + f[(p[0], *p[k + 1:])]), k, f[p[:k + 1]],
                                     f[(p[0], *p[k + 1:])]) for k in range(1, len(p) - 1))
        out[p[0]].append((-score, -a, " ".join(p[1:]).encode(), left, right))
    return sorted((lang, k + 1, p.decode(), -a, left, right, n[lang], -score) for lang, found in out.items()
                  for k, (score, a, p, left, right) in enumerate(sorted(found)[:top]))


def texts(seed, n=60):
    rnd = random.Random(seed)
    words = ["a", "B", "the", "new", "York", "é", "x#", "日本"]
    rows = []
    for _ in range(n):
        parts = rnd.choices(words, k=rnd.randrange(0, 25)) + rnd.choice([[], ["new", "york", "city", "hall"]])
        rows.append((rnd.choice(["en", "de", None, ""]), rnd.choice([" ", "  ", "\t"]).join(parts) +
                     rnd.choice(["", ".", "\n", " a, the b!"])))
    return rows + [("en", None), ("en", ""), ("fr", " . ")]


def table(spark, rows):
    return spark.createDataFrame([(i, t, lang, "s", 0, 1) for i, (lang, t) in enumerate(rows)],
                                 "doc_id long, text string, lang string, rank string, path int, f int")


@pytest.mark.parametrize("seed", [1, 2])
def test_phrases_equal_brute_force(spark, seed):
    rows = texts(seed)
    got = sorted(tuple(r) for r in phrases.mine(table(spark, rows), least=4, top=25).collect())
    assert got == mined(rows, 4, 25) and len(got) > 20


def test_many_ranges_and_split_texts_change_nothing(spark, monkeypatch):
    rows = [*texts(3), ("en", "hot hot " * 400 + ". " + "hot pair x " * 200)]
    monkeypatch.setattr(phrases, "MARK", 4)
    monkeypatch.setattr(phrases, "RANGE", 32)
    got = sorted(tuple(r) for r in phrases.mine(table(spark, rows).repartition(4), least=5).collect())
    assert got == mined(rows, 5)


@pytest.mark.parametrize("seed", range(10))
def test_a_run_is_cut_at_the_bounds_inside_it_only(seed):
    rng = np.random.default_rng(seed)
    edge = np.array([0, 1, 255, 256, 2**63, 2**64 - 1], np.uint64)
    rows = np.unique(np.where(rng.random((300, 3)) < .5, rng.choice(edge, (300, 3)), rng.integers(1, 2**63, (300, 3), np.uint64)),
                     axis=0)
    bounds = rows[rng.random(len(rows)) < rng.choice([0, .1, .9])]
    run = rows[rng.integers(0, 100):rng.integers(101, len(rows))]
    first, edges = phrases._cut(run, phrases._strings(bounds))
    low, high = tuple(run[0]), tuple(run[-1])
    assert len(edges) == 2 + sum(low < tuple(b) <= high for b in bounds)
    pieces = [(first + i, tuple(r)) for i, (a, b) in enumerate(zip(edges[:-1], edges[1:], strict=True)) for r in run[a:b]]
    assert pieces == [(sum(tuple(b) <= tuple(r) for b in bounds), tuple(r)) for r in run]


def test_many_parts_are_summed_by_one_sort(monkeypatch):
    sorts = []
    monkeypatch.setattr(np, "lexsort", lambda keys, f=np.lexsort: sorts.append(len(keys[0])) or f(keys))
    part = Tree.of_rows(np.array([[1, 2], [1, 3], [4, 0]], np.uint64), np.array([5, 1, 2]))
    assert listed(union([part] * 500)) == [((1, 2), 2500), ((1, 3), 500), ((4,), 1000)]
    assert sorts == [1500]


def test_runs_and_shuffles_do_not_stay(spark, tmp_path, monkeypatch):
    monkeypatch.setattr(common, "scratch_path", lambda spark, name: f"{tmp_path}/{name}")
    disk = spark.sparkContext._jvm.org.apache.spark.SparkEnv.get().blockManager().diskBlockManager()

    def shuffled():
        return set(re.findall(r"shuffle_\d+_\d+_\d+[.]data", disk.getAllFiles().mkString(" ")))

    settings, before = spark.conf.getAll, shuffled()
    found = phrases.mine(table(spark, texts(4)).repartition(3), least=4)
    for _ in range(100):  # they are deleted beside the job
        if not shuffled() - before:
            break
        time.sleep(.1)
    assert not shuffled() - before and spark.conf.getAll == settings
    stored = {p.name.split("-")[1] for p in tmp_path.glob("llm-*")}
    assert {"short", "long", "words", "kept"} <= stored and not stored & {"pairs", "phrases"}
    assert sorted(tuple(r) for r in found.collect()) == mined(texts(4), 4)


def test_phrases_of_empty_tables(spark):
    assert phrases.mine(table(spark, [])).collect() == []
    assert phrases.mine(table(spark, [("en", None), (None, "one two")])).collect() == []


def test_scores_pass_64_bits(spark):
    big = 9_000_000_000_000_000
    rows = [([1, 2], big), ([1, 3], big), ([1, 2, 3], big - 1)]
    counted = spark.createDataFrame(rows, "path array<bigint>, f bigint")
    row = phrases.candidates(counted).first()
    assert row.score == 2000000 * (big - 1) // (2 * big) and row.l == row.r == big


# divergence


def audited(rows, least=10, top=10):
    """Brute force over (lang, source, text) rows."""
    lower = str.maketrans("ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz")
    df, count, groups = Counter(), Counter(), set()
    for lang, source, text in rows:
        lang, source = lang or "", source or ""
        groups.add((lang, source))
        found = re.findall(r"[^\x00-\x40\x5B-\x60\x7B-\x7F]+", (text or "").translate(lower))
        df.update((lang, t) for t in set(found))
        count.update((lang, source, t) for t in found)
    out = []
    for lang in {g[0] for g in groups}:
        kept = sorted(t for (x, t), n in df.items() if x == lang and n >= least)
        sources = sorted(s for x, s in groups if x == lang)
        p = {}
        for s in sources:
            n = [count[lang, s, t] for t in kept]
            p[s] = [1 + 10**9 * (x + 2) // (sum(n) + 2 * len(kept)) for x in n] if kept else []
        n = [sum(count[lang, s, t] for s in sources) for t in kept]
        q = [1 + 10**9 * (x + 2) // (sum(n) + 2 * len(kept)) for x in n] if kept else []
        for s in sources:
            pairs = [(-sum((a - b)**2 // (a + b) for a, b in zip(p[s], p[t], strict=True)), t.encode())
                     for t in sources if t != s]
            out += [(lang, s, "pair", t.decode(), -v, k + 1) for k, (v, t) in enumerate(sorted(pairs))]
            terms = [(-((a - b)**2 // (a + b)), t.encode()) for a, b, t in zip(p[s], q, kept, strict=True)
                     if a > b and count[lang, s, t]]
            out += [(lang, s, "term", t.decode(), -v, k + 1) for k, (v, t) in enumerate(sorted(terms)[:top])]
    return sorted(out)


def sourced(seed, n=80):
    rnd = random.Random(seed)
    words = ["a", "B", "the", "York7x", "é", "日本", "--", "zz"]
    rows = [(rnd.choice(["en", "de", None]), rnd.choice(["s1", "s2", "s3", None]),
             " ".join(rnd.choices(words, k=rnd.randrange(0, 8)))) for _ in range(n)]
    return rows + [("en", "s1", "copied text the a")] * 12 + [("en", "only empty", None), ("xx", "lonely", "word"),
                                                             ("yy", "u", ""), ("yy", "v", None)]


def sources_table(spark, rows):
    return spark.createDataFrame([(i, t, lang, s, "x", 1) for i, (lang, s, t) in enumerate(rows)],
                                 "doc_id long, text string, lang string, source string, key string, rank int")


@pytest.mark.parametrize("slices", [1024, 2])
def test_audit_equals_brute_force(spark, monkeypatch, slices):
    monkeypatch.setattr(divergence, "SOURCES", slices)
    rows = sourced(slices)
    got = sorted(tuple(r) for r in divergence.audit(sources_table(spark, rows), least=5).collect())
    assert got == audited(rows, 5)
    assert {"pair", "term"} == {r[2] for r in got}


def test_audit_of_odd_rows_and_empty_tables(spark):
    rows = [("en", "s", t) for _, t in ODD] * 2 + [("en", "t", "word one")]
    docs = sources_table(spark, rows)
    assert sorted(tuple(r) for r in divergence.audit(docs, least=1).collect()) == audited(rows, 1)
    assert divergence.audit(sources_table(spark, [])).collect() == []
    assert documents(spark, []).count() == 0


@pytest.mark.parametrize("name", ["op11_phrase_collocations", "op12_source_divergence"])
def test_query_matches_sql(spark, name):
    sf = "/root/testdata/sf0.01"
    con = duckdb.connect()
    con.execute(f"CREATE VIEW documents AS SELECT * FROM read_parquet('{sf}/documents.parquet')")
    cur = con.execute(statements()[name])
    names = [d[0] for d in cur.description]
    out = queries()[name](spark, sf)
    assert Counter(tuple(r[c] for c in names) for r in out.collect()) == Counter(cur.fetchall())
