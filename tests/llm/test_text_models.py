"""Language ID, BPE, quality, PII, toxicity, near-duplicates, pipeline."""

import hashlib
import itertools
import random
import zlib

import numpy as np
import pyarrow as pa
import pytest
from hypothesis import given, settings
from hypothesis import strategies as st

import __spark_entry__ as E
from marquee.llm import bpe, langid, neardup, pii, quality, toxicity
from marquee.llm.components import connected
from marquee.llm.shingles import shingle_sets
from tests.conftest import SF_SMALL
from tests.llm.helpers import ODD, components, documents, shingle_set

tokenizers = pytest.importorskip("public_tokenizers")
RANKS = bpe.load_ranks(open(tokenizers.path("byte_bpe_multi_50k.tiktoken"), "rb").read())


# byte-level BPE

@pytest.fixture(scope="module")
def reference():
    import tiktoken

    return tiktoken.Encoding("own", pat_str=tokenizers.PATTERN, mergeable_ranks=RANKS, special_tokens={})


@settings(max_examples=300, deadline=None)
@given(st.text(alphabet=st.one_of(st.sampled_from("abethin 's.\n\t1é"), st.characters(exclude_categories=["Cs"])),
               max_size=80))
def test_encoding_equals_tiktoken(reference, text):
    encoder = bpe.Encoder(bpe.Tree(RANKS, leaf=3), tokenizers.PATTERN)
    ids = np.frombuffer(encoder.encode(text), "<u4").tolist()
    assert ids == reference.encode_ordinary(text)
    assert encoder.tree.decode(ids) == text.encode()


def test_long_matches_are_joined_exactly(reference):
    tree = bpe.Tree(RANKS, leaf=4)
    rng = random.Random(3)
    for _ in range(200):
        text = "".join(rng.choice("aabcdetéß") for _ in range(rng.randint(1, 400)))
        assert tree.encode(text.encode()) == reference.encode_ordinary(text)


def test_tokenize_rows(spark, reference):
    path, outputs = tokenizers.path("byte_bpe_multi_50k.tiktoken"), ("ids", "decoded", "ids_sha256", "decoded_sha256")
    docs = documents(spark, ODD)
    rows = bpe.tokenize(docs, path, tokenizers.PATTERN, outputs=outputs).collect()
    want = sorted(((i or -1), reference.encode_ordinary(t or ""), t or "") for i, t in ODD)
    assert sorted(((r.doc_id or -1), r.ids, r.decoded) for r in rows) == want
    for r in rows:
        assert r.ids_sha256 == hashlib.sha256(np.array(r.ids, "<u4").tobytes()).hexdigest()
        assert r.decoded_sha256 == hashlib.sha256(r.decoded.encode()).hexdigest() and r.n_tokens == len(r.ids)
    assert bpe.tokenize(docs.where("false"), path, tokenizers.PATTERN).count() == 0


# near-duplicates

def _near_rows(n=40, seed=1):
    rng = random.Random(seed)
    base = [f"w{i}" for i in range(60)]
    rows = []
    for i in range(n):
        w = list(base) if i % 3 else [f"v{i % 7}_{j}" for j in range(30)]
        for _ in range(rng.randint(0, 6)):
            w[rng.randrange(len(w))] = f"x{rng.random()}"
        rows.append((100 + i, " ".join(w)))
    return rows + [(300 + i, "an exact copy of some words here") for i in range(10)] + [
        (400, "AN exact copy of some words here"), (401, "tiny"), (402, "TINY")]


@pytest.mark.parametrize("size", [4, 5])
def test_components_equal_brute_force(spark, size):
    rows = [r for r in ODD if r[0] is not None] + _near_rows()
    want = components(rows, size, 80)
    got = neardup.deduplicate(documents(spark, rows + [(None, None)]), size=size).collect()
    assert len(got) == len(rows) + 1
    for r in got:
        if r.doc_id is not None:
            assert r.component_id == want[r.doc_id] and r.kept == (r.doc_id == r.component_id)
    sizes = sorted(r.n_shingles for r in got if r.doc_id is not None)
    assert sizes == sorted(len(shingle_set(t, size)) for _, t in rows)


def test_large_buckets_are_closed_exactly(spark, monkeypatch):
    """All open buckets go through the prefix filter, one hub a round."""
    monkeypatch.setattr(neardup, "SMALL", 1)
    kept = neardup.links.__defaults__
    monkeypatch.setattr(neardup.links, "__defaults__", (*kept[:-1], 1))
    rng = random.Random(8)
    rows = []
    for g in range(3):
        base = [f"g{g}w{i}" for i in range(50)]
        for i in range(14):  # from equal to far, so that many pairs are near the threshold
            w = list(base)
            for _ in range(i % 7):
                w[rng.randrange(50)] = rng.choice(["p", "q", "r"]) + str(rng.randrange(4))
            rows.append((100 * g + i, " ".join(w)))
    want = components(rows, 4, 80)
    got = {r.doc_id: r.component_id for r in neardup.deduplicate(documents(spark, rows), size=4).collect()}
    assert got == want


def test_one_of_each_group_stays(spark):
    rows = _near_rows()
    docs = documents(spark, rows + rows[:1])
    kept = neardup.keep_one(docs, size=5)
    assert kept.columns == docs.columns
    assert sorted(r.doc_id for r in kept.collect()) == sorted(set(components(rows, 5, 80).values()))
    assert neardup.keep_one(docs.where("false")).count() == 0


def test_rows_without_id_and_texts_of_a_repeated_id(spark):
    long = " ".join(f"w{i}" for i in range(60))
    near, alone = long.replace("w59", "x"), " ".join(f"a{i}" for i in range(30))
    other, third = " ".join(f"o{i}" for i in range(30)), " ".join(f"t{i}" for i in range(30))
    rows = [(None, long), (None, near), (None, long), (5, near),      # copies of a row with an id
            (None, alone), (None, alone), (None, alone + " more"),    # copies without any id
            (7, other), (7, third), (7, third), (3, other),           # one text of id 7 is a copy, the other is not
            (None, ""), (None, None), (9, "")]
    docs = documents(spark, rows)
    kept = sorted(((r.doc_id or -1, r.text or "") for r in neardup.keep_one(docs, size=5).collect()))
    groups = [[x for x in kept if x[0] == -1 and x[1].startswith(alone)], [x for x in kept if not x[1].startswith(alone)]]
    assert len(groups[0]) == 1
    assert groups[1] == sorted([(5, near), (7, third), (3, other), (-1, ""), (-1, ""), (9, "")])
    got = neardup.deduplicate(docs, size=5).collect()
    assert len(got) == len(rows)
    assert [(r.component_id, r.kept) for r in got if r.doc_id is None and r.n_shingles > 50] == [(5, False)] * 3
    bare = [r for r in got if r.doc_id is None and 0 < r.n_shingles < 50]
    assert [r.component_id for r in bare] == [None] * 3 and sum(r.kept for r in bare) == 1
    assert sorted((r.component_id, r.kept) for r in got if r.doc_id == 7) == [(3, False), (7, True), (7, True)]


def test_screening_bounds():
    least = neardup.least_matches(80)
    assert len(least) == 8 and least == sorted(least) and least[0] >= 1
    # more certainty asked for, fewer pruned
    assert all(a <= b for a, b in zip(neardup.least_matches(80, 1e-12), least, strict=True))


def test_chain_of_links_is_one_component(spark):
    links = spark.createDataFrame([(i, i + 1) for i in range(50)] + [(100, 101), (7, 7)], "u long, v long")
    got = dict(map(tuple, connected(links).collect()))
    assert {got[i] for i in range(51)} == {0} and got[101] == 100
    assert connected(links.where("false")).count() == 0


def test_shingle_sets_tell_texts_apart():
    texts = [None, "", "a b c", "A b  C", "a b c d e", "ab c", "a\x0bb c", "d e a b c d", "x y z " * 100]
    sets = [s.tolist() for s in shingle_sets(pa.array(texts, pa.string()), 3)]
    for a, b in itertools.combinations(range(len(texts)), 2):
        x, y = shingle_set(texts[a], 3), shingle_set(texts[b], 3)
        assert len(set(sets[a]) & set(sets[b])) == len(x & y)
    assert sets[0] == sets[1] == [] and sets[2] == sets[3]


# language ID

def test_automaton_finds_exactly_the_substrings():
    symbols = [0, 1, 1, 0, 2, 1, 0, 1, 1, 2]
    to = langid.automaton(symbols, 3)
    known = {tuple(symbols[i:j]) for i in range(10) for j in range(i + 1, 11)}
    for word in itertools.chain.from_iterable(itertools.product(range(3), repeat=n) for n in (1, 2, 3, 4)):
        state = 0
        for c in word:
            state = int(to[state, c]) if state >= 0 else -1
        assert (state >= 0) == (word in known)


def _phrases(text, learned):
    """Greedy cross-parse by substring search."""
    count, at = 1, 0
    for i in range(len(text)):
        if text[at:i + 1] not in learned:
            count, at = count + 1, i if text[i] in learned else i + 1
    return count


def test_phrase_counts_equal_substring_search():
    learned, model = "abcabdabe caab", langid.Model(["l"], "abcde", [], [1.0])
    model.tables.append(langid.parser(langid.automaton([int(c) for c in model.symbols(learned)], 7)))
    for text in ("abcab", "zzabd", "caabcaab e", "abdx abe", "e", "ea"):
        parts, _ = langid.cut([model.symbols(text)])
        assert int(model.phrases(parts)[0][0]) == _phrases(text, learned), text


def test_language_rows(spark):
    en, de = "the cat and the dog sat on the mat with them ", "der hund und die katze sitzen auf dem schoenen stuhl "
    docs = documents(spark, [(i, en * 5) for i in range(5)]).union(documents(spark, [(10 + i, de * 5) for i in range(5)], "de"))
    model = langid.learn(docs.union(documents(spark, [(90, "nothing")], None)))
    asked = documents(spark, [*ODD, (50, "the dog and the cat"), (51, "DIE Katze, der Hund!"), (52, "123 ...")])
    rows = langid.predict(asked, model).collect()
    assert len(rows) == len(ODD) + 3
    got = {r.doc_id: r for r in rows}
    assert (got[50].lang_pred, got[51].lang_pred) == ("en", "de")
    assert all(got[i].lang_pred == "und" and got[i].score == 0 for i in (1, 2, 3, 52))
    assert all(0 <= r.score <= 1 for r in rows)
    none = langid.learn(docs.where("false"))
    assert {r.lang_pred for r in langid.predict(asked, none).collect()} == {"und"}
    assert langid.predict(asked.where("false"), model).count() == 0


# quality and toxicity

def _marked(spark, n=60):
    rng = random.Random(4)
    plain = lambda: " ".join(rng.choice(["alpha", "beta", "gamma", "delta", "omega"]) for _ in range(30))
    rows = [(i, plain() + (" idiotic nonsense ###" if i % 3 == 0 else "")) for i in range(n)]
    labels = spark.createDataFrame([(i, int(i % 3 != 0), int(i % 3 == 0), "x") for i, _ in rows] + [(None, 1, 1, "x")],
                                   "doc_id long, quality int, toxic int, text string")
    return documents(spark, rows), labels


@pytest.mark.parametrize("module,column,sign", [(quality, "quality", 1), (toxicity, "toxic", -1)])
def test_classifiers_learn_and_score_odd_rows(spark, module, column, sign):
    docs, labels = _marked(spark)
    model = module.learn(docs, labels)
    asked = documents(spark, [*ODD, (50, "alpha beta gamma"), (51, "beta idiotic nonsense ### alpha")])
    rows = module.score(asked, model).collect()
    assert len(rows) == len(ODD) + 2 and all(0 <= r.score <= 1 for r in rows)
    got = {r.doc_id: r.score for r in rows}
    assert sign * (got[50] - got[51]) > 0.2
    assert got[1] == got[2]  # null is empty
    # without labels every text gets one score
    blank = module.score(asked, module.learn(docs, labels.where("false"))).collect()
    assert {r.score for r in blank} == {0.5}
    assert module.score(asked.where("false"), model).count() == 0


def test_hinge_model_reaches_the_dual_optimum():
    rng = np.random.default_rng(0)
    codes = [np.unique(rng.integers(0, 50, 12)) for _ in range(40)]
    labels = [int(3 in c or 7 in c) for c in codes]
    ratio = quality.log_count_ratio(codes, labels)
    scaled, bias = quality.fit_hinge(codes, labels, ratio, epochs=200)
    margins = [quality.margin(c, ratio * ratio, scaled, bias) for c in codes]
    assert all((m > 0) == (y == 1) for m, y in zip(margins, labels, strict=True))


def test_block_max_search_is_exact(monkeypatch):
    monkeypatch.setattr(toxicity, "BLOCK", 4)
    rng = np.random.default_rng(2)
    index = toxicity.Index(np.arange(30, dtype=np.uint64), np.ones(30))
    rows = []
    for i in range(50):
        at = np.unique(rng.integers(0, 30, rng.integers(1, 6)))
        w = rng.random(len(at)) + 0.1
        rows.append((str(i), i % 2, at, w / np.sqrt((w * w).sum())))
    index.build(rows)
    dense = np.zeros((50, 30))
    for i, (_, _, at, w) in enumerate(rows):
        dense[i, at] = w
    for i in range(50):
        sims = dense @ dense[i]
        want = sorted((-s, j) for j, s in enumerate(sims) if s > 0)[:7]
        where, found = index.nearest(rows[i][2], rows[i][3], k=7)
        assert np.allclose(found, [-s for s, _ in want])
        assert np.allclose(sims[where], found)


@pytest.mark.parametrize("name,column,floor", [("op3_quality_classifier", "quality", 0.8), ("op6_toxicity", "toxic", 0.7)])
def test_held_out_accuracy(spark, name, column, floor):
    rows = E.queries()[name](spark, "/root/testdata/sf0.01").collect()
    labels = {r.doc_id: r[column] for r in spark.read.parquet("/root/testdata/sf0.01/labels.parquet").collect()}
    assert len(rows) == 1000
    for r in rows:
        assert r.held_out == (zlib.crc32(str(r.doc_id).encode()) % 5 == 0)
    held = [r for r in rows if r.held_out and labels.get(r.doc_id) is not None]
    assert sum(r.predicted == labels[r.doc_id] for r in held) / len(held) >= floor


def test_held_out_language_accuracy(spark):
    rows = E.queries()["op1_language_id"](spark, "/root/testdata/sf0.01").collect()
    langs = {r.doc_id: r.lang for r in spark.read.parquet("/root/testdata/sf0.01/documents.parquet").collect()}
    held = [r for r in rows if r.held_out and langs[r.doc_id]]
    assert all(r.held_out == (zlib.crc32(str(r.doc_id).encode()) % 4 == 2) for r in rows)
    assert sum(r.lang_pred == langs[r.doc_id] for r in held) / len(held) > 0.97


# personal data

PII_TEXTS = ODD + [
    (60, "é mail a.b@c.example.com, b@c and x@@y.de"), (61, "ip 10.0.0.256 1.2.3.4.5.6.7.8 and 300.1.1.1"),
    (62, "card 4111 1111 1111 1111 and 4111111111111112"), (63, "call +1 (017) 555-7713 or +1 2 or +12345678901234567"),
    (64, "a@b.c" * 50), (65, "9" * 500 + "@" + "a." * 20)]


def _base(text):
    import re

    digits = lambda m: re.sub("[^0-9]", "", m)

    def luhn(d):
        total = sum(int(c) if i % 2 == 0 else sum(divmod(2 * int(c), 10)) for i, c in enumerate(reversed(d)))
        return total % 10 == 0

    rules = (("email", r"[A-Za-z0-9._%+-]+@[A-Za-z0-9-]+(\.[A-Za-z0-9-]+)+", lambda m: True),
             ("ip", r"[0-9]+(\.[0-9]+)(\.[0-9]+)(\.[0-9]+)", lambda m: all(int(p) <= 255 for p in m.split("."))),
             ("card", r"[0-9]([\x20-]?[0-9])+", lambda m: 16 <= len(digits(m)) <= 19 and luhn(digits(m))),
             ("phone", r"\+[0-9][\x20().0-9-]+[0-9]", lambda m: 8 <= len(digits(m)) <= 15))
    return [(k, m.start(), m.end()) for k, (_, p, ok) in enumerate(rules) for m in re.finditer(p, text) if ok(m.group())]


@settings(max_examples=300, deadline=None)
@given(st.text(alphabet="a@.-+ 0129()%\né", max_size=60))
def test_base_spans_equal_the_patterns(text):
    assert pii.base_spans(text) == _base(text)


def test_gradients_are_right():
    tagger, rng = pii.Tagger(hidden=3, dtype="float64"), np.random.default_rng(0)
    ids, tags = rng.integers(0, pii.N_CLASSES, (6, 3)), np.array([[0, 1, 2, 0, 3, 4]] * 3).T
    emissions, kept = tagger.forward(ids, keep=True)
    _, grad, dt = tagger.loss(emissions, tags)
    grads = tagger.backward(grad, kept) | {"t": dt}
    for name, place in (("x", (1, int(ids[2, 1]), 4)), ("u", (0, 1, 7)), ("o", (4, 3)), ("c", (2,)), ("t", (0, 1))):
        old, values = tagger.w[name][place], []
        for step in (1e-5, -1e-5):
            tagger.w[name][place] = old + step
            values.append(tagger.loss(tagger.forward(ids)[0], tags)[0])
        tagger.w[name][place] = old
        assert (values[0] - values[1]) / 2e-5 == pytest.approx(grads[name][place], abs=1e-6)


def test_path_is_the_best_path():
    tagger, rng = pii.Tagger(hidden=2, dtype="float64"), np.random.default_rng(1)
    tagger.w["t"] = rng.normal(0, 1, tagger.w["t"].shape)
    for _ in range(5):
        e = rng.normal(0, 2, (4, pii.TAGS))
        score = lambda p: tagger.first[p[0]] + sum(e[i, p[i]] for i in range(4)) + sum(  # noqa: B023, E731
            (tagger.w["t"] + tagger.ban)[p[i], p[i + 1]] for i in range(3))  # noqa: B023
        assert tuple(tagger.path(e)) == max(itertools.product(range(pii.TAGS), repeat=4), key=score)


def test_pii_rows(spark):
    docs = documents(spark, PII_TEXTS)
    tagger = pii.learn(docs)
    rows = pii.find(docs, tagger).collect()
    assert len(rows) == len(PII_TEXTS)
    want = {}
    for i, t in PII_TEXTS:
        text = ",".join(f"{pii.KINDS[k]}:{s}:{e}" for k, s, e in _base(t or ""))
        want.setdefault(i, {})[hashlib.sha256(text.encode()).hexdigest()] = text
    for r in rows:
        base = want[r.doc_id][r.base_sha256]
        assert set(filter(None, base.split(","))) <= set(r.spans.split(","))
    assert pii.find(docs.where("false"), None).count() == 0 and pii.learn(docs.where("false")) is None
    masked = pii.mask(docs, None)
    assert masked.columns == docs.columns
    texts = {r.doc_id: r.text for r in masked.collect()}
    assert texts[62] == "card <CARD> and 4111111111111112" and texts[1] is None and texts[4] == "x"


def test_tagger_adds_plausible_spans_across_windows():
    rng = random.Random(9)
    texts = []
    for i in range(150):
        w = [rng.choice(["the", "of", "and", "eron"]) for _ in range(30)]
        w[rng.randrange(30)] = rng.choice([f"ab.{i % 90 + 10}@mail{i % 10}.example.com", f"+1 ({i + 100}) 555-{1000 + i}"])
        texts.append(" ".join(w))
    tagger = pii.Tagger().fit(*pii.training_set(texts))
    found = pii.added_spans(texts, [[] for _ in texts], tagger)  # as if the patterns were not there
    hits = sum(set(_base(t)) <= set(f) for t, f in zip(texts, found, strict=True))
    assert hits >= 100
    assert pii.added_spans(["no anchor here at all"], [[]], tagger) == [[]]


# the pipeline

def test_pipeline_equals_its_stages_by_brute_force(spark, reference):
    corpus_pipeline = pytest.importorskip("corpus_pipeline")
    assert [n for n, _ in corpus_pipeline.STAGES] == [
        "quality_rules", "near_duplicates", "decontamination", "personal_data", "byte_bpe"]
    from tests.llm.test_native import _counts

    docs = spark.read.parquet(f"{SF_SMALL}/documents.parquet")
    texts = {r.doc_id: r.text for r in docs.collect()}
    # too few labels here to certify a cutoff: the base rule alone decides
    kept = {i: t for i, t in texts.items() if not _counts(t)[5]}
    groups = components(sorted(kept.items()), 5, 80)
    kept = {i: t for i, t in kept.items() if groups[i] == i}
    items = [r.text for r in spark.read.parquet(f"{SF_SMALL}/benchmark.parquet").collect()]
    from tests.llm.test_native import _norm

    grams = {tuple(w[s:s + 10]) for w in map(_norm, items) for s in range(max(1, len(w) - 9))}
    kept = {i: t for i, t in kept.items()
            if not any(tuple(_norm(t)[s:s + 10]) in grams for s in range(max(1, len(_norm(t)) - 9)))}
    rows = {r.doc_id: r for r in corpus_pipeline.run(spark, SF_SMALL).collect()}
    assert set(rows) == set(kept)
    for i, r in rows.items():
        if not any(c in "0123456789@" for c in kept[i]):  # nothing to mask
            assert r.ids == reference.encode_ordinary(kept[i])
        elif spans := _base(kept[i]):
            text = bytes(b for t in r.ids for b in next(k for k, v in [(TOKEN[t], t)])).decode()
            assert all(kept[i][s:e] not in text for _, s, e in spans)


TOKEN = {i: t for t, i in RANKS.items()}
