"""Small tables and brute-force versions for the text operators."""

import itertools
import os
import sys

sys.path.insert(0, os.path.dirname(os.path.dirname(os.path.dirname(os.path.abspath(__file__)))))

BLANKS = " \t\n\x0b\x0c\r"

# null, empty, blank, tiny, long and repeated texts; ids tie and repeat
ODD = [(1, None), (2, ""), (3, " \n\t "), (4, "x"), (5, "one two three"), (6, "word " * 3000), (7, "ünï cödé 日本 \U0001f600"),
       (7, "ünï cödé 日本 \U0001f600"), (7, "another text of the same id"), (None, "no id here at all"), (8, "a" * 20000)]


def documents(spark, rows, lang="en", source="s"):
    """A documents table with clashing and foreign columns beside it."""
    return spark.createDataFrame(
        [(i, t, lang, source, len(t or ""), "kept", 1.5) for i, t in rows],
        "doc_id long, text string, lang string, source string, n_chars long, words string, score double")


def words(text):
    return "".join(" " if c in BLANKS else c for c in (text or "")).split(" ") and [
        w for w in "".join(" " if c in BLANKS else c for c in (text or "")).split(" ") if w]


def shingle_set(text, size):
    w = [x.encode() for x in words((text or ""))]
    w = [bytes(c + 32 if 65 <= c <= 90 else c for c in x) for x in w]
    if not w:
        return set()
    return {tuple(w[i:i + size]) for i in range(len(w) - size + 1)} if len(w) >= size else {tuple(w)}


def components(rows, size, percent):
    """doc_id -> smallest id reachable, by comparing all pairs."""
    sets = {}
    for i, t in rows:
        sets.setdefault(i, []).append(shingle_set(t, size))
    parent = {i: i for i in sets}

    def find(x):
        while parent[x] != x:
            x = parent[x]
        return x

    for a, b in itertools.combinations(sets, 2):
        for x, y in itertools.product(sets[a], sets[b]):
            same = len(x & y)
            if x and y and 100 * same >= percent * (len(x) + len(y) - same):
                u, v = find(a), find(b)
                parent[max(u, v)] = min(u, v)
    return {i: find(i) for i in sets}
