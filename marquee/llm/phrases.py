"""Phrase collocation mining with weighted acyclic automata.

A phrase is 2 to 4 words in a row inside a piece of text. Its parts meet
more often than by chance when the phrase is frequent beside its parts.

1. **Count.** Every block of text gives the sorted n-grams of its
   positions as a count transducer (``transducer``): from each word the next
   words up to the order, clipped at the end of the piece, after the
   language as first label. The count of any shorter n-gram is the weight of
   its arc, the sum over the range of n-grams that start with it. Labels are
   64-bit hashes of words.
2. **Union by prefix range.** The transducers are stored in runs of ``MARK``
   n-grams; one n-gram of each run, its mark, gives range bounds of about ``RANGE`` n-grams.
   Bounds are whole n-grams, so a hot word, or a hot prefix of any length,
   is spread over as many ranges as it needs. A run is cut into neighbouring
   pieces of its sorted n-grams; each range is summed in one task by one sort
   of its pieces, so many small pieces cost no more than a few large ones. An
   n-gram inside a range has its count there; one that a bound runs through
   has partial counts in a few ranges, added afterwards.
3. **Two orders.** Words and pairs are counted first. A phrase of 3 or 4
   words holds only pairs that are as frequent as itself, so the second
   count takes n-grams inside runs of frequent pairs only. The pairs are
   known by a bit array of ``BITS`` bits (16 MB at any size of the corpus);
   equal bits let a rare pair pass, which costs work and changes no count.
4. **Compose.** Every way to cut a candidate in two asks for the counts of
   its parts. The distinct parts are composed with count transducers of the
   counted n-grams, cell by cell, and joined back; the lowest score counts.

Sums, scores and comparisons are integers (products as decimals).

Defined results: null texts are empty, a null language is ``und``; words of
equal 64-bit hash count as one word (none below some billion words);
repeated rows all count; an empty table gives an empty table; other columns
are ignored. Text between two marks of a piece is held in one task.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from marquee.llm.common import discard, materialize, ship, shuffles_removed, small_batches

ORDER = 4
LEAST = 30
TOP = 2000
COVER_PERCENT = 80
NO_LANGUAGE = "und"
MARK = 1 << 15
RANGE = 1 << 20
# runs, or pieces of them (1.5 MB at most each), that go to Python at once
PIECES = 16
# marks on the driver (some 40 MB at most): beyond it, chosen by their hash
MAX_MARKS = 1_000_000
BITS = 1 << 27
CELL = 1 << 20
# the last cut of a ranking is made over the first ones of so many parts
PARTS = 64
CUTS = ".,;:!?\n\x0b\x0c\r"
SCALE = 2_000_000


def _labels_of(texts):
    """Labels of the values of an Arrow string column (not words)."""
    import numpy as np
    import xxhash

    return np.array([xxhash.xxh3_64_intdigest(t.encode(), 5) | 1 for t in texts.to_pylist()], np.uint64)


def _slots(rows):
    """Bit numbers of (language, word, word) rows of labels."""
    import numpy as np

    from marquee.llm.shingles import mix

    k = np.uint64(0x9E3779B97F4A7C15)
    out = rows[:, 0]
    for d in (1, 2):
        out = mix(out * k + rows[:, d])
    return (out >> np.uint64(37)).astype(np.int64)


def shards(docs: DataFrame, order: int, lang_col: str, text_col: str, pairs=None) -> DataFrame:
    """Per block of text, in runs of ``MARK`` n-grams: mark (one of them), n
    (how many), body (the transducer), and, with ``pairs`` (the broadcast bits
    of the frequent pairs), the words of frequent pairs as labels and words. With ``pairs`` only n-grams of
    over two words inside runs of frequent pairs are counted."""
    ship(docs.sparkSession)

    def run(batches):
        import numpy as np
        import pyarrow as pa
        import xxhash

        from marquee.llm.terms import Words, blocks, classes
        from marquee.llm.transducer import Counts, Tree

        cuts = classes(CUTS)
        gaps = classes(CUTS + " \t")

        def shard(data, offsets, langs):
            words = Words(data, offsets, gaps)
            n = len(words)
            starts = np.append(np.flatnonzero(words.breaks(cuts)), n)
            room = starts[np.searchsorted(starts, np.arange(n), "right")] - np.arange(n)
            heads = _labels_of(langs)
            of_word, index, items = np.unique(words.hashes, return_index=True, return_inverse=True)
            symbols = np.unique(np.concatenate([of_word, heads]))
            items = np.searchsorted(symbols, of_word)[items]
            head = np.searchsorted(symbols, heads)[words.doc]
            kept = np.zeros(len(of_word), bool)
            if pairs is not None:
                bits = np.frombuffer(pairs.value, np.uint8)
                good = np.zeros(n + order, bool)
                at = np.flatnonzero(room > 1)
                slot = _slots(np.stack([symbols[head[at]], words.hashes[at], words.hashes[at + 1]], 1))
                at = at[(bits[slot >> 3] >> (slot & 7).astype(np.uint8)) & 1 == 1]
                good[at] = True
                number = np.searchsorted(of_word, words.hashes)
                kept[number[at]] = kept[number[at + 1]] = True
                run = np.ones(n, np.int64)
                for k in range(order - 1, 0, -1):
                    run = np.where(good[:n], 1 + np.append(run[1:], 1), 1)
                room = np.where(run > 2, np.minimum(run, order), 0)
            tree = Tree.of_sequence(symbols, head, items, np.minimum(room, order), order)
            rows, counts = tree.rows()
            # in runs: no cell of the stored table is large. A run's mark is
            # one of its n-grams, chosen by a hash: also where blocks have one
            # run each, the marks are spread as the n-grams are
            runs = []
            for a in range(0, len(rows), MARK):
                part, n = rows[a:a + MARK], min(MARK, len(rows) - a)
                mark = part[xxhash.xxh3_64_intdigest(part[[0, -1]].tobytes()) % n]
                runs.append((mark.astype(">u8").tobytes(), n, Counts.of(Tree.of_rows(part, counts[a:a + MARK])).dump()))
            kept = np.flatnonzero(kept)
            dictionary = words.strings(index[kept]).to_pylist() if pairs is not None else []
            labels = of_word[kept].view(np.int64).tolist()
            if pairs is not None:
                for lang, label in sorted(set(zip(langs.to_pylist(), heads.view(np.int64).tolist(), strict=True))):
                    dictionary.append(lang)
                    labels.append(label)
            return runs, labels, dictionary

        for batch in batches:
            for data, offsets, owner in blocks(batch.column(1), cuts):
                runs, labels, dictionary = shard(data, offsets, batch.column(0).take(pa.array(owner)))
                runs = runs or [(None, 0, b"")]
                rest = len(runs) - 1
                yield pa.RecordBatch.from_arrays(
                    [pa.array([r[0] for r in runs], pa.binary()), pa.array([r[1] for r in runs], pa.int64()),
                     pa.array([r[2] for r in runs], pa.binary()),
                     pa.array([labels, *[[]] * rest], pa.list_(pa.int64())),
                     pa.array([dictionary, *[[]] * rest], pa.list_(pa.string()))],
                    ["mark", "n", "body", "labels", "words"])

    return docs.select(F.coalesce(F.col(f"`{lang_col}`").cast("string"), F.lit(NO_LANGUAGE)).alias("lang"),
                       F.col(f"`{text_col}`").cast("string").alias("text")).mapInArrow(
        run, "mark binary, n bigint, body binary, labels array<bigint>, words array<string>")


def _bounds(stored: DataFrame, order: int):
    """Lower bounds of all ranges but the first, as sorted rows of labels."""
    import numpy as np

    total = stored.agg(F.sum("n")).first()[0] or 0
    parts = total // RANGE
    if not parts:
        return np.zeros((0, order + 1), np.uint64)
    marks = stored.select("mark").where("n > 0").orderBy(F.xxhash64("mark")).limit(MAX_MARKS)
    found = sorted(r.mark for r in marks.collect())
    chosen = sorted({bytes(found[i * len(found) // (parts + 1)]) for i in range(1, min(parts, len(found)) + 1)})
    return np.frombuffer(b"".join(chosen), ">u8").astype(np.uint64).reshape(-1, order + 1)


def _numbers(bodies):
    """The numbers in an Arrow binary column, one body after the other."""
    import numpy as np

    ends = np.frombuffer(bodies.buffers()[1], np.int32)[[bodies.offset, bodies.offset + len(bodies)]]
    return np.frombuffer(bodies.buffers()[2].slice(ends[0], ends[1] - ends[0]), np.uint64)


def _strings(rows):
    """Rows of labels as byte strings that sort as the rows do."""
    import numpy as np

    return np.ascontiguousarray(rows, ">u8").view(f"S{8 * rows.shape[1]}").ravel()


def _cut(rows, bounds):
    """(range of the first piece, edges of the pieces) of sorted rows cut at
    ``bounds`` (sorted, as ``_strings``). Only bounds between the first and
    the last row are looked at, however many there are."""
    import numpy as np

    low, high = np.searchsorted(bounds, _strings(rows[[0, -1]]), "right")
    return int(low), np.concatenate([[0], np.searchsorted(_strings(rows), bounds[low:high]), [len(rows)]])


def count(stored: DataFrame, order: int, least: int) -> DataFrame:
    """(path, f, slot): labels of the language and of the words of every
    n-gram found ``least`` times or more, and of every language alone; slot
    is the bit number of a pair, else -1."""
    spark = stored.sparkSession
    bounds = spark.sparkContext.broadcast(_bounds(stored, order))

    def cut(batches):
        import numpy as np
        import pyarrow as pa

        from marquee.llm.transducer import Counts

        limits = _strings(bounds.value)
        for batch in batches:
            for body in batch.column(0).to_pylist():
                rows, counts = Counts.load(body).tree().rows()
                first, edges = _cut(rows, limits)
                # the pieces are neighbours in one buffer: none is made by itself
                data = np.column_stack([rows, counts.astype(np.uint64)])
                pieces = pa.Array.from_buffers(pa.binary(), len(edges) - 1, [
                    None, pa.py_buffer((edges * data.strides[0]).astype(np.int32)), pa.py_buffer(data)])
                full = np.flatnonzero(np.diff(edges))
                yield pa.RecordBatch.from_arrays([pa.array(first + full, pa.int32()), pieces.take(pa.array(full))],
                                                 ["range", "body"])

    def merge(table):
        import numpy as np
        import pyarrow as pa

        from marquee.llm.transducer import union_of_rows

        part = table.column("range")[0].as_py()
        parts = [_numbers(x).reshape(-1, order + 2) for x in table.column("body").chunks]
        ends = np.append(0, np.cumsum([len(x) for x in parts]))
        rows, counts = np.empty((ends[-1], order + 1), np.uint64, order="F"), np.empty(ends[-1], np.int64)
        for x, a, b in zip(parts, ends[:-1], ends[1:], strict=True):
            rows[a:b], counts[a:b] = x[:, :-1], x[:, -1].view(np.int64)
        tree = union_of_rows(rows, counts)
        del rows, counts, parts, x
        edges = [bounds.value[i] for i in (part - 1, part) if 0 <= i < len(bounds.value)]
        open_arcs = {x for e in edges for x in tree.on(e)}
        paths, sizes, sums, slots = [], [], [], []
        for d in range(tree.depth):
            # arcs that a bound runs through may go on in other ranges
            keep = tree.weight[d] >= (least if d else 0)
            keep[[arc for level, arc in open_arcs if level == d]] = True
            keep = np.flatnonzero(keep)
            rows = tree.paths(d, keep)
            paths.append(rows.ravel().view(np.int64))
            sizes.append(np.full(len(keep), d + 1))
            sums.append(tree.weight[d][keep])
            slots.append(_slots(rows) if d == 2 else np.full(len(keep), -1))
        ends = np.append(0, np.cumsum(np.concatenate(sizes))).astype(np.int32)
        del tree
        pa.default_memory_pool().release_unused()
        return pa.table({"path": pa.ListArray.from_arrays(ends, np.concatenate(paths)), "f": np.concatenate(sums),
                         "slot": np.concatenate(slots)})

    pieces = stored.select("body").mapInArrow(cut, "range int, body binary")
    found = pieces.groupBy("range").applyInArrow(merge, "path array<bigint>, f bigint, slot bigint")
    return found.groupBy("path").agg(F.sum("f").alias("f"), F.max("slot").alias("slot")).where(
        (F.col("f") >= least) | (F.size("path") == 1))


def _pair_bits(counted: DataFrame):
    """The bit array of the counted pairs: at most 4,096 rows of 4 KB."""
    slot = F.col("slot") + 1  # Spark numbers bits from 1
    rows = counted.where(F.size("path") == 3).groupBy(F.bitmap_bucket_number(slot).alias("bucket")).agg(
        F.bitmap_construct_agg(F.bitmap_bit_position(slot)).alias("bits")).collect()
    out = bytearray(BITS // 8)
    for r in rows:
        at = (r.bucket - 1) * 4096
        out[at:at + len(r.bits)] = r.bits
    return counted.sparkSession.sparkContext.broadcast(bytes(out))


def compose(parts: DataFrame, counted: DataFrame) -> DataFrame:
    """(path, f) of the n-grams asked for in ``parts`` (path, distinct)."""
    cells = counted.count() // CELL + 1

    def lookup(asked, known):
        import numpy as np
        import pyarrow as pa

        from marquee.llm.transducer import Counts, Tree

        def rows_of(table):
            column = table.column("path").combine_chunks()
            column = column.chunk(0) if isinstance(column, pa.ChunkedArray) else column
            size = np.diff(np.asarray(column.offsets))
            out = np.zeros((len(size), ORDER + 1), np.uint64)
            for d in range(ORDER + 1):
                on = size > d
                out[on, d] = np.asarray(column.flatten()).view(np.uint64)[
                    (np.asarray(column.offsets)[:-1] - column.offsets[0].as_py())[on] + d]
            return out

        wanted, rows = rows_of(asked), rows_of(known)
        counts = np.asarray(known.column("f").combine_chunks()).astype(np.int64)
        order = np.lexsort(rows.T[::-1])
        found = Counts.of(Tree.of_rows(rows[order], counts[order])).compose(wanted) if len(rows) else np.zeros(
            len(wanted), np.int64)
        return pa.table({"path": asked.column("path"), "f": pa.array(found, pa.int64())})

    def cell(path: str) -> Column:
        return F.pmod(F.xxhash64(path), F.lit(cells)).alias("cell")

    asked = parts.select(cell("path"), "path").groupBy("cell")
    known = counted.select(cell("path"), "path", "f").groupBy("cell")
    return asked.cogroup(known).applyInArrow(lookup, "path array<bigint>, f bigint").where("f > 0")


def candidates(counted: DataFrame) -> DataFrame:
    """Per candidate: path, a, l, r, score by its lowest-scoring cut."""
    words = F.size("path") - 1
    phrases = counted.where(words > 1).select("path", F.col("f").alias("a"))
    k = F.col("k")
    cuts = phrases.withColumn("k", F.explode(F.sequence(F.lit(1), words - 1))).select(
        "path", "a", "k", F.slice("path", 1, k + 1).alias("left"),
        F.concat(F.slice("path", 1, 1), F.slice("path", k + 2, words - k)).alias("right"))
    parts = cuts.select(F.col("left").alias("path")).union(cuts.select("right")).distinct()
    known = materialize(compose(parts, counted), "parts")
    scored = cuts.join(known.select(F.col("path").alias("left"), F.col("f").alias("l")), "left").join(
        known.select(F.col("path").alias("right"), F.col("f").alias("r")), "right").withColumn(
        "score", F.expr(f"CAST({SCALE} AS DECIMAL(7,0)) * CAST(a AS DECIMAL(19,0)) DIV (CAST(l AS DECIMAL(19,0)) "
                        "+ CAST(r AS DECIMAL(19,0)))"))
    best = scored.groupBy("path", "a").agg(F.min(F.struct("score", "k", "l", "r")).alias("best"))
    return best.select("path", "a", "best.l", "best.r", "best.score")


def uncovered(scored: DataFrame, percent: int = COVER_PERCENT) -> DataFrame:
    """Candidates but those inside a longer one of ``percent`` of their
    count or more."""
    words = F.size("path") - 1
    n = F.col("n")
    inner = (scored.where(words > 2)
             .withColumn("n", F.explode(F.sequence(F.lit(2), words - 1)))
             .withColumn("s", F.explode(F.sequence(F.lit(2), words - n + 2)))
             .select(F.concat(F.slice("path", 1, 1), F.slice("path", F.col("s"), n)).alias("path"), "a")
             .groupBy("path").agg(F.max("a").alias("longer")))
    cover = F.coalesce(F.col("longer"), F.lit(0)).cast("decimal(19,0)") * 100 >= F.col("a").cast(
        "decimal(19,0)") * percent
    return scored.join(inner, "path", "left").where(~cover).drop("longer")


def mine(docs: DataFrame, lang_col: str = "lang", text_col: str = "text", least: int = LEAST,
         top: int = TOP) -> DataFrame:
    """The ``top`` phrases of every language: lang, rank, phrase, a, l, r,
    n, score."""
    spark = docs.sparkSession
    with shuffles_removed(spark):
        pairs = materialize(shards(docs, 2, lang_col, text_col).select("mark", "n", "body"), "pairs")
        with small_batches(spark, rows=PIECES):
            short = materialize(count(pairs.where("n > 0"), 2, least), "short")
        discard(pairs)
        bits = _pair_bits(short)
        longer = materialize(shards(docs, ORDER, lang_col, text_col, bits), "phrases")
        with small_batches(spark, rows=PIECES):
            long = materialize(count(longer.where("n > 0"), ORDER, least).where(F.size("path") > 3), "long")
        bits.unpersist()
        names = longer.select(F.explode(F.arrays_zip("labels", "words")).alias("x")).groupBy(
            F.col("x.labels").alias("label")).agg(F.min("x.words").alias("word"))
        names = materialize(names, "words")
        discard(longer)
    totals = short.where(F.size("path") == 1).select(F.element_at("path", 1).alias("head"), F.col("f").alias("n"))
    counted = short.where(F.size("path") > 1).unionByName(long)
    with shuffles_removed(spark):
        kept = materialize(uncovered(materialize(candidates(counted), "candidates")), "kept")

    # a candidate has at most ORDER + 1 labels
    spelt = kept.select("path", F.posexplode("path").alias("at", "label")).join(names, "label").groupBy("path").agg(
        F.array_sort(F.collect_list(F.struct("at", "word"))).alias("names"))
    named = kept.join(spelt, "path").join(totals, F.element_at("path", 1) == F.col("head")).select(
        F.col("names")[0]["word"].alias("lang"),
        F.array_join(F.transform(F.slice("names", 2, ORDER), lambda x: x["word"]), " ").alias("phrase"),
        "a", "l", "r", "n", "score")
    order = [F.col("score").desc(), F.col("a").desc(), F.col("phrase").asc()]
    first = named.withColumn("part", F.pmod(F.xxhash64("phrase"), F.lit(PARTS))).withColumn(
        "rank", F.row_number().over(Window.partitionBy("lang", "part").orderBy(*order))).where(F.col("rank") <= top)
    last = first.withColumn("rank", F.row_number().over(Window.partitionBy("lang").orderBy(*order)).cast("bigint"))
    return last.where(F.col("rank") <= top).select("lang", "rank", "phrase", "a", "l", "r", "n", "score")
