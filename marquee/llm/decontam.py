"""Benchmark decontamination (DataFrame expressions only).

Items and documents are normalised alike: A-Z lower-cased, words are runs
of ASCII letters and digits and of anything beyond ASCII. A window is ten
consecutive words of an item; an item with one to nine words is one window
of its own length. Every token window of every document is hashed and
looked up in the set of hashed item windows; each hit is then verified word
by word against the item's window.

The item set is broadcast only when its counted windows stay under
``MAX_BROADCAST_WINDOWS``; a larger one is met by a plain join that Spark
shuffles (and splits on skew). Windows that are not in the set never leave
the task that made them.

Defined results: null and word-less texts have no words and are clean; an
empty benchmark leaves every document clean; equal items share windows and
are all reported; rows are told apart by doc_id and a hash of the text, so
rows without doc_id, or of a repeated one, are judged each by its own text,
and equal rows get equal results; other columns are kept by
``remove_documents`` and ``remove_spans`` and never read.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from marquee.llm.common import ascii_lower, bind, free_name, keys_to, materialize

WINDOW = 10
# what separates words: every ASCII character but letters and digits
GAP = r"[\x00-\x2F\x3A-\x60\x7B-\x7F]+"
# (item, window) rows: hash, length, item and ten words, under 100 MB
MAX_BROADCAST_WINDOWS = 500_000


def words_of(text: Column) -> Column:
    """Normalised words of a text (no empty ones)."""
    parts = F.split(ascii_lower(F.coalesce(text.cast("string"), F.lit(""))), GAP)
    return F.filter(parts, lambda w: w != "")


def row_of(text: Column) -> Column:
    """What tells rows of one doc_id apart: a hash of the text."""
    return F.xxhash64(F.coalesce(text.cast("string"), F.lit("")))


def _windows(words: Column, length: int) -> Column:
    """Hash of every window of ``length`` words, in order of its start."""
    return bind(F.transform(words, lambda w: F.xxhash64(w)), lambda h: F.when(
        F.size(h) >= length,
        F.transform(F.sequence(F.lit(0), F.size(h) - length),
                    lambda i: F.xxhash64(*[F.get(h, i + k) for k in range(length)])))
        .otherwise(F.array().cast("array<bigint>")))


def _placed(words: Column, length: int) -> Column:
    """The windows of one length as (length, start, hash)."""
    return F.transform(_windows(words, length), lambda h, i: F.struct(
        F.lit(length).alias("length"), i.alias("start"), h.alias("hash")))


def item_windows(benchmark: DataFrame, id_col: str = "item_id", text_col: str = "text") -> DataFrame:
    """One row per distinct (item_id, window): hash, length, words."""
    items = benchmark.select(F.col(id_col).alias("item_id"), words_of(F.col(text_col)).alias("w")).where(
        F.size("w") > 0)
    span = F.least(F.size("w"), F.lit(WINDOW))
    starts = items.select("item_id", "w", span.alias("length"),
                          F.explode(F.sequence(F.lit(0), F.size("w") - span)).alias("start"))
    grams = starts.select("item_id", "length", F.slice("w", F.col("start") + 1, F.col("length")).alias("gram"))
    # the same hash as of document windows: of the word hashes, in turn
    pieces = [F.when(F.col("length") == n, F.xxhash64(*[F.xxhash64(F.get("gram", F.lit(k))) for k in range(n)]))
              for n in range(1, WINDOW + 1)]
    return grams.select("item_id", "length", F.array_join("gram", " ").alias("gram"),
                        F.coalesce(*pieces).alias("hash")).distinct()


def hits(docs: DataFrame, benchmark: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """Verified hits of every distinct (doc_id, text): doc_id, row (a hash of
    the text), start (word index), length, item_id."""
    windows = materialize(item_windows(benchmark), "windows")
    keys = windows.select("length", "hash").distinct()
    # at most ten lengths; the count bounds what may be broadcast
    lengths = windows.groupBy("length").count().collect()
    small = sum(r["count"] for r in lengths) <= MAX_BROADCAST_WINDOWS
    wanted = sorted(r["length"] for r in lengths) or [WINDOW]
    doc = docs.select(F.col(id_col).alias("doc_id"), row_of(F.col(text_col)).alias("row"),
                      words_of(F.col(text_col)).alias("w"))
    if len(wanted) == 1:
        rows = doc.select("doc_id", "row", F.lit(wanted[0]).alias("length"),
                          F.posexplode(_windows(F.col("w"), wanted[0])).alias("start", "hash"))
    else:
        rows = doc.select("doc_id", "row", F.inline(F.concat(*[_placed(F.col("w"), n) for n in wanted])))
    met = rows.join(F.broadcast(keys) if small else keys, ["length", "hash"], "left_semi")
    # a set: no more than the windows of one text, however often it occurs
    found = materialize(
        met.groupBy("doc_id", "row").agg(F.collect_set(F.struct("start", "length", "hash")).alias("at")), "hits")
    # verify on the words themselves: only texts with a hit are read again, and moved
    texts = docs.select(F.col(id_col).alias("__id"), row_of(F.col(text_col)).alias("__row"),
                        F.col(text_col).alias("__text")).join(
        keys_to(found.select("doc_id", "row")), _same("doc_id", "row"), "left_semi")
    cut = found.join(texts, _same("doc_id", "row")).select("doc_id", "row", "at", words_of(F.col("__text")).alias("w"))
    spelled = cut.select("doc_id", "row", F.inline(bind(F.col("w"), lambda w: F.transform("at", lambda a: F.struct(
        a["start"].alias("start"), a["length"].alias("length"), a["hash"].alias("hash"),
        F.array_join(F.slice(w, a["start"] + 1, a["length"]), " ").alias("gram"))))))
    return (spelled.join(F.broadcast(windows) if small else windows, ["length", "hash", "gram"])
            .select("doc_id", "row", "start", "length", "item_id").distinct())


def _same(id_col: str, row: str | Column, of: tuple[str, str] = ("__id", "__row")) -> Column:
    """Whether a row is that of the columns ``of``: id and hash of the text."""
    return F.col(id_col).eqNullSafe(F.col(of[0])) & ((F.col(row) if isinstance(row, str) else row) == F.col(of[1]))


def judge(docs: DataFrame, benchmark: DataFrame, id_col: str = "doc_id", text_col: str = "text",
          rows: bool = False) -> DataFrame:
    """Per document: words, hit words, items that occur, digest, verdict;
    with ``rows`` also the hash of the text."""
    found = hits(docs, benchmark, id_col, text_col)
    per = found.groupBy("doc_id", "row").agg(
        F.sort_array(F.collect_set(F.struct("start", "length"))).alias("at"),
        F.array_sort(F.collect_set(F.col("item_id").cast("string"))).alias("items"))
    ends = F.transform("at", lambda a: F.struct(a["start"].alias("s"), (a["start"] + a["length"]).alias("e")))
    covered = F.aggregate(
        ends, F.struct(F.lit(0).alias("to"), F.lit(0).cast("long").alias("n")),
        lambda acc, x: F.struct(F.greatest(acc["to"], x["e"]).alias("to"),
                                (acc["n"] + F.greatest(F.lit(0), x["e"] - F.greatest(x["s"], acc["to"]))).alias("n")),
        lambda acc: acc["n"])
    marked = per.select(F.col("doc_id").alias("__id"), F.col("row").alias("__row"), covered.alias("hit"), "items")
    base = docs.select(F.col(id_col).alias("doc_id"), row_of(F.col(text_col)).alias("row"),
                       F.size(words_of(F.col(text_col))).cast("long").alias("n_words"))
    items = F.coalesce(F.col("items"), F.array().cast("array<string>"))
    return base.join(marked, _same("doc_id", "row"), "left").select(
        *(["doc_id", "row"] if rows else ["doc_id"]), "n_words",
        F.coalesce("hit", F.lit(0)).cast("long").alias("n_hit"),
        F.size(items).cast("long").alias("n_items"),
        F.sha2(F.array_join(items, ","), 256).alias("items_sha256"),
        (F.coalesce("hit", F.lit(0)) > 0).alias("contaminated"))


def remove_documents(docs: DataFrame, benchmark: DataFrame, id_col: str = "doc_id",
                     text_col: str = "text", max_share: float = 0.0) -> DataFrame:
    """``docs`` without the documents whose hit words exceed ``max_share``
    of their words (0: any hit)."""
    bad = hits(docs, benchmark, id_col, text_col) if max_share <= 0 else judge(
        docs, benchmark, id_col, text_col, rows=True).where(F.col("n_hit") > max_share * F.col("n_words"))
    of = free_name(docs, "__id"), free_name(docs, "__row")
    gone = materialize(bad.select(F.col("doc_id").alias(of[0]), F.col("row").alias(of[1])).distinct(), "contaminated")
    return docs.join(keys_to(gone), _same(id_col, row_of(F.col(text_col)), of), "left_anti")


def remove_spans(docs: DataFrame, benchmark: DataFrame, id_col: str = "doc_id",
                 text_col: str = "text", mark: str = " ") -> DataFrame:
    """``docs`` with the text of every hit word replaced: each run of hit
    words, with the gaps inside it, becomes ``mark``. Clean texts are not
    touched."""
    of = free_name(docs, "__id"), free_name(docs, "__row")
    hit = free_name(docs, "__hit")
    at = hits(docs, benchmark, id_col, text_col).groupBy(
        F.col("doc_id").alias(of[0]), F.col("row").alias(of[1])).agg(
        F.sort_array(F.collect_set(F.struct(
            F.col("start").alias("s"), (F.col("start") + F.col("length")).alias("e")))).alias(hit))
    joined = docs.join(at, _same(id_col, row_of(F.col(text_col)), of), "left")
    # words and gaps in turn: gap 0, word 0, gap 1, word 1, ..., last gap
    text, raw = F.col(text_col).cast("string"), r"[^\x00-\x2F\x3A-\x40\x5B-\x60\x7B-\x7F]+"
    found = F.regexp_extract_all(text, F.lit(f"({raw})"), F.lit(1))
    gaps = F.split(text, raw)
    # runs of hit words: windows that overlap or touch become one
    merged = F.aggregate(hit, F.array().cast("array<struct<s:int,e:int>>"), lambda acc, x: F.when(
        (F.size(acc) > 0) & (F.element_at(acc, -1)["e"] >= x["s"]),
        F.concat(F.slice(acc, 1, F.size(acc) - 1), F.array(F.struct(
            F.element_at(acc, -1)["s"].alias("s"), F.greatest(F.element_at(acc, -1)["e"], x["e"]).alias("e")))))
        .otherwise(F.concat(acc, F.array(x))))

    def between(w: Column, g: Column, first: Column, last: Column) -> Column:
        return F.array_join(F.zip_with(F.slice(g, first + 1, last - first), F.slice(w, first + 1, last - first),
                                       lambda a, b: F.concat(a, b)), "")

    def rebuilt(w: Column) -> Column:
        return bind(merged, lambda runs: bind(gaps, lambda g: F.concat(
            F.array_join(F.transform(runs, lambda r, j: F.concat(
                between(w, g, F.when(j > 0, F.get(runs, j - 1)["e"]).otherwise(F.lit(0)), r["s"]),
                F.get(g, r["s"]), F.lit(mark))), ""),
            between(w, g, F.element_at(runs, -1)["e"], F.size(w)), F.get(g, F.size(w)))))

    return joined.withColumn(text_col, F.when(F.col(hit).isNull(), F.col(text_col)).otherwise(
        bind(found, rebuilt))).drop(*of, hit)
