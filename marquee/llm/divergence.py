"""Source divergence audit: how far the term shares of the sources of a
language lie apart.

1. **Collapse.** Identical texts of a language (equal md5) become one text
   with the number of its copies per source, so a text is shuffled and
   tokenized once however often it occurs. Copies are counted before the
   shuffle; a text in very many sources is held in slices of about
   ``SOURCES`` of them.
2. **Count.** Blocks of texts give, per language and cell of terms, the
   document frequency of every term (copies weigh) and its occurrences per
   source, packed. A cell, a share of the terms by their hash, is summed in
   one task; terms of ``least`` documents or more stay, each with its sparse
   vector of counts per source.
3. **Compare.** With p = 1 + floor(10**9 * (count + 2) / (N + 2 V)) of V kept
   terms and N their occurrences, two distributions differ by the sum of
   f = floor((p - q)**2 / (p + q)). A term that neither source has gives the
   same f everywhere; one that only one of them has depends on its p and the
   other's p of no occurrence. So a pair of sources needs the terms both have
   (a join on the term), a histogram of the p of each, and counts:
   the sum over all V terms without visiting them.

All arithmetic is on integers (products as decimals).

Defined results: null text, language and source are ``""``; sources without
terms take part with no occurrences; a language without kept terms has
pairs of value 0 and no terms; a language of one source has no pairs;
repeated rows all count; an empty table gives an empty table; other columns
are ignored. A text is tokenized in one piece, so memory is bounded by the
longest text. Terms of equal 64-bit hash count as one.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from marquee.llm.common import materialize, ship

LEAST = 10
TERMS = 10
SCALE = 1_000_000_000
SOURCES = 1024
BLOCK = 3 << 20


def collapse(docs: DataFrame, groups: int, lang_col: str = "lang", source_col: str = "source",
             text_col: str = "text") -> DataFrame:
    """lang, text, sources (array of source and copies): one row per distinct
    text of a language, or one per slice of its sources where the table has
    over ``SOURCES`` (``groups``: the number of groups)."""
    def text_of(column: str) -> Column:
        return F.coalesce(F.col(f"`{column}`").cast("string"), F.lit(""))

    keyed = docs.select(text_of(lang_col).alias("lang"), text_of(source_col).alias("source"),
                        text_of(text_col).alias("text")).withColumn("key", F.unhex(F.md5("text")))
    copies = keyed.groupBy("lang", "key", "source").agg(F.count(F.lit(1)).alias("copies"))
    part = F.pmod(F.xxhash64("source"), F.lit(1 + groups // SOURCES))
    vectors = copies.groupBy("lang", "key", part.alias("part")).agg(
        F.collect_list(F.struct("source", "copies")).alias("sources"))
    texts = keyed.groupBy("lang", "key").agg(F.first("text").alias("text"))
    return vectors.join(texts, ["lang", "key"]).select("lang", "text", "sources")


def count_terms(texts: DataFrame, least: int = LEAST) -> DataFrame:
    """lang, term, df, counts (array of source and n) of every term found in
    ``least`` documents of the language or more."""
    spark = texts.sparkSession
    ship(spark)
    cells = int(spark.conf.get("spark.sql.shuffle.partitions"))

    def pack(**columns) -> bytes:
        import pyarrow as pa

        batch = pa.RecordBatch.from_arrays(list(columns.values()), list(columns))
        sink = pa.BufferOutputStream()
        with pa.ipc.new_stream(sink, batch.schema, options=pa.ipc.IpcWriteOptions(compression="zstd")) as out:
            out.write_batch(batch)
        return sink.getvalue().to_pybytes()

    def run(batches):
        import numpy as np
        import pyarrow as pa

        from marquee.llm.shingles import slices, text_bytes
        from marquee.llm.terms import Words, classes
        from marquee.llm.transducer import ranges

        gaps = classes([c for c in range(128) if not chr(c).isalpha()])
        for batch in (part for whole in batches for part in slices(whole, 1, BLOCK)):
            words = Words(*text_bytes(batch.column(1)), gaps)
            langs = batch.column(0).dictionary_encode()
            lang = np.asarray(langs.indices).astype(np.int64)
            vectors = batch.column(2)
            flat = vectors.flatten()
            names = flat.field("source").dictionary_encode()
            source = np.asarray(names.indices).astype(np.int64)
            copies = np.asarray(flat.field("copies")).astype(np.int64)
            n_sources = np.diff(np.asarray(vectors.offsets)).astype(np.int64)
            first = np.cumsum(n_sources) - n_sources
            weight = np.append(0, np.cumsum(copies))
            weight = weight[first + n_sources] - weight[first]

            hashes, index, term = np.unique(words.hashes, return_index=True, return_inverse=True)
            pairs, tf = np.unique((words.doc << 32) | term, return_counts=True)
            doc, term = pairs >> 32, pairs & 0xFFFFFFFF
            # (language, cell, term) in order: what goes to one cell lies together
            cell = (hashes % np.uint64(cells)).astype(np.int64)
            by_cell = np.argsort(cell, kind="stable")
            place = np.empty(len(hashes), np.int64)
            place[by_cell] = np.arange(len(hashes))
            keys, of = np.unique((lang[doc] << 32) | place[term], return_inverse=True)
            df = np.zeros(len(keys), np.int64)
            np.add.at(df, of, weight[doc])
            each = n_sources[doc]
            at = ranges(first[doc], each)
            entries, to = np.unique((np.repeat(of, each) << 32) | source[at], return_inverse=True)
            counts = np.zeros(len(entries), np.int64)
            np.add.at(counts, to, np.repeat(tf, each) * copies[at])
            term = by_cell[keys & 0xFFFFFFFF]
            goal = ((keys >> 32) * cells + cell[term])
            starts = np.flatnonzero(np.append(True, goal[1:] != goal[:-1])[:len(goal)])
            edges = np.append(starts, len(keys))
            places = np.searchsorted(entries >> 32, edges)
            strings = words.strings(index[term])
            sizes = np.diff(np.searchsorted(entries >> 32, np.arange(len(keys) + 1)))
            rows = []
            for k, a in enumerate(starts.tolist()):
                b, x, y = int(edges[k + 1]), int(places[k]), int(places[k + 1])
                rows.append((langs.dictionary[int(keys[a] >> 32)].as_py(), int(goal[a] % cells), pack(
                    term=strings.slice(a, b - a), df=pa.array(df[a:b]), size=pa.array(sizes[a:b])), pack(
                    source=pa.DictionaryArray.from_arrays(pa.array((entries[x:y] & 0xFFFFFFFF).astype(np.int32)),
                                                          names.dictionary).cast(pa.string()),
                    n=pa.array(counts[x:y]))))
            yield pa.RecordBatch.from_arrays(
                [pa.array([r[i] for r in rows], t) for i, t in enumerate((pa.string(), pa.int32(), pa.binary(),
                                                                         pa.binary()))],
                ["lang", "cell", "terms", "entries"])

    def merge(table):
        import numpy as np
        import pyarrow as pa

        from marquee.llm.transducer import ranges

        def opened(column):
            return pa.concat_tables([pa.ipc.open_stream(x.as_py()).read_all() for x in table.column(column)])

        def coded(column):
            found = column.combine_chunks()
            found = (found.chunk(0) if isinstance(found, pa.ChunkedArray) else found).dictionary_encode()
            return np.asarray(found.indices).astype(np.int64), found.dictionary

        terms, entries = opened("terms"), opened("entries")
        term, words = coded(terms.column("term"))
        df = np.zeros(len(words), np.int64)
        np.add.at(df, term, np.asarray(terms.column("df")))
        kept = np.flatnonzero(df >= least)
        number = np.full(len(words), -1, np.int64)
        number[kept] = np.arange(len(kept))
        source, names = coded(entries.column("source"))
        of = number[np.repeat(term, np.asarray(terms.column("size")))]
        on = np.flatnonzero(of >= 0)
        keys, to = np.unique((of[on] << 32) | source[on], return_inverse=True)
        counts = np.zeros(len(keys), np.int64)
        np.add.at(counts, to, np.asarray(entries.column("n"))[on])
        ends = np.searchsorted(keys >> 32, np.arange(len(kept) + 1)).astype(np.int32)
        vector = pa.StructArray.from_arrays([names.take(pa.array(keys & 0xFFFFFFFF)), pa.array(counts)],
                                            ["source", "n"])
        lang = table.column("lang")[0].as_py()
        return pa.table({"lang": pa.array([lang] * len(kept), pa.string()), "term": words.take(pa.array(kept)),
                         "df": pa.array(df[kept]), "counts": pa.ListArray.from_arrays(pa.array(ends), vector)})

    packed = texts.mapInArrow(run, "lang string, cell int, terms binary, entries binary")
    return packed.groupBy("lang", "cell").applyInArrow(
        merge, "lang string, term string, df bigint, counts array<struct<source:string,n:bigint>>")


def _share(count: str, total: str, kept: str) -> Column:
    """p of a count among ``total`` occurrences of ``kept`` terms."""
    return F.expr(f"1 + CAST({SCALE} AS DECIMAL(10,0)) * CAST({count} + 2 AS DECIMAL(19,0)) "
                  f"DIV CAST({total} + 2 * {kept} AS DECIMAL(20,0))")


def _apart(p: str, q: str) -> str:
    return f"(({p} - {q}) * ({p} - {q}) DIV ({p} + {q}))"


def audit(docs: DataFrame, lang_col: str = "lang", source_col: str = "source", text_col: str = "text",
          least: int = LEAST, top: int = TERMS) -> DataFrame:
    """lang, source, part, item, value, rank: part ``pair`` ranks the other
    sources of the language by divergence, part ``term`` the ``top`` terms
    that the source has more of than the language."""
    def text_of(column: str) -> Column:
        return F.coalesce(F.col(f"`{column}`").cast("string"), F.lit(""))

    names = materialize(docs.select(text_of(lang_col).alias("lang"), text_of(source_col).alias("source")).distinct(),
                        "groups")
    texts = collapse(docs, names.count(), lang_col, source_col, text_col)
    kept = materialize(count_terms(texts, least), "terms")
    spread = kept.select("lang", "term", F.aggregate("counts", F.lit(0).cast("bigint"),
                                                     lambda s, x: s + x["n"]).alias("all"),
                         F.explode("counts").alias("x")).select(
        "lang", "term", "all", F.col("x.source").alias("source"), F.col("x.n").alias("n"))
    langs = kept.groupBy("lang").agg(F.count(F.lit(1)).alias("v"), F.sum(F.aggregate(
        "counts", F.lit(0).cast("bigint"), lambda s, x: s + x["n"])).alias("lang_total"))
    held = spread.groupBy("lang", "source").agg(F.count(F.lit(1)).alias("held"), F.sum("n").alias("total"))
    # p0: the share of a kept term without an occurrence
    groups = materialize(names.join(held, ["lang", "source"], "left").join(langs, "lang", "left").select(
        "lang", "source", F.coalesce("held", F.lit(0)).alias("held"), F.coalesce("total", F.lit(0)).alias("total"),
        F.coalesce("v", F.lit(0)).alias("v"), "lang_total").withColumn(
        "p0", F.when(F.col("v") > 0, _share("0", "total", "greatest(v, 1)"))), "sources")
    shares = materialize(spread.join(groups, ["lang", "source"]).select(
        "lang", "term", "source", _share("n", "total", "v").alias("p"), "p0",
        _share("all", "lang_total", "v").alias("q")), "shares")

    one = shares.select("lang", "term", F.col("source").alias("s"), F.col("p").alias("ps"), F.col("p0").alias("zs"))
    two = shares.select("lang", "term", F.col("source").alias("t"), F.col("p").alias("pt"), F.col("p0").alias("zt"))
    both = one.join(two, ["lang", "term"]).where("s < t").groupBy("lang", "s", "t").agg(
        F.count(F.lit(1)).alias("both"),
        F.sum(F.expr(f"{_apart('ps', 'pt')} - {_apart('ps', 'zt')} - {_apart('zs', 'pt')}")).alias("met"))
    levels = shares.groupBy("lang", "source", "p").agg(F.count(F.lit(1)).alias("n"))
    other = groups.select("lang", F.col("source").alias("t"), F.col("p0").alias("zt"))
    alone = levels.join(other, "lang").where("source != t").groupBy("lang", "source", "t").agg(
        F.sum(F.expr(f"n * {_apart('p', 'zt')}")).alias("alone"))
    pairs = groups.select("lang", F.col("source").alias("s"), F.col("held").alias("hs"), F.col("p0").alias("zs"),
                          "v").join(groups.select("lang", F.col("source").alias("t"), F.col("held").alias("ht"),
                                                  F.col("p0").alias("zt")), "lang").where("s < t")
    valued = pairs.join(both, ["lang", "s", "t"], "left").join(
        alone.select("lang", F.col("source").alias("s"), "t", F.col("alone").alias("of_s")), ["lang", "s", "t"],
        "left").join(alone.select("lang", F.col("source").alias("t"), F.col("t").alias("s"),
                                  F.col("alone").alias("of_t")), ["lang", "s", "t"], "left")
    value = F.expr("coalesce(of_s, 0) + coalesce(of_t, 0) + coalesce(met, 0) + coalesce((v - hs - ht "
                   f"+ coalesce(both, 0)) * {_apart('zs', 'zt')}, 0)").cast("bigint")
    either = valued.select("lang", value.alias("value"), F.explode(F.array(
        F.struct(F.col("s").alias("source"), F.col("t").alias("item")),
        F.struct(F.col("t").alias("source"), F.col("s").alias("item")))).alias("x")).select(
        "lang", "x.source", "x.item", "value")
    order = Window.partitionBy("lang", "source").orderBy(F.col("value").desc(), F.col("item").asc())
    by_pair = either.withColumn("rank", F.row_number().over(order)).withColumn("part", F.lit("pair"))
    by_term = shares.where("p > q").select("lang", "source", F.col("term").alias("item"),
                                           F.expr(_apart("p", "q")).alias("value")).withColumn(
        "rank", F.row_number().over(order)).where(F.col("rank") <= top).withColumn("part", F.lit("term"))
    columns = ["lang", "source", "part", "item", "value", "rank"]
    return by_pair.select(*columns).unionByName(by_term.select(*columns))
