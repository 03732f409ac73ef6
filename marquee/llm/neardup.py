"""Near-duplicates: MinHash bands, sequential Bayesian verification, exact
confirmation, connected components.

1. One pass makes for every text its set of distinct word shingles (64-bit
   hashes), its size, a 128-bit digest and a MinHash signature of
   ``ROWS * BANDS`` 16-bit values. Equal digests are equal sets and become
   one class, represented by its first row: of smallest doc_id, rows without
   doc_id last.
2. Class representatives that agree on a band (``ROWS`` = 4 values) share
   a bucket. A pair at similarity 0.8 misses all 32 bands with probability
   (1 - 0.8**4)**32 = 5e-8.
3. In every bucket the smallest member first meets all others. Verified
   links merge components, which closes most buckets, so a group of copies
   costs about one pair per member instead of all pairs. What is left is
   met exactly, without a cap: buckets of up to ``SMALL`` members by all
   pairs across components; the members of larger ones by a prefix filter,
   since two sets at the threshold share a shingle among the rarest of
   either (rarest by counts over these members). A pair is met in the first
   bucket that both prefixes share and nowhere else, and only where the
   parities of the sets leave room for the threshold. A text of a large group
   whose own shingles exceed the allowed difference has no shared shingle
   there and needs no pair at all. Buckets of prefix shingles are then
   closed by rounds of hubs from their smallest components: a hub meets all
   members outside its component and leaves the bucket.
4. A candidate pair is compared ``BATCH`` signature values at a time. With m
   of n values equal, the similarity has the posterior Beta(m + 1, n - m + 1);
   a pair is pruned as soon as its posterior probability of reaching the
   threshold is below ``miss``. Survivors are verified on their full sets.
5. Verified links give components by alternating stars.

Defined results: texts without words, and null texts, have no shingles and
are linked with nothing; a text of fewer words than a shingle has its whole
sequence as one; rows are judged by their texts, told apart by a 64-bit hash
of doc_id and text, so an id with several texts may be in several
components; a component is named by its smallest doc_id, or null where no
row of it has one, and then one of its rows is kept; an empty table gives an
empty table; other columns are ignored.
"""

from __future__ import annotations

import math

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from marquee.llm.common import free_name, held, keys_to, materialize, ship, small_batches
from marquee.llm.components import connected

BANDS, ROWS = 32, 4
BATCH = 16
MISS = 1e-6
SMALL = 16
# a pair of sets with longer prefixes may be met more than once (harmless)
BEFORE = 64
# bits of a set's parity (below), in words of 64
PARITY = 512
# ids are broadcast up to this many (some 16 MB), else joined by a shuffle
MAX_BROADCAST_IDS = 1_000_000


def _permutations():
    import numpy as np

    rng = np.random.default_rng(7)
    n = BANDS * ROWS
    return rng.integers(0, 2**63, n, dtype=np.uint64), rng.integers(0, 2**63, n, dtype=np.uint64) * np.uint64(2) + np.uint64(1)


def minhash(items, masks, factors):
    """16-bit MinHash values of a set of hashes, in blocks of bounded size."""
    import numpy as np

    low = None
    for a in range(0, len(items), 2048):
        part = ((items[a:a + 2048][:, None] ^ masks) * factors).min(axis=0)
        low = part if low is None else np.minimum(low, part)
    return ((low >> np.uint64(40)) & np.uint64(0xFFFF)).astype(np.uint16)


def row_key(id_col: str, text_col: str) -> Column:
    """What tells rows apart: a hash of id and text."""
    return F.xxhash64(F.col(id_col), F.coalesce(F.col(text_col).cast("string"), F.lit("")))


def signatures(docs: DataFrame, size: int, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """doc_id, key, n_shingles, digest, sig: one bigint per band, the four
    16-bit values of the band side by side."""
    id_type = docs.schema[id_col].dataType.simpleString()

    def run(batches):
        import numpy as np
        import pyarrow as pa
        import xxhash

        from marquee.llm.shingles import shingle_sets, small_parts

        held(None)  # what the worker did before
        masks, factors = _permutations()
        for batch in small_parts(batches, 2):
            n, digests, sigs = [], [], []
            for s in shingle_sets(batch.column(2), size):
                n.append(len(s))
                digests.append(xxhash.xxh3_128_digest(s.tobytes()))
                sigs.append(minhash(s, masks, factors).view(np.int64) if len(s) else np.zeros(BANDS, np.int64))
            flat = np.concatenate(sigs) if sigs else np.zeros(0, np.int64)
            yield pa.RecordBatch.from_arrays(
                [batch.column(0), batch.column(1), pa.array(n, pa.int64()), pa.array(digests, pa.binary()),
                 pa.ListArray.from_arrays(pa.array(np.arange(len(n) + 1, dtype=np.int32) * BANDS), pa.array(flat))],
                ["doc_id", "key", "n_shingles", "digest", "sig"])

    return docs.select(F.col(id_col).alias("doc_id"), row_key(id_col, text_col).alias("key"),
                       F.col(text_col).cast("string").alias("text")).mapInArrow(
        run, f"doc_id {id_type}, key bigint, n_shingles bigint, digest binary, sig array<bigint>")


def least_matches(percent: int, miss: float = MISS) -> list[int]:
    """For n = BATCH, 2 BATCH, ... compared values: the fewest matches with
    which P(similarity >= percent / 100) is at least ``miss``. The posterior
    tail of Beta(m + 1, n - m + 1) is a binomial sum over n + 1 trials."""
    t, out = percent / 100, []
    for n in range(BATCH, BANDS * ROWS + 1, BATCH):
        tail, m = 0.0, -1
        while tail < miss:
            m += 1
            tail += math.comb(n + 1, m) * t**m * (1 - t)**(n + 1 - m)
        out.append(m)
    return out


def screen(pairs: DataFrame, reps: DataFrame, percent: int, miss: float = MISS) -> DataFrame:
    """Candidate pairs (a, b) that no batch of signature values prunes.
    Sizes alone rule out pairs whose smaller set is under the threshold's
    share of the larger one (exact)."""
    left = reps.select(F.col("doc_id").alias("a"), F.col("n_shingles").alias("na"), F.col("sig").alias("sa"))
    right = reps.select(F.col("doc_id").alias("b"), F.col("n_shingles").alias("nb"), F.col("sig").alias("sb"))
    met = (pairs.join(left, "a").join(right, "b")
           .where(100 * F.least("na", "nb") >= percent * F.greatest("na", "nb")).select("a", "b", "sa", "sb"))
    least = least_matches(percent, miss)

    def run(batches):
        import numpy as np
        import pyarrow as pa

        def values(column):
            return np.asarray(column.flatten()).reshape(-1, BANDS).view(np.uint16)

        for batch in batches:
            if not batch.num_rows:
                continue
            x, y = values(batch.column(2)), values(batch.column(3))
            alive, equal = np.arange(batch.num_rows), np.zeros(batch.num_rows, np.int64)
            for step, low in enumerate(least):
                cut = slice(step * BATCH, (step + 1) * BATCH)
                equal[alive] += (x[alive, cut] == y[alive, cut]).sum(axis=1)
                alive = alive[equal[alive] >= low]
            yield pa.RecordBatch.from_arrays(
                [batch.column(0).take(pa.array(alive)), batch.column(1).take(pa.array(alive))], ["a", "b"])

    kind = reps.schema["doc_id"].dataType.simpleString()
    return met.mapInArrow(run, f"a {kind}, b {kind}").distinct()


def sets_of(docs: DataFrame, ids: DataFrame, size: int, id_col: str, text_col: str) -> DataFrame:
    """The full shingle sets of the documents named in ``ids`` (doc_id), and
    their parity: ``PARITY`` bits, each whether an odd number of shingles
    fall on it. Sets whose parities differ in n bits differ in n shingles or
    more."""
    id_type = docs.schema[id_col].dataType.simpleString()
    few = ids.count() <= MAX_BROADCAST_IDS
    texts = docs.select(F.col(id_col).alias("doc_id"), F.col(text_col).cast("string").alias("text")).join(
        F.broadcast(ids) if few else ids, "doc_id", "left_semi")

    def run(batches):
        import numpy as np
        import pyarrow as pa

        from marquee.llm.shingles import shingle_sets, small_parts

        for batch in small_parts(batches, 1):
            sets = list(shingle_sets(batch.column(1), size))
            ends = np.cumsum([0, *map(len, sets)]).astype(np.int32)
            flat = np.concatenate([*sets, np.zeros(0, np.uint64)]).view(np.int64)
            odd = [np.packbits((np.bincount((s & np.uint64(PARITY - 1)).astype(np.int64), minlength=PARITY) & 1)
                               .astype(np.uint8)).view(np.int64) for s in sets]
            words = np.arange(len(sets) + 1, dtype=np.int32) * (PARITY // 64)
            yield pa.RecordBatch.from_arrays(
                [batch.column(0), pa.ListArray.from_arrays(pa.array(ends), pa.array(flat)), pa.ListArray.from_arrays(
                    pa.array(words), pa.array(np.concatenate([*odd, np.zeros(0, np.int64)])))],
                ["doc_id", "items", "parity"])

    return texts.mapInArrow(run, f"doc_id {id_type}, items array<bigint>, parity array<bigint>")


def confirm(pairs: DataFrame, sets: DataFrame, percent: int) -> DataFrame:
    """Pairs whose full sets reach the threshold."""
    left = sets.select(F.col("doc_id").alias("a"), F.col("items").alias("ia"))
    right = sets.select(F.col("doc_id").alias("b"), F.col("items").alias("ib"))

    def run(batches):
        import numpy as np
        import pyarrow as pa

        def parts(column):
            ends = np.asarray(column.offsets)
            flat = np.asarray(column.values)
            return [flat[a:b] for a, b in zip(ends[:-1], ends[1:], strict=True)]

        for batch in batches:
            ok = []
            for x, y in zip(parts(batch.column(2)), parts(batch.column(3)), strict=True):
                both = np.concatenate([x, y])
                both.sort(kind="stable")
                same = int((both[1:] == both[:-1]).sum())
                ok.append(len(x) > 0 and 100 * same >= percent * (len(both) - same))
            mask = pa.array(ok, pa.bool_())
            yield pa.RecordBatch.from_arrays([batch.column(0).filter(mask), batch.column(1).filter(mask)], ["a", "b"])

    kind = sets.schema["doc_id"].dataType.simpleString()
    return (pairs.join(left, "a").join(right, "b").select("a", "b", "ia", "ib")
            .mapInArrow(run, f"a {kind}, b {kind}").distinct())


def _may_reach(na, ra, nb, rb, percent: int):
    """Whether sets of na and nb shingles can reach the threshold when no
    more than ra of the one and rb of the other can be shared (exact)."""
    return F.least(ra, rb) * (100 + percent) >= (na + nb) * percent


def _may_match(na, pa, nb, pb, percent: int):
    """Whether sets of these sizes and parities can reach the threshold: two
    sets at it differ in a bounded number of shingles (exact)."""
    differ = F.aggregate(F.zip_with(pa, pb, lambda x, y: F.bit_count(x.bitwiseXOR(y))), F.lit(0), lambda s, x: s + x)
    return differ * (100 + percent) <= (na + nb) * (100 - percent)


def prefix_buckets(sets: DataFrame, percent: int) -> DataFrame:
    """(bucket, id, n, room): the shared shingles in the prefix of every
    set. With the shingles in order of their counts over ``sets``, two sets
    at the threshold share one of the first n - ceil(percent * n) + 1 of
    each, and have no more in common than what follows their first common
    shingle: the ``room`` there. A set whose room cannot reach the threshold
    even with the smallest set of a bucket is not in that bucket."""
    rows = sets.select(F.col("doc_id").alias("id"), F.size("items").alias("n"), "parity", F.explode("items").alias("bucket"))
    counts = rows.groupBy("bucket").agg(F.count("*").alias("df")).where("df > 1")
    own = Window.partitionBy("id")
    need = F.ceil(F.col("n") * percent / 100).cast("int")
    # the n - shared shingles of one set alone come first in its order
    kept = materialize(
        rows.join(counts, "bucket").withColumn("shared", F.count("*").over(own)).where(F.col("shared") >= need)
        .withColumn("k", F.row_number().over(own.orderBy("df", "bucket")))
        .where(F.col("k") <= F.col("shared") - need + 1)
        .select("bucket", "id", "n", "parity", (F.col("shared") - F.col("k") + 1).alias("room"),
                F.collect_list("bucket").over(own.orderBy("df", "bucket").rowsBetween(-BEFORE, -1)).alias("before")),
        "prefixes")
    low = kept.groupBy("bucket").agg(F.min("n").alias("low"))
    return kept.join(low, "bucket").where(
        _may_reach(F.col("n"), F.col("room"), F.col("low"), F.col("room"), percent)).drop("low")


def _open(members: DataFrame, labels: DataFrame) -> DataFrame:
    """(bucket, id, n, room, before, parity, label, size) of the buckets that hold
    several components. labels: (node, component)."""
    named = members.join(labels, F.col("id") == F.col("node"), "left").select(
        "bucket", "id", "n", "room", "before", "parity", F.coalesce("component", "id").alias("label"))
    several = named.groupBy("bucket").agg(
        F.min("label").alias("l"), F.max("label").alias("h"), F.count("*").alias("size")).where("l != h")
    return named.join(several.select("bucket", "size"), "bucket")


def _hubs(members: DataFrame, at_once: int) -> DataFrame:
    """Members of the smallest components, never of the largest one: that
    one needs no hub, the others meet it."""
    sizes = members.groupBy("bucket", "label").agg(F.count("*").alias("rows"))
    largest = sizes.groupBy("bucket").agg(F.max(F.struct("rows", "label")).alias("top"))
    order = Window.partitionBy("bucket").orderBy("rows", "label", "id")
    return (members.join(sizes, ["bucket", "label"]).join(largest, "bucket")
            .where(F.col("label") != F.col("top.label")).withColumn("k", F.row_number().over(order))
            .where(F.col("k") <= at_once).select("bucket", "id", "n", "room", "before", "parity", "label"))


def _across(hubs: DataFrame, members: DataFrame, percent: int) -> DataFrame:
    """Pairs (a, b) of hubs and members of other components that the exact
    bounds do not rule out, in the first bucket that they share."""
    h, m = hubs.alias("h"), members.alias("m")
    met = h.join(m, (F.col("h.bucket") == F.col("m.bucket")) & (F.col("h.label") != F.col("m.label")) & _may_reach(
        F.col("h.n"), F.col("h.room"), F.col("m.n"), F.col("m.room"), percent)
        & ~F.arrays_overlap("h.before", "m.before")
        & _may_match(F.col("h.n"), F.col("h.parity"), F.col("m.n"), F.col("m.parity"), percent))
    return met.select(F.least("h.id", "m.id").alias("a"), F.greatest("h.id", "m.id").alias("b")).distinct()


def links(docs: DataFrame, reps: DataFrame, size: int, percent: int, id_col: str = "doc_id",
          text_col: str = "text", miss: float = MISS, hubs_at_once: int = 256) -> DataFrame:
    """Links (u, v) between representatives, verified ones or those of a
    representative and the smallest one of its component: enough of them that
    the components are those of all verified pairs of all buckets."""
    # none yet; made by Spark alone, as rows from Python cost each executor
    # a second Python daemon with workers of its own
    failed = reps.select(F.col("doc_id").alias("a"), F.col("doc_id").alias("b")).where(F.lit(False))

    def sets_for(ids: DataFrame, tag: str) -> DataFrame:
        return materialize(sets_of(docs, materialize(ids.distinct(), "ids"), size, id_col, text_col), tag)

    def verified(wanted: DataFrame):
        """Links among the wanted pairs, and the pairs that failed."""
        likely = materialize(screen(wanted, reps, percent, miss).join(failed, ["a", "b"], "left_anti"), "likely")
        if likely.isEmpty():
            return likely, likely
        ids = likely.select(F.col("a").alias("doc_id")).union(likely.select("b"))
        good = materialize(confirm(likely, sets_for(ids, "sets"), percent), "links")
        return good, likely.join(good, ["a", "b"], "left_anti")

    def as_links(pairs: DataFrame) -> DataFrame:
        return pairs.select(F.col("a").alias("u"), F.col("b").alias("v"))

    def tree(labels: DataFrame) -> DataFrame:
        """What the links so far come to: a link for every member."""
        return labels.select(F.col("node").alias("u"), F.col("component").alias("v")).where("u != v")

    n = F.col("n_shingles").alias("n")
    slots = reps.select(F.col("doc_id").alias("id"), n, F.posexplode("sig").alias("band", "value")).select(
        "id", "n", F.xxhash64("band", "value").alias("bucket"))
    shared = slots.groupBy("bucket").agg(
        F.min(F.struct("id", "n")).alias("hub"), F.max("id").alias("last")).where("hub.id != last")
    members = materialize(slots.join(shared.select("bucket", "hub"), "bucket"), "buckets").select(
        "bucket", "id", "n", F.col("n").alias("room"), F.array().cast("array<bigint>").alias("before"),
        F.array().cast("array<bigint>").alias("parity"), "hub").where("id != hub.id")
    wanted = members.where(_may_reach(F.col("n"), F.col("n"), F.col("hub.n"), F.col("hub.n"), percent)).select(
        F.col("hub.id").alias("a"), F.col("id").alias("b")).distinct()
    found, failed = verified(wanted)
    labels = materialize(connected(as_links(found)), "labels")

    left = materialize(_open(members.drop("hub"), labels), "open")
    little = left.where(F.col("size") <= SMALL)
    wanted = _across(little, little, percent)
    large = left.where(F.col("size") > SMALL).select(F.col("id").alias("doc_id"))
    if large.isEmpty():
        return tree(labels).union(as_links(verified(wanted)[0]))
    members = prefix_buckets(sets_for(large, "large"), percent)
    while True:
        members = materialize(_open(members, labels), "open")
        hubs = materialize(_hubs(members, hubs_at_once), "hubs")
        wanted = _across(hubs, members, percent) if wanted is None else wanted.union(
            _across(hubs, members, percent)).distinct()
        good, bad = verified(wanted)
        if not good.isEmpty():
            labels = materialize(connected(tree(labels).union(as_links(good))), "labels")
        failed, wanted = failed.union(bad), None
        members = members.join(hubs.select("bucket", "id"), ["bucket", "id"], "left_anti").select(
            "bucket", "id", "n", "room", "before", "parity")
        # every hub has met its bucket; what is left may hold several components
        if _open(members, labels).isEmpty():
            return tree(labels)
        hubs_at_once *= 8


def _verdicts(docs: DataFrame, size: int, percent: int, id_col: str, text_col: str, miss: float) -> DataFrame:
    """Per row: doc_id, key, at (of this row alone), n_shingles, and the
    first row of its component as top: (no_id, doc_id, key, at). Rows without
    shingles have no top."""
    spark = docs.sparkSession
    ship(spark)
    with small_batches(spark):
        return _judged(docs, size, percent, id_col, text_col, miss)


def _judged(docs: DataFrame, size: int, percent: int, id_col: str, text_col: str, miss: float) -> DataFrame:
    # numbered once and stored: later reads see the same numbers
    sigs = materialize(signatures(docs, size, id_col, text_col).withColumn(
        "at", F.monotonically_increasing_id()), "signatures")
    some = sigs.where("n_shingles > 0").withColumn("me", F.struct(
        F.col("doc_id").isNull().alias("no_id"), "doc_id", "key", "at"))
    classes = materialize(some.groupBy("digest").agg(F.min("me").alias("first"), F.count("*").alias("n")).where(
        "n > 1").select("digest", "first"), "classes")
    own = some.join(keys_to(classes), "digest", "left").withColumn("first", F.coalesce("first", "me"))
    reps = materialize(own.where(F.col("first.at") == F.col("at")).select(
        F.col("key").alias("doc_id"), "n_shingles", "sig", "me"), "representatives")
    # a text is read once where several rows are equal in id and text
    texts = docs.select(row_key(id_col, text_col).alias("doc_id"), F.col(text_col).alias("text"))
    again = materialize(some.groupBy(F.col("key").alias("doc_id")).count().where("count > 1").select("doc_id"), "again")
    if not again.isEmpty():
        again = keys_to(again)
        texts = texts.join(again, "doc_id", "left_anti").union(
            texts.join(again, "doc_id", "left_semi").dropDuplicates(["doc_id"]))
    parts = materialize(connected(links(texts, reps, size, percent, "doc_id", "text", miss)), "components")
    tops = parts.join(reps.select(F.col("doc_id").alias("node"), "me"), "node").groupBy("component").agg(
        F.min("me").alias("linked"))
    named = materialize(parts.join(tops, "component").select("node", "linked"), "tops")
    judged = own.select("doc_id", "key", "at", "n_shingles", "first").join(
        named, F.col("first.key") == F.col("node"), "left").select(
        "doc_id", "key", "at", "n_shingles", F.coalesce("linked", "first").alias("top"))
    bare = sigs.where("n_shingles = 0").select(
        "doc_id", "key", "at", "n_shingles", F.lit(None).cast(judged.schema["top"].dataType).alias("top"))
    return judged.union(bare)


def deduplicate(docs: DataFrame, size: int = 5, percent: int = 80, id_col: str = "doc_id",
                text_col: str = "text", miss: float = MISS) -> DataFrame:
    """Per row: doc_id, n_shingles, component_id, kept. Rows of the id that
    names their component are kept, as is one row of a component without ids."""
    rows = _verdicts(docs, size, percent, id_col, text_col, miss)
    top = F.col("top")
    return rows.select(
        "doc_id", "n_shingles", F.when(top.isNull(), F.col("doc_id")).otherwise(top["doc_id"]).alias("component_id"),
        F.when(top.isNull(), F.lit(True)).when(F.col("doc_id").isNull(), F.col("at") == top["at"])
        .otherwise(F.col("doc_id") == top["doc_id"]).alias("kept"))


def keep_one(docs: DataFrame, size: int = 5, percent: int = 80, id_col: str = "doc_id",
             text_col: str = "text") -> DataFrame:
    """``docs`` with one row of each group of copies: the one of smallest id,
    then of smallest hash of id and text; rows without id last. Other texts
    of its id stay. Rows equal in id and text count once, as the smallest of
    them over all columns; rows with neither id nor words all stay."""
    rows = materialize(_verdicts(docs, size, percent, id_col, text_col, MISS), "verdicts")
    at, key, one = (free_name(docs, name) for name in ("__id", "__key", "__one"))
    last = rows.where(F.col("top").isNull() | (F.col("key") == F.col("top.key")))
    gone = materialize(rows.where(F.col("key") != F.col("top.key")).select(
        F.col("doc_id").alias(at), F.col("key").alias(key)).distinct(), "gone")
    same = (row_key(id_col, text_col) == F.col(key)) & F.col(id_col).eqNullSafe(F.col(at))
    left = docs.join(keys_to(gone), same, "left_anti")
    twice = last.where("doc_id IS NOT NULL OR top IS NOT NULL").groupBy(
        F.col("doc_id").alias(at), F.col("key").alias(key)).count().where("count > 1").drop("count")
    twice = materialize(twice, "repeated")
    if twice.isEmpty():
        return left
    twice = keys_to(twice)
    names = [F.col(f"{one}.`{c}`").alias(c) for c in docs.columns]
    again = left.join(twice, same, "left_semi").groupBy(
        F.col(id_col).alias(at), row_key(id_col, text_col).alias(key)).agg(
        F.min(F.struct(*[F.col(f"`{c}`") for c in docs.columns])).alias(one)).select(*names)
    return left.join(twice, same, "left_anti").unionByName(again)
