"""Secret scan by corpus-wide ownership (DataFrame expressions only).

Every text is scanned for candidates: the base kinds (assignments of named
secrets, access key ids, long hexadecimal strings), which always stand, and
two further kinds, long mixed tokens and private key headers. Candidate
values are hashed and counted over the whole corpus by distinct
repositories (documents) and owners (sources). A value is a copied example
when many owners share it, or when its owners hold it in many repositories
each, as templates and fixtures are; what "many" is follows from the corpus:
its number of owners, and its repositories per owner. One that few owners
hold in few places and that looks random is live. Further kinds are reported
only where they are live, and every candidate's verdict is counted per
document.

Ownership is counted in steps that combine before each shuffle, (value,
owner, repository) first, so neither a value in a third of all documents
nor an owner of a third of them gathers in one task beyond one row a value.

Defined results: null and empty texts have no spans; a null source is an
unknown owner, another one for every document; ids may repeat: rows are told apart by id and text, and equal rows
get equal results; an empty table gives an empty table; other columns are
ignored. Offsets are code points, ends exclusive.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from marquee.llm.common import bind, materialize

ASSIGN = (r"""(?i:password|passwd|secret|token|api_?key)["']?\x20*[:=]\x20*["']?([A-Za-z0-9+/_.=-]+)""")
# runs are matched whole, so a least length drops the same runs afterwards
ACCESS = r"AKIA[A-Z0-9]{14,}"
HEX = r"[0-9a-f]{16,}"
MIXED = r"(?<![A-Za-z0-9+/_-])(?=[A-Za-z+/_-]{0,60}[0-9])(?=[0-9+/_-]{0,60}[A-Za-z])[A-Za-z0-9+/_-]{20,}"
PEM = r"-----BEGIN [A-Z ]{0,40}PRIVATE KEY-----"
KINDS = ("assign", "access", "hex", "mixed", "pem")
BASE = 3

MAX_OWNERS = 2      # a live value has at most so many owners,
OWNER_SHARE = 0.001  # or this share of all owners where that is more;
MAX_REPOSITORIES = 8   # and each of them holds it in at most so many repositories,
REPOSITORY_SHARE = 0.01  # or this share of the mean number of an owner
MIN_CHARACTERS = 8  # and so many different characters, at least
# parts that placeholders are written with
PLACEHOLDERS = "(?i)example|sample|placeholder|changeme|dummy|your[_-]"


BLOCK = 128


def running(sizes: Column) -> Column:
    """The sum of the sizes before each one. Summed in blocks, then over the
    blocks: arrays that grow by appending stay short, so the cost is linear
    in the number of sizes up to some 16,000, and no square of it beyond."""
    nothing = F.array().cast("array<int>")

    def sums(part: Column) -> Column:
        return F.aggregate(part, F.struct(F.lit(0).alias("at"), nothing.alias("out")), lambda acc, x: F.struct(
            (acc["at"] + x).alias("at"), F.concat(acc["out"], F.array(acc["at"])).alias("out")))

    blocks = F.transform(F.sequence(F.lit(0), F.floor((F.size(sizes) - 1) / BLOCK).cast("int")),
                         lambda i: sums(F.slice(sizes, i * BLOCK + 1, BLOCK)))
    whole = bind(blocks, lambda b: bind(sums(F.transform(b, lambda x: x["at"]))["out"], lambda base: F.flatten(
        F.transform(b, lambda x, i: F.transform(x["out"], lambda y: y + F.get(base, i))))))
    return F.when(F.size(sizes) == 0, nothing).otherwise(whole)


def _matches(text: Column, pattern: str) -> Column:
    """(start, end, match) of all matches: the texts between them, from a
    split by the same pattern, give the places."""
    found = F.regexp_extract_all(text, F.lit(pattern), F.lit(0))
    empty = F.array().cast("array<struct<start:int,end:int,match:string>>")

    def placed(m: Column) -> Column:
        def of(gaps: Column) -> Column:
            both = F.zip_with(F.slice(gaps, 1, F.size(m)), m, lambda g, x: F.length(g) + F.length(x))
            return bind(running(both), lambda at: F.transform(m, lambda x, i: bind(
                F.get(at, i) + F.length(F.get(gaps, i)), lambda start: F.struct(
                    start.alias("start"), (start + F.length(x)).alias("end"), x.alias("match")))))

        return bind(F.split(text, pattern, -1), of)

    return bind(found, lambda m: F.when(F.size(m) == 0, empty).otherwise(placed(m)))


def _value(match: Column, kind: int) -> Column:
    return F.regexp_extract(match, ASSIGN, 1) if kind == 0 else match


def candidates(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text",
               owner_col: str = "source") -> DataFrame:
    """doc_id, owner, row (a hash of the text) and found: array of (start,
    kind, end, value hash, looks random)."""
    text = F.coalesce(F.col(text_col).cast("string"), F.lit(""))

    def of(kind: int, pattern: str) -> Column:
        kept = _matches(text, pattern)
        if kind == 0:
            kept = F.filter(kept, lambda x: F.length(_value(x["match"], 0)) >= 12)
        random = lambda v: ((F.size(F.array_distinct(F.split(v, ""))) >= MIN_CHARACTERS)
                            & ~v.rlike(PLACEHOLDERS)) if kind != 4 else F.lit(True)
        return F.transform(kept, lambda x: F.struct(
            x["start"].alias("start"), F.lit(kind).alias("kind"), x["end"].alias("end"),
            F.xxhash64(_value(x["match"], kind)).alias("value"), random(_value(x["match"], kind)).alias("random")))

    every = [of(k, p) for k, p in enumerate((ASSIGN, ACCESS, HEX, MIXED, PEM))]
    return docs.select(F.col(id_col).alias("doc_id"), F.col(owner_col).cast("string").alias("owner"),
                       F.xxhash64(text).alias("row"), F.sort_array(F.concat(*every)).alias("found"))


def _owner() -> Column:
    """Whose document it is: one without a source has an owner of its own."""
    return F.coalesce(F.concat(F.lit("source "), "owner"), F.concat_ws(
        " ", F.lit("document"), F.col("doc_id").cast("string"), F.col("row").cast("string")))


def ownership(found: DataFrame) -> DataFrame:
    """Per candidate value: distinct repositories and owners."""
    rows = found.select("doc_id", "row", _owner().alias("owner"), F.explode("found").alias("c")).select(
        "doc_id", "owner", F.col("c.value").alias("value"))
    per_owner = rows.distinct().groupBy("value", "owner").agg(F.count("*").alias("repositories"))
    return per_owner.groupBy("value").agg(F.sum("repositories").alias("repositories"),
                                          F.count("*").alias("owners"))


def corpus_size(found: DataFrame) -> tuple[int, int]:
    """(owners, repositories) of the corpus: documents by id and text."""
    per_owner = found.select(_owner().alias("owner"), "doc_id", "row").distinct().groupBy("owner").agg(
        F.count("*").alias("n"))
    row = per_owner.agg(F.count("*").alias("owners"), F.sum("n").alias("repositories")).first()
    return int(row.owners), int(row.repositories or 0)


def scan(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", owner_col: str = "source",
         max_owners: int = MAX_OWNERS) -> DataFrame:
    """doc_id; found: all spans that stand, as (start, kind, end, live,
    owners, repositories), the base kinds always and the further kinds where
    they are live and touch no base span."""
    found = materialize(candidates(docs, id_col, text_col, owner_col), "secrets")
    owners, repositories = corpus_size(found)
    most_owners = max(max_owners, int(OWNER_SHARE * owners))
    most_each = max(MAX_REPOSITORIES, int(REPOSITORY_SHARE * repositories / max(owners, 1)))
    each = found.where(F.size("found") > 0).select("doc_id", "row", F.explode(F.array_distinct("found")).alias("c"))
    known = each.withColumn("value", F.col("c.value")).join(ownership(found), "value")
    live = F.col("c.random") & (F.col("owners") <= most_owners) & (
        F.col("repositories") <= F.col("owners") * most_each)
    judged = known.select("doc_id", "row", F.struct(
        F.col("c.start").alias("start"), F.col("c.kind").alias("kind"), F.col("c.end").alias("end"),
        live.alias("live"), "owners", "repositories").alias("s"))
    # equal rows are equal in all of this, so a set is enough
    per_row = judged.groupBy("doc_id", "row").agg(F.sort_array(F.collect_set("s")).alias("all"))
    free = F.filter("all", lambda s: (s["kind"] < BASE) | (s["live"] & ~F.exists(
        "all", lambda b: (b["kind"] < BASE) & (b["start"] < s["end"]) & (s["start"] < b["end"]))))
    spans = per_row.select(F.col("doc_id").alias("__id"), F.col("row").alias("__row"), free.alias("spans"))
    none = F.array().cast(spans.schema["spans"].dataType)
    return found.join(spans, F.col("doc_id").eqNullSafe(F.col("__id")) & (F.col("row") == F.col("__row")), "left") \
        .select("doc_id", F.coalesce("spans", none).alias("found"))


def _joined(spans: Column) -> Column:
    names = F.array(*[F.lit(k) for k in KINDS])
    return F.array_join(F.transform(spans, lambda s: F.concat_ws(
        ":", F.get(names, s["kind"]), s["start"].cast("string"), s["end"].cast("string"))), ",")


def digest(scanned: DataFrame) -> DataFrame:
    """The counts, the digest of the base spans, and all spans as text."""
    of = lambda k: F.size(F.filter("found", lambda s: s["kind"] == k)).cast("long")
    return scanned.select(
        "doc_id", *[of(k).alias(f"n_{KINDS[k]}") for k in range(BASE)],
        F.sha2(_joined(F.filter("found", lambda s: s["kind"] < BASE)), 256).alias("base_sha256"),
        _joined(F.col("found")).alias("spans"),
        F.size(F.filter("found", lambda s: s["live"])).cast("long").alias("n_live"),
        F.size(F.filter("found", lambda s: ~s["live"])).cast("long").alias("n_example"))
