"""Helpers shared by the operators."""

from __future__ import annotations

import contextlib
import uuid

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from marquee.plans.session import scratch_path

# the white space that separates words: space and \x09-\x0D
BLANKS = " \t\n\x0b\x0c\r"
BLANK_RUN = r"[\x20\x09-\x0D]+"


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir.rstrip('/')}/{name}.parquet")


def bind(value: Column, body) -> Column:
    """``body(value)`` with ``value`` evaluated once per row: a lambda
    variable, which the optimizer cannot copy into inner lambdas."""
    return F.get(F.transform(F.array(value), body), F.lit(0))


def free_name(df: DataFrame, name: str) -> str:
    """``name``, with underscores behind it until no column of ``df`` has it
    (in any case)."""
    taken = {c.lower() for c in df.columns}
    while name.lower() in taken:
        name += "_"
    return name


def words_of(text: Column) -> Column:
    """Blank-separated words of a text; null and blank texts have none."""
    inner = F.btrim(F.coalesce(text, F.lit("")), F.lit(BLANKS))
    return F.when(inner == "", F.array().cast("array<string>")).otherwise(F.split(inner, BLANK_RUN))


def materialize(df: DataFrame, tag: str) -> DataFrame:
    """Write ``df`` as Parquet under the shared checkpoint folder and read
    it back: a lineage cut that any executor can read again."""
    path = scratch_path(df.sparkSession, f"llm-{tag}-{uuid.uuid4().hex}")
    df.write.parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)


def discard(stored: DataFrame) -> None:
    """Delete what ``materialize`` wrote, once nothing will read it again."""
    spark = stored.sparkSession
    for folder in {f.rpartition("/")[0] for f in stored.inputFiles()}:
        path = spark._jvm.org.apache.hadoop.fs.Path(spark._jvm.java.net.URI(folder))
        path.getFileSystem(spark._jsparkSession.sessionState().newHadoopConf()).delete(path, True)


@contextlib.contextmanager
def shuffles_removed(spark: SparkSession):
    """Queries run inside the block delete their shuffle files when they
    end; else these stay until the driver collects its garbage."""
    key = "spark.sql.classic.shuffleDependency.fileCleanup.enabled"
    before = spark.conf.get(key, None)
    spark.conf.set(key, "true")
    try:
        yield
    finally:
        spark.conf.unset(key) if before is None else spark.conf.set(key, before)


# keys of rows are broadcast up to this many (some 50 MB), else joined by a shuffle
MAX_BROADCAST_KEYS = 500_000


def keys_to(keys: DataFrame) -> DataFrame:
    """Stored ``keys`` of few columns, to join texts with: while they are few
    the texts stay where they are, else both sides are shuffled."""
    return F.broadcast(keys) if keys.count() <= MAX_BROADCAST_KEYS else keys


@contextlib.contextmanager
def small_batches(spark: SparkSession, rows: int = 1000, size: int = 4 << 20):
    """Jobs inside the block hand wide rows to Python in batches of at most
    ``rows`` rows (and ``size`` bytes where Spark cuts by bytes), so that
    neither side holds ten thousand sets at once. The session's own settings
    come back afterwards."""
    wanted = {"spark.sql.execution.arrow.maxRecordsPerBatch": str(rows),
              "spark.sql.execution.arrow.maxBytesPerBatch": str(size)}
    before = {k: spark.conf.get(k) for k in wanted}
    try:
        for k, v in wanted.items():
            spark.conf.set(k, v)
        yield
    finally:
        for k, v in before.items():
            spark.conf.set(k, v)


_HELD: dict = {}


def held(name: str | None, key=None, build=None):
    """In a worker: the model ``name``, built for ``key`` and kept from task
    to task. A worker holds one model; asking for another, or for none,
    drops it, as a process outlives the job that needed it."""
    if name is None or (name, key) not in _HELD:
        _HELD.clear()
        if name is not None:
            _HELD[name, key] = build()
    return _HELD.get((name, key))


def ascii_lower(text: Column) -> Column:
    """Lower-case A-Z only."""
    return F.translate(text, "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz")


def ship(spark: SparkSession) -> None:
    """Give the Python workers this package (a small zip, once a session),
    so that they need no installed copy. Files only; nothing is stored on a
    machine that later tasks rely on."""
    import pathlib
    import tempfile
    import zipfile

    context = spark.sparkContext
    if getattr(context, "_marquee_shipped", False):
        return
    root = pathlib.Path(__file__).resolve().parents[1]
    path = f"{tempfile.mkdtemp(prefix='marquee-src-')}/marquee-src.zip"
    with zipfile.ZipFile(path, "w") as out:
        for file in sorted(root.rglob("*.py")):
            out.write(file, f"{root.name}/{file.relative_to(root)}")
    context.addPyFile(path)
    context._marquee_shipped = True


def labelled_sample(docs: DataFrame, labels: DataFrame, label_col: str, per_class: int, id_col: str = "doc_id",
                    text_col: str = "text") -> DataFrame:
    """At most ``per_class`` labelled texts of each class 0 and 1: id, text,
    label. The ids are chosen from the narrow label table, by a hash that
    does not depend on partitioning; a document labelled both ways, or with
    no text row, teaches nothing. Of a repeated id one row per text stays."""
    marks = (labels.where(F.col(label_col).isin(0, 1) & F.col(id_col).isNotNull())
             .groupBy(F.col(id_col).alias("id"))
             .agg(F.min(label_col).alias("label"), F.max(label_col).alias("other")).where("label = other"))
    order = [F.xxhash64(F.col("id").cast("string")), F.col("id")]
    # a top-k of each class: every task keeps per_class ids, none sorts a class
    zero, one = (marks.where(F.col("label") == c).select("id", "label").orderBy(*order).limit(per_class) for c in (0, 1))
    chosen = zero.unionByName(one)
    # at most 2 * per_class ids
    return docs.select(F.col(id_col).alias("id"), F.coalesce(F.col(text_col).cast("string"), F.lit("")).alias("text")) \
        .join(F.broadcast(chosen), "id").dropDuplicates(["id", "text"])
