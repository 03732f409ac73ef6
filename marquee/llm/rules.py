"""Quality rules with risk-controlled cutoffs (DataFrame expressions only).

Every document gets a few counts (words, symbols, repeated lines, words in
repeated windows, capitals). A fixed base rule rejects very short and very
repetitive texts. Beyond it, each measured ratio may reject documents above
a cutoff, and that cutoff is *certified* on labelled holdouts:

* the candidate cutoffs are a fixed grid, chosen before any label is seen;
* per stratum (language), rule and cutoff the labelled good documents that
  the cutoff would reject are counted, k of n;
* the cutoff is admissible when the exact binomial lower tail
  P(Bin(n, risk) <= k) is at most delta divided by the number of
  (stratum, rule, cutoff) tests (Bonferroni), i.e. when the exact upper
  confidence bound of the false rejection rate is below ``risk``;
* each rule's risk is the total risk divided by the number of rules, so in
  every stratum all rules together reject at most ``risk`` of the good
  documents, simultaneously with probability 1 - delta;
* among admissible cutoffs the one with the best gain (share of bad
  documents rejected minus a multiple of the share of good ones) is taken;
  ties go to the most lenient. Without gain or enough labels a rule is off.

Defined results: a null text has no words and fails the base rule; an empty
``docs`` gives an empty result; a null stratum is a stratum of its own name
(``""``); strata with under 1 % of the labelled rows share one stratum, so
there are at most 101; repeated rows are measured one by one; a doc_id
labelled both ways counts as bad; without labels only the base rule holds.
Other columns of ``docs`` are neither read nor returned by ``measure``.
"""

from __future__ import annotations

import math
from dataclasses import dataclass, field

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from marquee.llm.common import BLANKS, bind, free_name, materialize, words_of

WINDOW = 8
MIN_WORDS = 20
MAX_REPEAT_PERCENT = 30
SYMBOLS = "#*$%&|<>"

# Candidate cutoffs of each rule; a document above the cutoff is rejected.
GRID = tuple(round(0.02 * i, 2) for i in range(1, 25)) + tuple(round(0.5 + 0.05 * i, 2) for i in range(10))
RULES = ("symbols", "dup_lines", "repeats", "capitals")
OTHER = "*"


def _repeat_words(words: Column) -> Column:
    """Number of words inside windows of ``WINDOW`` words that occur twice
    or more. Windows are compared by a 64-bit hash of their word hashes."""
    def covered(h: Column) -> Column:
        keyed = F.sort_array(F.transform(h, lambda x, i: F.struct(x.alias("h"), i.alias("p"))))
        hit = bind(keyed, lambda s: F.sort_array(F.transform(F.filter(
            F.transform(s, lambda x, i: F.struct(
                x["p"].alias("p"),
                (F.coalesce(F.get(s, i - 1)["h"] == x["h"], F.lit(False))
                 | F.coalesce(F.get(s, i + 1)["h"] == x["h"], F.lit(False))).alias("dup"))),
            lambda x: x["dup"]), lambda x: x["p"])))
        return bind(hit, lambda p: F.aggregate(
            F.transform(p, lambda x, i: F.least(F.lit(WINDOW), F.coalesce(F.get(p, i + 1) - x, F.lit(WINDOW)))),
            F.lit(0).cast("long"), lambda acc, x: acc + x))

    def counted(wh: Column) -> Column:
        starts = F.sequence(F.lit(0), F.size(wh) - WINDOW)
        hashes = F.transform(starts, lambda i: F.xxhash64(*[F.get(wh, i + k) for k in range(WINDOW)]))
        return F.when(F.size(wh) < WINDOW + 1, F.lit(0).cast("long")).otherwise(bind(
            hashes, lambda h: F.when(F.size(F.array_distinct(h)) == F.size(h), F.lit(0).cast("long"))
            .otherwise(covered(h))))

    return bind(F.transform(words, lambda w: F.xxhash64(w)), counted)


def _measures(id_col: str = "doc_id", text_col: str = "text", stratum_col: str = "lang") -> list[Column]:
    text = F.coalesce(F.col(text_col).cast("string"), F.lit(""))
    keep = lambda cls: F.length(F.regexp_replace(text, f"[^{cls}]+", "")).cast("long")
    lines = F.filter(F.split(text, "\n"), lambda x: F.btrim(x, F.lit(BLANKS)) != "")
    counts = F.struct(
        bind(words_of(text), lambda w: F.struct(
            F.size(w).cast("long").alias("n_words"), _repeat_words(w).alias("n_repeat_words"))).alias("w"),
        bind(lines, lambda x: F.struct(
            F.size(x).cast("long").alias("n_lines"),
            (F.size(x) - F.size(F.array_distinct(x))).cast("long").alias("n_dup_lines"))).alias("l"),
        (F.length(text) - keep(r"\x20\x09-\x0D")).alias("word_chars"),
        keep(SYMBOLS).alias("n_symbols"), keep("A-Z").alias("n_capitals"))
    part = lambda a, b: a / F.greatest(b, F.lit(1))

    def named(c: Column) -> Column:
        n_words, repeats = c["w"]["n_words"], c["w"]["n_repeat_words"]
        return F.struct(
            n_words.alias("n_words"), c["word_chars"].alias("word_chars"), c["n_symbols"].alias("n_symbols"),
            c["l"]["n_dup_lines"].alias("n_dup_lines"), repeats.alias("n_repeat_words"),
            F.array(part(c["n_symbols"], c["word_chars"]), part(c["l"]["n_dup_lines"], c["l"]["n_lines"]),
                    part(repeats, n_words), part(c["n_capitals"], c["word_chars"])).alias("ratios"),
            ((n_words < MIN_WORDS) | (100 * repeats > MAX_REPEAT_PERCENT * n_words)).alias("base_failed"))

    m = bind(counts, named)
    return [F.col(id_col).alias("doc_id"),
            F.coalesce(F.col(stratum_col).cast("string"), F.lit("")).alias("stratum"), m.alias("m")]


def measure(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text",
            stratum_col: str = "lang") -> DataFrame:
    """doc_id, stratum, the counts and the rule ratios of every text."""
    return docs.select(*_measures(id_col, text_col, stratum_col)).select("doc_id", "stratum", "m.*")


def _log_factorial(n: Column) -> Column:
    """ln n!: exact up to 20, then Stirling's series (error under 1e-13)."""
    x = n.cast("double")
    series = (x * F.log(x) - x + 0.5 * F.log(2 * math.pi * x)
              + 1 / (12 * x) - 1 / (360 * F.pow(x, 3)) + 1 / (1260 * F.pow(x, 5)))
    return F.when(n <= 20, F.log(F.factorial(F.least(n, F.lit(20)).cast("int")))).otherwise(series)


def binomial_tail(k: Column, n: Column, risk: float) -> Column:
    """P(Bin(n, risk) <= k) for long columns 0 <= k <= n. At or above the
    mean the tail is no evidence and 1.0 is returned. Below it the terms
    fall as j goes down from k; those more than forty standard deviations
    away are below 1e-300 and are left out."""
    top = (_log_factorial(n) - _log_factorial(k) - _log_factorial(n - k)
           + k * math.log(risk) + (n - k) * math.log1p(-risk))
    terms = F.least(k, F.ceil(40 * F.sqrt((k + 1).cast("double")) + 40)).cast("long")
    odds = (1 - risk) / risk
    total = F.when(k == 0, F.lit(1.0)).otherwise(F.aggregate(
        F.sequence(F.lit(0).cast("long"), F.greatest(terms, F.lit(1)) - 1),
        F.struct(F.lit(1.0).alias("sum"), F.lit(1.0).alias("term")),
        lambda acc, i: bind(
            acc["term"] * (k - i) * odds / (n - k + i + 1),
            lambda t: F.struct((acc["sum"] + t).alias("sum"), t.alias("term"))),
        lambda acc: acc["sum"]))
    return F.when(k >= n * risk, F.lit(1.0)).otherwise(F.exp(top) * total)


@dataclass(frozen=True)
class Cutoffs:
    """Certified cutoffs: ``values[stratum][rule]``; a missing one is off."""
    values: dict[str, dict[str, float]] = field(default_factory=dict)
    strata: tuple[str, ...] = ()

    def rejected(self, stratum: Column, ratios: Column) -> Column:
        """True where a certified cutoff is exceeded."""
        known = F.when(stratum.isin(list(self.strata)), stratum).otherwise(F.lit(OTHER)) \
            if self.strata else F.lit(OTHER)
        out = F.lit(False)
        for name, rules in sorted(self.values.items()):
            over = F.lit(False)
            for rule, cut in sorted(rules.items()):
                over = over | (F.get(ratios, F.lit(RULES.index(rule))) > F.lit(cut))
            out = out | ((known == name) & over)
        return out


def holdout(measured: DataFrame, labels: DataFrame, id_col: str = "doc_id",
            label_col: str = "quality") -> DataFrame:
    """Measured documents that carry a label: stratum, ratios, good."""
    marks = (labels.where(F.col(label_col).isNotNull() & F.col(id_col).isNotNull())
             .groupBy(F.col(id_col).alias("doc_id")).agg((F.min(label_col) == 1).alias("good")))
    return (measured.where(~F.col("base_failed")).join(marks, "doc_id")
            .select("stratum", "ratios", "good"))


def certify(held: DataFrame, risk: float = 0.02, delta: float = 0.05, penalty: float = 20.0) -> DataFrame:
    """One row per (stratum, rule, cutoff): counts, tail and admissibility.
    At most 101 strata x 4 rules x 34 cutoffs rows."""
    n_rules, n_cuts = len(RULES), len(GRID)
    binned = held.select("stratum", "good", F.posexplode("ratios").alias("rule", "value")).select(
        "stratum", "good", "rule",
        F.size(F.filter(F.array(*[F.lit(c) for c in GRID]), lambda c: F.col("value") > c)).alias("bin"))
    counted = binned.groupBy("stratum", "rule", "bin").agg(
        F.sum(F.col("good").cast("long")).alias("good"), F.sum((~F.col("good")).cast("long")).alias("bad"))
    sizes = counted.where("rule = 0").groupBy("stratum").agg(F.sum(F.col("good") + F.col("bad")).alias("rows"))
    named = sizes.select("stratum", F.when(
        F.col("rows") * 100 >= F.sum("rows").over(_all()), F.col("stratum")).otherwise(F.lit(OTHER)).alias("name"))
    pooled = (counted.join(named, "stratum").groupBy("name", "rule", "bin")
              .agg(F.sum("good").alias("good"), F.sum("bad").alias("bad")))
    # cutoff i rejects the documents of bins above i
    per_rule = pooled.groupBy("name", "rule").agg(
        F.collect_list(F.struct("bin", "good", "bad")).alias("bins"),
        F.sum("good").alias("n_good"), F.sum("bad").alias("n_bad"))
    above = lambda f: F.aggregate("bins", F.lit(0).cast("long"),
                                  lambda acc, b: acc + F.when(b["bin"] > F.col("cut"), b[f]).otherwise(0))
    grid = (per_rule.select("*", F.explode(F.sequence(F.lit(0), F.lit(n_cuts - 1))).alias("cut"))
            .select("name", "rule", "cut", "n_good", "n_bad", above("good").alias("k_good"),
                    above("bad").alias("k_bad")))
    tests = F.size(F.collect_set("name").over(_all())) * n_rules * n_cuts
    out = grid.select("*", binomial_tail(F.col("k_good"), F.col("n_good"), risk / n_rules).alias("tail"),
                      tests.alias("tests"))
    gain = (F.col("k_bad") / F.greatest("n_bad", F.lit(1))
            - penalty * F.col("k_good") / F.greatest("n_good", F.lit(1)))
    return out.select("*", (F.col("tail") <= delta / F.col("tests")).alias("admissible"), gain.alias("gain"))


def _all():
    """One window over a table of at most a few thousand rows."""
    return Window.partitionBy(F.lit(1))


def fit(measured: DataFrame, labels: DataFrame, risk: float = 0.02, delta: float = 0.05,
        penalty: float = 20.0) -> Cutoffs:
    """Cutoffs of every stratum. What reaches the driver is the certified
    grid, at most 101 x 4 x 34 rows whatever the corpus holds."""
    rows = certify(holdout(measured, labels), risk, delta, penalty).collect()
    best: dict[tuple[str, str], tuple[float, int]] = {}
    for r in rows:
        if r["admissible"] and r["gain"] > 0:
            key = (r["name"], RULES[r["rule"]])
            best[key] = max(best.get(key, (0.0, -1)), (r["gain"], r["cut"]))
    values: dict[str, dict[str, float]] = {}
    for (name, rule), (_, cut) in sorted(best.items()):
        values.setdefault(name, {})[rule] = GRID[cut]
    return Cutoffs(values, tuple(sorted({r["name"] for r in rows} - {OTHER})))


def judge(docs: DataFrame, labels: DataFrame, risk: float = 0.02, delta: float = 0.05) -> DataFrame:
    """The counts of every document with ``kept``. The measures are written
    once (a few numbers per document) and read for both the certification
    and the verdicts, so texts are scanned once."""
    measured = materialize(measure(docs), "rules")
    cuts = fit(measured, labels, risk, delta)
    return measured.select(
        "doc_id", "n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words", "base_failed",
        (~F.col("base_failed") & ~cuts.rejected(F.col("stratum"), F.col("ratios"))).alias("kept"))


def filter_documents(docs: DataFrame, labels: DataFrame, risk: float = 0.02, delta: float = 0.05) -> DataFrame:
    """``docs`` without the rejected rows, all columns kept. Rows are written
    once beside their measures, so the verdict needs neither a join nor a
    second measuring; rows that share a doc_id are judged one by one."""
    name = free_name(docs, "__rules")
    measured = materialize(docs.withColumn(name, F.struct(*_measures())), "rules")
    r = F.col(name)
    cuts = fit(measured.select(f"{name}.doc_id", f"{name}.stratum", f"{name}.m.*"), labels, risk, delta)
    return measured.where(~r["m"]["base_failed"] & ~cuts.rejected(r["stratum"], r["m"]["ratios"])).drop(name)
