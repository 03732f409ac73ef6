"""Run by tests/test_failures.py in its own process (own SparkContext):
the catalogue chain with one injected task failure after a shuffle."""

import json
import sys

sys.path.insert(0, sys.argv[1])

from pyspark import TaskContext  # noqa: E402

from marquee.operators import groups  # noqa: E402
from marquee.plans.session import local_session  # noqa: E402
from marquee.sources import starview  # noqa: E402

SF = "/root/testdata/sf0.01"


def fail_once(batches):
    ctx = TaskContext.get()
    if ctx.partitionId() == 0 and ctx.attemptNumber() == 0:
        raise RuntimeError("injected task failure")
    yield from batches


def results(spark, inject):
    clean = starview.clean_titles(spark, SF)
    if inject:
        clean = clean.mapInPandas(fail_once, clean.schema)
    med = sorted(tuple(r) for r in groups.roi_by_genre(clean).collect())
    dirs = sorted(tuple(r) for r in groups.director_summary(clean).collect())
    return {"median": med, "directors": dirs}


if __name__ == "__main__":
    spark = local_session(cores="4,4", partitions=8, app="marquee-failures")
    a = results(spark, inject=False)
    b = results(spark, inject=True)
    print(json.dumps({"same": a == b, "groups": len(a["median"]), "directors": len(a["directors"])}))
    spark.stop()
