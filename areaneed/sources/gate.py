"""A gate in the writing job: a table is published only if it keeps its contract and its rules.

The counts of failing rows come with the write itself (``DataFrame.observe``), not from a second pass;
rules that need more than one row run on the written files. Each write has a folder of its own, and a
pointer row added at the end names it, so readers keep the last good table until then and a
breach leaves it in place.
"""

from __future__ import annotations

import time
import uuid
from collections.abc import Callable, Iterable, Mapping
from functools import reduce

from pyspark.errors import AnalysisException
from pyspark.sql import Column, DataFrame, Observation, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from areaneed.operators.quality import contract_breaches, dq_unique

#: A check over the written rows: (check, failing_rows) rows.
Check = Callable[[DataFrame], DataFrame]


class BrokenContract(RuntimeError):
    """A table failed its rules; ``breaches`` maps each broken rule to its failing rows (columns
    in breach of the declared schema count one each)."""

    def __init__(self, table: str, breaches: Mapping[str, int]):
        listed = ", ".join(f"{rule}: {n}" for rule, n in sorted(breaches.items()))
        super().__init__(f"{table} is not published: {listed}")
        self.table = table
        self.breaches = dict(breaches)


def publish(
    df: DataFrame,
    root: str,
    name: str,
    schema: T.StructType | None = None,
    failing: Mapping[str, Column] | None = None,
    unique: Iterable[str] = (),
    after: Iterable[Check] = (),
    partition: Iterable[str] = (),
) -> DataFrame:
    """Write ``df``, and publish it as table ``name`` if nothing fails; else ``BrokenContract``.

    ``failing`` maps a rule to the condition of a failing row, as in ``declared_checks``. A null
    condition does not fail. A task that ran twice may count twice, which changes no verdict:
    only whether a count is zero decides. ``partition`` writes one folder per value; a value such as
    '01' stays a text.
    """
    if schema is not None and (wrong := contract_breaches(df, schema)):
        raise BrokenContract(name, {f"contract {c}": 1 for c in wrong})
    rules = dict(failing or {})
    seen = Observation(f"{name}-{uuid.uuid4().hex}")
    counts = [F.count_if(cond).alias(f"c{i}") for i, cond in enumerate(rules.values())]
    path = f"{root}/{name}/{uuid.uuid4().hex}"
    counted = df.observe(seen, F.count(F.lit(1)).alias("rows"), *counts)
    writer = counted.write.option("maxRecordsPerFile", 5_000_000)
    (writer.partitionBy(*partition) if partition else writer).parquet(path)
    found = seen.get
    breaches = {rule: found[f"c{i}"] for i, rule in enumerate(rules)}
    rows = df.sparkSession.read.schema(df.schema).parquet(path).select(*df.columns)
    later = [dq_unique(rows, list(unique))] if unique else []
    later += [check(rows) for check in after]
    if later:
        checked = reduce(DataFrame.unionByName, [x.select("check", "failing_rows") for x in later])
        breaches |= {r["check"]: r["failing_rows"] for r in checked.collect()}  # a row a check
    broken = {rule: n for rule, n in breaches.items() if n}
    if broken:
        raise BrokenContract(name, broken)
    pointer = df.sparkSession.createDataFrame(
        [(time.time_ns(), path, found["rows"])], "at long, path string, rows long"
    )
    pointer.coalesce(1).write.mode("append").parquet(f"{root}/{name}_published")
    return rows


def published(spark: SparkSession, root: str, name: str) -> DataFrame | None:
    """The last published table, None before the first."""
    try:
        pointers = spark.read.parquet(f"{root}/{name}_published")
    except AnalysisException as error:
        if error.getCondition() != "PATH_NOT_FOUND":
            raise
        return None
    path = pointers.orderBy(F.desc("at"), F.desc("path")).first()["path"]
    return spark.read.parquet(path)
