"""Token counts kept up to date by signed changes.

A batch of changes (inserted, deleted and revised documents) is reduced to
additive deltas by source, language and tokenizer version and written as one
commit, in a folder of its own named by the batch. Totals are the sum of all
commits, so a batch costs its own size, not the corpus'. A batch that is
committed already is left as it is: running it again, after a failure or by
mistake, changes nothing.

Defined cases: a missing count is 0; missing sources, languages and versions are
groups of their own; repeated rows of changes each count, for a change is an
event; an empty batch commits nothing to add; groups whose totals are all zero
stay as rows of zeros. Other columns of the changes are not read. A kind of change
other than the three fails the batch.
"""

from __future__ import annotations

import re
from functools import reduce

from pyspark.sql import Column, DataFrame, SparkSession, functions as F

KEYS = ["source", "lang", "tokenizer_version"]
TOTALS = "source string, lang string, tokenizer_version string, documents long, tokens long"


def deltas(changes: DataFrame) -> DataFrame:
    """Sum signed changes per group; Spark adds them up within tasks first, so hot groups are cheap to move.

    ``changes`` has ``kind`` (insert, delete, revise), the three keys, ``tokens`` (of
    a delete: the count that goes) and ``previous`` (of a revision: the count so far).
    """
    kind, tokens = F.col("kind"), F.coalesce("tokens", F.lit(0)).cast("long")

    def signed(insert: Column, delete: Column, revise: Column) -> Column:
        return (
            F.when(kind == "insert", insert)
            .when(kind == "delete", delete)
            .when(kind == "revise", revise)
            .otherwise(F.raise_error(F.concat(F.lit("unknown change: "), F.coalesce(kind, F.lit("none")))).cast("long"))
        )

    one, none = F.lit(1).cast("long"), F.lit(0).cast("long")
    return (
        changes.select(
            *[F.col(k).cast("string") for k in KEYS],
            signed(one, -one, none).alias("documents"),
            signed(tokens, -tokens, tokens - F.coalesce("previous", F.lit(0)).cast("long")).alias("tokens"),
        )
        .groupBy(*KEYS)
        .agg(F.sum("documents").alias("documents"), F.sum("tokens").alias("tokens"))
    )


class TokenRollup:
    """Totals below ``path``, a folder that all executors reach."""

    def __init__(self, spark: SparkSession, path: str):
        self.spark, self.path = spark, path.rstrip("/")

    def _folder(self, batch: str) -> str:
        if not re.fullmatch(r"[A-Za-z0-9_.-]+", batch):
            raise ValueError(f"a batch name is letters, digits, '_', '.' and '-': {batch!r}")
        return f"{self.path}/commit={batch}"

    def _exists(self, path: str) -> bool:
        jvm = self.spark._jvm
        place = jvm.org.apache.hadoop.fs.Path(path)
        return place.getFileSystem(self.spark._jsc.hadoopConfiguration()).exists(place)

    def committed(self, batch: str) -> bool:
        """Spark writes the marker last, so half a batch is never counted."""
        return self._exists(f"{self._folder(batch)}/_SUCCESS")

    def commit(self, batch: str, changes: DataFrame) -> bool:
        """Add a batch; False if it was there already."""
        if self.committed(batch):
            return False
        deltas(changes).write.mode("overwrite").parquet(self._folder(batch))
        return True

    def totals(self, batches: list[str]) -> DataFrame:
        """Totals over the named batches that are committed."""
        done = [self._folder(b) for b in dict.fromkeys(batches) if self.committed(b)]
        read = self.spark.read.schema(TOTALS)
        rows = [read.parquet(p) for p in done] or [self.spark.createDataFrame([], TOTALS)]
        return (
            reduce(DataFrame.unionByName, rows)
            .groupBy(*KEYS)
            .agg(F.sum("documents").alias("documents"), F.sum("tokens").alias("tokens"))
        )
