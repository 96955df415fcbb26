"""Exact dedup: a persistent digest index, bucketed and sorted by hash, that new rows are anti-joined with.

A text counts as its SHA-256 after A-Z are lower-cased, null as the empty text. Only (digest, id)
rows are shuffled, never texts, and copies are counted before the shuffle, so a group that holds a
third of all rows costs one partial row per task; its decision goes to `SALTS` tasks, dealt by id.

The index is a folder: `v0`, `v1`, ... with the bucketed Parquet files of each version, and `versions`
with an empty file `<version>-<buckets>` for each, written last. The highest one counts, whatever the
session's settings are. `compact` writes the next version: one sorted file a bucket, which the next
anti-join reads as it is, without a sort. There may be many readers, but one writer at a time.

A batch has a name. Ingesting it again (after a lost driver, say) appends only what is missing of it
and gives the same decisions: rows that the batch itself brought stay.

Defined results: a null id is smaller than any other, so such a row stays only if all copies lack an
id. Of rows that repeat both text and id exactly one stays. An empty table gives an empty result.
Columns beyond `id_col` and `text_col` are not read, whatever their names.
"""

from __future__ import annotations

import uuid

from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from .common import ascii_lower, configured, fresh, materialise, names_in, partitions, remove, touch

INDEX_SCHEMA = "digest BINARY, keep_id BIGINT, batch STRING"
#: A group's rows are dealt to as many tasks; fits the bits of a long.
SALTS = 60


def digest(text: Column) -> Column:
    return F.unhex(F.sha2(ascii_lower(F.coalesce(text, F.lit(""))).cast("binary"), 256))


class DigestIndex:
    """The digests seen so far, as a bucketed table at `path`, each bucket sorted by digest.

    An index that exists keeps its number of buckets; asking for another one is an error (`compact`
    changes it). Appending is a sort-merge anti-join in which only the new side is shuffled: the index
    is read bucket by bucket.
    """

    def __init__(self, spark: SparkSession, path: str, buckets: int | None = None):
        self.spark, self.path = spark, path
        known = [tuple(int(x) for x in name.split("-")) for name in names_in(spark, f"{path}/versions")]
        if not known:
            known = [(0, buckets or partitions(spark))]
            touch(spark, f"{path}/versions/{known[0][0]}-{known[0][1]}")
        self.version, self.buckets = max(known)
        if buckets not in (None, self.buckets):
            raise ValueError(f"the index at {path} has {self.buckets} buckets, not {buckets}")
        self.name = self._table(self.version, self.buckets)

    def _folder(self, version: int) -> str:
        return f"{self.path}/v{version}"

    def _table(self, version: int, buckets: int) -> str:
        """The name under which this session knows a version's files."""
        name = f"digest_index_{uuid.uuid5(uuid.NAMESPACE_URL, f'{self._folder(version)}-{buckets}').hex}"
        if not self.spark.catalog.tableExists(name):
            self.spark.sql(
                f"CREATE TABLE {name} ({INDEX_SCHEMA}) USING parquet "
                f"CLUSTERED BY (digest) SORTED BY (digest) INTO {buckets} BUCKETS LOCATION '{self._folder(version)}'"
            )
        self.spark.catalog.refreshTable(name)  # others may have appended
        return name

    def read(self) -> DataFrame:
        return self.spark.table(self.name)

    def _append(self, rows: DataFrame, version: int, buckets: int) -> None:
        (
            rows.repartition(buckets, "digest").write.mode("append").format("parquet").bucketBy(buckets, "digest").sortBy("digest")
            .option("path", self._folder(version)).saveAsTable(self._table(version, buckets))
        )
        self.spark.catalog.refreshTable(self._table(version, buckets))

    def compact(self, buckets: int | None = None) -> None:
        """Rewrite the index as one sorted file a bucket (`buckets` of them); what read the version before goes on reading it."""
        version, buckets = self.version + 1, buckets or self.buckets
        self.spark.sql(f"DROP TABLE IF EXISTS {self._table(version, buckets)}")
        remove(self.spark, self._folder(version))  # of a compaction that did not end
        with configured(self.spark, "spark.sql.sources.bucketing.autoBucketedScan.enabled", "false"):  # one task a bucket
            self._append(self.read(), version, buckets)
        touch(self.spark, f"{self.path}/versions/{version}-{buckets}")
        for older in range(self.version):
            remove(self.spark, self._folder(older))
        self.version, self.buckets, self.name = version, buckets, self._table(version, buckets)

    def ingest(self, docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", batch: str | None = None) -> DataFrame:
        """Deduplicate `docs` against the index and itself, append what is new, return the decisions.

        One row per row of `docs`: id, digest, keep_id, group_size (copies in this batch), copy
        (1.. among rows of equal id and text), kept. A digest known from an earlier batch keeps its
        earlier id and none of the new rows. `batch` names the batch, so that it can be repeated; without
        a name it is a new one each time.
        """
        batch = batch or uuid.uuid4().hex
        salt = F.pmod(F.xxhash64("id"), F.lit(SALTS)).cast("int")
        rows = docs.select(F.col(id_col).cast("bigint").alias("id"), digest(F.col(text_col)).alias("digest"))
        by_id = materialise(rows.groupBy("digest", "id").agg(F.count("*").alias("copies")).withColumn("salt", salt), "dedup-counts")
        held = F.expr("bit_or(shiftleft(1L, salt))").alias("held")
        groups = by_id.groupBy("digest").agg(F.max("id").alias("newest"), F.sum("copies").alias("group_size"), held)
        groups = materialise(groups, "dedup-groups")
        # of a compacted index each bucket is one file, whose order is then relied upon
        with configured(self.spark, "spark.sql.legacy.bucketedTableScan.outputOrdering", "true"):
            new = groups.join(self.read().hint("merge"), "digest", "left_anti")
            self._append(new.select("digest", F.col("newest").alias("keep_id"), F.lit(batch).alias("batch")), self.version, self.buckets)
        of_group = groups.join(self.read().hint("merge"), "digest")
        salts = F.filter(F.sequence(F.lit(0), F.lit(SALTS - 1)), lambda s: F.getbit(F.col("held"), s) == 1)
        of_group = of_group.select("digest", "keep_id", (F.col("batch") == batch).alias("own"), "group_size", F.explode(salts).alias("salt"))
        stays = F.col("own") & F.col("id").eqNullSafe(F.col("keep_id"))
        return (
            by_id.join(of_group, ["digest", "salt"])
            .withColumn("copy", F.explode(F.sequence(F.lit(1).cast("bigint"), "copies")))
            .select("id", "digest", "keep_id", "group_size", "copy", (stays & (F.col("copy") == 1)).alias("kept"))
        )


def survivors(docs: DataFrame, index: DigestIndex, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """The rows of `docs` that stay, with their columns. Texts are shuffled once, by (digest, id), which no group shares."""
    own, copy, kept_id, kept_digest = (fresh(docs, c) for c in ("_own", "_copy", "_kept_id", "_kept_digest"))
    kept = index.ingest(docs, id_col, text_col).where("kept")
    kept = kept.select(F.col("id").alias(kept_id), F.col("digest").alias(kept_digest))
    match = F.col(own).eqNullSafe(F.col(kept_digest)) & F.col(id_col).cast("bigint").eqNullSafe(F.col(kept_id))
    found = docs.withColumn(own, digest(F.col(text_col))).join(kept, match, "left_semi")
    first = Window.partitionBy(own, id_col).orderBy(id_col)
    return found.withColumn(copy, F.row_number().over(first)).where(F.col(copy) == 1).drop(copy, own)
