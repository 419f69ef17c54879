"""Exact deduplication with a persistent digest index (operator 1), DataFrame code only.

The index is a table of the digests seen so far and the document that stays for each,
bucketed and sorted by digest in a folder of its own. A batch of documents is reduced to
one row per digest, anti-joined with the index by sort-merge on the buckets, and what is
new is appended. Texts never move: only digests and ids are shuffled, merged in each task
first, so a group of copies with a third of all rows arrives as one row per task.

Defined results: a null text is empty; a null ``doc_id`` loses against every other one;
rows with the same ``doc_id`` and equal texts are one document, returned and counted
once; an empty table gives no rows; other columns are not read, whatever their names.
"""

from __future__ import annotations

import json
import uuid

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from claimloom.llm.shared import free_name, stored, whole_text
from claimloom.sources import hadoop

WHITE_SPACE = r"[\x20\x09-\x0D]+"
LEAST_BUCKETS = 64
BUCKET_ROWS = 4_000_000

_FIELDS = "digest binary, keep_id long, batch string"


def text_digest(column: str = "text") -> Column:
    """sha256 (hexadecimal) of the text with each run of white space as one space."""
    return F.sha2(F.regexp_replace(whole_text(column), WHITE_SPACE, " "), 256)


class DigestIndex:
    """Digests of all documents kept so far, below ``folder``; it outlives the session.

    The number of buckets is fixed when the index is made and kept with it: as given, or so
    that the first batch has some ``BUCKET_ROWS`` digests in each. ``compacted`` makes an index of
    another number.
    """

    def __init__(self, spark: SparkSession, folder: str, buckets: int | None = None):
        self._spark = spark
        self._folder = folder
        self._table: str | None = None
        self._buckets = self._stored_buckets()
        if self._buckets is None and buckets is not None:
            self._make(buckets)
        elif self._buckets is not None:
            if buckets not in (None, self._buckets):
                raise ValueError(f"the index in {folder} has {self._buckets} buckets")
            self._register()

    def _layout(self) -> str:
        return f"{self._folder}/_layout.json"

    def _stored_buckets(self) -> int | None:
        if not hadoop.exists(self._spark, self._layout()):
            return None
        return json.loads(hadoop.read_text(self._spark, self._layout()))["buckets"]

    def _make(self, buckets: int) -> None:
        text = json.dumps({"buckets": int(buckets)})
        hadoop.write_new_text(self._spark, self._layout(), text)
        # another session may have been first
        self._buckets = self._stored_buckets()
        self._register()

    def _register(self) -> None:
        # the name is the session's; the folder is what persists
        self._table = f"digest_index_{uuid.uuid4().hex}"
        self._spark.sql(
            f"CREATE TABLE {self._table} ({_FIELDS}) USING parquet "
            f"CLUSTERED BY (digest) SORTED BY (digest) INTO {self._buckets} BUCKETS "
            f"LOCATION '{self._folder}'"
        )

    def close(self) -> None:
        """Take the index out of the session's catalogue; the folder stays."""
        if self._table:
            self._spark.sql(f"DROP TABLE IF EXISTS {self._table}")
            self._table = None

    def entries(self) -> DataFrame:
        """All entries, partitioned by digest as they are stored."""
        if self._table is None:
            return self._spark.createDataFrame([], _FIELDS)
        return self._spark.table(self._table)

    def append(self, firsts: DataFrame, batch: str) -> None:
        """Add entries; one file per bucket, as the rows are dealt out like the buckets."""
        entries = firsts.select("digest", "keep_id", F.lit(batch).alias("batch"))
        self._write(entries)

    def _write(self, entries: DataFrame) -> None:
        (
            entries.repartition(self._buckets, "digest")
            .write.format("parquet")
            .mode("append")
            .bucketBy(self._buckets, "digest")
            .sortBy("digest")
            .saveAsTable(self._table)
        )
        self._spark.catalog.refreshTable(self._table)

    def compacted(self, folder: str, buckets: int) -> DigestIndex:
        """The same entries as an index in a new folder, with one file per bucket."""
        index = DigestIndex(self._spark, folder, buckets)
        index._write(self.entries())
        return index

    def deduplicate(self, docs: DataFrame, batch: str | None = None) -> DataFrame:
        """Register ``docs`` and tell for each document which one stays.

        Columns: ``doc_id, keep_id, group_size, kept, text_sha256, copies``. ``group_size``
        counts this batch's documents with that text, ``copies`` the repeated rows.
        Of equal texts the smallest ``doc_id`` of the first batch that had one stays.

        A batch that is given again under its name gives the same result again: what it has
        registered itself does not count as seen. So a job that was lost after it registered
        its batch can be repeated. Without a name each call is a batch of its own.
        """
        batch = batch or uuid.uuid4().hex
        digests = stored(
            docs.select(
                F.col("doc_id").cast("long").alias("doc_id"),
                F.unhex(text_digest()).alias("digest"),
            )
            .groupBy("doc_id", "digest")
            .agg(F.count("*").alias("copies")),
            "digests",
        )
        if self._table is None:
            self._make(max(LEAST_BUCKETS, -(-digests.count() // BUCKET_ROWS)))
        # min() passes over nulls, so it is null only where all ids are
        firsts = digests.groupBy("digest").agg(
            F.min("doc_id").alias("keep_id"), F.count("*").alias("group_size")
        )
        seen = self.entries()
        others = seen.where(F.col("batch") != batch).drop("batch")
        old = stored(
            others.join(digests.select("digest").distinct(), "digest", "left_semi"), "seen"
        )
        self.append(firsts.join(seen.hint("merge"), "digest", "left_anti"), batch)

        before = old.select("digest", F.col("keep_id").alias("before_id"), F.lit(True).alias("was"))
        groups = firsts.join(before, "digest", "left")
        keep_id = F.when(F.col("was"), F.col("before_id")).otherwise(F.col("keep_id"))
        groups = groups.select(
            "digest", keep_id.alias("keep_id"), "group_size", F.col("was").isNull().alias("new")
        )
        # stored, so that the join below has nothing but two shuffles and Spark can split
        # the partition of a digest with very many documents
        groups = stored(groups, "digest-groups")
        kept = F.col("new") & F.col("doc_id").eqNullSafe(F.col("keep_id"))
        return digests.join(groups, "digest").select(
            "doc_id",
            "keep_id",
            "group_size",
            kept.alias("kept"),
            F.lower(F.hex("digest")).alias("text_sha256"),
            "copies",
        )


def keep_first(docs: DataFrame, index: DigestIndex, batch: str | None = None) -> DataFrame:
    """``docs`` without the rows whose text the index or an earlier row already has.

    Columns and their order stay. Only rows that come more than once with the same id
    are shuffled whole, to keep one of each.
    """
    decided = index.deduplicate(docs, batch).where("kept")
    id_name = free_name(docs.columns, "kept_id")
    digest_name = free_name([*docs.columns, id_name], "kept_digest")
    keys = decided.select(
        F.col("doc_id").alias(id_name), F.col("text_sha256").alias(digest_name), "copies"
    )
    keyed = docs.withColumn(digest_name, text_digest())

    def rows(chosen: DataFrame) -> DataFrame:
        # by both, so that a text with very many rows is spread by their ids
        chosen = chosen.drop("copies").withColumnRenamed(digest_name, "_" + digest_name)
        same = F.col(digest_name) == F.col("_" + digest_name)
        same &= F.col("doc_id").cast("long").eqNullSafe(F.col(id_name))
        return keyed.join(chosen, same).drop("_" + digest_name)

    once = rows(keys.where("copies = 1")).drop(digest_name, id_name)
    repeated = (
        rows(keys.where("copies > 1"))
        .dropDuplicates([digest_name, id_name])
        .drop(digest_name, id_name)
    )
    return once.select(*docs.columns).unionByName(repeated.select(*docs.columns))
