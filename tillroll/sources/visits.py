"""A scan log stored by visit, so that what groups or joins by visit moves no rows."""

from __future__ import annotations

import uuid

from pyspark.sql import DataFrame

from tillroll.session import new_folder


def stored_by_visit(scans: DataFrame, buckets: int | None = None, folder: str | None = None) -> DataFrame:
    """The scan log from a table bucketed and sorted by visit.

    It is shuffled once, when it is written, a file per bucket. Sums per visit, splits by visit and
    joins of tables made of it then read bucket by bucket, without an exchange, and so do two
    stored logs with as many buckets. By default these are as many as the session's shuffle
    partitions; take more for a larger log, as a bucket is read by one task. ``folder`` is one that
    all executors share, by default beside what is checkpointed, and the table is dropped with it.
    """
    spark = scans.sparkSession
    buckets = buckets or int(spark.conf.get("spark.sql.shuffle.partitions"))
    name = f"visits_{uuid.uuid4().hex}"
    dealt = scans.repartition(buckets, "visit_number")
    writer = dealt.write.bucketBy(buckets, "visit_number").sortBy("visit_number")
    writer.option("path", folder or new_folder(spark)).saveAsTable(name)
    return spark.table(name)
