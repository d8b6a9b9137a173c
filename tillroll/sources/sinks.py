"""Writing itemsets, labels, ids, and the feature matrix in sparse and dense form."""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from tillroll.operators.itemsets import itemset_lines


def write_itemsets(itemsets: DataFrame, path: str) -> None:
    """Text lines at ``path``; the frequencies are only in the table form."""
    itemset_lines(itemsets).write.mode("overwrite").text(path)


def write_columns(rows: DataFrame, path: str) -> None:
    """Plain CSV with a header, for labels, ids and the feature dictionary."""
    rows.write.mode("overwrite").option("header", True).csv(path)


def write_sparse(rows: DataFrame, path: str) -> None:
    """Parquet with ``indices`` and ``values`` per visit."""
    rows.write.mode("overwrite").parquet(path)


def dense_lines(sparse: DataFrame, width: int) -> DataFrame:
    """``sparse`` with a ``line``: all ``width`` values as comma-separated text.

    Each entry brings the zeros before it, so a line costs its entries, not its width,
    and no plan has thousands of columns.
    """

    def entry(index, position):
        previous = F.when(position > 0, F.try_element_at("indices", position)).otherwise(-1)
        zeros = F.repeat(F.lit("0,"), (index - previous - 1).cast("int"))
        return F.concat(zeros, F.element_at("values", position + 1).cast("string"), F.lit(","))

    last = F.coalesce(F.try_element_at("indices", F.lit(-1)), F.lit(-1))
    tail = F.repeat(F.lit("0,"), (F.lit(width - 1) - last).cast("int"))
    text = F.concat(F.array_join(F.transform("indices", entry), ""), tail)
    return sparse.withColumn("line", F.rtrim(text, F.lit(",")))


#: Columns a dense file may have: its header is one line that the driver holds.
MAX_WIDTH = 100_000


def column_names(dictionary: DataFrame) -> DataFrame:
    """(idx, name): the features by name; one that several families have with its family's number."""
    alone = F.count("*").over(Window.partitionBy("feature")) == 1
    qualified = F.concat("feature", F.lit(" ("), F.col("family").cast("string"), F.lit(")"))
    return dictionary.select("idx", F.when(alone, F.col("feature")).otherwise(qualified).alias("name"))


def write_dense(sparse: DataFrame, dictionary: DataFrame, path: str, max_width: int = MAX_WIDTH) -> None:
    """Gzipped CSV of the full rows, with the dictionary as its header in every file.

    The rows keep their order; the visit number is not written. A dictionary beyond
    ``max_width`` fails before anything is written.
    """
    width = dictionary.count()
    if width > max_width:
        raise ValueError(f"{width} columns; write the sparse form or raise max_width")
    name = F.col("name")
    quoted = F.when(
        name.rlike('[,"]'), F.concat(F.lit('"'), F.replace(name, F.lit('"'), F.lit('""')), F.lit('"'))
    ).otherwise(name)
    names = F.sort_array(F.collect_list(F.struct("idx", quoted.alias("name"))))
    header = column_names(dictionary).agg(F.array_join(names["name"], ",")).first()[0]
    lines = dense_lines(sparse, width).select("line").toDF(header)
    # One ready-made column: nothing in it is to be quoted or escaped again.
    plain = {"header": True, "sep": "\u0001", "quote": "\u0000", "escapeQuotes": False}
    lines.write.mode("overwrite").options(compression="gzip", **plain).csv(path)
