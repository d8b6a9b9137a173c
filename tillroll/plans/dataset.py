"""From two scan logs to training and test sets on disk."""

from __future__ import annotations

import json
from collections.abc import Sequence
from dataclasses import dataclass

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tillroll.constants import IGNORED_TRIP_TYPES, MIN_SUPPORT, N_CLUSTERS, SAMPLE_VISITS, TOP_UPCS
from tillroll.operators import features, itemsets, matrix, minibatch, split, vocabulary
from tillroll.session import checkpoint, prepare, scoped
from tillroll.sources import scanlog, sinks


def build(
    train: DataFrame,
    test: DataFrame,
    out: str,
    categories: DataFrame,
    ignored: Sequence[int] = IGNORED_TRIP_TYPES,
    min_support: float = MIN_SUPPORT,
    top_upcs: int = TOP_UPCS,
    n_clusters: int = N_CLUSTERS,
    seed: int = 0,
    departments: Sequence[str] | None = None,
    upcs: DataFrame | None = None,
    dictionary: DataFrame | None = None,
) -> Fitted:
    """Fit on ``train`` what is not given, and write features of both logs under ``out``.

    ``out`` is a folder all executors share. UPCs, itemsets, departments of the vectors and
    clusters come from the training log. The dictionary holds the departments and
    finelines of both logs, unless a frozen one is given: then other features are left out.
    Written are

    - ``visit_features``, ``itemset_table``, ``train_matrix``, ``test_matrix``: Parquet,
    - ``itemsets``: text lines,
    - ``features``, ``labels``, ``test_ids``: CSV,
    - ``train``, ``test``: dense gzipped CSV in the order of ``labels`` and ``test_ids``,
    - ``fitted``: what was fitted, see :meth:`Fitted.load`, and returned from there, for
      :func:`apply` on later logs, also of other sessions.

    Whatever else is materialised on the way is removed at the end, also of a failure.
    """
    spark = prepare(train.sparkSession)
    with scoped(spark):
        both = scanlog.union_inputs(train, test)
        upcs = checkpoint(vocabulary.top_terms(train, "upc", top_upcs) if upcs is None else upcs)

        features.visit_features(both, categories, upcs).write.mode("overwrite").parquet(f"{out}/visit_features")
        base = spark.read.parquet(f"{out}/visit_features")

        mined = itemsets.mine(itemsets.transactions(train, ignored), min_support)
        mined.write.mode("overwrite").parquet(f"{out}/itemset_table")
        sets = spark.read.parquet(f"{out}/itemset_table")
        sinks.write_itemsets(sets, f"{out}/itemsets")

        departments = vocabulary.column_terms(train, "department") if departments is None else list(departments)
        points = minibatch.department_entries(features.purchases(train), departments)
        centres = minibatch.train(points, len(departments), n_clusters, seed)

        if dictionary is None:
            summed = F.col("family").isin(features.RETURNED, features.PURCHASED, features.FINELINE)
            occurring = base.where(summed).select("family", "feature").distinct()
            terms = vocabulary.feature_terms(occurring, categories, upcs, features.FITTED_FEATURES)
            dictionary = vocabulary.feature_dictionary(terms)
        dictionary = checkpoint(dictionary)
        sinks.write_columns(dictionary.orderBy("idx"), f"{out}/features")

        Fitted(categories, upcs, sets, departments, centres, dictionary).save(f"{out}/fitted")
        fitted = Fitted.load(spark, f"{out}/fitted")
        matrix_of_both = checkpoint(apply(both, fitted))
        labelled = matrix_of_both.join(features.extract_labels(train), "visit_number")
        rows = _write_part(split.shuffled(labelled, seed), dictionary, f"{out}/train")
        sinks.write_columns(rows.select("visit_number", "trip_type"), f"{out}/labels")
        rows = _write_part(split.of_visits(matrix_of_both, test).orderBy("visit_number"), dictionary, f"{out}/test")
        sinks.write_columns(rows.select("visit_number"), f"{out}/test_ids")
    return fitted


#: Of the saved form of a fit; one of another version is not read.
VERSION = 1

_TABLES = {
    "categories": "department string, category string",
    "upcs": "upc bigint",
    "itemsets": "trip_type int, items array<string>, freq bigint",
    "centres": "cluster int, centre array<bigint>, n bigint",
    "dictionary": "idx bigint, family int, feature string",
}


@dataclass(frozen=True)
class Fitted:
    """Everything a later log needs to get the columns of the first one."""

    categories: DataFrame
    upcs: DataFrame
    itemsets: DataFrame
    departments: Sequence[str]
    centres: DataFrame
    dictionary: DataFrame

    def save(self, folder: str) -> None:
        """Write the tables as Parquet, and last what they are, so a broken save is not read."""
        spark = self.dictionary.sparkSession
        for name, schema in _TABLES.items():
            columns = [field.split(" ")[0] for field in schema.split(", ")]
            getattr(self, name).select(*columns).write.mode("overwrite").parquet(f"{folder}/{name}")
        places = [(n, name) for n, name in enumerate(self.departments)]
        named = spark.createDataFrame(places, "place int, department string")
        named.write.mode("overwrite").parquet(f"{folder}/departments")
        said = json.dumps({"version": VERSION, "tables": _TABLES, "departments": len(places)})
        spark.createDataFrame([(said,)], "value string").coalesce(1).write.mode("overwrite").text(f"{folder}/about")

    @staticmethod
    def load(spark: SparkSession, folder: str) -> Fitted:
        """A saved fit, in any session. Another version, or tables that are not as saved, are an error."""
        about = json.loads(spark.read.text(f"{folder}/about").first()[0])
        if about["version"] != VERSION:
            raise ValueError(f"a fit of version {about['version']}, not {VERSION}")
        tables = {name: spark.read.parquet(f"{folder}/{name}") for name in _TABLES}
        for name, schema in _TABLES.items():
            held = ", ".join(f"{column} {kind}" for column, kind in tables[name].dtypes)
            if held != schema or about["tables"][name] != schema:
                raise ValueError(f"{name} has {held}, not {schema}")
        named = spark.read.parquet(f"{folder}/departments").orderBy("place").collect()
        if len(named) != about["departments"]:
            raise ValueError(f"{len(named)} departments, not {about['departments']}")
        return Fitted(departments=[r.department for r in named], **tables)


def apply(log: DataFrame, fitted: Fitted) -> DataFrame:
    """(visit_number, indices, values) of a log over what was fitted before; nothing is refitted."""
    log = scanlog.with_label(log)
    purchases = checkpoint(features.purchases(log))
    item_sets = itemsets.match(purchases, fitted.itemsets)
    points = minibatch.department_entries(purchases, fitted.departments)
    assigned = minibatch.nearest(points, fitted.centres)
    encoded = matrix.encoding(fitted.dictionary, fitted.categories)
    return matrix.matrix_rows(
        log,
        encoded,
        (item_sets, "item_set", features.ITEM_SET),
        (assigned, "cluster", features.DEPT_CATEGORY),
    )


def run(spark: SparkSession, source: str, out: str, categories: DataFrame, mini: bool = False, **settings) -> Fitted:
    """From ``source``/train.csv and test.csv to the files of :func:`build`.

    ``mini`` takes the first SAMPLE_VISITS visits of each log, for development.
    """
    logs = [scanlog.read_scans(spark, f"{source}/{part}.csv") for part in ("train", "test")]
    if mini:
        logs = [scanlog.sample_visits(log, SAMPLE_VISITS) for log in logs]
    return build(*logs, out, categories, **settings)


def _write_part(rows: DataFrame, dictionary: DataFrame, path: str) -> DataFrame:
    # Sorted once: all forms are written from the materialised order.
    ordered = checkpoint(rows)
    sinks.write_sparse(ordered, f"{path}_matrix")
    sinks.write_dense(ordered, dictionary, path)
    return ordered
