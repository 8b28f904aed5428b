"""A bounded sample of labelled rows for fitting a classifier."""

from __future__ import annotations

import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from harborline.llm.common import stored


def labelled_ids(docs: DataFrame, known: DataFrame) -> DataFrame:
    """``_id, _label, _bytes``: the ids of ``docs`` that ``known`` (``_id, _label``, one row an id) has a label for.

    Only ids and lengths meet the labels. Labels grow with the documents, so they are never broadcast: one plan at every size.
    """
    present = docs.select(F.col("doc_id").cast("long").alias("_id"), F.coalesce(F.octet_length("text"), F.lit(0)).cast("long").alias("_bytes"))
    return stored(present.groupBy("_id").agg(F.max("_bytes").alias("_bytes")).join(known.hint("merge"), "_id"), "labelled")


def bounded_sample(docs: DataFrame, labelled: DataFrame, fit_rows: int, fit_bytes: int) -> DataFrame:
    """``_id, _label, text``: for each label as many ids, in the order of their hashes, as both bounds allow; one text an id."""
    chosen = None
    for label in (0, 1):
        few = labelled.filter((F.col("_label") == label) & (F.col("_bytes") <= fit_bytes)).orderBy(F.xxhash64("_id"), "_id").limit(fit_rows)
        chosen = few if chosen is None else chosen.unionByName(few)
    rows = stored(chosen, "sample").toPandas()  # bounded by the parameter
    rows["_hash"] = pd.util.hash_array(rows["_id"].to_numpy("int64"))
    rows = rows.sort_values(["_label", "_hash", "_id"])
    rows = rows[rows.groupby("_label")["_bytes"].cumsum() <= fit_bytes]
    ids = docs.sparkSession.createDataFrame(list(zip(rows["_id"].tolist(), rows["_label"].tolist())), "_id long, _label int")
    sample = docs.select(F.col("doc_id").cast("long").alias("_id"), "text").join(F.broadcast(ids), "_id")
    return sample.groupBy("_id", "_label").agg(F.min(F.coalesce("text", F.lit(""))).alias("text"))
