"""Labels: the held-out fold and a bounded training sample."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

FOLDS = 5
LONGEST = 1 << 16  # bytes of a text that a training sample may hold


def held_out(doc_id="doc_id") -> F.Column:
    """True for the fold that no model learns from: crc32 of the id as text divisible by five."""
    return F.coalesce(F.crc32(F.col(doc_id).cast("string").cast("binary")) % FOLDS == 0, F.lit(False))


def label_sample(docs: DataFrame, labels: DataFrame, label: str, per_class: int,
                 id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """``(doc_id, text bytes, y)`` of at most ``per_class`` labelled documents of either class outside
    the held-out fold, chosen by a hash of the id (the same at every run), without texts over ``LONGEST``
    bytes. Null labels take no part; of contradicting rows the larger label counts. Of several texts under
    one id the one of smallest hash stands for it, so the bound holds for rows."""
    known = (labels.select(F.col(id_col).cast("long").alias("doc_id"), F.col(label).cast("int").alias("y"))
             .where(F.col("doc_id").isNotNull() & F.col("y").isin(0, 1) & ~held_out())
             .groupBy("doc_id").agg(F.max("y").alias("y")))
    order = [F.xxhash64("doc_id"), "doc_id"]
    chosen = [r for y in (0, 1) for r in known.where(F.col("y") == y).orderBy(*order).limit(per_class).collect()]
    ids = docs.sparkSession.createDataFrame(chosen, "doc_id long, y int")
    text = docs.select(F.col(id_col).cast("long").alias("doc_id"),
                       F.coalesce(F.col(text_col).cast("binary"), F.lit(b"")).alias("text"))
    text = text.where(F.octet_length("text") <= LONGEST)
    found = text.join(F.broadcast(ids), "doc_id")  # at most 2 x per_class ids
    first = F.min(F.struct(F.xxhash64("text").alias("h"), "text")).alias("first")  # combined map-side: a hot id is a row a task
    return found.groupBy("doc_id", "y").agg(first).select("doc_id", "first.text", "y")
