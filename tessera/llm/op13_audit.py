"""Filter interaction audit: what every filter removes in every order, and its Shapley share.

1. Every document becomes a mask of the filters it fails. The filters on its
   own text are column expressions. Being a copy needs no join back to the
   text: rows of equal text meet as (text digest, part, labels) subgroups
   holding their rows, their smallest id and the rows at that id, so all rows
   but those at the text's smallest id are copies.
2. Documents are counted by (part, mask, labels): at most 32 x 4 rows a part.
3. The 32 coalitions of filters are tabulated: v(S) documents fail some filter
   of S. A filter's step in an order is a difference of two coalitions.
4. The Shapley share of a filter is the efficiency-constrained least-squares
   fit to v under the Shapley kernel; its normal equations are solved in
   rationals once, as the solution is linear in v, and the shares over all
   orders come out whole.

Defined results: a null text is empty, a null part is the empty string (one
part with empty strings); a row with a null id is no copy and has none; of
repeated rows of one id and text none is a copy of the other; an id with
several label rows is good (toxic) when one of them says so, null labels say
nothing; a long text is one row like any other; an empty table gives no rows;
columns other than id, text, part and the labels are not read.
"""

from __future__ import annotations

from collections.abc import Callable, Iterable, Iterator
from fractions import Fraction
from itertools import permutations
from math import comb, factorial

import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from .common import sorted_runs, table

SPACE = r"[\x20\x09-\x0D]+"
UPPER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ"
FILTERS = "ABCDE"


def text_failures(text: F.Column) -> dict[str, F.Column]:
    """The failure conditions that a document's own text decides, by filter letter."""
    words = F.array_remove(F.split(text, SPACE), "")
    n_words, n_distinct = F.size(words), F.size(F.array_distinct(words))
    n_chars = F.char_length(text)
    upper = n_chars - F.char_length(F.translate(text, UPPER, ""))
    return {"A": n_words < 200,
            "B": 100 * n_distinct.cast("long") < 50 * n_words.cast("long"),
            "C": 100 * upper.cast("long") > 3 * n_chars.cast("long"),
            "D": text.rlike(r"[#$%&*|]")}


def failure_counts(docs: DataFrame, labels: DataFrame, part_col: str = "lang", id_col: str = "doc_id", text_col: str = "text",
                   failures: Callable[[F.Column], dict[str, F.Column]] = text_failures) -> DataFrame:
    """``(part, mask, good, toxic, n)``: documents by the filters they fail (bit k: the k-th; the last bit: a copy of a smaller id)."""
    text = F.coalesce(F.col(text_col).cast("string"), F.lit(""))
    known = (labels.where(F.col(id_col).isNotNull()).groupBy(F.col(id_col).cast("long").alias("id"))
             .agg(F.coalesce(F.max(F.col("quality") == 1), F.lit(False)).alias("good"),
                  F.coalesce(F.max(F.col("toxic") == 1), F.lit(False)).alias("bad")))
    own = list(failures(F.col("text")).values())
    rows = (docs.select(F.col(id_col).cast("long").alias("id"), text.alias("text"),
                        F.coalesce(F.col(part_col).cast("string"), F.lit("")).alias("part"))
            .select("id", "part", F.unhex(F.sha2("text", 256)).alias("digest"),
                    sum((F.when(c, 1 << k).otherwise(0) for k, c in enumerate(own)), F.lit(0)).alias("mask"))
            .join(known, "id", "left").fillna(False, ["good", "bad"]))
    rows = rows.groupBy("digest", "part", "mask", "good", "bad", "id").agg(F.count("*").alias("n"))
    # A text's rows meet as few subgroups, so a text that a third of all rows share is no hot key here.
    sub = rows.groupBy("digest", "part", "mask", "good", "bad").agg(
        F.sum("n").alias("n"), F.coalesce(F.sum(F.when(F.col("id").isNull(), F.col("n"))), F.lit(0)).alias("no_id"),
        F.min(F.when(F.col("id").isNotNull(), F.struct("id", "n"))).alias("first"))
    least = sub.groupBy("digest").agg(
        F.min("first.id").alias("least"),
        F.collect_list(F.struct("part", "mask", "good", "bad", "n", "no_id", "first")).alias("subs"))
    each = least.select("least", F.explode("subs").alias("s")).select("least", "s.*")
    unique = F.col("no_id") + F.when(F.col("first.id") == F.col("least"), F.col("first.n")).otherwise(0)
    copy = 1 << len(own)
    kinds = F.array(F.struct(F.col("mask"), unique.alias("n")),
                    F.struct((F.col("mask") + copy).alias("mask"), (F.col("n") - unique).alias("n")))
    return (each.select("part", "good", F.col("bad").alias("toxic"), F.explode(kinds).alias("k"))
            .where("k.n > 0").groupBy("part", F.col("k.mask").alias("mask"), "good", "toxic").agg(F.sum("k.n").alias("n")))


def solve(a: list[list[Fraction]], b: list[list[Fraction]]) -> list[list[Fraction]]:
    """``x`` with ``a x = b`` (``b`` of any width), by elimination in rationals."""
    rows = [[*x, *y] for x, y in zip(a, b)]
    for i in range(len(rows)):
        p = next(r for r in range(i, len(rows)) if rows[r][i])
        rows[i], rows[p] = rows[p], rows[i]
        rows[i] = [x / rows[i][i] for x in rows[i]]
        for r in range(len(rows)):
            if r != i and rows[r][i]:
                f = rows[r][i]
                rows[r] = [x - f * y for x, y in zip(rows[r], rows[i])]
    return [r[len(a):] for r in rows]


def shapley_matrix(m: int) -> list[list[Fraction]]:
    """Share of each of ``m`` players as a linear form of the values of the ``2**m`` coalitions.

    Least squares over the proper coalitions S with weight (m - 1) / (C(m, |S|) |S| (m - |S|)), under the
    constraint that the shares add up to v(all) - v(none); one multiplier takes the constraint.
    """
    size = 1 << m
    zero = Fraction(0)
    normal = [[zero] * (m + 1) for _ in range(m + 1)]
    right = [[zero] * size for _ in range(m + 1)]
    for s in range(1, size - 1):
        k = s.bit_count()
        w = Fraction(m - 1, comb(m, k) * k * (m - k))
        inside = [i for i in range(m) if s >> i & 1]
        for i in inside:
            right[i][s] += w
            right[i][0] -= w  # the fit is to v(S) - v(none)
            for j in inside:
                normal[i][j] += w
    for i in range(m):
        normal[i][m] = normal[m][i] = Fraction(1)
    right[m][size - 1] += 1
    right[m][0] -= 1
    return solve(normal, right)[:m]


def coalition_values(counts: dict[int, int], m: int) -> list[int]:
    """v(S) for every S: documents that fail some filter of S."""
    return [sum(n for mask, n in counts.items() if mask & s) for s in range(1 << m)]


def audit_rows(counts: list[tuple[int, bool, bool, int]], filters: str, shares: list[list[Fraction]]) -> list[tuple]:
    """``(filter_order, step, kept, removed, redundant, unique_fails, good_lost, toxic_lost, shapley)`` of one part."""
    m = len(filters)
    tables = []
    for chosen in (lambda g, t: True, lambda g, t: g, lambda g, t: t):
        by_mask: dict[int, int] = {}
        for mask, good, toxic, n in counts:
            if chosen(good, toxic):
                by_mask[mask] = by_mask.get(mask, 0) + n
        tables.append(coalition_values(by_mask, m))
    v, good, toxic = tables
    total, everyone = sum(c[3] for c in counts), (1 << m) - 1
    shapley = []
    for share in shares:
        over_orders = factorial(m) * sum(c * x for c, x in zip(share, v))
        assert over_orders.denominator == 1
        shapley.append(int(over_orders))
    out = []
    for order in permutations(range(m)):
        before = 0
        for step, f in enumerate(order, 1):
            after = before | 1 << f
            removed = v[after] - v[before]
            out.append(("".join(filters[i] for i in order), step, total - v[after], removed, v[1 << f] - removed,
                        v[everyone] - v[everyone & ~(1 << f)], good[after] - good[before], toxic[after] - toxic[before], shapley[f]))
            before = after
    return out


AUDIT = ("part string, filter_order string, step int, kept long, removed long, redundant long, unique_fails long, "
         "good_lost long, toxic_lost long, shapley long")


def filter_audit(counts: DataFrame, filters: str = FILTERS) -> DataFrame:
    """The audit of every part from its ``failure_counts``: one row per order and step."""
    from pyspark.sql.pandas.types import to_arrow_schema
    from pyspark.sql.types import _parse_datatype_string

    schema = to_arrow_schema(_parse_datatype_string(AUDIT))
    shares = shapley_matrix(len(filters))

    def run(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for rows in sorted_runs(batches, "part"):  # whole parts, each of at most 2 ** filters x 4 rows
            parts: dict[str, list] = {}
            for r in rows.to_pylist():
                parts.setdefault(r["part"], []).append((r["mask"], r["good"], r["toxic"], r["n"]))
            for part, own in parts.items():
                cols = list(zip(*audit_rows(own, filters, shares)))
                yield pa.RecordBatch.from_arrays(
                    [pa.array([part] * len(cols[0]), pa.string()), *(pa.array(c, f.type) for c, f in zip(cols, list(schema)[1:]))],
                    schema=schema)

    return counts.repartition("part").sortWithinPartitions("part").mapInArrow(run, AUDIT)


def op13_filter_audit(spark: SparkSession, sf_dir: str) -> DataFrame:
    return filter_audit(failure_counts(table(spark, sf_dir, "documents"), table(spark, sf_dir, "labels")))


ORACLE = r"""
WITH lab AS (SELECT doc_id, coalesce(bool_or(quality = 1), false) AS good, coalesce(bool_or(toxic = 1), false) AS bad
             FROM labels WHERE doc_id IS NOT NULL GROUP BY doc_id),
d AS (SELECT doc_id, coalesce(text, '') AS t, coalesce(lang, '') AS part FROM documents),
w AS (SELECT doc_id, part, t, regexp_extract_all(t, '[^\x20\x09-\x0D]+') AS ws, min(doc_id) OVER (PARTITION BY t) AS least FROM d),
x AS (SELECT w.part, coalesce(lab.good, false) AS good, coalesce(lab.bad, false) AS bad,
             (len(ws) < 200)::INT + 2 * (100 * len(list_distinct(ws)) < 50 * len(ws))::INT
             + 4 * (100 * length(regexp_replace(t, '[^A-Z]', '', 'g')) > 3 * length(t))::INT
             + 8 * regexp_matches(t, '[#$%&*|]')::INT + 16 * coalesce(w.doc_id > least, false)::INT AS mask
      FROM w LEFT JOIN lab USING (doc_id)),
c AS (SELECT part, mask, good, bad, count(*) AS n FROM x GROUP BY ALL),
f AS (SELECT unnest(['A', 'B', 'C', 'D', 'E']) AS l, unnest([1, 2, 4, 8, 16]) AS b),
o AS (SELECT a.l || b.l || c.l || d.l || e.l AS filter_order, [a.b, b.b, c.b, d.b, e.b] AS bits
      FROM f a, f b, f c, f d, f e WHERE (a.b | b.b | c.b | d.b | e.b) = 31),
s AS (SELECT filter_order, step, bits[step] AS own, list_sum(bits[1:step])::INT AS upto FROM o, range(1, 6) r(step)),
g AS (SELECT part, filter_order, step, own,
             sum(n) FILTER (mask & upto = 0) AS kept,
             sum(n) FILTER (mask & own > 0 AND mask & (upto - own) = 0) AS removed,
             sum(n) FILTER (mask & own > 0 AND mask & (upto - own) > 0) AS redundant,
             sum(n) FILTER (mask = own) AS unique_fails,
             sum(n) FILTER (mask & own > 0 AND mask & (upto - own) = 0 AND good) AS good_lost,
             sum(n) FILTER (mask & own > 0 AND mask & (upto - own) = 0 AND bad) AS toxic_lost
      FROM s, c GROUP BY ALL)
SELECT part, filter_order, step::INT AS step, coalesce(kept, 0)::BIGINT AS kept, coalesce(removed, 0)::BIGINT AS removed,
       coalesce(redundant, 0)::BIGINT AS redundant, coalesce(unique_fails, 0)::BIGINT AS unique_fails,
       coalesce(good_lost, 0)::BIGINT AS good_lost, coalesce(toxic_lost, 0)::BIGINT AS toxic_lost,
       sum(coalesce(removed, 0)) OVER (PARTITION BY part, own)::BIGINT AS shapley
FROM g
"""
