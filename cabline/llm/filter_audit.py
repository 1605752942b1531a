"""Filter interaction audit over failing-id relations.

``judge`` reads the texts once and stores, per filter, a table of the ids of rows that
fail it.  Rows get an id of their own, in a table written once, since doc_ids may be
null or repeated.  From then on no text is read:

- the survivors of a prefix (a *set* of filters: its order doesn't change them) are the
  survivors of the prefix without its last letter, LEFT ANTI the last one's id table;
- what filter f removes after prefix P is the survivors of P LEFT SEMI f's id table, with
  the labels of these rows;
- what f finds gone already is the rest of its id table.

The 2 ** k prefixes of one size are joined at once, on (filter, id), so there are two joins
a size.  Survivors and id tables are partitioned by the id alone, which every join keeps:
the rows are dealt once.  Only counts leave the joins.  An order's step looks its (prefix, filter) up.

``duplicates`` (E) compares 128-bit hashes of whole texts with the smallest doc_id that has the
text; the smallest is a combinable minimum, and both it and the labels are joined with
salted keys, so that one text or id with a third of the rows is split.  No join of rows is
by broadcast at any size.

Cases: a null text is empty; a null doc_id is no smaller or larger id (such rows are
neither copies nor originals) and has no labels; rows that repeat an id are rows of
their own, with the same labels; a null part is the empty string; repeated label rows
count once, and one of several decides good or toxic; an empty table gives no rows.
"""

from __future__ import annotations

from collections.abc import Iterator
from itertools import combinations, permutations
from math import factorial

import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from cabline.llm._common import cut, setting

#: letter -> percent or count of its condition; E is a comparison of texts
MIN_WORDS, MIN_DISTINCT, MAX_CAPITALS = 100, 80, 10
SYMBOLS = b"#$%&*|"
FILTERS = "ABCDE"
SALTS = 16

_CAPITALS = bytes(range(0x41, 0x5B))
_CONTINUATION = bytes(range(0x80, 0xC0))


def failed_letters(text: bytes) -> str:
    """The letters A to D of the conditions that a text fails."""
    words = text.split()
    out = "A" if len(words) < MIN_WORDS else ""
    if 100 * len(set(words)) < MIN_DISTINCT * len(words):
        out += "B"
    points = len(text) - (0 if text.isascii() else
                          len(text) - len(text.translate(None, _CONTINUATION)))
    if 100 * (len(text) - len(text.translate(None, _CAPITALS))) > MAX_CAPITALS * points:
        out += "C"
    if len(text) != len(text.translate(None, SYMBOLS)):
        out += "D"
    return out


def judge(docs: DataFrame, id_col: str, text_col: str, part_col: str) -> DataFrame:
    """(id, doc_id, part, hash, failed): a row each, of the whole texts."""
    rows = docs.select(F.col(id_col).cast("long").alias("doc_id"),
                       F.coalesce(F.col(part_col).cast("string"), F.lit("")).alias("part"),
                       F.coalesce(F.col(text_col).cast("string").cast("binary"),
                                  F.lit(b"")).alias("text"))

    def facts(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        import xxhash

        for b in batches:
            texts = b.column("text").to_pylist()
            yield pa.RecordBatch.from_arrays(
                [b.column("doc_id"), b.column("part"),
                 pa.array([xxhash.xxh3_128_digest(x) for x in texts], pa.binary()),
                 pa.array([failed_letters(x) for x in texts], pa.string())],
                ["doc_id", "part", "hash", "failed"])

    judged = rows.mapInArrow(facts, "doc_id long, part string, hash binary, failed string")
    return cut(judged.withColumn("id", F.monotonically_increasing_id()), "audit-rows")


def salted_join(rows: DataFrame, few: DataFrame, key: str, salts: int = SALTS) -> DataFrame:
    """Inner join on ``key``, whose rows are dealt by ``pmod(id, salts)`` too.

    Both sides grow with the input, and Spark's estimate of the copies counts neither the
    salts nor what a compressed table grows to: they never travel by the driver."""
    copies = few.withColumn("__salt", F.explode(F.sequence(F.lit(0), F.lit(salts - 1))))
    return rows.withColumn("__salt", F.pmod("id", F.lit(salts)).cast("int")).join(
        copies.hint("merge"), [key, "__salt"]).drop("__salt")


def failing_ids(judged: DataFrame, letter: str) -> DataFrame:
    """(id) of the rows that fail the filter of a letter."""
    if letter != "E":
        return judged.where(F.instr("failed", letter) > 0).select("id")
    first = (judged.where("doc_id is not null").groupBy("hash")
             .agg(F.min("doc_id").alias("first"), F.max("doc_id").alias("last"))
             .where("last > first").select("hash", "first"))
    return salted_join(judged, first, "hash").where("doc_id > first").select("id")


def label_ids(judged: DataFrame, labels: DataFrame, id_col: str) -> DataFrame:
    """(id, good, toxic) of the rows whose labels say one of them."""
    of = (labels.select(F.col(id_col).cast("long").alias("doc_id"),
                        F.coalesce(F.col("quality") == 1, F.lit(False)).alias("good"),
                        F.coalesce(F.col("toxic") == 1, F.lit(False)).alias("toxic"))
          .where("doc_id is not null").groupBy("doc_id")
          .agg(F.max("good").alias("good"), F.max("toxic").alias("toxic")).where("good or toxic"))
    return salted_join(judged.select("id", "doc_id"), of, "doc_id").select("id", "good", "toxic")


def _next_letters(prefix, letters: str, larger: bool):
    """Array column of the letters that may follow a prefix (sorted letters)."""
    after = F.lit(True) if larger else F.lit(False)
    return F.array_compact(F.array(*[
        F.when((F.instr(prefix, x) == 0) & (~after | (F.substring(prefix, -1, 1) < x)), F.lit(x))
        for x in letters]))


def removals(rows: DataFrame, failing: DataFrame, letters: str) -> DataFrame:
    """(part, prefix, filter, removed, good_lost, toxic_lost) for every prefix (a set, as
    sorted letters) and every other filter; combinations that remove nothing are missing.

    ``rows(id, part, good, toxic)``, ``failing(filter, id)``."""
    spark = rows.sparkSession
    # all joins are on (filter, id) of rows dealt by id: equal pairs lie in one partition
    with setting(spark, "spark.sql.requireAllClusterKeysForCoPartition", "false"):
        parts = int(spark.conf.get("spark.sql.shuffle.partitions"))
        survivors = rows.repartition(parts, "id").withColumn("prefix", F.lit(""))
        failing = failing.repartition(parts, "id")
        found = []
        for size in range(len(letters)):
            if size:
                ways = survivors.withColumn("filter", F.explode(
                    _next_letters(F.col("prefix"), letters, larger=True)))
                survivors = (ways.join(failing.hint("merge"), ["filter", "id"], "left_anti")
                             .select("id", "part", "good", "toxic",
                                     F.concat("prefix", "filter").alias("prefix")))
            ways = survivors.withColumn("filter", F.explode(
                _next_letters(F.col("prefix"), letters, larger=False)))
            removed = ways.join(failing.hint("merge"), ["filter", "id"], "left_semi")
            found.append(removed.groupBy("part", "prefix", "filter").agg(
                F.count("*").alias("removed"), F.count_if("good").alias("good_lost"),
                F.count_if("toxic").alias("toxic_lost")))
        out = found[0]
        for more in found[1:]:
            out = out.unionByName(more)
        return cut(out, "audit-removals")


def step_table(letters: str) -> list[tuple[str, int, str, str]]:
    """(filter_order, step, filter, prefix as sorted letters) of every order."""
    return [("".join(o), i + 1, x, "".join(sorted(o[:i])))
            for o in permutations(letters) for i, x in enumerate(o)]


def audit(docs: DataFrame, labels: DataFrame, id_col: str = "doc_id", text_col: str = "text",
          part_col: str = "lang", label_id_col: str = "doc_id",
          letters: str = FILTERS) -> DataFrame:
    """Per part, filter order and step: kept, removed, redundant, unique_fails, good_lost,
    toxic_lost and shapley (long)."""
    spark = docs.sparkSession
    judged = judge(docs, id_col, text_col, part_col)
    tables = {x: cut(failing_ids(judged, x), f"audit-failing-{x}") for x in letters}
    marked = cut(label_ids(judged, labels, label_id_col), "audit-labels")
    rows = judged.select("id", "part").join(marked.hint("merge"), "id", "left").select(
        "id", "part", F.coalesce("good", F.lit(False)).alias("good"),
        F.coalesce("toxic", F.lit(False)).alias("toxic"))
    failing = None
    for x, ids in tables.items():
        ids = ids.select(F.lit(x).alias("filter"), "id")
        failing = ids if failing is None else failing.unionByName(ids)
    removed = removals(rows, failing, letters)

    # from here on as many rows as parts, times 80 at most; zeros are filled in
    sizes = judged.groupBy("part").agg(F.count("*").alias("rows"))
    n = len(letters)
    every = [("".join(p), x) for x in letters for k in range(n)
             for p in combinations([y for y in letters if y != x], k)]
    weight = F.create_map(*[v for k in range(n) for v in (F.lit(k), F.lit(
        factorial(k) * factorial(n - 1 - k)))])
    grid = sizes.select("*", F.inline(F.array(*[
        F.struct(F.lit(p).alias("prefix"), F.lit(x).alias("filter")) for p, x in every])))
    cells = grid.join(removed, ["part", "prefix", "filter"], "left").na.fill(
        0, ["removed", "good_lost", "toxic_lost"])
    of = cells.groupBy("part", "filter").agg(
        F.sum(F.when(F.col("prefix") == "", F.col("removed"))).alias("fails"),
        F.sum(F.when(F.length("prefix") == n - 1, F.col("removed"))).alias("unique_fails"),
        F.sum(F.col("removed") * weight[F.length("prefix")]).alias("shapley"))
    cells = cells.join(of, ["part", "filter"])
    steps = spark.createDataFrame(step_table(letters),
                                  "filter_order string, step int, filter string, prefix string")
    placed = cells.join(F.broadcast(steps), ["prefix", "filter"])
    # an order's survivors: those of its part less what its steps so far removed, n rows each
    so_far = placed.groupBy("part", "filter_order", "rows").agg(F.array_sort(F.collect_list(
        F.struct("step", "removed", "fails", "unique_fails", "good_lost", "toxic_lost",
                 "shapley"))).alias("steps"))
    before = F.aggregate(F.slice("steps", F.lit(1), F.col("x.step")), F.lit(0).cast("long"),
                         lambda total, s: total + s["removed"])
    return so_far.select("*", F.explode("steps").alias("x")).select(
        "part", "filter_order", "x.step", (F.col("rows") - before).alias("kept"), "x.removed",
        (F.col("x.fails") - F.col("x.removed")).alias("redundant"), "x.unique_fails",
        "x.good_lost", "x.toxic_lost", "x.shapley")
