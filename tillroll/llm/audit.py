"""Filter interaction audit: what each filter removes in every order of the filters.

Five filters look at whole texts; a row fails any set of them, so a part (a
language) has at most 32 mask cells, each with a count of rows, of good rows and
of toxic rows. Every cell folds once across the broadcast array of all orders:
``transform`` walks the orders, ``aggregate`` applies one order's filters left to
right and carries whether the cell is gone, which gives 600 structs weighted with
the cell's counts. The arrays of a part's cells are merged by elementwise sums.

Only digests move, never texts: rows are counted by (id, digest, ...) before the
join with labels, and copies of a text (however many) are one row a task before
they meet by digest. All of it is built-in functions.

Defined results: null text counts as empty, null language as part ``''``. A row
fails E if a smaller doc_id has the same text; rows with a null doc_id (and rows
that repeat the least id of a text) are in no order and pass E. Rows that repeat
an id count each; labels that repeat an id count as 1 where any row says 1, null
as 0. An empty table has no parts and no rows; other columns are not read.
"""

from __future__ import annotations

from itertools import permutations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from tillroll.llm.scratch import table

#: Least number of words (A), percent of distinct words (B), most percent of
#: capitals (C), characters that may not occur (D).
LEAST_WORDS, DISTINCT_PERCENT, CAPITAL_PERCENT, FORBIDDEN = 200, 50, 3, r"[#$%&*|]"
FILTERS = "ABCDE"
COUNTS = ["kept", "removed", "redundant", "unique_fails", "good_lost", "toxic_lost"]


def marked(docs: DataFrame) -> DataFrame:
    """id, part, digest of the text and the letters of the filters A to D that it fails."""
    whole = docs.select(
        F.col("doc_id").cast("long").alias("id"),
        F.coalesce(F.col("lang").cast("string"), F.lit("")).alias("part"),
        F.coalesce(F.col("text").cast("string"), F.lit("")).alias("text"),
    )
    split = whole.withColumn("words", F.array_remove(F.split("text", r"[\x20\x09-\x0D]+"), ""))
    n_words = F.size("words").cast("long")
    fails = {
        "A": n_words < LEAST_WORDS,
        "B": F.size(F.array_distinct("words")).cast("long") * 100 < n_words * DISTINCT_PERCENT,
        "C": F.regexp_count("text", F.lit("[A-Z]")).cast("long") * 100 > F.char_length("text").cast("long") * CAPITAL_PERCENT,
        "D": F.col("text").rlike(FORBIDDEN),
    }
    letters = F.concat(*(F.when(f, F.lit(x)).otherwise(F.lit("")) for x, f in fails.items()))
    return split.select("id", "part", F.unhex(F.sha2("text", 256)).alias("digest"), letters.alias("fails"))


def cells(docs: DataFrame, labels: DataFrame) -> DataFrame:
    """part, fails (letters of all failed filters) and the rows n, good, toxic of each mask cell."""
    rows = marked(docs).groupBy("id", "digest", "fails", "part").agg(F.count("*").alias("c"))
    said = labels.where("doc_id IS NOT NULL").groupBy(F.col("doc_id").cast("long").alias("id")).agg(
        *(F.max(F.when(F.col(c) == 1, 1).otherwise(0)).alias(name) for c, name in (("quality", "good"), ("toxic", "toxic")))
    )
    unnamed = rows.where("id IS NULL").withColumns({"good": F.lit(None).cast("int"), "toxic": F.lit(None).cast("int")})
    named = rows.where("id IS NOT NULL").join(said, "id", "left").unionByName(unnamed)
    # at most one row for each text, part and label from here on
    texts = named.groupBy("digest", "fails", "part", F.coalesce("good", F.lit(0)).alias("good"), F.coalesce("toxic", F.lit(0)).alias("toxic")).agg(
        F.sum("c").alias("n"),
        F.min(F.when(F.col("id").isNotNull(), F.struct("id", "c"))).alias("first"),
        F.coalesce(F.sum(F.when(F.col("id").isNull(), F.col("c"))), F.lit(0)).alias("unnamed"),
    )
    least = F.min("first.id").over(Window.partitionBy("digest"))
    passed = F.col("unnamed") + F.when(F.col("first.id") == least, F.col("first.c")).otherwise(0)
    both = F.array(
        F.struct(F.col("fails"), F.col("passed").alias("n")),
        F.struct(F.concat("fails", F.lit("E")).alias("fails"), (F.col("n") - F.col("passed")).alias("n")),
    )
    split = texts.withColumn("passed", passed).select("part", "good", "toxic", F.inline(both)).where("n > 0")
    return split.groupBy("part", "fails").agg(
        F.sum("n").alias("n"), F.sum(F.col("n") * F.col("good")).alias("good"), F.sum(F.col("n") * F.col("toxic")).alias("toxic")
    )


def orders(spark, filters: str = FILTERS) -> DataFrame:
    """One row: the array of all orders, each an array of letters."""
    every = F.array(*(F.array(*map(F.lit, p)) for p in permutations(filters)))
    return spark.range(1).select(every.alias("orders"))


def _steps(order: Column) -> Column:
    """The structs of one cell under one order, a struct a step."""
    names = F.concat_ws("", order)
    shape = "array<struct<filter_order:string,step:int,letter:string," + ",".join(f"{c}:bigint" for c in COUNTS) + ">>"

    def count(when: Column, what: str = "n") -> Column:
        return F.when(when, F.col(what)).otherwise(F.lit(0)).cast("bigint")

    def apply(state: Column, letter: Column) -> Column:
        fails, gone = F.contains(F.col("fails"), letter), state["gone"]
        removed = fails & ~gone
        step = F.struct(
            names.alias("filter_order"),
            (F.size(state["steps"]) + 1).alias("step"),
            letter.alias("letter"),
            count(~gone & ~fails).alias("kept"),
            count(removed).alias("removed"),
            count(fails & gone).alias("redundant"),
            count(F.col("fails") == letter).alias("unique_fails"),
            count(removed, "good").alias("good_lost"),
            count(removed, "toxic").alias("toxic_lost"),
        )
        return F.struct((gone | fails).alias("gone"), F.concat(state["steps"], F.array(step)).cast(shape).alias("steps"))

    start = F.struct(F.lit(False).alias("gone"), F.array().cast(shape).alias("steps"))
    return F.aggregate(order, start, apply, lambda state: state["steps"])


def interactions(docs: DataFrame, labels: DataFrame, filters: str = FILTERS) -> DataFrame:
    """part, filter_order, step, the counts of ``COUNTS`` and shapley, for every
    order of ``filters``; zeros included."""
    folded = cells(docs, labels).crossJoin(F.broadcast(orders(docs.sparkSession, filters))).select(
        "part", F.flatten(F.transform("orders", _steps)).alias("steps")
    )

    def add(x: Column, y: Column) -> Column:
        return F.struct(x["filter_order"], x["step"], x["letter"], *((x[c] + y[c]).alias(c) for c in COUNTS))

    merged = folded.groupBy("part").agg(F.collect_list("steps").alias("each")).select(  # 32 arrays a part at most
        "part",
        F.aggregate(F.slice("each", 2, 2 ** len(filters)), F.element_at("each", 1), lambda a, b: F.zip_with(a, b, add)).alias("steps"),
    )
    total = F.transform(
        F.array(*map(F.lit, filters)),
        lambda x: F.aggregate("steps", F.lit(0).cast("bigint"), lambda s, y: s + F.when(y["letter"] == x, y["removed"]).otherwise(0)),
    )
    rows = merged.withColumn("totals", total).select("part", "totals", F.inline("steps"))
    return rows.select(
        "part", "filter_order", "step", *COUNTS, F.element_at("totals", F.instr(F.lit(filters), F.col("letter"))).alias("shapley")
    )


def op11_filter_interaction_audit(spark, sf_dir: str) -> DataFrame:
    """The five filters over all ``documents``, in all 120 orders, for each language."""
    return interactions(table(spark, sf_dir, "documents"), table(spark, sf_dir, "labels"))


#: The same rows in DuckDB.
OP11_SQL = rf"""
WITH d AS (
  SELECT doc_id, coalesce(lang, '') AS part, coalesce(text, '') AS t,
    regexp_extract_all(coalesce(text, ''), '[^\x20\x09-\x0D]+') AS w FROM documents),
f AS (
  SELECT doc_id, part,
    (CASE WHEN len(w) < {LEAST_WORDS} THEN 'A' ELSE '' END)
    || (CASE WHEN 100 * len(list_distinct(w)) < {DISTINCT_PERCENT} * len(w) THEN 'B' ELSE '' END)
    || (CASE WHEN 100 * len(regexp_extract_all(t, '[A-Z]')) > {CAPITAL_PERCENT} * length(t) THEN 'C' ELSE '' END)
    || (CASE WHEN regexp_matches(t, '{FORBIDDEN}') THEN 'D' ELSE '' END)
    || (CASE WHEN doc_id > min(doc_id) OVER (PARTITION BY t) THEN 'E' ELSE '' END) AS fails FROM d),
l AS (SELECT doc_id, max((quality IS NOT DISTINCT FROM 1)::INTEGER) AS good, max((toxic IS NOT DISTINCT FROM 1)::INTEGER) AS toxic
  FROM labels GROUP BY doc_id),
c AS (
  SELECT part, fails, count(*) AS n, sum(coalesce(good, 0)) AS good, sum(coalesce(toxic, 0)) AS toxic
  FROM f LEFT JOIN l ON l.doc_id = f.doc_id GROUP BY part, fails),
x AS (SELECT unnest(['A', 'B', 'C', 'D', 'E']) AS v),
o AS (
  SELECT a.v || b.v || c.v || d.v || e.v AS filter_order FROM x a, x b, x c, x d, x e
  WHERE len(list_distinct([a.v, b.v, c.v, d.v, e.v])) = 5),
s AS (
  SELECT part, filter_order, step, substr(filter_order, step, 1) AS letter, n, good, toxic, fails,
    contains(fails, substr(filter_order, step, 1)) AS fail,
    fails <> '' AND regexp_matches(substr(filter_order, 1, step - 1), '[' || CASE fails WHEN '' THEN '-' ELSE fails END || ']') AS gone
  FROM c, o, (SELECT unnest(range(1, 6))::INTEGER AS step)),
r AS (
  SELECT part, filter_order, step, letter,
    sum(CASE WHEN NOT gone AND NOT fail THEN n ELSE 0 END)::BIGINT AS kept,
    sum(CASE WHEN NOT gone AND fail THEN n ELSE 0 END)::BIGINT AS removed,
    sum(CASE WHEN gone AND fail THEN n ELSE 0 END)::BIGINT AS redundant,
    sum(CASE WHEN fails = letter THEN n ELSE 0 END)::BIGINT AS unique_fails,
    sum(CASE WHEN NOT gone AND fail THEN good ELSE 0 END)::BIGINT AS good_lost,
    sum(CASE WHEN NOT gone AND fail THEN toxic ELSE 0 END)::BIGINT AS toxic_lost
  FROM s GROUP BY ALL)
SELECT part, filter_order, step, kept, removed, redundant, unique_fails, good_lost, toxic_lost,
  (sum(removed) OVER (PARTITION BY part, letter))::BIGINT AS shapley FROM r
"""
