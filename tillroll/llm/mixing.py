"""Mixing sources to target weights by hierarchical budgeting.

A token budget is propagated down a domain-language-source tree. At each node
the children get shares by weight; a child that cannot use its share (its
subtree's tokens times ``max_epochs``) gets what it can use, and the shortage is
dealt among its siblings by weight again. A node's budget never exceeds what its
subtree can use, so a shortage reaches an ancestor's siblings only after the
siblings below are full. All budgets are integers and add up exactly.

Each leaf then takes the token-prefix of its seeded epochs: whole epochs, and of
the next one the documents in a keyed order of their own until the budget is
met; the last document is cut at the budget. The running count is taken in two
levels (runs of the keyed order, then inside a run), so a leaf with a third of
all rows is no single task. Everything is built-in functions.

Defined results: null text has no tokens; null language or source is a leaf of
its own named ``''``; documents without tokens come with the prefix they stand
in; rows that repeat an id are rows; a leaf without tokens yields nothing; an
empty table gives no rows; other columns are not read.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from tillroll.llm.scratch import Scratch, table

LEVELS = ["domain", "lang", "source"]
#: Documents in a run of a leaf's keyed order, about.
RUN = 2_000
#: Target weights of the query and the pipeline; a child that is not named has weight 1.
WEIGHTS = {
    "domain": {"d0": 4, "d1": 3, "d2": 2, "d3": 1},
    "lang": {"en": 4, "de": 2, "es": 2, "fr": 2},
    "source": {},
}


def counted(docs: DataFrame) -> DataFrame:
    """doc_id, domain, lang, source and n_tokens (words at 0x20 and 0x09-0x0D).

    The tables name no domain: sources are dealt to four by digest."""
    source = F.coalesce(F.col("source").cast("string"), F.lit(""))
    domain = F.concat(F.lit("d"), (F.conv(F.substring(F.md5(source), 1, 2), 16, 10).cast("int") % 4).cast("string"))
    words = F.regexp_count(F.col("text"), F.lit(r"[^\x20\x09-\x0D]+"))
    return docs.select(
        F.col("doc_id").cast("long").alias("doc_id"),
        domain.alias("domain"),
        F.coalesce(F.col("lang").cast("string"), F.lit("")).alias("lang"),
        source.alias("source"),
        F.coalesce(words, F.lit(0)).cast("long").alias("n_tokens"),
    )


def _weight(level: str, weights: dict[str, dict[str, int]]):
    named = weights.get(level) or {}
    if any(not isinstance(w, int) or w < 1 for w in named.values()):
        raise ValueError("weights are positive integers")
    out = F.lit(1)
    for name, w in named.items():
        out = F.when(F.col(level) == name, F.lit(w)).otherwise(out)
    return out.cast("decimal(19,0)")


def _deal(children: DataFrame, parents: list[str], level: str) -> DataFrame:
    """Shares ``b`` (the parent's budget) among children with ``w`` and capacity ``c``; adds ``budget``."""
    node = Window.partitionBy(*parents) if parents else Window.partitionBy(F.lit(0))
    by_need = node.orderBy(F.col("c").cast("double") / F.col("w").cast("double"), level)
    before = F.coalesce(F.sum("c").over(by_need.rowsBetween(Window.unboundedPreceding, -1)), F.lit(0)).cast("decimal(19,0)")
    after = F.sum("w").over(by_need.rowsBetween(0, Window.unboundedFollowing)).cast("decimal(19,0)")
    open_ = F.col("_open")
    return (
        children.withColumn("_open", F.col("c") * after > F.col("w") * (F.col("b") - before).cast("decimal(19,0)"))
        .withColumn("_rest", (F.col("b") - F.coalesce(F.sum(F.when(~open_, F.col("c"))).over(node), F.lit(0))).cast("decimal(19,0)"))
        .withColumn("_weights", F.sum(F.when(open_, F.col("w"))).over(node).cast("decimal(19,0)"))
        .withColumn("_share", F.when(open_, F.expr("(w * _rest) div _weights").cast("decimal(19,0)")))
        .withColumn("_odd", (F.col("_rest") - F.sum("_share").over(node)).cast("decimal(19,0)"))
        .withColumn("_nth", F.sum(F.when(open_, 1).otherwise(0)).over(by_need.rowsBetween(Window.unboundedPreceding, 0)))
        .withColumn(
            "budget",
            F.when(open_, F.col("_share") + F.when(F.col("_nth") <= F.col("_odd"), 1).otherwise(0))
            .otherwise(F.col("c"))
            .cast("decimal(19,0)"),
        )
        .drop("_open", "_rest", "_weights", "_share", "_odd", "_nth", "b")
    )


def budgets(leaves: DataFrame, percent: int, max_epochs: int, weights: dict[str, dict[str, int]]) -> DataFrame:
    """Budget of each leaf (domain, lang, source, n_tokens, docs): ``percent`` % of all tokens in total."""
    sized = leaves.withColumn("c", (F.col("n_tokens") * max_epochs).cast("decimal(19,0)"))
    tree = sized.groupBy("domain").agg(F.sum("c").cast("decimal(19,0)").alias("c"))
    total = sized.agg(
        F.least(F.expr(f"sum(n_tokens) * {int(percent)} div 100"), F.sum("c")).cast("decimal(19,0)").alias("b")
    )
    now = _deal(tree.withColumn("w", _weight("domain", weights)).crossJoin(F.broadcast(total)), [], "domain")
    for depth in (2, 3):
        up, keys = LEVELS[: depth - 1], LEVELS[:depth]
        grain = sized if depth == 3 else sized.groupBy(*keys).agg(F.sum("c").cast("decimal(19,0)").alias("c"))
        given = now.select(*up, F.col("budget").alias("b"))
        now = _deal(grain.withColumn("w", _weight(keys[-1], weights)).join(given, up), up, keys[-1])
    return now


def mixture(
    docs: DataFrame,
    scratch: Scratch,
    percent: int = 80,
    max_epochs: int = 2,
    weights: dict[str, dict[str, int]] = WEIGHTS,
    seed: int = 11,
) -> DataFrame:
    """(doc_id, domain, lang, source, epoch, n_tokens, taken) of the mixture of
    ``docs``; a document has a row for each epoch that takes it."""
    rows = scratch.keep(counted(docs))
    leaves = rows.groupBy(*LEVELS).agg(F.sum("n_tokens").alias("n_tokens"), F.count("*").alias("docs"))
    plan = budgets(leaves, percent, max_epochs, weights).where("n_tokens > 0").select(
        *LEVELS,
        F.expr("budget div n_tokens").cast("int").alias("whole"),
        F.expr("budget % n_tokens").cast("long").alias("rest"),
        F.greatest(F.expr(f"docs div {RUN}"), F.lit(1)).alias("runs"),
    )
    key = F.md5(F.concat_ws(":", F.lit(str(seed)), (F.col("whole") + 1).cast("string"), F.coalesce(F.col("doc_id").cast("string"), F.lit(""))))
    keyed = scratch.keep(
        rows.join(plan, LEVELS)
        .withColumn("_key", key)
        .withColumn("_run", F.shiftright(F.conv(F.substring("_key", 1, 6), 16, 10).cast("long") * F.col("runs"), 24))
    )
    runs = keyed.groupBy(*LEVELS, "_run").agg(F.sum("n_tokens").alias("_sum"))
    before = Window.partitionBy(*LEVELS).orderBy("_run").rowsBetween(Window.unboundedPreceding, -1)
    offsets = runs.select(*LEVELS, "_run", F.coalesce(F.sum("_sum").over(before), F.lit(0)).alias("_offset"))
    inside = Window.partitionBy(*LEVELS, "_run").orderBy("_key", "doc_id", "n_tokens").rowsBetween(Window.unboundedPreceding, -1)
    started = (
        keyed.withColumn("_inside", F.coalesce(F.sum("n_tokens").over(inside), F.lit(0)))
        .join(offsets, [*LEVELS, "_run"])
        .withColumn("_left", F.col("rest") - F.col("_offset") - F.col("_inside"))
        .withColumn("_epochs", F.col("whole") + F.when(F.col("_left") > 0, 1).otherwise(0))
        .where("_epochs > 0")
    )
    return started.select(
        "doc_id", *LEVELS, F.explode(F.sequence(F.lit(1), F.col("_epochs"))).alias("epoch"), "n_tokens", "whole", "_left"
    ).select(
        "doc_id",
        *LEVELS,
        "epoch",
        "n_tokens",
        F.when(F.col("epoch") <= F.col("whole"), F.col("n_tokens")).otherwise(F.least("n_tokens", "_left")).alias("taken"),
    )


def op9_hierarchical_mixing(spark, sf_dir: str, percent: int = 80, max_epochs: int = 2) -> DataFrame:
    """The mixture of all ``documents`` at ``WEIGHTS``: ``percent`` % of their tokens."""
    return mixture(table(spark, sf_dir, "documents"), Scratch(spark, "op9"), percent, max_epochs)


def _level_sql(name: str, source: str, parents: str, key: str) -> str:
    part = f"PARTITION BY {parents} " if parents else ""
    over = f"({part})"
    order = f"({part}ORDER BY c::DOUBLE / w::DOUBLE, {key} "
    return f"""
{name}_1 AS (SELECT *, c * (sum(w) OVER {order}ROWS BETWEEN CURRENT ROW AND UNBOUNDED FOLLOWING))::HUGEINT
    > w * (b - coalesce(sum(c) OVER {order}ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING), 0))::HUGEINT AS o FROM {source}),
{name}_2 AS (SELECT *, (b - coalesce(sum(c) FILTER (WHERE NOT o) OVER {over}, 0))::HUGEINT AS r,
    (sum(w) FILTER (WHERE o) OVER {over})::HUGEINT AS ws,
    sum(CASE WHEN o THEN 1 ELSE 0 END) OVER {order}ROWS BETWEEN UNBOUNDED PRECEDING AND CURRENT ROW) AS nth FROM {name}_1),
{name}_3 AS (SELECT *, CASE WHEN o THEN w * r // ws END AS s FROM {name}_2),
{name} AS (SELECT *, CASE WHEN o THEN s + CASE WHEN nth <= r - sum(s) OVER {over} THEN 1 ELSE 0 END ELSE c END AS budget FROM {name}_3)"""


def _weight_sql(level: str) -> str:
    cases = " ".join(f"WHEN '{k}' THEN {v}" for k, v in WEIGHTS[level].items())
    return f"(CASE {level} {cases} ELSE 1 END)::HUGEINT" if cases else "1::HUGEINT"


#: The same rows in DuckDB.
OP9_SQL = rf"""
WITH d AS (
  SELECT doc_id, 'd' || (('0x' || substr(md5(coalesce(source, '')), 1, 2))::INTEGER % 4) AS domain,
    coalesce(lang, '') AS lang, coalesce(source, '') AS source,
    coalesce(len(regexp_extract_all(text, '[^\x20\x09-\x0D]+')), 0)::BIGINT AS n_tokens FROM documents),
l AS (SELECT domain, lang, source, sum(n_tokens)::HUGEINT AS t, 2 * sum(n_tokens)::HUGEINT AS c FROM d GROUP BY ALL),
x1 AS (SELECT domain, sum(c)::HUGEINT AS c, {_weight_sql("domain")} AS w,
  (SELECT least(sum(t)::HUGEINT * 80 // 100, sum(c))::HUGEINT FROM l) AS b FROM l GROUP BY domain),
{_level_sql("y1", "x1", "", "domain")},
x2 AS (SELECT g.domain, g.lang, g.c, {_weight_sql("lang")} AS w, y1.budget::HUGEINT AS b
  FROM (SELECT domain, lang, sum(c)::HUGEINT AS c FROM l GROUP BY ALL) g JOIN y1 ON y1.domain = g.domain),
{_level_sql("y2", "x2", "domain", "lang")},
x3 AS (SELECT l.domain, l.lang, l.source, l.t, l.c, 1::HUGEINT AS w, y2.budget::HUGEINT AS b
  FROM l JOIN y2 ON y2.domain = l.domain AND y2.lang = l.lang),
{_level_sql("y3", "x3", "domain, lang", "source")},
p AS (SELECT domain, lang, source, (budget // t)::INTEGER AS whole, (budget % t)::BIGINT AS rest FROM y3 WHERE t > 0),
k AS (SELECT d.*, p.whole, p.rest, md5('11:' || (p.whole + 1) || ':' || coalesce(d.doc_id::VARCHAR, '')) AS k
  FROM d JOIN p ON p.domain = d.domain AND p.lang = d.lang AND p.source = d.source),
q AS (SELECT *, rest - coalesce(sum(n_tokens) OVER (PARTITION BY domain, lang, source ORDER BY k, doc_id, n_tokens
  ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING), 0)::BIGINT AS room FROM k),
e AS (SELECT *, unnest(range(1, whole + (CASE WHEN room > 0 THEN 1 ELSE 0 END) + 1))::INTEGER AS epoch FROM q)
SELECT doc_id, domain, lang, source, epoch, n_tokens,
  CASE WHEN epoch <= whole THEN n_tokens ELSE least(n_tokens, room) END::BIGINT AS taken FROM e
"""
