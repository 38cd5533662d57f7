"""Mixing sources to target weights, on DataFrame functions alone.

Leaves are (domain, lang, source).  The budget of tokens goes down the tree:
every node's budget is dealt to its children by weight, no child gets more than
its capacity (tokens of its leaves times ``max_epochs``), and what a child can't
take goes to its siblings first; only what all of them together can't take is
left to the node's own siblings, as a node's capacity is its children's.
Budgets are whole tokens, rounded down at every node.

A leaf's stream is its documents in a seeded order (md5 of seed, epoch and id),
epoch after epoch; the leaf takes the prefix that fills its budget, the last
document in part.  The order inside an epoch is only needed at the boundary:
documents are dealt to buckets by hash, about ``BUCKET`` documents each, whole
buckets before the boundary are taken as sums, and only the boundary bucket is
sorted.  So a leaf of any size is never in one task (rows that share one id share a bucket).

Tokens are runs of characters other than white space.  Edge cases: null text
has no tokens and null keys are the name ``''``; documents without tokens are
never selected; names without a weight get ``default``; a weight of 0 selects
nothing; repeated rows are rows of their own (ties by id and length, equal rows
are interchangeable); an empty table gives an empty result; other columns are
ignored.
"""

from __future__ import annotations

from dataclasses import dataclass, field

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from tallyframe.llm.common import materialize

BUCKET = 512
TOKEN = r"[^\x20\x09-\x0D]+"


@dataclass(frozen=True)
class Mix:
    """Whole-number weights by name at each level; budget as a share of the corpus' tokens, in percent."""

    domain: dict = field(default_factory=lambda: {"web": 60, "curated": 40})
    lang: dict = field(default_factory=lambda: {"en": 40, "de": 20, "fr": 20, "es": 20})
    source: dict = field(default_factory=dict)
    default: int = 10
    budget_percent: int = 80
    max_epochs: int = 4
    seed: int = 17


def domain_of_source(source: Column) -> Column:
    """Domain of the test corpus: sources with a one-digit number are 'web', others 'curated'."""
    return F.when(source.rlike("^src[0-9]$"), F.lit("web")).otherwise(F.lit("curated"))


def _weight(names: dict, default: int, col: str) -> Column:
    if not names:
        return F.lit(default).cast("long")
    return F.coalesce(*[F.when(F.col(col) == k, F.lit(v)) for k, v in names.items()], F.lit(default)).cast("long")


def deal(children: DataFrame, parent: list[str], order: str) -> DataFrame:
    """Adds ``budget`` to children (w, cap, parent_budget): water filling within each parent."""
    w = Window.partitionBy(*parent) if parent else Window.partitionBy(F.lit(0))
    ranked = w.orderBy("ratio", order)
    before, after = ranked.rowsBetween(Window.unboundedPreceding, -1), ranked.rowsBetween(0, Window.unboundedFollowing)
    out = (children.where("w > 0")
           .withColumn("ratio", F.col("cap") / F.col("w"))
           .withColumn("b", F.least("parent_budget", F.sum("cap").over(w)))
           .withColumn("level", (F.col("b") - F.coalesce(F.sum("cap").over(before), F.lit(0))) / F.sum("w").over(after))
           .withColumn("lambda", F.max(F.when(F.col("ratio") > F.col("level"), F.col("level"))).over(w)))
    return (out.withColumn("budget", F.when(F.col("ratio") <= F.col("level"), F.col("cap"))
                           .otherwise(F.floor(F.col("lambda") * F.col("w"))).cast("long"))
            .drop("ratio", "b", "level", "lambda", "parent_budget", "w", "cap"))


def leaf_budgets(leaves: DataFrame, mix: Mix) -> DataFrame:
    """leaves: domain, lang, source, tokens, docs -> the same with ``budget``."""
    cap = leaves.withColumn("cap", F.col("tokens") * mix.max_epochs)
    total = leaves.agg(F.floor(F.sum("tokens") * mix.budget_percent / 100).cast("long"))
    domains = (cap.groupBy("domain").agg(F.sum("cap").alias("cap"))
               .withColumn("parent_budget", total.scalar())
               .withColumn("w", _weight(mix.domain, mix.default, "domain")))
    domains = deal(domains, [], "domain").withColumnRenamed("budget", "parent_budget")
    langs = (cap.groupBy("domain", "lang").agg(F.sum("cap").alias("cap")).join(domains, "domain")
             .withColumn("w", _weight(mix.lang, mix.default, "lang")))
    langs = deal(langs, ["domain"], "lang").withColumnRenamed("budget", "parent_budget")
    leaf = cap.join(langs, ["domain", "lang"]).withColumn("w", _weight(mix.source, mix.default, "source"))
    return deal(leaf, ["domain", "lang"], "source")


def select(docs: DataFrame, mix: Mix = Mix(), domain: Column | None = None) -> DataFrame:
    """domain, lang, source, doc_id, epoch, n_tokens, take_tokens: one row per document and epoch."""
    leaf = ["domain", "lang", "source"]
    slim = materialize(
        docs.select((domain_of_source(F.coalesce("source", F.lit(""))) if domain is None else domain).alias("domain"),
                    F.coalesce("lang", F.lit("")).alias("lang"), F.coalesce("source", F.lit("")).alias("source"),
                    "doc_id", F.regexp_count(F.coalesce("text", F.lit("")), F.lit(TOKEN)).cast("long").alias("n_tokens"))
        .where("n_tokens > 0"), "mix")
    leaves = materialize(
        leaf_budgets(slim.groupBy(*leaf).agg(F.sum("n_tokens").alias("tokens"), F.count(F.lit(1)).alias("docs")), mix)
        .withColumn("full", F.expr("budget div tokens")).withColumn("rest", F.expr("budget % tokens")), "mix-leaves")
    rows = slim.join(leaves, leaf)
    whole = (rows.where("full > 0").select(*leaf, "doc_id", "n_tokens", F.explode(F.expr("sequence(0, full - 1)")).alias("epoch"))
             .withColumn("take_tokens", F.col("n_tokens")))
    keyed = (rows.where("rest > 0")
             .withColumn("epoch", F.col("full"))
             .withColumn("h", F.md5(F.concat_ws(":", F.lit(str(mix.seed)), F.col("epoch").cast("string"),
                                                F.coalesce(F.col("doc_id").cast("string"), F.lit("")))))
             .withColumn("bucket", F.expr(f"conv(substr(h, 1, 8), 16, 10) * ceil(docs / {BUCKET}) div 4294967296")))
    sums = keyed.groupBy(*leaf, "bucket", "rest").agg(F.sum("n_tokens").alias("size"))
    start = Window.partitionBy(*leaf).orderBy("bucket").rowsBetween(Window.unboundedPreceding, -1)
    sums = (sums.withColumn("start", F.coalesce(F.sum("size").over(start), F.lit(0)))
            .where("start < rest").select(*leaf, "bucket", "start", "size"))
    near = keyed.join(sums, [*leaf, "bucket"])
    cols = [*leaf, "doc_id", "n_tokens", "epoch"]
    inside = near.where("start + size <= rest").select(*cols, F.col("n_tokens").alias("take_tokens"))
    edge = Window.partitionBy(*leaf, "bucket").orderBy("h", "doc_id", "n_tokens").rowsBetween(Window.unboundedPreceding, -1)
    cut = (near.where("start + size > rest")
           .withColumn("before", F.col("start") + F.coalesce(F.sum("n_tokens").over(edge), F.lit(0)))
           .where("before < rest")
           .select(*cols, F.least("n_tokens", F.col("rest") - F.col("before")).alias("take_tokens")))
    out = [*leaf, "doc_id", "epoch", "n_tokens", "take_tokens"]
    return whole.select(out).union(inside.select(out)).union(cut.select(out))


def _case(names: dict, default: int, col: str) -> str:
    whens = " ".join(f"WHEN {col} = '{k}' THEN {v}" for k, v in names.items())
    return f"CASE {whens} ELSE {default} END" if whens else str(default)


def oracle(mix: Mix = Mix(), documents: str = "documents") -> str:
    """DuckDB SQL for ``select`` (one window per leaf, no buckets)."""
    def level(name: str, source: str, keys: list[str], parent: list[str], w: str) -> str:
        part = f"PARTITION BY {', '.join(parent)}" if parent else ""
        return f"""
{name}_a AS (SELECT *, {w} AS w, cap / ({w}) AS ratio FROM {source}),
{name}_b AS (SELECT *, (least(pb, sum(cap) OVER ({part}))
    - coalesce(sum(cap) OVER ({part} ORDER BY ratio, {keys[-1]} ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING), 0))::DOUBLE
    / sum(w) OVER ({part} ORDER BY ratio, {keys[-1]} ROWS BETWEEN CURRENT ROW AND UNBOUNDED FOLLOWING) AS lev FROM {name}_a),
{name}_c AS (SELECT *, max(CASE WHEN ratio > lev THEN lev END) OVER ({part}) AS lam FROM {name}_b),
{name} AS (SELECT {', '.join(keys)}, (CASE WHEN ratio <= lev THEN cap ELSE floor(lam * w) END)::BIGINT AS budget FROM {name}_c)"""

    return f"""
WITH slim AS (
  SELECT CASE WHEN regexp_matches(coalesce(source, ''), '^src[0-9]$') THEN 'web' ELSE 'curated' END AS domain,
    coalesce(lang, '') AS lang, coalesce(source, '') AS source, doc_id,
    len(regexp_extract_all(coalesce(text, ''), '[^ \\t\\n\\x0B\\f\\r]+'))::BIGINT AS n_tokens
  FROM {documents}),
rws AS (SELECT * FROM slim WHERE n_tokens > 0),
leaf AS (SELECT domain, lang, source, sum(n_tokens)::BIGINT AS tokens, (sum(n_tokens) * {mix.max_epochs})::BIGINT AS cap FROM rws GROUP BY ALL),
dom_in AS (SELECT domain, sum(cap)::BIGINT AS cap, (SELECT floor(sum(tokens) * {mix.budget_percent} / 100)::BIGINT FROM leaf) AS pb FROM leaf GROUP BY 1),
{level('dom', 'dom_in', ['domain'], [], _case(mix.domain, mix.default, 'domain'))},
lang_in AS (SELECT l.domain, l.lang, sum(l.cap)::BIGINT AS cap, any_value(d.budget) AS pb FROM leaf l JOIN dom d USING (domain) GROUP BY 1, 2),
{level('lng', 'lang_in', ['domain', 'lang'], ['domain'], _case(mix.lang, mix.default, 'lang'))},
src_in AS (SELECT l.*, g.budget AS pb FROM leaf l JOIN lng g USING (domain, lang)),
{level('src', 'src_in', ['domain', 'lang', 'source'], ['domain', 'lang'], _case(mix.source, mix.default, 'source'))},
bud AS (SELECT l.domain, l.lang, l.source, s.budget // l.tokens AS full_n, s.budget % l.tokens AS rest
  FROM leaf l JOIN src s USING (domain, lang, source)),
j AS (SELECT r.*, b.full_n, b.rest, md5(concat_ws(':', '{mix.seed}', b.full_n::VARCHAR, coalesce(r.doc_id::VARCHAR, ''))) AS h
  FROM rws r JOIN bud b USING (domain, lang, source)),
part AS (SELECT *, coalesce(sum(n_tokens) OVER (PARTITION BY domain, lang, source ORDER BY h, doc_id NULLS FIRST, n_tokens
  ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING), 0)::BIGINT AS before FROM j WHERE rest > 0)
SELECT domain, lang, source, doc_id, epoch::BIGINT AS epoch, n_tokens, n_tokens AS take_tokens
FROM (SELECT *, unnest(range(full_n)) AS epoch FROM j WHERE full_n > 0)
UNION ALL
SELECT domain, lang, source, doc_id, full_n::BIGINT, n_tokens, least(n_tokens, rest - before)::BIGINT FROM part WHERE before < rest
"""


def op2(docs: DataFrame) -> DataFrame:
    return select(docs)
