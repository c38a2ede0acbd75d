"""Mixing sources to target weights by hierarchical budgets, with DataFrame functions only."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from .common import materialise, read_table, release

#: The tree of the registered query: domain -> (weight, sources of the table by number); sources elsewhere fall under OTHER.
DOMAINS = (("web", 4, 0, 4), ("books", 3, 5, 9), ("code", 2, 10, 14), ("forum", 1, 15, 19))
OTHER = ("other", 1)
LANGUAGES = (("en", 4), ("de", 2), ("fr", 2), ("es", 2))
#: Weight of a language or source that is not listed.
UNLISTED = 1
#: Share of the supply that is asked for, as a fraction, and how often a document may be used.
SHARE, EPOCHS = (1, 2), 4
SEED = "mix-1"
NONE = "(none)"
LEAF = ("domain", "lang", "source")
#: A table of at most so many leaves is broadcast; a larger one is joined by shuffling.
BROADCAST_LEAVES = 50_000


def count_tokens(text: Column) -> Column:
    """Words set apart by ASCII white space; a null text has none."""
    return F.coalesce(F.size(F.regexp_extract_all(text, F.lit(r"[^\x20\x09-\x0D]+"), F.lit(0))), F.lit(0)).cast("long")


def _domain(source: Column) -> Column:
    number = F.regexp_extract(source, "^src([0-9]{1,6})$", 1).try_cast("int")
    out = F.lit(OTHER[0])
    for name, _, low, high in DOMAINS:
        out = F.when(number.between(low, high), name).otherwise(out)
    return out


def _weight(column: Column, weights: tuple, rest: int) -> Column:
    out = F.lit(rest)
    for name, w in weights:
        out = F.when(column == name, w).otherwise(out)
    return out.cast("long")


def with_leaf(docs: DataFrame, lang_col: str = "lang", source_col: str = "source") -> DataFrame:
    """Add domain, lang and source of the tree (replacing columns of those names); nulls become '(none)'."""
    lang, source = F.coalesce(F.col(lang_col), F.lit(NONE)), F.coalesce(F.col(source_col), F.lit(NONE))
    return docs.withColumns({"lang": lang, "source": source, "domain": _domain(source)})


def share_out(children: DataFrame, parent: list[str], name: str) -> DataFrame:
    """Divide each parent's `budget` among its children by weight `w` up to their capacity `cap`, adding `part`.

    What one child can't take goes to its siblings in proportion to their weights: in the order of
    cap / w a child is full if its share of what is left covers its capacity. Whole numbers throughout;
    cap and budget are decimals, as their products with sums of weights pass the range of longs.
    """
    order = Window.partitionBy(*parent).orderBy(F.col("cap").cast("double") / F.col("w"), name)
    whole = Window.partitionBy(*parent)
    before = F.coalesce(F.sum("cap").over(order.rowsBetween(Window.unboundedPreceding, -1)), F.lit(0))
    rest = F.sum("w").over(order.rowsBetween(0, Window.unboundedFollowing))
    out = children.where("w > 0").withColumns({"before": before, "rest": rest})
    out = out.withColumn("full", F.expr("cap * rest <= w * greatest(budget - before, 0)"))
    out = out.withColumns({"taken": F.sum(F.when(F.col("full"), F.col("cap")).otherwise(0)).over(whole), "open": F.sum(F.when(F.col("full"), 0).otherwise(F.col("w"))).over(whole)})
    return out.withColumn("part", F.expr("CASE WHEN full THEN cap ELSE CAST(w * greatest(budget - taken, 0) DIV open AS decimal(38, 0)) END")).drop("before", "rest", "full", "taken", "open")


def leaf_budgets(supply: DataFrame, share: tuple[int, int] = SHARE, epochs: int = EPOCHS) -> DataFrame:
    """From the tokens of each leaf (domain, lang, source, supply) its `part` of the whole budget.

    Weights are propagated from the root; a node's capacity is that of the leaves below it, so a
    shortage is filled by siblings first and passes to the parent's siblings only if they are full.
    """
    leaves = supply.withColumn("cap", F.col("supply").cast("decimal(28, 0)") * epochs)
    langs = leaves.groupBy("domain", "lang").agg(F.sum("cap").alias("cap"))
    domains = langs.groupBy("domain").agg(F.sum("cap").alias("cap")).withColumn("w", _weight(F.col("domain"), tuple(d[:2] for d in DOMAINS), OTHER[1]))
    budget = F.expr(f"CAST(CAST(sum(cap) OVER (PARTITION BY 0) DIV {epochs} AS decimal(28, 0)) * {share[0]} DIV {share[1]} AS decimal(38, 0))")
    domains = share_out(domains.withColumn("root", F.lit(0)).withColumn("budget", budget), ["root"], "domain").select("domain", F.col("part").alias("budget"))
    langs = langs.join(domains, "domain").withColumn("w", _weight(F.col("lang"), LANGUAGES, UNLISTED))
    langs = share_out(langs, ["domain"], "lang").select("domain", "lang", F.col("part").alias("budget"))
    leaves = leaves.join(langs, ["domain", "lang"]).withColumn("w", F.lit(UNLISTED).cast("long"))
    return share_out(leaves, ["domain", "lang"], "source").select(*LEAF, "supply", "part")


def _small(leaves: DataFrame) -> DataFrame:
    return F.broadcast(leaves) if leaves.count() <= BROADCAST_LEAVES else leaves


def _key(seed: str) -> Column:
    return F.md5(F.concat_ws(":", F.lit(seed), F.col("_full").cast("string"), F.coalesce(F.col("doc_id").cast("string"), F.lit(""))).cast("binary"))


def mixing_plan(slim: DataFrame, share: tuple[int, int] = SHARE, epochs: int = EPOCHS, seed: str = SEED) -> DataFrame:
    """One row per leaf: how many full epochs it gives, and up to which bucket and token of the next one.

    slim has doc_id, domain, lang, source and n_tokens of every document. The documents of the last
    epoch are ordered by a seeded hash; its first three digits make 4,096 buckets whose sums are
    gathered by leaf, so no leaf is ever sorted in one task.
    """
    supply = slim.groupBy(*LEAF).agg(F.sum("n_tokens").alias("supply")).where("supply > 0")
    leaves = materialise(leaf_budgets(supply, share, epochs).select(*LEAF, F.expr("part DIV supply").alias("_full"), F.expr("CAST(part % supply AS bigint)").alias("_rest")), "leaves")
    keyed = slim.join(_small(leaves.where("_rest > 0")), list(LEAF)).withColumn("_bucket", F.substring(_key(seed), 1, 3))
    sums = keyed.groupBy(*LEAF, "_rest", "_bucket").agg(F.sum("n_tokens").alias("n"))
    upto = Window.partitionBy(*LEAF).orderBy("_bucket").rowsBetween(Window.unboundedPreceding, -1)
    last = sums.withColumn("_before", F.coalesce(F.sum("n").over(upto), F.lit(0))).where("_before < _rest").groupBy(*LEAF).agg(F.max("_bucket").alias("_last"), F.max("_before").alias("_before"))
    out = materialise(leaves.join(last, list(LEAF), "left"), "mixing")
    release(leaves)
    return out


def select_mixed(docs: DataFrame, plan: DataFrame, seed: str = SEED, n_tokens: Column | None = None) -> DataFrame:
    """The rows of docs (with doc_id, domain, lang, source) once for each epoch they are used in, with n_tokens, epoch and take_tokens.

    n_tokens counts the tokens of a row, by default it is the column of that name; only rows that are
    used are counted. One pass gives the full epochs and the buckets before a leaf's last one, a second
    the last buckets alone, ordered by leaf.
    """
    n_tokens = F.col("n_tokens") if n_tokens is None else n_tokens
    kept = [*(c for c in docs.columns if c != "n_tokens"), "n_tokens", "epoch", "take_tokens"]
    bucket = F.substring(_key(seed), 1, 3)
    joined = docs.join(_small(plan), list(LEAF))
    uses = F.col("_full") + F.when((F.col("_rest") > 0) & (bucket < F.col("_last")), 1).otherwise(0)
    whole = joined.withColumn("_full", uses).where("_full > 0").withColumn("n_tokens", n_tokens).where("n_tokens > 0")
    whole = whole.withColumn("epoch", F.explode(F.expr("sequence(0L, _full - 1)"))).withColumn("take_tokens", F.col("n_tokens"))
    order = Window.partitionBy(*LEAF).orderBy("_key", "doc_id", "n_tokens").rowsBetween(Window.unboundedPreceding, -1)
    edge = joined.where((F.col("_rest") > 0) & (bucket == F.col("_last"))).withColumns({"_key": _key(seed), "n_tokens": n_tokens})
    edge = edge.withColumn("_had", F.col("_before") + F.coalesce(F.sum("n_tokens").over(order), F.lit(0)))
    edge = edge.withColumns({"epoch": F.col("_full"), "take_tokens": F.least(F.col("n_tokens"), F.col("_rest") - F.col("_had"))})
    return whole.select(*kept).unionAll(edge.where("take_tokens > 0").select(*kept))


def mix(docs: DataFrame, share: tuple[int, int] = SHARE, epochs: int = EPOCHS, seed: str = SEED, text_col: str = "text") -> DataFrame:
    """All columns of docs for each use of a document, with domain, n_tokens, epoch and take_tokens.

    Each leaf of the domain-language-source tree gives the first `part` tokens of its seeded epochs:
    full epochs, then a prefix of the next one whose last document may be taken in part (take_tokens).
    Documents without tokens are never drawn, so null and empty texts go; null languages and sources
    form leaves of their own; a null doc_id is ordered as ''. Repeated rows count as separate
    documents. An empty table gives no rows. Columns called domain, n_tokens, epoch or take_tokens
    are replaced; others keep their names, apart from _full, _rest, _last, _before, _key, _bucket and _had.
    """
    docs = with_leaf(docs.drop("domain", "n_tokens", "epoch", "take_tokens"))
    slim = materialise(docs.select("doc_id", *LEAF, count_tokens(F.col(text_col)).alias("n_tokens")), "slim")
    plan = mixing_plan(slim, share, epochs, seed)
    release(slim)
    return select_mixed(docs, plan, seed, count_tokens(F.col(text_col)))


def op2_mixing(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = with_leaf(read_table(spark, sf_dir, "documents").withColumn("n_tokens", count_tokens(F.col("text"))))
    slim = materialise(docs.select("doc_id", *LEAF, "n_tokens"), "slim")
    return select_mixed(slim, mixing_plan(slim))


def oracle(documents: str = "documents", columns: str = "doc_id, domain, lang, source, n_tokens, epoch, take_tokens") -> str:
    """DuckDB SQL of mix() over a table with the columns of documents, with the default parameters."""
    number = "try_cast(regexp_extract(source, '^src([0-9]{1,6})$', 1) AS INTEGER)"
    domain = "CASE " + " ".join(f"WHEN {number} BETWEEN {low} AND {high} THEN '{name}'" for name, _, low, high in DOMAINS) + f" ELSE '{OTHER[0]}' END"
    weight = lambda c, ws, rest: "CASE " + " ".join(f"WHEN {c} = '{n}' THEN {w}" for n, w in ws) + f" ELSE {rest} END"

    def shared(source: str, parent: str, name: str) -> str:
        order = f"PARTITION BY {parent} ORDER BY cap / w, {name}"
        return f"""(SELECT *, CASE WHEN cap * rest_w <= w * greatest(budget - before, 0) THEN cap ELSE w * greatest(budget - taken, 0) // open END AS part FROM (
  SELECT *, sum(CASE WHEN cap * rest_w <= w * greatest(budget - before, 0) THEN cap ELSE 0 END) OVER (PARTITION BY {parent}) AS taken,
    sum(CASE WHEN cap * rest_w <= w * greatest(budget - before, 0) THEN 0 ELSE w END) OVER (PARTITION BY {parent}) AS open FROM (
    SELECT *, coalesce(sum(cap) OVER ({order} ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING), 0) AS before,
      sum(w) OVER ({order} ROWS BETWEEN CURRENT ROW AND UNBOUNDED FOLLOWING) AS rest_w FROM {source})))"""

    key = f"md5(concat_ws(':', '{SEED}', l.fulls::VARCHAR, coalesce(d.doc_id::VARCHAR, '')))"
    return f"""
WITH d AS (SELECT * REPLACE (coalesce(lang, '{NONE}') AS lang, coalesce(source, '{NONE}') AS source), {domain} AS domain,
    coalesce(len(regexp_extract_all(text, '[^\\x20\\x09-\\x0D]+')), 0) AS n_tokens FROM {documents}),
leaf AS (SELECT domain, lang, source, sum(n_tokens) AS supply, sum(n_tokens) * {EPOCHS} AS cap, {UNLISTED} AS w FROM d GROUP BY ALL HAVING sum(n_tokens) > 0),
lang0 AS (SELECT domain, lang, sum(cap) AS cap, {weight('lang', LANGUAGES, UNLISTED)} AS w FROM leaf GROUP BY domain, lang),
dom0 AS (SELECT domain, sum(cap) AS cap, {weight('domain', tuple(x[:2] for x in DOMAINS), OTHER[1])} AS w FROM lang0 GROUP BY domain),
dom1 AS (SELECT *, 0 AS root, sum(cap) OVER () // {EPOCHS} * {SHARE[0]} // {SHARE[1]} AS budget FROM dom0),
dom2 AS (SELECT domain, part AS budget FROM {shared('dom1', 'root', 'domain')}),
lang1 AS (SELECT * FROM lang0 JOIN dom2 USING (domain)),
lang2 AS (SELECT domain, lang, part AS budget FROM {shared('lang1', 'domain', 'lang')}),
leaf1 AS (SELECT * FROM leaf JOIN lang2 USING (domain, lang)),
leaf2 AS (SELECT domain, lang, source, (part // supply)::BIGINT AS fulls, (part % supply)::BIGINT AS rest FROM {shared('leaf1', 'domain, lang', 'source')}),
used AS (SELECT d.*, l.fulls, l.rest, coalesce(sum(n_tokens) OVER (PARTITION BY d.domain, d.lang, d.source ORDER BY {key}, doc_id, n_tokens ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING), 0) AS had
  FROM d JOIN leaf2 l USING (domain, lang, source)),
rows AS (SELECT *, unnest(range(fulls)) AS epoch, n_tokens AS take_tokens FROM used UNION ALL
  SELECT *, fulls AS epoch, least(n_tokens, rest - had)::BIGINT AS take_tokens FROM used WHERE had < rest)
SELECT {columns} FROM rows WHERE take_tokens > 0"""
