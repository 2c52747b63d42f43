"""URL filters: fixed host and path rules, and association rules mined from labels.

Tokens frequent enough with bad labels are kept first; those that are rules by
themselves are done. Combinations of the others grow token by token from
projected baskets, the conditional baskets of FP-growth: what a basket holds
after a prefix is all that the prefix can grow by. A prefix grows only while it
is frequent with bad labels and no rule yet, and to ``max_tokens`` at most.
(Spark's own FP-growth has no bound on the length: a bad directory of k segments
that often stand together makes it list 2^k combinations.) Rules pruned by
support and confidence are matched through an inverted index from token to
rule. Everything is DataFrame expressions.
"""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from larder.llm.common import materialise, pick, spread_join

# Verdict, host, path.
RULES = (("block", "net", "/"), ("allow", "example.net", "/en/"), ("block", "example.com", "/de/"), ("allow", "org", "/fr/"))


@dataclass(frozen=True)
class UrlParams:
    """``rules``: (verdict, host, path), a short list; ``support``: least share
    of labelled URLs that hold a rule's tokens and a bad label; ``confidence``:
    least share of bad ones among those with its tokens; ``max_tokens``: tokens
    of a rule; ``train_rows``: bound on the labelled ids whose URLs are mined;
    ``rows_per_id``: URLs of one id among them.

    Every host label, path segment and query part is a token. What bounds the
    rules is pruning: a token of a rule is frequent with bad labels by itself,
    one that is a rule alone needs no other, and tokens that always stand
    together are mined as one."""
    rules: tuple = RULES
    support: float = 0.01
    confidence: float = 0.9
    max_tokens: int = 3
    train_rows: int = 20000
    rows_per_id: int = 4
    seed: int = 7


def host_path(url: Column) -> tuple:
    """(host, path) of a URL; both empty for a null or one without ``://``."""
    at = F.instr(url, "://")
    rest = F.when(at > 0, url.substr(at + 3, F.length(url))).otherwise("")
    host = F.translate(F.regexp_extract(rest, r"^[^/?#]*", 0), "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz")
    return host, F.regexp_extract(rest, r"^[^/?#]*([^?#]*)", 1)


def url_tokens(url: Column, host: Column, path: Column) -> Column:
    """Distinct tokens: scheme, every host label by place, every path segment,
    file ending, every query key, alone and with its value, and a fragment
    mark. Digits become #."""
    labels = F.transform(F.reverse(F.split(host, r"\.")), lambda x, i: F.when(x != "", F.concat(F.lit("h"), (i + 1).cast("string"), F.lit("="), x)))
    segments = F.transform(F.split(path, "/"), lambda x: F.when(x != "", F.concat(F.lit("p:"), x)))
    query = F.split(F.regexp_extract(url, r"^[^?#]*\?([^#]*)", 1), "&")
    keys = F.transform(query, lambda x: F.when(x != "", F.concat(F.lit("q:"), F.substring_index(x, "=", 1))))
    values = F.transform(query, lambda x: F.when(x.contains("="), F.concat(F.lit("v:"), x)))
    ending = F.regexp_extract(path, r"\.([A-Za-z0-9]{1,5})$", 1)
    named = F.array(
        F.concat(F.lit("s:"), F.lower(F.substring_index(url, "://", 1))),
        F.when(ending != "", F.concat(F.lit("e:"), ending)),
        F.when(url.contains("#"), F.lit("f:")))
    plain = F.transform(F.concat(named, segments, keys, values), lambda x: F.regexp_replace(x, "[0-9]+", "#"))
    hosts = F.transform(labels, lambda x: F.concat(F.regexp_extract(x, "^h[0-9]+=", 0), F.regexp_replace(
        F.regexp_replace(x, "^h[0-9]+=", ""), "[0-9]+", "#")))
    return F.when(host == "", F.array().cast("array<string>")).otherwise(
        F.array_distinct(F.filter(F.concat(plain, hosts), lambda x: x.isNotNull())))


def fixed_rule(host: Column, path: Column, rules) -> tuple:
    """(rule, verdict) of the longest rule that fits, or nulls."""
    rule = verdict = None
    for kind, h, start in sorted(rules, key=lambda r: -len(r[1] + r[2])):
        fits = ((host == h) | host.endswith("." + h)) & path.startswith(start)
        name = F.lit(h + start)
        rule = F.when(fits, name) if rule is None else rule.when(fits, name)
        verdict = F.when(fits, F.lit(kind)) if verdict is None else verdict.when(fits, F.lit(kind))
    none = F.lit(None).cast("string")
    return (none, none) if rule is None else (rule, verdict)


def mine_rules(labelled: DataFrame, p: UrlParams) -> DataFrame:
    """``rule_id, slot, token, needs`` from ``labelled (tokens, bad)``, whose rows
    the caller bounds: a URL meets a rule with a token for each of its ``needs``
    slots. Of two rules of which one holds the other only the shorter is kept;
    both block the same URLs."""
    spark = labelled.sparkSession
    empty = "rule_id string, slot string, token string, needs int"
    rows = labelled.filter(F.size("tokens") > 0).withColumn("row", F.monotonically_increasing_id())
    rows = materialise(rows, "url-baskets")
    n = rows.count()
    least = p.support * n
    if not n:
        return spark.createDataFrame([], empty)
    each = rows.select("row", "bad", F.explode("tokens").alias("token"))
    seen = lambda k: F.sum(F.xxhash64("row", F.lit(k)).cast("decimal(38,0)"))
    single = each.groupBy("token").agg(F.count(F.lit(1)).alias("all"), F.sum(F.col("bad").cast("long")).alias("bad"),
                                       seen(1).alias("x"), seen(2).alias("y")).filter((F.col("bad") >= least) & (F.col("bad") > 0))
    single = materialise(single, "url-tokens")
    sure = F.col("bad") >= p.confidence * F.col("all")
    alone = single.filter(sure).select(F.col("token").alias("rule_id"), F.col("token").alias("slot"), "token", F.lit(1).alias("needs"))
    # Tokens of the same rows stand for each other; one in every row tells nothing.
    group = single.filter(~sure & (F.col("all") < n)).withColumn("slot", F.min("token").over(Window.partitionBy("all", "x", "y")))
    group = materialise(group.select("slot", "token"), "url-groups")
    kept = each.join(group, "token").groupBy("row", "bad").agg(F.sort_array(F.collect_set("slot")).alias("later"))
    found = _grown(kept, least, p).select("rule_id", F.size("slots").alias("needs"), F.explode("slots").alias("slot"))
    return materialise(alone.unionByName(found.join(group, "slot").select("rule_id", "slot", "token", "needs")), "url-rules")


def _grown(baskets: DataFrame, least: float, p: UrlParams) -> DataFrame:
    """``rule_id, slots`` of the shortest rules of two to ``max_tokens`` slots,
    from ``baskets (row, bad, later)`` with sorted slots, none a rule alone.

    A round appends to every prefix each slot that its projected basket still
    holds. A basket of s slots makes at most s^k / k! rows for k slots, fewer
    by the prefixes that are rare or rules already."""
    spark = baskets.sparkSession
    rules = spark.createDataFrame([], "rule_id string, slots array<string>")
    rest = F.slice("later", F.col("at") + 2, F.greatest(F.size("later"), F.lit(1))).alias("later")
    grown = baskets.select("bad", F.array().cast("array<string>").alias("slots"), "later")
    for length in range(1, p.max_tokens + 1):
        grown = grown.select("bad", "slots", "later", F.posexplode("later").alias("at", "slot")).select(
            "bad", F.concat("slots", F.array("slot")).alias("slots"), rest)
        grown = materialise(grown, "url-grown") if length < p.max_tokens else grown  # the last is only counted
        count = grown.groupBy("slots").agg(F.count(F.lit(1)).alias("all"), F.sum(F.col("bad").cast("long")).alias("hits"))
        count = materialise(count.filter((F.col("hits") >= least) & (F.col("hits") > 0)), "url-counts")
        sure = F.col("hits") >= p.confidence * F.col("all")
        if length > 1:
            rules = rules.unionByName(count.filter(sure).select(F.array_join("slots", " ").alias("rule_id"), "slots"))
        if length < p.max_tokens:
            open_ends = count.filter(~sure) if length > 1 else count
            grown = spread_join(grown.filter(F.size("later") > 0), open_ends.select("slots"), "slots").select("bad", "slots", "later")
    return rules


def matched(urls: DataFrame, rules: DataFrame) -> DataFrame:
    """``rid`` of the ``urls (rid, tokens)`` that hold all tokens of a rule."""
    each = urls.select("rid", F.explode("tokens").alias("token"))
    held = spread_join(each, rules, "token").select("rid", "rule_id", "needs", "slot").distinct()
    held = held.groupBy("rid", "rule_id", "needs").agg(F.count(F.lit(1)).alias("has"))
    return held.filter(F.col("has") == F.col("needs")).select("rid").distinct()


def judge_urls(pages: DataFrame, labels: DataFrame, params: UrlParams = UrlParams(), id_col: str = "page_id",
               url_col: str = "url") -> DataFrame:
    """One row per page: ``page_id, host, path, rule, verdict``.

    ``labels (doc_id, quality, toxic)`` label pages by equal id; toxic or
    low-quality ones are bad. A fixed rule decides where one fits, else a mined
    rule blocks, else the page is allowed. Null urls and such without ``://``
    have empty host and path, no tokens, and are allowed. Repeated rows and null
    ids keep their rows; without labels nothing is mined."""
    p = params
    d = pick(pages, page_id=id_col, url=url_col).withColumn("rid", F.monotonically_increasing_id())
    url = F.coalesce(F.col("url"), F.lit(""))
    host, path = host_path(url)
    d = d.select("rid", "page_id", host.alias("host"), path.alias("path"), "url")
    rule, verdict = fixed_rule(F.col("host"), F.col("path"), p.rules)
    d = materialise(d.select("rid", "page_id", "url", "host", "path", rule.alias("rule"), verdict.alias("given"),
                             url_tokens(url, F.col("host"), F.col("path")).alias("tokens")), "urls")
    bad = (F.coalesce(F.col("toxic"), F.lit(0)) == 1) | (F.coalesce(F.col("quality"), F.lit(1)) == 0)
    known = pick(labels, page_id="doc_id", quality="quality", toxic="toxic").filter(F.col("page_id").isNotNull())
    known = known.groupBy("page_id").agg(F.max(bad).alias("bad")).orderBy(F.xxhash64("page_id", F.lit(p.seed)), "page_id")
    place = F.row_number().over(Window.partitionBy("page_id").orderBy(F.xxhash64("tokens", F.lit(p.seed)), "url", "rid"))
    labelled = d.join(F.broadcast(known.limit(p.train_rows)), "page_id").withColumn("place", place)
    rules = mine_rules(labelled.filter(F.col("place") <= p.rows_per_id).select("tokens", "bad"), p)
    hits = matched(d.filter(F.col("given").isNull()), rules).withColumn("hit", F.lit("block"))
    return d.drop("tokens").join(hits, "rid", "left").select(
        "page_id", "host", "path", "rule", F.coalesce("given", "hit", F.lit("allow")).alias("verdict"))
