"""Mixing documents to target weights with soft domain membership.

A classifier trained on a labelled table predicts the probability of every
domain for every document. A document of t tokens adds t * p_d tokens to
domain d for each time it is taken; rates (how often it is taken) are fitted by
projected-gradient least squares so that the expected tokens of every domain
meet its target. Only one number per domain reaches the driver in an iteration;
a document's rate is a function of its own tokens, its probabilities and the
gradients so far, so rates are neither shuffled nor stored. Everything is
DataFrame expressions and Spark ML.
"""

from __future__ import annotations

import warnings
from collections.abc import Mapping
from dataclasses import dataclass, field

from pyspark.ml.classification import LogisticRegression
from pyspark.ml.feature import CountVectorizerModel
from pyspark.ml.functions import vector_to_array
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from larder.llm.common import SPACE_REGEX, materialise, pick, positional


@dataclass(frozen=True)
class MixParams:
    """``targets``: weight per domain; where empty, present shares to the power
    ``smoothing``. ``total``: tokens wanted; by default the present total, or
    with ``min_rate`` the least total that no domain has to be cut for and
    ``headroom`` more: documents taken more often for one domain bring some
    tokens of every other, also of the domain that sets the least total.
    ``min_rate``: lower bound of rates (0 or more). ``train_rows``: bound on the
    labelled ids that the classifier is fitted on, dealt evenly to the domains; ``markers``: words per
    domain that it looks at; ``max_domains``: at most; ``tolerance``: share of
    the total that a met target may be off; ``slack``: share of a target beyond
    which missing it is an error; ``write_every``: rounds after which the rates
    so far are written, so that a round's work does not grow with the rounds."""
    targets: Mapping[str, float] = field(default_factory=dict)
    smoothing: float = 0.7
    total: float | None = None
    min_rate: float = 0.0
    headroom: float = 0.1
    train_rows: int = 4000
    markers: int = 128
    max_domains: int = 64
    tolerance: float = 1e-4
    slack: float = 0.05
    max_rounds: int = 60
    write_every: int = 10
    seed: int = 7


def _words(text: Column) -> Column:
    """Words of a whole text, in lower case; an empty string may stand first or last."""
    return F.split(F.lower(F.coalesce(text, F.lit(""))), SPACE_REGEX)


def _n_words(words: str) -> Column:
    last = F.element_at(words, -1) == ""
    return (F.size(words) - F.when(F.col(words)[0] == "", 1).otherwise(0)
            - F.when(last & (F.size(words) > 1), 1).otherwise(0)).cast("long")


def _markers(rows: DataFrame, p: MixParams) -> list:
    """The words of the labelled rows that are in the most documents of a domain."""
    each = rows.select("domain", F.explode(F.array_distinct("mix_words")).alias("word")).filter("word <> ''")
    count = each.groupBy("domain", "word").count()
    place = F.row_number().over(Window.partitionBy("domain").orderBy(F.desc("count"), "word"))
    best = count.withColumn("place", place).filter(F.col("place") <= p.markers)
    return [r[0] for r in best.select("word").distinct().orderBy("word").collect()]


def _featured(df: DataFrame, words: list) -> DataFrame:
    """Which markers a text holds, as a sparse vector."""
    held = F.array_intersect(F.col("mix_words"), F.array(*[F.lit(w) for w in words]))
    known = CountVectorizerModel.from_vocabulary(words, inputCol="mix_held", outputCol="mix_features", minTF=1.0)
    return known.transform(df.withColumn("mix_held", held)).drop("mix_held")


def _quota(counts: list, bound: int) -> int:
    """The most that each may give so that all together give at most ``bound``;
    what small counts leave over goes to the larger ones."""
    left = bound
    for i, c in enumerate(sorted(counts)):
        share = left // (len(counts) - i)
        if c > share:
            return max(1, share)
        left -= c
    return max(counts)


def train_domains(docs: DataFrame, labels: DataFrame, p: MixParams):
    """(domains, (marker words, model)) from ``docs (doc_id, text, domain)`` whose ids are in
    ``labels (doc_id)``; the model is None for fewer than two domains. The
    domains are those of all labelled rows. The model is fitted on a bounded
    number of rows per domain, weighted to the domains' shares of all of them."""
    ids = labels.filter(F.col("doc_id").isNotNull()).select("doc_id").distinct()
    known = docs.filter(F.col("domain").isNotNull() & F.col("doc_id").isNotNull()).select("doc_id", "domain")
    known = materialise(known.join(ids, "doc_id", "left_semi").groupBy("doc_id", "domain").agg(F.count(F.lit(1)).alias("rows")), "mix-known")
    totals = known.groupBy("domain").agg(F.sum("rows").alias("rows"), F.count(F.lit(1)).alias("ids"))
    totals = totals.orderBy("domain").limit(p.max_domains + 1).collect()
    domains = [r["domain"] for r in totals]
    if len(domains) > p.max_domains:
        raise ValueError(f"more than {p.max_domains} domains")
    missing = sorted(d for d, w in p.targets.items() if w > 0 and d not in domains)
    if missing:
        raise ValueError(f"targets without labelled rows: {missing}")
    if len(domains) < 2:
        return domains, None
    quota = _quota([r["ids"] for r in totals], max(p.train_rows, len(domains)))
    place = F.array_position(F.array(*[F.lit(d) for d in domains]), F.col("domain"))
    least = F.array(*[F.lit(min(1.0, (2 * quota + 64) / r["ids"])) for r in totals])  # enough for the quota, and bounded at any scale
    u = F.pmod(F.xxhash64("doc_id", F.lit(p.seed)), F.lit(1 << 30)) / float(1 << 30)
    first = Window.partitionBy("domain").orderBy(u, F.xxhash64("doc_id"), "doc_id")
    sample = known.filter(u < F.get(least, (place - 1).cast("int"))).withColumn("place", F.row_number().over(first)).filter(F.col("place") <= quota).select("doc_id", "domain")
    rows = docs.join(F.broadcast(sample), ["doc_id", "domain"]).select("text", "domain")
    first = Window.partitionBy("domain").orderBy(F.xxhash64("text", F.lit(p.seed)), "text")  # repeated ids cannot outgrow the bound
    rows = materialise(rows.withColumn("place", F.row_number().over(first)).filter(F.col("place") <= 2 * quota).drop("place"), "mix-train")
    rows = materialise(rows.withColumn("mix_words", _words(F.col("text"))).drop("text"), "mix-words")
    words = _markers(rows, p)
    if not words:
        return domains, None
    taken = {r["domain"]: r["count"] for r in rows.groupBy("domain").count().collect()}
    shares = F.array(*[F.lit(r["rows"] / taken[r["domain"]]) for r in totals])
    rows = _featured(rows.withColumn("label", place.cast("double") - 1).withColumn("share", F.get(shares, (place - 1).cast("int"))), words)
    fit = LogisticRegression(featuresCol="mix_features", labelCol="label", weightCol="share", family="multinomial", maxIter=30, regParam=1e-4,
                             predictionCol="mix_pred", probabilityCol="mix_prob", rawPredictionCol="mix_raw")
    return domains, (words, fit.fit(materialise(rows.select("label", "share", "mix_features"), "mix-features")))


def posteriors(df: DataFrame, text: str, domains, model, p: MixParams) -> DataFrame:
    """``df`` with ``mix_tokens`` and ``mix_posterior`` (array in the order of ``domains``)."""
    df = df.withColumn("mix_words", _words(F.col(text))).withColumn("mix_tokens", _n_words("mix_words"))
    if model is None:
        return df.drop("mix_words").withColumn("mix_posterior", F.array(*[F.lit(1.0) for _ in domains]).cast("array<double>"))
    words, fitted = model
    out = fitted.transform(_featured(df, words)).withColumn("mix_posterior", vector_to_array("mix_prob"))
    return out.drop("mix_words", "mix_features", "mix_raw", "mix_prob", "mix_pred")


def _rate(steps: list, low: float, start: str | None = None) -> Column:
    """The rate after the gradient ``steps`` (one vector per round so far),
    from a start that is the same for all rows or a column. ``mix_posterior``
    must be a stored column: Spark puts what a column is made from into the
    lambda, which would make it anew for every step."""
    start = start or f"{max(1.0, low)!r}D"
    if not steps:
        return F.expr(start)
    listed = ", ".join("array(" + ", ".join(f"{v!r}D" for v in g) + ")" for g in steps)
    return F.expr(f"""aggregate(array({listed}), {start}, (r, g) -> greatest({low!r}D, r - aggregate(
        zip_with(mix_posterior, g, (x, y) -> x * y), 0.0D, (s, v) -> s + v)))""")


def fit_rates(scored: DataFrame, domains: list, p: MixParams) -> tuple:
    """(steps, report) for ``scored (mix_tokens, mix_posterior)``. Gradients are
    scaled by each document's tokens and each domain's present tokens; since
    probabilities sum to one, the scaled system's norm is at most one and a
    step of one is safe."""
    n = len(domains)

    def tokens(rate: Column, rows: DataFrame = scored) -> list:
        row = rows.agg(*[F.sum(F.col("mix_tokens") * rate * F.col("mix_posterior")[i]).alias(f"d{i}") for i in range(n)]).first()
        return [float(v or 0.0) for v in row]

    present = tokens(F.lit(1.0)) if n else []
    if not n or sum(present) <= 0:
        return [], {"domains": domains, "present": present, "wanted": present, "expected": present}
    weights = [p.targets.get(d, 0.0) for d in domains] if p.targets else [(c / sum(present)) ** p.smoothing for c in present]
    weights = [w / sum(weights) for w in weights]
    total = p.total or ((1 + p.headroom) * max(p.min_rate * c / w for c, w in zip(present, weights, strict=True) if w > 0)
                        if p.min_rate > 0 else sum(present))
    wanted = [total * w for w in weights]
    steps: list = []
    written, rows, start = 0, scored, None
    for turn in range(p.max_rounds + 1):
        got = tokens(_rate(steps[written:], p.min_rate, start), rows)
        if turn == p.max_rounds or max(abs(g - w) for g, w in zip(got, wanted, strict=True)) <= p.tolerance * total:
            break
        steps.append([round((g - w) / c, 12) if c > 0 else 0.0 for g, w, c in zip(got, wanted, present, strict=True)])
        if len(steps) - written >= p.write_every:
            rows = materialise(rows.select("mix_tokens", "mix_posterior", _rate(steps[written:], p.min_rate, start).alias("mix_rate")), "mix-rates")
            written, start = len(steps), "mix_rate"
    return steps, {"domains": domains, "present": present, "wanted": wanted, "expected": got}


def _fitted(scored: DataFrame, domains: list, p: MixParams) -> list:
    """The steps of ``fit_rates``. Targets that are not met (soft membership and
    ``min_rate`` can put them out of reach) are told by a warning, and are an
    error where one is off by more than the share ``p.slack`` of itself."""
    steps, report = fit_rates(scored, domains, p)
    total = sum(report["wanted"])
    off = {d: (g, w) for d, g, w in zip(domains, report["expected"], report["wanted"], strict=True) if abs(g - w) > p.tolerance * total}
    if off:
        told = f"targets not met after {len(steps)} rounds (expected and wanted tokens): {off}"
        if any(abs(g - w) > p.slack * (w or total) for g, w in off.values()):
            raise RuntimeError(told)
        warnings.warn(told, stacklevel=3)
    return steps


def _copies(doc_id: str, p: MixParams) -> Column:
    """The rate rounded up or down at random, always alike for one id."""
    u = F.pmod(F.xxhash64(F.col(doc_id), F.lit(p.seed)), F.lit(1 << 30)) / float(1 << 30)
    return F.floor(F.col("rate") + u).cast("long")


def _label_ids(labels: DataFrame) -> DataFrame:
    return pick(labels, doc_id="doc_id")


def mixing_rates(docs: DataFrame, labels: DataFrame, params: MixParams = MixParams(), id_col: str = "doc_id",
                 text_col: str = "text", domain_col: str = "lang") -> DataFrame:
    """One row per document: ``doc_id, n_tokens, posterior`` (map from domain
    to probability)``, rate, copies`` (the rate rounded, the expectation kept).

    Null and empty texts have no tokens and take the rate that their
    probabilities give; without any labelled domain every rate is 1. A target
    without labelled rows is an error, and so is one that is off by more than
    ``slack`` after the last round (a warning above ``tolerance``). Null ids and repeated rows keep their rows; rows of one id round alike."""
    p = params
    d = pick(docs, doc_id=id_col, text=text_col, domain=domain_col)
    domains, model = train_domains(d, _label_ids(labels), p)
    scored = materialise(posteriors(d.select("doc_id", "text"), "text", domains, model, p).drop("text"), "mix-scored")
    steps = _fitted(scored, domains, p)
    names = F.array(*[F.lit(x) for x in domains]).cast("array<string>")
    out = scored.withColumn("rate", _rate(steps, p.min_rate))
    return out.select("doc_id", F.col("mix_tokens").alias("n_tokens"), F.map_from_arrays(names, "mix_posterior").alias("posterior"),
                      "rate", _copies("doc_id", p).alias("copies"))


def mix(docs: DataFrame, labels: DataFrame, params: MixParams = MixParams(), id_col: str = "doc_id",
        text_col: str = "text", domain_col: str = "lang") -> DataFrame:
    """``docs``, each row repeated (or left out) according to its rate; all
    columns stay.

    Null ids, repeated rows, null and empty texts and missed targets as in
    ``mixing_rates``; very long texts are one row as any other. The rows are
    written once with their probabilities, so the classifier runs once; rates
    and copies are then read off the written table."""
    p = params
    flat, at, restore = positional(docs)
    d = flat.select(F.col(at(id_col)).alias("doc_id"), F.col(at(text_col)).alias("text"), F.col(at(domain_col)).alias("domain"))
    domains, model = train_domains(d, _label_ids(labels), p)
    scored = materialise(posteriors(flat, at(text_col), domains, model, p), "mix-scored")
    steps = _fitted(scored, domains, p)
    out = scored.withColumn("rate", _rate(steps, p.min_rate)).withColumn("copies", _copies(at(id_col), p)).filter("copies > 0")
    return restore(out.withColumn("copy", F.explode(F.sequence(F.lit(1).cast("long"), F.col("copies")))))
