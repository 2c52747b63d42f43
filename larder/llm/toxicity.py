"""Toxicity by a classifier chain.

Linear models predict the categories one after the other; each gets the
probabilities of the earlier ones as features. While the chain is trained these
are out-of-fold predictions, so a later model sees earlier probabilities as
good as they will be on new documents. Scoring is one pass in the JVM.
"""

from __future__ import annotations

from dataclasses import dataclass
from functools import reduce

from pyspark.ml.classification import LogisticRegression
from pyspark.ml.feature import CountVectorizerModel, VectorAssembler
from pyspark.ml.functions import vector_to_array
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from larder.llm.common import materialise, pick, positional


@dataclass(frozen=True)
class ChainParams:
    """``categories``: (name, SQL condition over the labels' columns) in chain
    order; ``verdict``: the category that decides; ``threshold``: its least
    probability; ``train_rows``: bound on the labelled rows of each class of the
    verdict that the models are fitted on, weighted to the classes' shares of all labels; ``rows_per_id``: most
    documents of one labelled id among them; ``vocabulary``: most words looked at; ``evidence``: least standard errors of a word; ``folds``: for out-of-fold predictions."""
    categories: tuple = (("junk", "quality = 0"), ("toxic", "toxic = 1"))
    verdict: str = "toxic"
    threshold: float = 0.5
    train_rows: int = 3000
    rows_per_id: int = 4
    vocabulary: int = 1024
    evidence: float = 3.0
    folds: int = 3
    iterations: int = 25
    seed: int = 7


def _words(text: Column) -> Column:
    return F.split(F.lower(F.coalesce(text, F.lit(""))), r"[^\p{L}\p{N}]+")


def _vocabulary(rows: DataFrame, p: ChainParams) -> list:
    """The words whose presence tells most about a category: the log odds of
    their shares of documents with and without it, in standard errors."""
    names = [n for n, _ in p.categories]
    totals = rows.agg(F.count(F.lit(1)).alias("n"), *[F.sum(n).alias(n) for n in names]).first()
    each = rows.select(*names, F.explode(F.array_distinct("words")).alias("word")).filter("word <> ''")
    count = each.groupBy("word").agg(F.count(F.lit(1)).alias("n"), *[F.sum(n).alias(n) for n in names]).filter("n > 1")

    def told(n):
        yes, no = float(totals[n] or 0), float((totals["n"] or 0) - (totals[n] or 0))
        a, b = F.col(n) + 0.5, F.col("n") - F.col(n) + 0.5
        return F.abs(F.log(a / (yes + 1)) - F.log(b / (no + 1))) / F.sqrt(1 / a + 1 / b)

    best = count.select("word", F.greatest(F.lit(0.0), *[told(n) for n in names]).alias("score"))
    return [r[0] for r in best.filter(F.col("score") >= p.evidence).orderBy(F.desc("score"), "word").limit(p.vocabulary).collect()]


def _held(df: DataFrame, words: list) -> DataFrame:
    """Which words of the vocabulary a text holds, as a sparse vector."""
    known = F.array(*[F.lit(w) for w in words]).cast("array<string>")
    model = CountVectorizerModel.from_vocabulary(words or [""], inputCol="chain_held", outputCol="chain_words", minTF=1.0)
    return model.transform(df.withColumn("chain_held", F.array_intersect("words", known))).drop("chain_held", "words")


class _Link:
    """One model of the chain; a constant where the labels know one class."""

    def __init__(self, name: str, earlier: list, p: ChainParams):
        self.name, self.p = name, p
        self.gather = VectorAssembler(inputCols=["chain_words", *[f"prob_{e}" for e in earlier]], outputCol="chain_x")

    def fit(self, rows: DataFrame) -> _Link:
        n, yes, low, high = rows.agg(F.sum("share"), F.sum(F.col("share") * F.col(self.name)), F.min(self.name), F.max(self.name)).first()
        self.constant = None if low != high else yes / n if n else 0.0
        if self.constant is None:
            self.model = LogisticRegression(featuresCol="chain_x", labelCol=self.name, weightCol="share", maxIter=self.p.iterations, regParam=1e-3,
                                            standardization=False,
                                            probabilityCol="chain_p", rawPredictionCol="chain_r", predictionCol="chain_y"
                                            ).fit(self.gather.transform(rows))
        return self

    def predict(self, df: DataFrame) -> DataFrame:
        if self.constant is not None:
            return df.withColumn(f"prob_{self.name}", F.lit(float(self.constant)))
        out = self.model.transform(self.gather.transform(df))
        return out.withColumn(f"prob_{self.name}", vector_to_array("chain_p")[1]).drop("chain_x", "chain_p", "chain_r", "chain_y")


def train_chain(docs: DataFrame, labels: DataFrame, p: ChainParams) -> tuple:
    """(vocabulary, links) from ``docs (doc_id, text)`` and ``labels (doc_id, ...)``."""
    marked = labels.select("doc_id", *[F.coalesce(F.expr(c), F.lit(False)).cast("double").alias(n) for n, c in p.categories])
    marked = marked.filter(F.col("doc_id").isNotNull()).groupBy("doc_id").agg(*[F.max(n).alias(n) for n, _ in p.categories])
    order = [F.xxhash64("doc_id", F.lit(p.seed)), F.col("doc_id")]
    sizes = {r[0]: r[1] for r in marked.groupBy(p.verdict).count().collect()}  # a sampled row stands for this many of its class
    share = [sizes.get(v, 0) / max(1, min(sizes.get(v, 0), p.train_rows)) for v in (0.0, 1.0)]
    marked = marked.withColumn("share", F.when(F.col(p.verdict) == 1.0, F.lit(share[1])).otherwise(F.lit(share[0])))
    # A threshold on the hash leaves enough ids for the sample, and a bounded number of them at any size.
    u = F.pmod(F.xxhash64("doc_id", F.lit(p.seed)), F.lit(1 << 30)) / float(1 << 30)
    likely = lambda v: min(1.0, (2 * p.train_rows + 64) / max(1, sizes.get(v, 0)))
    ids = reduce(DataFrame.union, [marked.filter((F.col(p.verdict) == v) & (u < likely(v))).orderBy(*order).limit(p.train_rows) for v in (0.0, 1.0)])
    fold = F.pmod(F.xxhash64("doc_id", F.lit(p.seed + 1)), F.lit(p.folds)).alias("fold")
    # Repeated ids cannot outgrow the bound: at most a few rows of each, ranked where they are before they are moved.
    place = F.row_number().over(Window.partitionBy("doc_id").orderBy(F.xxhash64("text", F.lit(p.seed)), "text"))
    rows = docs.join(F.broadcast(ids), "doc_id").withColumn("place", place).filter(F.col("place") <= p.rows_per_id)
    rows = materialise(rows.select(*[n for n, _ in p.categories], "share", fold, _words(F.col("text")).alias("words")), "chain-rows")
    words = _vocabulary(rows, p)
    rows = materialise(_held(rows, words), "chain-train")
    links: list = []
    names = [n for n, _ in p.categories]
    for i, name in enumerate(names):
        links.append(_Link(name, names[:i], p).fit(rows))
        if i + 1 < len(names):  # the next model learns from predictions of models that did not see the row
            out = [_Link(name, names[:i], p).fit(rows.filter(F.col("fold") != f)).predict(rows.filter(F.col("fold") == f))
                   for f in range(p.folds)]
            rows = materialise(reduce(DataFrame.unionByName, out), "chain-train")
    return words, links


def _scored(df: DataFrame, words: list, links: list) -> DataFrame:
    return reduce(lambda d, link: link.predict(d), links, _held(df, words)).drop("chain_words")


def toxicity(docs: DataFrame, labels: DataFrame, params: ChainParams = ChainParams(), id_col: str = "doc_id",
             text_col: str = "text") -> DataFrame:
    """One row per document: ``doc_id, prob_<category>`` in chain order, and
    ``is_toxic``.

    Null and empty texts hold no word and get the models' probabilities for
    that. Without labels, or with labels of one class, a category's probability
    is the share of its label (0 without rows). Null ids and repeated rows stay."""
    p = params
    d = pick(docs, doc_id=id_col, text=text_col)
    known = pick(labels, doc_id="doc_id", quality="quality", toxic="toxic")
    words, links = train_chain(d, known, p)
    out = _scored(d.select("doc_id", _words(F.col("text")).alias("words")), words, links)
    probs = [f"prob_{n}" for n, _ in p.categories]
    return out.select("doc_id", *probs, (F.col(f"prob_{p.verdict}") >= p.threshold).alias("is_toxic"))


def drop_toxic(docs: DataFrame, labels: DataFrame, params: ChainParams = ChainParams(), id_col: str = "doc_id",
               text_col: str = "text") -> DataFrame:
    """The rows of ``docs``, all columns, that are not toxic."""
    flat, at, restore = positional(docs)
    d = flat.select(F.col(at(id_col)).alias("doc_id"), F.col(at(text_col)).alias("text"))
    words, links = train_chain(d, pick(labels, doc_id="doc_id", quality="quality", toxic="toxic"), params)
    marked = _scored(flat.withColumn("words", _words(F.col(at(text_col)))), words, links)
    return restore(marked.filter(F.col(f"prob_{params.verdict}") < params.threshold))
