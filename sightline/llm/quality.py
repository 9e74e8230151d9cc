"""Quality classifier: a sparse rule ensemble (operator 4)."""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.ml.classification import LogisticRegression, RandomForestClassifier
from pyspark.ml.feature import VectorAssembler
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from sightline.session import pin

SAMPLE = 12_000  # labelled rows the ensemble is fitted on, the least by hash of their id
THRESHOLD = 0.3

Rule = tuple[tuple[str, str, float], ...]  # (statistic, "<=" or ">", threshold), all to hold


def statistics(text: str = "text") -> dict[str, Column]:
    """Statistics of a text; those of an empty text are 0."""
    body = F.coalesce(F.col(text).cast("string"), F.lit(""))
    length = F.length(body)
    words = F.filter(F.split(body, r"\s+"), lambda w: w != "")
    n = F.greatest(F.size(words), F.lit(1))
    chars = F.greatest(length, F.lit(1))
    rate = lambda pattern, over: (F.regexp_count(body, F.lit(pattern)) / over).cast("double")
    return {
        "words": F.size(words).cast("double"),
        "word_length": (length / n).cast("double"),
        "distinct": (F.size(F.array_distinct(words)) / n).cast("double"),
        "upper": rate("[A-ZÀ-Þ]", chars),
        "digits": rate("[0-9]", chars),
        "symbols": rate(r"[^\p{L}\p{N}\s.,]", chars),
        "stops": rate(r"[.,]", n),
        "lines": rate("\n", n),
        "repeats": rate(r"(?<!\S)(\S+)\s\1(?!\S)", n),
    }


@dataclass(frozen=True)
class RuleEnsemble:
    """Logistic weights of conjunctive rules over statistics."""

    intercept: float
    weights: tuple[tuple[Rule, float], ...]

    def score(self, stats: dict[str, Column]) -> Column:
        """The ensemble as one column expression."""
        total = F.lit(self.intercept)
        for rule, weight in self.weights:
            total = total + F.when(holds(rule, stats), F.lit(weight)).otherwise(F.lit(0.0))
        return 1 / (1 + F.exp(-total))


def holds(rule: Rule, stats: dict[str, Column]) -> Column:
    out = F.lit(True)
    for name, side, at in rule:
        out = out & (stats[name] <= at if side == "<=" else stats[name] > at)
    return out


def tree_rules(node, names: list[str], path: Rule = ()) -> list[Rule]:
    """Every path from the root of a fitted tree to a node below it, as a conjunction."""
    out = [path] if path else []
    if node.subtreeDepth() > 0:
        split = node.split()
        name, at = names[split.featureIndex()], float(split.threshold())
        out += tree_rules(node.leftChild(), names, (*path, (name, "<=", at)))
        out += tree_rules(node.rightChild(), names, (*path, (name, ">", at)))
    return out


def fit_rules(
    rows: DataFrame, label: str, names: list[str], trees: int = 24, depth: int = 3, penalty: float = 0.002, seed: int = 4
) -> RuleEnsemble:
    """Fit the ensemble on statistics ``names`` and a 0/1 ``label``.

    A forest of shallow trees proposes rules, a lasso logistic regression weighs them; rules of
    weight 0 are dropped.  With one class only, or without rows, the score is the smoothed share of
    label 1.
    """
    ones, total = rows.agg(F.sum(label), F.count(label)).first()
    if not total or ones in (0, total):
        share = ((ones or 0) + 1) / (total + 2)
        return RuleEnsemble(_logit(share), ())
    vectors = VectorAssembler(inputCols=names, outputCol="_stats").transform(rows)
    forest = RandomForestClassifier(
        labelCol=label, featuresCol="_stats", numTrees=trees, maxDepth=depth, seed=seed, featureSubsetStrategy="onethird",
        maxBins=128,
    ).fit(vectors)
    rules = sorted({r for t in forest.trees for r in tree_rules(t._java_obj.rootNode(), names)})
    columns = {name: F.col(name) for name in names}
    met = rows.select(label, *[holds(r, columns).cast("double").alias(f"_r{i}") for i, r in enumerate(rules)])
    met = pin(VectorAssembler(inputCols=[f"_r{i}" for i in range(len(rules))], outputCol="_rules").transform(met).select(label, "_rules"))
    model = LogisticRegression(
        labelCol=label, featuresCol="_rules", regParam=penalty, elasticNetParam=1.0, standardization=False, maxIter=200
    ).fit(met)
    weights = tuple((r, float(w)) for r, w in zip(rules, model.coefficients.toArray()) if w)
    return RuleEnsemble(float(model.intercept), weights)


def _logit(p: float) -> float:
    from math import log

    return log(p / (1 - p))


def held_out(doc_id: str = "doc_id") -> Column:
    return F.coalesce(F.crc32(F.col(doc_id).cast("string").cast("binary")) % 5 == 0, F.lit(False))


def train(docs: DataFrame, labels: DataFrame, sample: int = SAMPLE, text: str = "text", doc_id: str = "doc_id") -> RuleEnsemble:
    """Fit on at most ``sample`` labelled documents that are not held out.

    Null labels are ignored.  The sample, of bounded size, is broadcast to the documents, so that
    statistics are taken of its texts only.
    """
    chosen = labels.where(F.col("quality").isNotNull() & F.col(doc_id).isNotNull() & ~held_out(doc_id)).select(
        F.col(doc_id).alias("_id"), F.col("quality").cast("double").alias("_label"))
    chosen = chosen.orderBy(F.xxhash64("_id"), "_id", "_label").limit(sample)
    rows = docs.select(F.col(doc_id).alias("_id"), F.col(text).alias("_text")).join(F.broadcast(chosen), "_id")
    stats = statistics("_text")
    return fit_rules(pin(rows.select("_label", *[c.alias(k) for k, c in stats.items()])), "_label", list(stats))


def score_quality(docs: DataFrame, model: RuleEnsemble, text: str = "text") -> DataFrame:
    """Add ``score`` (0 to 1) and ``predicted`` (1 if score >= 0.3) to every document.

    The compiled rules are column expressions over statistics of the whole text; nothing else of the
    row enters the score.  Null and empty texts have statistics of 0 and get the score of these.
    All columns stay; ``score`` and ``predicted`` are replaced if present.
    """
    stats = statistics(text)
    wide = docs.withColumns({f"_stat_{k}": c for k, c in stats.items()})
    scored = wide.withColumn("score", model.score({k: F.col(f"_stat_{k}") for k in stats}))
    return scored.withColumn("predicted", (F.col("score") >= THRESHOLD).cast("int")).drop(*[f"_stat_{k}" for k in stats])


def quality_digest(docs: DataFrame, labels: DataFrame) -> DataFrame:
    """One row per document with its score and whether it was held out of the fit."""
    scored = score_quality(docs.select("doc_id", "text"), train(docs, labels))
    return scored.select("doc_id", held_out().alias("held_out"), "score", "predicted")
