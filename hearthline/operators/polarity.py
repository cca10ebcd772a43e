"""Filling missing positions with a text classifier: TF-IDF over one and two words, multinomial logistic regression.

The classifier may be fitted on a bounded sample of labelled rows (``sample`` rows, a documented parameter); its word
statistics are taken over all rows with a text, and its predictions cover all rows. Words and pairs of words are hashed
into FEATURES places, so there is no vocabulary to cut and none to gather.
"""

from __future__ import annotations

from pyspark.ml import Pipeline, PipelineModel
from pyspark.ml.classification import LogisticRegression
from pyspark.ml.feature import IDF, HashingTF, NGram, Normalizer, RegexTokenizer, SQLTransformer, StringIndexer
from pyspark.ml.functions import vector_to_array
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from hearthline.functions.text import model_text

FEATURES, SAMPLE, THRESHOLD, MIN_CHARS = 1 << 18, 50_000, 0.70, 10


def _features() -> list:
    return [
        RegexTokenizer(inputCol="_t", outputCol="_w", pattern=r"(?u)\b\w\w+\b", gaps=False),
        NGram(inputCol="_w", outputCol="_g", n=2),
        SQLTransformer(statement="SELECT *, concat(_w, _g) AS _all FROM __THIS__"),
        HashingTF(inputCol="_all", outputCol="_tf", numFeatures=FEATURES),
        IDF(inputCol="_tf", outputCol="_idf", minDocFreq=2),
        Normalizer(inputCol="_idf", outputCol="features", p=2.0),
    ]


def fit_positions(rows: DataFrame, text: str, label: str, sample: int = SAMPLE, inverse_strength: float = 4.0, id_: str | None = None):
    """(labels, fitted pipeline); None where fewer than two labels are known. At most about ``sample`` labelled rows train
    the classifier, drawn by a hash of ``id_`` (of the text where no id is named), so equally at every size."""
    enough = rows.where(F.length(F.coalesce(F.col(text), F.lit(""))) >= MIN_CHARS).select(model_text(F.col(text)).alias("_t"), F.col(label).alias("_label"), F.xxhash64(id_ or text).alias("_draw"))
    labelled = enough.where("_label IS NOT NULL")
    n = labelled.count()
    if n == 0:
        return None
    if n > sample:
        labelled = labelled.where(F.pmod("_draw", F.lit(1_000_000)) < F.lit(int(1_000_000 * sample / n)))
    kinds = labelled.groupBy("_label").agg(F.count(F.lit(1)).alias("_n"))
    total, k = kinds.agg(F.sum("_n"), F.count(F.lit(1))).collect()[0]
    if k < 2:
        return None
    features = Pipeline(stages=_features()).fit(enough.select("_t"))
    weighted = labelled.join(F.broadcast(kinds), "_label").withColumn("_weight", F.lit(float(total)) / (F.lit(float(k)) * F.col("_n")))  # a handful of labels
    index = StringIndexer(inputCol="_label", outputCol="label", stringOrderType="alphabetAsc", handleInvalid="keep").fit(weighted)
    learner = LogisticRegression(family="multinomial", weightCol="_weight", regParam=1.0 / (inverse_strength * total), elasticNetParam=0.0, standardization=False, maxIter=100)
    return index.labels, PipelineModel([*features.stages, learner.fit(features.transform(index.transform(weighted)))])


def predict_positions(rows: DataFrame, fitted, text: str) -> DataFrame:
    """``rows`` with ``predicted`` and ``probability`` (three digits); both null where the text is shorter than MIN_CHARS or nothing could be fitted."""
    if fitted is None:
        return rows.withColumn("predicted", F.lit(None).cast("string")).withColumn("probability", F.lit(None).cast("double"))
    labels, model = fitted
    scored = model.transform(rows.withColumn("_t", F.coalesce(model_text(F.col(text)), F.lit(""))))
    p = F.slice(vector_to_array(F.col("probability")), 1, len(labels))
    best = F.element_at(F.array(*[F.lit(x) for x in labels]), F.array_position(p, F.array_max(p)).cast("int"))
    enough = F.length(F.coalesce(F.col(text), F.lit(""))) >= MIN_CHARS
    return scored.withColumn("_p", F.array_max(p)).select(*rows.columns, F.when(enough, best).alias("predicted"), F.when(enough, F.round("_p", 3)).alias("probability"))


def impute(scored: DataFrame, label: str, locked: Column, threshold: float = THRESHOLD) -> DataFrame:
    """Adds ``<label>_final`` and ``<label>_source``: what was recorded, else a prediction of enough probability where the row isn't locked."""
    take = F.col(label).isNull() & ~F.coalesce(locked, F.lit(False)) & (F.col("probability") >= threshold)
    return scored.withColumn(f"{label}_final", F.coalesce(F.col(label), F.when(take, F.col("predicted")))).withColumn(f"{label}_source", F.when(F.col(label).isNotNull(), "recorded").when(take, "model"))


def report(scored: DataFrame, label: str, threshold: float = THRESHOLD) -> DataFrame:
    """Per recorded label: rows, predicted right, kept at the threshold, kept and right."""
    known = scored.where(F.col(label).isNotNull() & F.col("predicted").isNotNull())
    right, kept = F.col(label) == F.col("predicted"), F.col("probability") >= threshold
    return known.groupBy(label).agg(F.count(F.lit(1)).alias("n"), F.count_if(right).alias("n_right"), F.count_if(kept).alias("n_kept"), F.count_if(kept & right).alias("n_kept_right"))
