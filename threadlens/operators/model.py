"""Stance classifier (M2, M3) with MLlib.

The deep sequence models of the original are single-machine tensor code;
the user-visible task — a class-weighted 4-class stance classifier on the
example text (optionally plus the nine numeric features) — is an MLlib
pipeline fitted on executors: tokens -> HashingTF -> IDF [-> assemble with
features] -> multinomial logistic regression weighted by class weight.
"""

from __future__ import annotations

from pyspark.ml import Pipeline, PipelineModel
from pyspark.ml.classification import LogisticRegression
from pyspark.ml.feature import IDF, HashingTF, RegexTokenizer, SQLTransformer, VectorAssembler
from pyspark.ml.functions import vector_to_array
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from threadlens.operators.encode import MODEL_FEATURES
from threadlens.operators.evaluate import argmax, class_weights


def _text_col() -> F.Column:
    return F.concat_ws(" [SEP] ", F.coalesce("clean_text_src", F.lit("")),
                       F.coalesce("clean_text_prev", F.lit("")), F.coalesce("clean_text", F.lit("")))


def fit_stance(train: DataFrame, with_features: bool = False, num_features: int = 1 << 16,
               max_iter: int = 50, reg: float = 0.01) -> PipelineModel:
    """M2: fit on labelled examples; class weights as in M1 (one row per
    class, broadcast)."""
    lab = train.where(F.col("stance_label").isNotNull())
    w = class_weights(lab).select(F.col("class").alias("stance_label"), F.col("weight").alias("cw"))
    lab = lab.join(F.broadcast(w), "stance_label", "left") \
        .withColumn("label", F.col("stance_label").cast("double")) \
        .withColumn("cw", F.coalesce("cw", F.lit(1.0))) \
        .withColumn("model_text", _text_col())
    stages = [
        RegexTokenizer(inputCol="model_text", outputCol="_tok", pattern=r"\s+", toLowercase=True),
        HashingTF(inputCol="_tok", outputCol="_tf", numFeatures=num_features),
        IDF(inputCol="_tf", outputCol="_tfidf"),
    ]
    feat = "_tfidf"
    if with_features:
        stages.append(SQLTransformer(statement="SELECT *, " + ", ".join(
            f"CAST({c} AS DOUBLE) AS _f_{c}" for c in MODEL_FEATURES) + " FROM __THIS__"))
        stages.append(VectorAssembler(inputCols=["_tfidf", *[f"_f_{c}" for c in MODEL_FEATURES]],
                                      outputCol="_all"))
        feat = "_all"
    stages.append(LogisticRegression(featuresCol=feat, labelCol="label", weightCol="cw",
                                     family="multinomial", maxIter=max_iter, regParam=reg))
    return Pipeline(stages=stages).fit(lab)


def predict(model: PipelineModel, df: DataFrame) -> DataFrame:
    """M3 via the model: logits -> class (lowest index on ties)."""
    scored = model.transform(df.withColumn("model_text", _text_col()))
    z = vector_to_array("rawPrediction")
    return scored.withColumn("z", z).withColumn("pred", argmax("z")) \
        .drop("_tok", "_tf", "_tfidf", "_all", "rawPrediction", "probability", "prediction", "model_text",
              *[f"_f_{c}" for c in MODEL_FEATURES])


def evaluate_splits(scored: DataFrame, weights: DataFrame, gold: str = "stance_label",
                    split_col: str = "fold") -> DataFrame:
    """Per split: class-weighted loss (M8), accuracy (M4), macro and weighted
    F1 (M6, M7) of scored examples (``z`` logits, ``pred``) — one row per
    split, all aggregations."""
    from threadlens.operators.evaluate import accuracy, f1, weighted_log_loss
    s = scored.where(F.col(gold).isNotNull()).select(
        F.col(split_col).alias("split"), F.col(gold).cast("int").alias("gold"), "pred", "z")
    keys = ["split"]
    return (weighted_log_loss(s, weights, group_cols=keys)
            .join(accuracy(s, group_cols=keys).select("split", "accuracy"), keys)
            .join(f1(s, "macro", group_cols=keys), keys)
            .join(f1(s, "weighted", group_cols=keys), keys))


def learning_curve(examples: DataFrame, epochs: int = 2, with_features: bool = False, run: str = "lr",
                   train_fold: str = "train", num_features: int = 1 << 16, patience: int | None = None) -> DataFrame:
    """The epoch loop of training, as a table ``(run, epoch, split, loss,
    accuracy, f1_macro, f1_weighted)`` — the input of ``running_best`` /
    ``early_stop`` / ``learning_curves``. One model is carried from epoch to
    epoch (``operators.epochs``); with ``patience`` the loop stops as M11 says."""
    from threadlens.operators.epochs import fit_epochs
    return fit_epochs(examples, epochs, with_features, run, train_fold, num_features, patience).curve(examples.sparkSession)
