"""A ranker of candidates: learned from words whose choice is known, it gives each word its best candidate."""

from __future__ import annotations

from pyspark.ml import Pipeline, PipelineModel
from pyspark.ml.classification import LogisticRegression
from pyspark.ml.feature import OneHotEncoder, StandardScaler, StringIndexer, VectorAssembler
from pyspark.ml.functions import vector_to_array
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F


def held_out(word: Column, of: int = 4) -> Column:
    """One word in ``of``, by a hash, so a word's candidates stay together."""
    return F.crc32(F.encode(word.cast("string"), "utf-8")) % of == 0


def fit(frame: DataFrame, label: str, numbers: list[str], kinds: list[str]) -> PipelineModel:
    """Weights of the candidates' features: numbers, scaled (null: 0), and kinds, one-hot (null and unseen are kinds)."""
    ready = _ready(frame, numbers, kinds).withColumn("_label", F.coalesce(F.col(label).cast("double"), F.lit(0.0)))
    index = StringIndexer(inputCols=[f"_k_{c}" for c in kinds], outputCols=[f"_i_{c}" for c in kinds], handleInvalid="keep", stringOrderType="alphabetAsc")
    hot = OneHotEncoder(inputCols=[f"_i_{c}" for c in kinds], outputCols=[f"_h_{c}" for c in kinds], handleInvalid="keep")
    scaled = [VectorAssembler(inputCols=[f"_n_{c}" for c in numbers], outputCol="_raw"), StandardScaler(withMean=True, inputCol="_raw", outputCol="_scaled")] if numbers else []
    parts = VectorAssembler(inputCols=(["_scaled"] if numbers else []) + [f"_h_{c}" for c in kinds], outputCol="_x")
    learn = LogisticRegression(featuresCol="_x", labelCol="_label", probabilityCol="_p", predictionCol="_y", rawPredictionCol="_r", maxIter=50, regParam=0.001)
    return Pipeline(stages=([index, hot] if kinds else []) + scaled + [parts, learn]).fit(ready)


def _ready(frame: DataFrame, numbers: list[str], kinds: list[str]) -> DataFrame:
    made = {f"_n_{c}": F.coalesce(F.col(c).cast("double"), F.lit(0.0)) for c in numbers} | {f"_k_{c}": F.coalesce(F.col(c).cast("string"), F.lit("\u0000")) for c in kinds}
    return frame.withColumns(made)


def best(model: PipelineModel, frame: DataFrame, word: str, candidate: str, numbers: list[str], kinds: list[str]) -> DataFrame:
    """The row of each word's likeliest candidate, with its score; equal scores go to the smaller candidate."""
    scored = model.transform(_ready(frame, numbers, kinds)).withColumn("score", vector_to_array("_p")[1]).select(*frame.columns, "score")
    order = Window.partitionBy(word).orderBy(F.desc("score"), candidate)
    return scored.withColumn("_rank", F.row_number().over(order)).where("_rank = 1").drop("_rank")
