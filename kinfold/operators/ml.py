"""Binary classifiers of pairs, as Spark ML pipelines over feature columns."""

from __future__ import annotations

from dataclasses import dataclass, field

from pyspark.ml import Pipeline, PipelineModel
from pyspark.ml.classification import GBTClassifier, LogisticRegression
from pyspark.ml.feature import StandardScaler, VectorAssembler
from pyspark.ml.functions import vector_to_array
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from .features import BASIC, UNFITTED_IDF


@dataclass
class Matcher:
    """fit(), score(), importances(), save() and load() of a model over feature_names; nulls and NaN count as 0. idf, default_idf: the token weights that its features were made with."""

    feature_names: list[str] = field(default_factory=lambda: list(BASIC))
    balanced: bool = True
    seed: int = 42
    model: PipelineModel | None = None
    idf: DataFrame | None = None
    default_idf: float = UNFITTED_IDF

    def _filled(self, df: DataFrame) -> DataFrame:
        missing = [c for c in self.feature_names if c not in df.columns]
        if missing:
            raise ValueError(f"no such features: {missing}")
        return df.withColumns({c: F.coalesce(F.nanvl(F.col(c).cast("double"), F.lit(0.0)), F.lit(0.0)) for c in self.feature_names})

    def _stages(self, n: float) -> list:
        raise NotImplementedError

    def fit(self, labelled: DataFrame) -> Matcher:
        counts = {r.label: r.n for r in labelled.groupBy("label").agg(F.count("*").alias("n")).collect()}
        if set(counts) != {0, 1}:
            raise ValueError("labels of both classes are needed")
        n = sum(counts.values())
        weight = F.when(F.col("label") == 1, n / (2 * counts[1])).otherwise(n / (2 * counts[0])) if self.balanced else F.lit(1.0)
        rows = self._filled(labelled).withColumn("_weight", weight).withColumn("label", F.col("label").cast("double"))
        self.model = Pipeline(stages=[VectorAssembler(inputCols=self.feature_names, outputCol="_raw"), *self._stages(float(n))]).fit(rows)
        return self

    def score(self, df: DataFrame) -> DataFrame:
        """df with p, the probability of a match, as a float."""
        scored = self.model.transform(self._filled(df))
        return scored.select(*df.columns, vector_to_array("probability")[1].cast("float").alias("p"))

    def importances(self) -> dict[str, float]:
        last = self.model.stages[-1]
        values = last.featureImportances.toArray() if hasattr(last, "featureImportances") else abs(last.coefficients.toArray())
        total = float(values.sum()) or 1.0
        return dict(sorted(zip(self.feature_names, (float(v) / total for v in values)), key=lambda x: -x[1]))

    def save(self, path: str, overwrite: bool = False) -> None:
        """The model, the token weights, and a row with the names of the features; a folder that exists stays unless it is to be overwritten."""
        writer, mode = self.model.write(), "overwrite" if overwrite else "errorifexists"
        (writer.overwrite() if overwrite else writer).save(f"{path}/model")
        spark = SparkSession.getActiveSession()
        spark.createDataFrame([(self.feature_names, float(self.default_idf), self.idf is not None)], "feature_names array<string>, default_idf double, has_idf boolean").coalesce(1).write.mode(mode).json(f"{path}/about")
        if self.idf is not None:
            self.idf.write.mode(mode).parquet(f"{path}/idf")

    def load(self, path: str) -> Matcher:
        spark = SparkSession.getActiveSession()
        self.model = PipelineModel.load(f"{path}/model")
        about = spark.read.schema("feature_names array<string>, default_idf double, has_idf boolean").json(f"{path}/about").first()
        self.feature_names, self.default_idf = list(about.feature_names), about.default_idf
        self.idf = spark.read.parquet(f"{path}/idf") if about.has_idf else None
        return self


@dataclass
class LogisticMatcher(Matcher):
    """L2-regularised logistic regression over standardised features; c is the inverse of the penalty over the weights' sum."""

    c: float = 1.0
    rounds: int = 1000

    def _stages(self, n: float) -> list:
        scaler = StandardScaler(inputCol="_raw", outputCol="features", withMean=True, withStd=True)
        return [scaler, LogisticRegression(featuresCol="features", labelCol="label", weightCol="_weight", maxIter=self.rounds, regParam=1.0 / (self.c * n), elasticNetParam=0.0, standardization=False)]


@dataclass
class BoostedMatcher(Matcher):
    """Gradient-boosted trees."""

    trees: int = 100
    rate: float = 0.05
    depth: int = 5
    least_rows: int = 10

    def _stages(self, n: float) -> list:
        return [GBTClassifier(featuresCol="_raw", labelCol="label", weightCol="_weight", maxIter=self.trees, stepSize=self.rate, maxDepth=self.depth, minInstancesPerNode=self.least_rows, seed=self.seed)]


def better(first: tuple[Matcher, float], second: tuple[Matcher, float]) -> Matcher:
    """Of two (matcher, macro F0.5) the better; the second among equals."""
    return first[0] if first[1] > second[1] else second[0]
