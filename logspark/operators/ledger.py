"""Model answers that are asked for once: a stored table of answers by a digest of model, prompt and text.

A text is looked up before the model is called. What it answers is appended to the table before anything else
uses it, so a batch that runs again, the same text in another batch, or a second use of a result calls nobody.
Failures are not stored; a later run asks again. Calls wait longer after each failure, and a run makes no more
than a given number of calls, failed ones included: each of its tasks has an equal share of them.
"""

from __future__ import annotations

import time
from collections.abc import Iterator
from dataclasses import dataclass

import pandas as pd
from pyspark.sql import Column, DataFrame, SparkSession, functions as F

from logspark.operators.infer import TextModel

ANSWERS = "digest string, answer string"
OVER_BUDGET = "not asked: the budget of calls is used up"


class CallShare:
    """The calls of one task; waits ``wait``, 2 * ``wait``, ... seconds between tries."""

    def __init__(self, model: TextModel, calls: int, wait: float):
        self.model, self.left, self.wait = model, calls, wait

    def answer(self, texts: list[str]) -> list[tuple[str | None, str | None]]:
        """(answer, error) per text. A batch that keeps failing is tried text by text, as long as calls are left."""
        error = OVER_BUDGET
        for attempt in range(self.model.attempts):
            if not self.left:
                return [(None, error)] * len(texts)
            if attempt:
                time.sleep(self.wait * 2 ** (attempt - 1))
            self.left -= 1
            try:
                answers = self.model.client(self.model.prompt, texts)
                if len(answers) != len(texts):
                    raise ValueError(f"{len(answers)} answers for {len(texts)} texts")
                return [(a, None) for a in answers]
            except Exception as failure:
                error = f"{type(failure).__name__}: {failure}"
        if len(texts) == 1:
            return [(None, error)]
        return [self.answer([text])[0] for text in texts]


@dataclass(frozen=True)
class AnswerLedger:
    """Stored answers below ``path``, by ``shares`` of the digests, so that a lookup joins shares of equal keys."""

    path: str
    model_name: str = "model"

    def digest(self, model: TextModel, text: Column) -> Column:
        return F.sha2(F.concat(F.lit(f"{self.model_name}\0{model.prompt}\0"), text), 256)

    def answers(self, spark: SparkSession) -> DataFrame:
        """Every stored answer once; two runs at a time may both have asked."""
        place = spark._jvm.org.apache.hadoop.fs.Path(self.path)
        if not place.getFileSystem(spark._jsc.hadoopConfiguration()).exists(place):
            return spark.createDataFrame([], ANSWERS)
        return spark.read.schema(ANSWERS).parquet(self.path).groupBy("digest").agg(F.min("answer").alias("answer"))

    def predict(
        self, df: DataFrame, model: TextModel, input_col: str, output_col: str | None = None, max_calls: int = 1000,
        callers: int = 1, wait: float = 1.0,
    ) -> DataFrame:
        """``df`` with the answers and an ``error`` column; null input gets neither. Asks at once, with at most ``max_calls`` calls."""
        if not 1 <= callers <= max_calls:
            raise ValueError("each caller needs a call at least")
        spark, name = df.sparkSession, output_col or model.output_col
        asked = df.withColumn("_digest", self.digest(model, F.col(input_col)))
        texts = asked.where(F.col("_digest").isNotNull()).groupBy(F.col("_digest").alias("digest")).agg(F.first(input_col).alias("text"))
        missing = texts.join(self.answers(spark).select("digest"), "digest", "left_anti").repartition(callers)
        share = max_calls // callers

        def ask(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
            calls = CallShare(model, share, wait)
            for batch in batches:
                for low in range(0, len(batch), model.batch_size):
                    part = batch.iloc[low : low + model.batch_size]
                    answers, errors = zip(*calls.answer(part["text"].tolist()))
                    yield pd.DataFrame({"digest": part["digest"].tolist(), "answer": answers, "error": errors})

        # Answers and errors are written at once, in one run of the model; only answers are read as known later.
        run = f"{self.path}-runs/{time.time_ns()}"
        missing.mapInPandas(ask, f"{ANSWERS}, error string").write.parquet(run)
        told = spark.read.schema(f"{ANSWERS}, error string").parquet(run)
        told.where(F.col("error").isNull()).select("digest", "answer").write.mode("append").parquet(self.path)
        failed = told.where(F.col("error").isNotNull()).select("digest", "error")
        found = self.answers(spark).withColumn("error", F.lit(None).cast("string")).unionByName(failed, allowMissingColumns=True)
        found = found.select(F.col("digest").alias("_digest"), F.col("answer").alias("_answer"), F.col("error").alias("_error"))
        joined = asked.join(found, "_digest", "left")
        return joined.select(*df.columns, F.col("_answer").alias(name), F.col("_error").alias("error"))
