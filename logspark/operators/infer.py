"""Calls to a text-generation model, one answer per row.

A model is a prompt and a client; a client is any callable that takes the prompt and a list of
texts and gives a list of answers. No client for a real service is included: pass your own.
"""

from __future__ import annotations

import json
from collections.abc import Callable, Iterator
from dataclasses import dataclass

import pandas as pd
from pyspark.sql import DataFrame, Row, SparkSession, functions as F, types as T
from pyspark.sql.udtf import AnalyzeArgument, AnalyzeResult

WARNING_PROMPT = (
    "A user of our company failed to log in several times. The input is one line of comma-separated values: "
    "language, first_name, last_name, mail, warning_count, failure_time, source_ip, details. "
    "Write to the user in their language and sum up what happened. "
    'Answer as JSON: {"mail": "<mail address>", "message": "<text>"}'
)

Client = Callable[[str, list[str]], list[str]]


def template_client(prompt: str, texts: list[str]) -> list[str]:
    """Stands in for a model: fills a fixed English sentence from the fields of the text."""
    answers = []
    for text in texts:
        _, first, last, mail, count, time, address, details = text.split(", ", 7)
        event = f"{count} warnings came before a failed login at {time} from {address}: {details}"
        message = f"Dear {first} {last}, {event}"
        answers.append(json.dumps({"mail": mail, "message": message}, ensure_ascii=False))
    return answers


@dataclass(frozen=True)
class TextModel:
    """A registered model: named input and output, prompt, client, and how often to try."""

    client: Client = template_client
    prompt: str = WARNING_PROMPT
    input_col: str = "failed_login"
    output_col: str = "user_mail"
    batch_size: int = 32
    attempts: int = 3

    def answer(self, texts: list[str]) -> list[tuple[str | None, str | None]]:
        """(answer, error) per text. A batch that keeps failing is tried text by text."""
        error = None
        for _ in range(self.attempts):
            try:
                answers = self.client(self.prompt, texts)
                if len(answers) != len(texts):
                    raise ValueError(f"{len(answers)} answers for {len(texts)} texts")
                return [(a, None) for a in answers]
            except Exception as failure:
                error = f"{type(failure).__name__}: {failure}"
        if len(texts) == 1:
            return [(None, error)]
        return [self.answer([text])[0] for text in texts]


def ml_predict(
    df: DataFrame, model: TextModel, input_col: str, output_col: str | None = None, callers: int | None = None
) -> DataFrame:
    """``df`` with the answer of the model and an ``error`` column; null input gets neither.

    Each partition calls the model on its own; ``callers`` sets how many do.

    Answers cost money and may differ each time: write the result before using it twice.
    """
    output_col = output_col or model.output_col
    out = T.StructType([T.StructField(output_col, T.StringType()), T.StructField("error", T.StringType())])
    size = model.batch_size

    @F.pandas_udf(out)
    def predict(batches: Iterator[pd.Series]) -> Iterator[pd.DataFrame]:
        for texts in batches:
            answers = [(None, None)] * len(texts)
            asked = [i for i, text in enumerate(texts) if text is not None]
            for low in range(0, len(asked), size):
                part = asked[low:low + size]
                for i, pair in zip(part, model.answer([texts.iloc[i] for i in part])):
                    answers[i] = pair
            yield pd.DataFrame(answers, columns=[output_col, "error"])

    predict = predict.asNondeterministic()
    spread = df.repartition(callers) if callers else df
    return spread.withColumn("_answer", predict(F.col(input_col))).select(*df.columns, "_answer.*")


def register_predict(spark: SparkSession, model: TextModel, name: str = "ml_predict") -> None:
    """Make the model a table function: ``SELECT ... FROM t, LATERAL ml_predict(text_column)``."""
    class Predict:
        def eval(self, text: str):
            yield (None, None) if text is None else model.answer([text])[0]

    spark.udtf.register(name, F.udtf(Predict, returnType=f"{model.output_col} string, error string"))


def register_predict_rows(spark: SparkSession, model: TextModel, name: str = "ml_predict_rows") -> None:
    """Make the model a table function over a whole table: ``SELECT * FROM ml_predict_rows(TABLE(t), 'text_column')``.

    Gives the rows with the answer and an ``error``. Each partition of the table hands its rows to the model in batches.
    """
    class PredictRows:
        def __init__(self):
            self.rows, self.texts = [], []

        @staticmethod
        def analyze(rows: AnalyzeArgument, text: AnalyzeArgument) -> AnalyzeResult:
            if text.value not in rows.dataType.names:
                raise ValueError(f"no such column: {text.value}")
            added = [T.StructField(n, T.StringType()) for n in (model.output_col, "error")]
            return AnalyzeResult(schema=T.StructType([*rows.dataType.fields, *added]))

        def eval(self, rows: Row, text: str):
            self.rows.append(tuple(rows))
            self.texts.append(rows[text])
            if len(self.rows) == model.batch_size:
                yield from self._answered()

        def terminate(self):
            if self.rows:
                yield from self._answered()

        def _answered(self):
            asked = [t for t in self.texts if t is not None]
            answers = iter(model.answer(asked) if asked else [])
            for row, text in zip(self.rows, self.texts):
                yield (*row, *(next(answers) if text is not None else (None, None)))
            self.rows, self.texts = [], []

    spark.udtf.register(name, F.udtf(PredictRows))
