"""Where streams go: appended tables, keyed tables, and the flow from failed logins to messages."""

from __future__ import annotations

from collections.abc import Callable, Mapping
from dataclasses import dataclass

from pyspark.sql import DataFrame, SparkSession, functions as F, types as T
from pyspark.sql.streaming import DataStreamWriter, StreamingQuery

from logspark.operators.enrich import enrich_users
from logspark.operators.infer import TextModel, ml_predict
from logspark.operators.keyed import KeyedTable, upsert_latest
from logspark.schemas import ENRICHED_FAILED_LOGINS_DDL, FAILED_LOGIN_ATTEMPTS_DDL, GENERATED_MESSAGES_DDL


def start(
    writer: DataStreamWriter, available_now: bool, trigger: Mapping, path: str | None = None
) -> StreamingQuery:
    """Start a stream that takes in what is there and stops, or one that runs by ``trigger``."""
    options = {"availableNow": True} if available_now else trigger
    return (writer.trigger(**options) if options else writer).start(path)


@dataclass(frozen=True)
class BatchTable:
    """One folder per batch id."""

    path: str

    def folder(self, batch_id: int) -> str:
        return f"{self.path}/batch_id={batch_id}"

    def write(self, df: DataFrame, batch_id: int) -> None:
        df.write.mode("overwrite").parquet(self.folder(batch_id))

    def drop(self, spark: SparkSession, batch_id: int) -> None:
        path = spark._jvm.org.apache.hadoop.fs.Path(self.folder(batch_id))
        path.getFileSystem(spark._jsc.hadoopConfiguration()).delete(path, True)

    def read(self, spark: SparkSession, schema: T.StructType | str, batch_id: int) -> DataFrame:
        """The rows of one batch; none before the first."""
        if batch_id < 0:
            return spark.createDataFrame([], schema)
        return spark.read.schema(schema).parquet(self.folder(batch_id))


def append_stream(df: DataFrame, path: str, checkpoint: str, available_now: bool = True, **trigger) -> StreamingQuery:
    """Append rows to a Parquet table, each batch once."""
    writer = df.writeStream.format("parquet").outputMode("append").option("checkpointLocation", checkpoint)
    return start(writer, available_now, trigger, path)


def upsert_stream(
    df: DataFrame, table: KeyedTable, checkpoint: str, available_now: bool = True, **trigger
) -> StreamingQuery:
    """Write each batch of changes to a keyed table; a replayed batch replaces itself."""
    writer = df.writeStream.foreachBatch(table.write).option("checkpointLocation", checkpoint)
    return start(writer, available_now, trigger)


@dataclass(frozen=True)
class LoginTables:
    """The tables between a failed login and a message, below one folder."""

    path: str

    def _table(self, name: str, ddl: str, mode: str, order: tuple[str, ...] = ()) -> KeyedTable:
        return KeyedTable(f"{self.path}/{name}", ddl, ("username",), mode, order)

    @property
    def attempts(self) -> KeyedTable:
        return self._table("failed_login_attempts", FAILED_LOGIN_ATTEMPTS_DDL, "upsert", ("failure_time",))

    @property
    def enriched(self) -> KeyedTable:
        return self._table("enriched_failed_logins", ENRICHED_FAILED_LOGINS_DDL, "append")

    @property
    def answers(self) -> KeyedTable:
        return self._table("model_answers", f"{GENERATED_MESSAGES_DDL}, error string", "append")

    @property
    def messages(self) -> KeyedTable:
        return self._table("generated_messages", GENERATED_MESSAGES_DDL, "upsert")


def message_step(
    users: DataFrame, tables: LoginTables, model: TextModel | None = None
) -> Callable[[DataFrame, int], None]:
    """What to do with the suspicious logins of a micro-batch: keep, enrich, ask the model, keep the answers.

    Each step reads what the one before has stored for the batch, so the matches are computed once
    and the model is asked once per enriched row. A batch that failed half-way runs again and
    replaces what it had written. Texts the model failed on stay in the answers with their error.
    """
    model = model or TextModel()

    def step(matches: DataFrame, batch_id: int) -> None:
        spark = matches.sparkSession
        # Matches of one instant are told apart by log_id, so a replay keeps the same one.
        if "log_id" in matches.columns:
            matches = upsert_latest(matches, "username", ("failure_time", "log_id"))
        tables.attempts.write(matches, batch_id)
        tables.enriched.write(enrich_users(tables.attempts.batch(spark, batch_id), users), batch_id)
        texts = tables.enriched.batch(spark, batch_id)
        tables.answers.write(ml_predict(texts, model, "big_string", "email_message"), batch_id)
        tables.messages.write(tables.answers.batch(spark, batch_id).filter(F.col("error").isNull()), batch_id)

    return step


def login_messages_stream(
    matches: DataFrame,
    users: DataFrame,
    tables: LoginTables,
    checkpoint: str,
    model: TextModel | None = None,
    available_now: bool = True,
    **trigger,
) -> StreamingQuery:
    """From a stream of suspicious logins to stored messages."""
    step = message_step(users, tables, model)
    writer = matches.writeStream.foreachBatch(step).option("checkpointLocation", checkpoint)
    return start(writer, available_now, trigger)
