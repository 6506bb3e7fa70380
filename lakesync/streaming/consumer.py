"""Message-triggered runs on Structured Streaming: every message is a JSON object of parameters for one run of a job.

A queue is a folder, <uri>/<queue>/, into which files of JSON lines are dropped; with an amqp: or amqps: uri messages are
fetched from the broker into such a folder beside the checkpoints, a file each. Messages of a micro-batch run in
order. Each run commits how far its queue has come together with its rows, so a micro-batch that is replayed after a
failure skips what was done. A message that is no JSON object, or whose run fails after its retries, goes to the
dead-letter table of its queue, and the rest goes on.
"""

from __future__ import annotations

import logging
from datetime import UTC, datetime
from threading import Thread

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.streaming import StreamingQuery

from ..functions.coerce import json_parameters
from ..functions.idents import parse_schema
from ..plans.config import Config, Queue
from ..plans.engine import SyncEngine
from .amqp import bridge

log = logging.getLogger(__name__)
DEAD_LETTERS = "queue:string,exchange:string,payload:string,error:string,failed_at:timestamp"
#: Message files that a micro-batch takes at most.
FILES_PER_BATCH = 100
#: Without a message for so long a broker's queue counts as empty when a run is to end.
IDLE_SECONDS = 2.0


class Consumer:
    def __init__(self, spark: SparkSession, engine: SyncEngine, config: Config, checkpoints: str):
        if config.rabbitmq is None:
            raise ValueError("Config has no 'rabbitmq' section")
        self.spark, self.engine, self.config, self.checkpoints = spark, engine, config, checkpoints.rstrip("/")

    def _dead(self, binding: Queue, payload: str, error: Exception) -> None:
        job = self.config.job(binding.job)
        catalog = self.engine.catalog(job.destination)
        catalog.create_namespace("dead_letters")
        name = "".join(c if c.isalnum() else "_" for c in binding.queue)
        table, _ = catalog.create_table(f"dead_letters.{name}", schema := parse_schema(DEAD_LETTERS))
        row = (binding.queue, binding.dead_letter_exchange, payload, str(error)[:2000], datetime.now(UTC).replace(tzinfo=None))
        table.append(self.spark.createDataFrame([row], schema))

    def handle(self, binding: Queue, messages: DataFrame, batch_id: int) -> None:
        """Run the job for each message of a micro-batch."""
        job, key = self.config.job(binding.job), f"sync.stream.{binding.queue}"
        catalog = self.engine.catalog(job.destination)
        held = catalog.load(job.full_name).metadata().properties.get(key) if catalog.exists(job.full_name) else None
        done = tuple(map(int, held.split(":"))) if held else (-1, -1)
        rows = messages.where(F.length(F.trim("value")) > 0).select("value", F.col("_metadata.file_path").alias("file"), F.monotonically_increasing_id().alias("at"))
        for k, row in enumerate(rows.orderBy("file", "at").toLocalIterator()):
            if (batch_id, k) <= done:
                continue
            try:
                parameters = json_parameters(row["value"])
                summary = self.engine.run(job, parameters, {key: f"{batch_id}:{k}"})
                log.info("Queue '%s': job '%s' wrote %d rows", binding.queue, job.name, summary.rows_written)
            except Exception as error:  # noqa: BLE001  kept beside its message
                log.error("Queue '%s': %s", binding.queue, error)
                self._dead(binding, row["value"], error)

    @property
    def broker(self) -> bool:
        return self.config.rabbitmq.uri.startswith(("amqp:", "amqps:"))

    def folder(self, binding: Queue) -> str:
        """Where the messages of a queue are read from."""
        return f"{f'{self.checkpoints}/messages' if self.broker else self.config.rabbitmq.uri.rstrip('/')}/{binding.queue}"

    def fetch(self, binding: Queue, idle: float | None = None) -> int:
        """Messages of a broker's queue to its folder, until none comes for `idle` seconds."""
        from ..sources.files import Files

        return bridge(self.config.rabbitmq.uri, binding, lambda name, text: Files(self.spark).create(f"{self.folder(binding)}/{name}", text), idle=idle)

    def start(self, binding: Queue, once: bool = False) -> StreamingQuery:
        """A streaming query for one queue; once: end when all messages that are there have run."""
        from ..sources.files import Files

        folder = self.folder(binding)
        Files(self.spark).mkdirs(folder)
        messages = self.spark.readStream.format("text").option("maxFilesPerTrigger", FILES_PER_BATCH).load(folder).select("value", "_metadata")
        writer = messages.writeStream.queryName(f"sync {binding.queue}").option("checkpointLocation", f"{self.checkpoints}/{binding.queue}")
        writer = writer.foreachBatch(lambda df, batch_id: self.handle(binding, df, batch_id))
        return (writer.trigger(availableNow=True) if once else writer.trigger(processingTime="1 second")).start()

    def run(self, once: bool = False) -> None:
        """All queues, each by a query of its own, until they end."""
        if self.broker:
            for binding in self.config.rabbitmq.queues:
                if once:
                    self.fetch(binding, IDLE_SECONDS)
                else:
                    Thread(target=self.fetch, args=(binding,), daemon=True, name=f"fetch {binding.queue}").start()
        queries = [self.start(binding, once) for binding in self.config.rabbitmq.queues]
        for query in queries:
            query.awaitTermination()
