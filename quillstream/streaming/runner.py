"""Runs the ingestion plan over a stream of files or notifications.

The checkpoint makes input exactly-once; a batch is written as a version of the index under the batch's number, so a
batch that is replayed after a failure changes nothing. Dead letters go to a folder named by batch, overwritten on replay.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ..config import Settings
from ..functions.text import utc_stamp
from ..operators.index import Store
from ..plans import ingest
from ..sources import admission
from ..sources import files as file_source


class PiiBreaker:
    """Stops the stream after so many batches in a row in which no document could be scanned."""

    def __init__(self, most: int):
        self.most, self.failed = most, 0

    def see(self, scanned: int, unscanned: int) -> None:
        self.failed = self.failed + 1 if unscanned and not scanned else 0
        if self.failed >= self.most:
            raise RuntimeError(f"personal data could not be scanned in {self.failed} batches in a row")


def step(store: Store, dead: str, s: Settings, model=None, entities=None, service=None) -> Callable[[DataFrame, int], None]:
    """What foreachBatch runs. Files whose content could not be read (read_error) are dead letters of the read stage."""
    breaker = PiiBreaker(s.pii_breaker)

    def run(batch: DataFrame, number: int) -> None:
        unread = None
        if "read_error" in batch.columns:
            batch = batch.persist()
            unread = ingest.letters(batch.where("read_error is not null").select("file_path", F.lit("read").alias("stage"), F.col("read_error").alias("reason")))
            docs = ingest.documents(batch.where("read_error is null").drop("read_error"), s=s)
        else:
            docs = ingest.documents(batch, s=s)
        other = entities is not None or service is not None
        # a service is asked once a chunk: what it said is kept for the breaker, the index and the letters
        found = ingest.scanned(docs, s, entities, service).persist() if other else None
        made = (ingest.embedded(found, s, model) if other else ingest.chunks(docs, s, model)).persist()
        try:
            halted = None
            if other:
                seen = found.agg(F.count_if(F.col("pii_status") == "ok").alias("ok"), F.count_if(F.col("pii_status").isin("failed", "partial")).alias("bad")).first()
                breaker.see(seen.ok, seen.bad)
                halted = found.where(F.col("pii_status").isin("failed", "partial")) if s.pii_policy == "halt" else None
            ingest.upsert(store, made, number)
            failed = ingest.dead_letters(ingest.status(docs, made, halted))
            (failed if unread is None else failed.unionByName(unread)).write.mode("overwrite").json(f"{dead}/batch={number}")
        finally:
            for held in (made, found, batch if unread is not None else None):
                if held is not None:
                    held.unpersist()

    return run


def ingest_files(spark: SparkSession, root: str, store: Store, checkpoint: str, dead: str, s: Settings = Settings(), describe: Callable[[DataFrame], DataFrame] | None = None, once: bool = True, model=None, service=None):
    """Starts the stream over the files under root. describe adds source_type and source_url."""
    found = file_source.read_files(spark, root, s, streaming=True)
    return _start(found, step(store, dead, s, model, service=service), checkpoint, describe, once)


def ingest_notified(spark: SparkSession, mode: str, messages: str, root: str, store: Store, checkpoint: str, dead: str, s: Settings = Settings(), describe: Callable[[DataFrame], DataFrame] | None = None, once: bool = True, model=None, service=None):
    """Starts the stream over messages that name files under root: a folder of text files, a message a line. In mode
    "event" a message is one notification; in mode "queue" one or a list, bare or under data. Exactly one mode runs.

    Files are read by the tasks that hold their notifications; what is not admitted is left out with its reason counted
    by admission.admit, and malformed messages are dead letters of the admit stage.
    """
    if mode not in ("event", "queue"):
        raise ValueError(f"mode must be event or queue, not {mode}")
    lines = spark.readStream.text(messages)
    if mode == "event":
        lines = lines.where(~F.coalesce(F.ltrim("value").startswith("["), F.lit(False)))
    run = step(store, dead, s, model, service=service)

    def files(batch: DataFrame, number: int) -> None:
        lost = admission.malformed(batch).select(F.col("value").alias("file_path"), F.lit("admit").alias("stage"), "reason")
        ingest.letters(lost).write.mode("overwrite").json(f"{dead}/messages-batch={number}")
        admitted = admission.admit(admission.unwrap(batch), s).where("reject_reason is null").select("blob_path").distinct()
        read = file_source.fetch(admitted, root, s).select(F.col("blob_path").alias("file_path"), "length", utc_stamp(F.current_timestamp()).alias("last_modified"), "content", "read_error")
        run(describe(read) if describe else read, number)

    out = lines.writeStream.foreachBatch(files).option("checkpointLocation", checkpoint)
    return (out.trigger(availableNow=True) if once else out).start()


def _start(found: DataFrame, run: Callable[[DataFrame, int], None], checkpoint: str, describe: Callable[[DataFrame], DataFrame] | None, once: bool):
    out = (describe(found) if describe else found).writeStream.foreachBatch(run).option("checkpointLocation", checkpoint)
    return (out.trigger(availableNow=True) if once else out).start()
