"""Batch jobs at a provider: send requests in files, wait, and collect what came back.

The frames are distributed; what the driver holds is one file at a time, as uploads are calls of a
provider. What was offered is stored with the job, so that ids in replies mean what they meant when
they were sent, whatever the tables say by then.
"""

from __future__ import annotations

import json
import time
import urllib.request
import uuid
from collections.abc import Callable
from dataclasses import dataclass, field
from typing import Protocol

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ..functions.text import composite_id
from ..operators import batching, relational, resolve
from ..sources import files
from . import providers
from .stages import PROMPT_VERSION, TASK


class Client(Protocol):
    def submit(self, content: bytes) -> str:
        """Uploads a file of requests and starts a batch; its id."""

    def status(self, batch: str) -> str:
        """The batch's state."""

    def result(self, batch: str) -> bytes:
        """The file of replies of an ended batch, empty if there is none."""


@dataclass
class LocalClient:
    """Answers requests at once by a function, for runs without a provider."""

    answer: Callable[[dict], str | None]
    done: dict[str, bytes] = field(default_factory=dict)

    def submit(self, content: bytes) -> str:
        out = []
        for line in content.decode().splitlines():
            request = json.loads(line)
            reply = self.answer(request)
            if reply is not None:
                out.append(json.dumps({"custom_id": request["custom_id"], "response": {"body": {"choices": [{"message": {"content": reply}}]}}}))
        batch = f"batch-{len(self.done)}"
        self.done[batch] = "\n".join(out).encode()
        return batch

    def status(self, batch: str) -> str:
        return "completed"

    def result(self, batch: str) -> bytes:
        return self.done[batch]


@dataclass
class HttpClient:
    """The usual files and batches API."""

    base: str
    key: str
    timeout: float = 180.0

    def submit(self, content: bytes) -> str:
        mark = uuid.uuid4().hex
        head = f'--{mark}\r\nContent-Disposition: form-data; name="purpose"\r\n\r\nbatch\r\n--{mark}\r\nContent-Disposition: form-data; name="file"; filename="requests.jsonl"\r\nContent-Type: application/jsonl\r\n\r\n'
        body = head.encode() + content + f"\r\n--{mark}--\r\n".encode()
        request = urllib.request.Request(f"{self.base.rstrip('/')}/files", body, {"Authorization": f"Bearer {self.key}", "Content-Type": f"multipart/form-data; boundary={mark}"}, method="POST")
        with urllib.request.urlopen(request, timeout=self.timeout) as reply:
            file = json.loads(reply.read())["id"]
        made = providers.post_json(f"{self.base.rstrip('/')}/batches", self.key, {"input_file_id": file, "endpoint": batching.ENDPOINT, "completion_window": "24h"}, self.timeout)
        return made["id"]

    def _batch(self, batch: str) -> dict:
        return json.loads(providers.get_bytes(f"{self.base.rstrip('/')}/batches/{batch}", self.key, self.timeout))

    def status(self, batch: str) -> str:
        return self._batch(batch)["status"]

    def result(self, batch: str) -> bytes:
        file = self._batch(batch).get("output_file_id")
        return providers.get_bytes(f"{self.base.rstrip('/')}/files/{file}/content", self.key, self.timeout) if file else b""


def submit(rows: DataFrame, client: Client, folder: str, kind: str, model: str, system: str, payload: str = "payload", top_k: int = 0, most: int = batching.TARGET_BYTES) -> DataFrame:
    """Send a request for each row of (TimelineName, TaskRowId, payload, …); returns the rows too large to send."""
    spark = rows.sparkSession
    rows.write.mode("overwrite").parquet(f"{folder}/snapshot")
    rows = spark.read.parquet(f"{folder}/snapshot")
    line = batching.request_line(composite_id(*map(F.col, TASK)), model, system, F.col(payload))
    fits, skipped = batching.split_oversize(rows.select(*TASK, line.alias("line")), most=most)
    # Chunks are filled timeline by timeline, so that packing runs for timelines side by side.
    chunks = batching.pack(fits.withColumn("group", F.sha2("TimelineName", 256)), "group", "TaskRowId", "bytes", most).select("group", F.col("TaskRowId").alias("position"), "chunk")
    placed = fits.withColumn("group", F.sha2("TimelineName", 256)).withColumn("position", F.col("TaskRowId")).join(chunks, ["group", "position"])
    files.write_requests(placed, f"{folder}/requests")
    batches = []
    for name in [r.file for r in spark.read.text(f"{folder}/requests").select("file").distinct().orderBy("file").collect()]:
        part = spark.read.text(f"{folder}/requests/file={name}", wholetext=True).collect()
        batches.append(client.submit("".join(r.value for r in part).encode()))
    files.write_manifest(spark, f"{folder}/manifest", created_at=time.strftime("%Y-%m-%dT%H:%M:%S"), kind=kind, model=model, prompt_version=PROMPT_VERSION, top_k=top_k, batch_ids=batches, snapshot=f"{folder}/snapshot")
    return skipped


def collect(spark: SparkSession, client: Client, folder: str, sleep: Callable[[float], None] = time.sleep, every: float = 60.0) -> DataFrame:
    """The snapshot's rows with ``reply``, null where none came back; of several for one row the last counts."""
    manifest = files.read_manifest(spark, f"{folder}/manifest")
    for k, batch in enumerate(manifest["batch_ids"]):
        if batching.wait(lambda b=batch: client.status(b), sleep, every) == "completed":
            lines = [(x,) for x in client.result(batch).decode().splitlines()]
            spark.createDataFrame(lines, "value string").coalesce(1).write.mode("overwrite").text(f"{folder}/replies/{k:06d}")
        else:
            spark.createDataFrame([], "value string").write.mode("overwrite").text(f"{folder}/replies/{k:06d}")
    rows = spark.read.parquet(manifest["snapshot"]).withColumn("custom_id", composite_id(*map(F.col, TASK)))
    if not manifest["batch_ids"]:
        return rows.withColumn("reply", F.lit(None).cast("string")).drop("custom_id")
    found = batching.replies(files.read_lines(spark, f"{folder}/replies/*")).withColumnRenamed("content", "reply")
    return relational.fill_missing(rows, found, ["custom_id"], {"reply": None}).drop("custom_id")


def collected_classes(collected: DataFrame) -> DataFrame:
    """Classes of collected replies; the fallback where none came back."""
    return collected.select("*", *providers.classification(F.col("reply"))).drop("reply")


def collected_links(collected: DataFrame) -> DataFrame:
    """Checked results of collected replies, by what was offered when they were sent."""
    return collected.select(*TASK, resolve.validated(F.col("reply"), F.col("offered")).alias("result"))
