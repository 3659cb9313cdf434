"""Model providers: the one place where rows leave Spark. All are called inside tasks, by partition.

A provider is an object that can be sent to executors. ``RuleClassifier``, ``HashEmbedder`` and
``ReplayResolver`` need no network; ``HttpChat`` and ``HttpEmbedder`` speak the usual JSON API.
"""

from __future__ import annotations

import json
import time
import urllib.request
from collections.abc import Callable, Iterator, Sequence
from dataclasses import dataclass, field
from typing import Protocol

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F


class Classifier(Protocol):
    def classify(self, name: str, clean: str, wbs: str) -> str:
        """A JSON reply with task_class, confidence and reason_short."""


class Embedder(Protocol):
    model: str

    def embed(self, texts: Sequence[str]) -> list[Sequence[float]]:
        """A vector for each text."""


class Resolver(Protocol):
    def resolve(self, payload: str) -> str:
        """A JSON reply with the links of a task."""


CLASSIFIER_PROMPT = (
    "Decide whether a schedule task is progress on an engineering document (its issue, review, approval, revision, delivery or update): ENG_DOC. "
    "All else is OTHER: purchasing and material steps, building and installing, tests and commissioning, meetings, milestones, site work, manufacturing. "
    "The wbs_name is context only. When unsure answer OTHER with LOW or MEDIUM confidence. "
    'Reply with JSON only: {"task_class": "ENG_DOC" or "OTHER", "confidence": "HIGH", "MEDIUM" or "LOW", "reason_short": "a short reason in English"}'
)
RESOLVER_PROMPT = (
    "Choose which of the offered register documents a schedule task makes progress on: none, one or several, and only those it clearly names. Be conservative. "
    "Shared discipline, chapter, category or broad words are no reason, nor is similarity; purchasing, logistics, construction, tests, meetings and milestones never link. "
    "Weigh the document title against task_name_clean first, then RACI title and description; the rest is weak support. With LOW task_class_confidence prefer none. "
    "Confidence: 0.9 and more for the same document, 0.75 for a strong match, 0.5 for a plausible one; leave out less. "
    'Reply with JSON only: {"links": [{"candidate_id": 1, "confidence": 0.0, "reason_short": "a short reason in English"}]}'
)
FALLBACK_REASON = "LLM unavailable or invalid response"


@dataclass
class RuleClassifier:
    """Classifies by words, for runs without a model."""

    documents: Sequence[str] = ("datasheet", "drawing", "specification", "report", "p&id", "document", "review", "revision", "approval", "relazione", "issue")
    others: Sequence[str] = ("purchase", "po ", "rfq", "order", "install", "construct", "commission", "meeting", "milestone", "test", "vendor")

    def classify(self, name: str, clean: str, wbs: str) -> str:
        low = f"{clean} ".lower()
        other = next((w for w in self.others if w in low), None)
        document = next((w for w in self.documents if w in low), None)
        label, word, sure = ("OTHER", other, "MEDIUM") if other or not document else ("ENG_DOC", document, "HIGH")
        return json.dumps({"task_class": label, "confidence": sure if word else "LOW", "reason_short": f"word: {word}" if word else "no known word"})


@dataclass
class HashEmbedder:
    """Vectors from hashed words and word pairs, for runs without a model; the same everywhere."""

    dim: int = 64
    model: str = "hash-64"

    def embed(self, texts: Sequence[str]) -> list[Sequence[float]]:
        import zlib

        out = []
        for text in texts:
            v = np.zeros(self.dim, np.float32)
            words = text.lower().split()
            for part in words + [f"{a} {b}" for a, b in zip(words, words[1:], strict=False)]:
                h = zlib.crc32(part.encode())
                v[h % self.dim] += 1 if h >> 16 & 1 else -1
            out.append(v)
        return out


@dataclass
class ReplayResolver:
    """Replies from a list by a part of the payload; the best candidate otherwise."""

    replies: dict[str, str] = field(default_factory=dict)

    def resolve(self, payload: str) -> str:
        for part, reply in self.replies.items():
            if part in payload:
                return reply
        best = json.loads(payload)["candidates"][:1]
        return json.dumps({"links": [{"candidate_id": c["candidate_id"], "confidence": max(0.0, c["similarity"]), "reason_short": "nearest"} for c in best]})


def retrying(call: Callable[[], str], retries: int, backoff: float, sleep: Callable[[float], None] = time.sleep) -> str:
    """Calls once and up to ``retries`` times more, waiting longer each time; raises the last failure."""
    for attempt in range(max(0, retries) + 1):
        try:
            return call()
        except Exception:
            if attempt >= retries:
                raise
            sleep(max(0.0, backoff) * (attempt + 1))
    raise AssertionError


def post_json(url: str, key: str, body: dict, timeout: float) -> dict:
    request = urllib.request.Request(url, json.dumps(body).encode(), {"Authorization": f"Bearer {key}", "Content-Type": "application/json"}, method="POST")
    with urllib.request.urlopen(request, timeout=timeout) as reply:
        return json.loads(reply.read())


def get_bytes(url: str, key: str, timeout: float) -> bytes:
    """The content of a result file."""
    with urllib.request.urlopen(urllib.request.Request(url, headers={"Authorization": f"Bearer {key}"}), timeout=timeout) as reply:
        return reply.read()


@dataclass
class HttpChat:
    """A classifier and resolver over a chat API."""

    base: str
    key: str
    model: str
    timeout: float = 60.0

    def _ask(self, system: str, user: str) -> str:
        messages = [{"role": "system", "content": system}, {"role": "user", "content": user}]
        reply = post_json(f"{self.base.rstrip('/')}/chat/completions", self.key, {"model": self.model, "temperature": 0, "messages": messages}, self.timeout)
        return reply["choices"][0]["message"]["content"]

    def classify(self, name: str, clean: str, wbs: str) -> str:
        return self._ask(CLASSIFIER_PROMPT, json.dumps({"task_name": name, "task_name_clean": clean, "wbs_name": wbs}, ensure_ascii=False))

    def resolve(self, payload: str) -> str:
        return self._ask(RESOLVER_PROMPT, payload)


@dataclass
class HttpEmbedder:
    """An embedder over an embeddings API."""

    base: str
    key: str
    model: str
    timeout: float = 60.0

    def embed(self, texts: Sequence[str]) -> list[Sequence[float]]:
        reply = post_json(f"{self.base.rstrip('/')}/embeddings", self.key, {"model": self.model, "input": list(texts)}, self.timeout)
        return [item["embedding"] for item in reply["data"]]


def _schema(rows: DataFrame, more: str) -> str:
    return ", ".join(f"`{f.name}` {f.dataType.simpleString()}" for f in rows.schema) + more


def ask(rows: DataFrame, inputs: Sequence[str], call: Callable[..., str], output: str = "reply", workers: int = 0) -> DataFrame:
    """Adds the reply to each row's inputs; null where the call fails. ``workers`` sets how many run at a time."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            replies = []
            for values in zip(*(batch.column(c).to_pylist() for c in inputs), strict=True):
                try:
                    replies.append(call(*(v or "" for v in values)))
                except Exception:  # noqa: BLE001  a provider may fail in any way; the row says so
                    replies.append(None)
            yield pa.RecordBatch.from_arrays([*batch.columns, pa.array(replies, pa.string())], [*batch.schema.names, output])

    return (rows.repartition(workers) if workers else rows).mapInArrow(run, _schema(rows, f", `{output}` string"))


def embed(rows: DataFrame, text: str, embedder: Embedder, batch: int = 256) -> DataFrame:
    """Adds Embedding (of unit length; a zero vector stays), Dim and EmbeddingModel, ``batch`` texts a call."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for own in batches:
            vectors: list[np.ndarray] = []
            texts = [t or "" for t in own.column(text).to_pylist()]
            for at in range(0, len(texts), batch):
                for v in embedder.embed(texts[at : at + batch]):
                    v = np.asarray(v, np.float32)
                    size = float(np.linalg.norm(v))
                    vectors.append(v / size if size else v)
            more = [pa.array(vectors, pa.list_(pa.float32())), pa.array([len(v) for v in vectors], pa.int32()), pa.array([embedder.model] * len(texts), pa.string())]
            yield pa.RecordBatch.from_arrays([*own.columns, *more], [*own.schema.names, "Embedding", "Dim", "EmbeddingModel"])

    return rows.mapInArrow(run, _schema(rows, ", Embedding array<float>, Dim int, EmbeddingModel string"))


def classification(reply) -> list:
    """Columns of a classifier's reply: class, confidence and reason, with the fallback for replies that are no object."""
    from ..functions.text import REASON_LIMIT, clipped, confidence_label, strip_fence, task_class

    v = F.try_parse_json(strip_fence(reply))
    get = lambda name: F.try_variant_get(v, f"$.{name}", "string")
    read = F.coalesce(F.schema_of_variant(v).startswith("OBJECT"), F.lit(False))
    label = task_class(get("task_class"))
    absent = F.try_variant_get(v, "$.task_class", "variant").isNull()
    reason = F.when(read & (label.isNotNull() | absent), F.coalesce(get("reason_short"), F.lit(""))).otherwise(FALLBACK_REASON)
    sure = F.when(read & (label.isNotNull() | absent), confidence_label(get("confidence"))).otherwise("LOW")
    return [F.when(read, F.coalesce(label, F.lit("OTHER"))).otherwise("OTHER").alias("TaskClass"), sure.alias("TaskClassConfidence"), clipped(reason, REASON_LIMIT).alias("TaskClassReason")]
