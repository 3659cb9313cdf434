"""Candidates and their retrieval: the best of each task's block by cosine similarity."""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from ..functions.text import candidate_text, is_filled, text_hash, title_key
from ..functions.vectors import dot, same_size

TOP_K = 30
METHOD = "embedding_cosine_topk"
#: Vectors in a chunk of queries and of candidates; a task scores one pair of chunks at a time.
QUERY_CHUNK, CANDIDATE_CHUNK = 1024, 4096


def build_candidates(register: DataFrame, consolidated: DataFrame, descriptions: DataFrame, enriched: DataFrame) -> DataFrame:
    """Matched documents of the register with what is known of them, their text and its hash.

    The register is made distinct before the join; titles that are null or blank are left out.
    """
    documents = register.where(is_filled(F.col("Document_title"))).select("Document_title", F.col("Mdr_code_name_ref").alias("TimelineName")).distinct()
    matched = consolidated.where(F.col("ConsolidatedDecisionType") == "MATCH")
    rows = documents.join(matched, "Document_title")
    rows = rows.join(descriptions, rows["ConsolidatedTitleKey"] == descriptions["TitleKey"], "left").drop("TitleKey")
    rows = rows.join(enriched, rows["ConsolidatedTitleKey"] == enriched["TitleKey"], "left").drop("TitleKey")
    rows = rows.withColumnRenamed("Document_title", "MdrDocumentTitle").withColumn("MdrTitleKey", title_key(F.col("MdrDocumentTitle")))
    text = candidate_text(*map(F.col, ("MdrDocumentTitle", "ConsolidatedRaciTitle", "EffectiveDescription", "DisciplineName", "TypeName", "CategoryDescription", "ChapterName")))
    return rows.distinct().withColumn("CandidateText", text).withColumn("TextHash", text_hash(F.col("CandidateText")))


def topk_by_expression(queries: DataFrame, candidates: DataFrame, block: str, k: int) -> DataFrame:
    """(block, query, candidate, similarity, rank) from frames of (block, query|candidate, vector).

    A join on the block, scored in generated code; a limit per group is pushed below the shuffle.
    """
    right = candidates.withColumnRenamed("vector", "_other")
    scored = queries.join(right, block).select(block, "query", "candidate", F.coalesce(same_size(F.col("vector"), F.col("_other")), dot(F.col("vector"), F.col("_other"))).alias("similarity"))
    return _ranked(scored, block, k)


def _ranked(scored: DataFrame, block: str, k: int) -> DataFrame:
    place = F.row_number().over(Window.partitionBy(block, "query").orderBy(F.desc("similarity"), "candidate"))
    return scored.withColumn("rank", place).where(F.col("rank") <= k)


def _chunks(df: DataFrame, block: str, key: str, size: int, name: str) -> DataFrame:
    """Vectors by block in chunks of about ``size``, each one row."""
    sizes = df.groupBy(block).agg(F.ceil(F.count("*") / F.lit(size)).cast("int").alias("_chunks"))
    placed = df.join(sizes, block).withColumn("_chunk", F.pmod(F.xxhash64(key), F.col("_chunks")).cast("int"))
    return placed.groupBy(block, "_chunk").agg(F.collect_list(F.struct(F.col(key).alias("id"), "vector")).alias(name)).withColumnRenamed("_chunk", f"{name}_chunk")


def topk_by_blocks(queries: DataFrame, candidates: DataFrame, block: str, k: int = TOP_K) -> DataFrame:
    """The same result by matrix products over pairs of chunks.

    A block of any size is dealt out as pairs of bounded chunks, so a large block keeps many tasks busy,
    and each pair hands on at most k rows for a query. Ids are longs.
    """
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for row in range(batch.num_rows):
                (qi, a), (ci, b) = (_matrix(batch.column(c)[row].values) for c in ("q", "c"))
                if a.shape[1] != b.shape[1]:
                    raise ValueError(f"vector sizes differ: {a.shape[1]} and {b.shape[1]}")
                s = np.round(a @ b.T, 12)
                top = np.lexsort((np.broadcast_to(ci, s.shape), -s), axis=1)[:, :k]
                at = np.repeat(np.arange(len(qi)), top.shape[1])
                block_value = pa.array([batch.column(block)[row].as_py()] * len(at), batch.schema.field(block).type)
                yield pa.RecordBatch.from_arrays([block_value, pa.array(qi[at]), pa.array(ci[top.ravel()]), pa.array(s[at, top.ravel()])], [block, "query", "candidate", "similarity"])

    q = _chunks(queries, block, "query", QUERY_CHUNK, "q")
    c = _chunks(candidates, block, "candidate", CANDIDATE_CHUNK, "c")
    pairs = q.join(c, block).repartition(F.xxhash64(block, "q_chunk", "c_chunk"))
    scored = pairs.select(block, "q", "c").mapInArrow(run, f"`{block}` {dict(queries.dtypes)[block]}, query long, candidate long, similarity double")
    return _ranked(scored, block, k)


def _matrix(rows: pa.StructArray) -> tuple[np.ndarray, np.ndarray]:
    ids, vectors = rows.field("id").to_numpy(), rows.field("vector")
    flat = vectors.flatten().to_numpy(zero_copy_only=False).astype(np.float64)
    if len(flat) % max(len(ids), 1):
        raise ValueError("vector sizes differ")
    return ids, flat.reshape(len(ids), -1)
