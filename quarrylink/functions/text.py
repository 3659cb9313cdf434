"""String expressions over columns. A null is an empty string unless a function says otherwise."""

from __future__ import annotations

import re

from pyspark.sql import Column
from pyspark.sql import functions as F

from .expr import bind, text_or_empty

#: The domains of labels, and limits of stored texts.
TASK_CLASSES, FALLBACK_CLASS = ("ENG_DOC", "OTHER"), "OTHER"
CONFIDENCES, FALLBACK_CONFIDENCE = ("HIGH", "MEDIUM", "LOW"), "LOW"
REASON_LIMIT, ERROR_LIMIT, CELL_LIMIT = 300, 500, 32767
PREFIX_LIMIT = 4
FENCE = "```"


def normalize(value: Column) -> Column:
    """Lower case, ``&`` spelt out, parentheses dropped, everything but a-z and 0-9 one space."""
    spelt = F.replace(F.lower(text_or_empty(value)), F.lit("&"), F.lit(" and "))
    bare = F.regexp_replace(spelt, r"\([^)]*\)", " ")
    return F.trim(F.regexp_replace(bare, r"[^a-z0-9]+", " "))


def remove_prefix(value: Column) -> Column:
    """Drops what stands before the first ``-``, with it, if that is at most four characters."""
    t = F.trim(text_or_empty(value))
    dash = F.instr(t, "-")
    return F.when(dash.between(1, PREFIX_LIMIT + 1), F.trim(F.substr(t, dash + 1))).otherwise(t)


def extract_project_code(value: Column) -> Column:
    """The first run of four or more digits; the whole name if there is none. Null stays null."""
    found = F.regexp_extract(value, r"[0-9]{4,}", 0)
    return F.when(found != "", found).otherwise(value)


def normalize_column_name(name: str) -> str:
    """A column's name in lower case with single underscores; for plans, not for rows."""
    return re.sub(r"[^a-z0-9]+", "_", name.strip().lower()).strip("_")


def column_name(value: Column) -> Column:
    """The same as an expression."""
    return F.btrim(F.regexp_replace(F.lower(F.trim(text_or_empty(value))), r"[^a-z0-9]+", "_"), F.lit("_"))


def text_hash(value: Column) -> Column:
    """SHA-256 of the text with white space collapsed."""
    return F.sha2(F.trim(F.regexp_replace(text_or_empty(value), r"\s+", " ")), 256)


def labelled(*parts: tuple[str, Column]) -> Column:
    """Lines of ``label: value``."""
    return F.concat_ws("\n", *(F.concat(F.lit(f"{label}: "), text_or_empty(value)) for label, value in parts))


def task_text(name: Column, wbs: Column, task_class: Column | str = "ENG_DOC") -> Column:
    """The text of a task that is embedded."""
    cls = F.lit(task_class) if isinstance(task_class, str) else task_class
    return labelled(("Task name", remove_prefix(name)), ("WBS", wbs), ("Task class", cls))


def candidate_text(title: Column, raci: Column, description: Column, discipline: Column, kind: Column, category: Column, chapter: Column) -> Column:
    """The text of a document candidate that is embedded."""
    return labelled(
        ("MDR title", title), ("RACI title", raci), ("RACI description", description), ("Discipline", discipline),
        ("Document type", kind), ("Category", category), ("Chapter", chapter),
    )


def title_key(value: Column) -> Column:
    return F.lower(F.trim(value))


def is_filled(value: Column) -> Column:
    return F.coalesce(F.trim(value) != "", F.lit(False))


def task_class(value: Column) -> Column:
    """The label in upper case; null if it is not one of the domain's."""
    label = F.upper(F.trim(value))
    return F.when(label.isin(*TASK_CLASSES), label)


def confidence_label(value: Column) -> Column:
    label = F.upper(F.trim(value))
    return F.when(label.isin(*CONFIDENCES), label).otherwise(FALLBACK_CONFIDENCE)


def strip_fence(value: Column) -> Column:
    """The content of a fenced block, without its ``json`` tag; other texts trimmed."""
    t = F.trim(F.regexp_replace(value, r"^\s+|\s+$", ""))
    inner = F.btrim(t, F.lit("`"))
    untagged = F.regexp_replace(F.regexp_replace(inner, r"^(?i:json)", ""), r"^\s+|\s+$", "")
    return F.when(t.startswith(FENCE), untagged).otherwise(t)


def line_bytes(value: Column) -> Column:
    """Bytes of a line in a file, with its line end."""
    return F.octet_length(value) + 1


def clipped(value: Column, limit: int) -> Column:
    return F.substring(value, 1, limit)


def cell_text(value: Column) -> Column:
    """A report cell: never null, no longer than a workbook holds."""
    return clipped(text_or_empty(value), CELL_LIMIT)


def cell_time(value: Column) -> Column:
    return F.coalesce(F.date_format(value, "yyyy-MM-dd HH:mm:ss"), F.lit(""))


def composite_id(timeline: Column, row_id: Column) -> Column:
    return F.concat_ws("::", timeline, row_id.cast("string"))


def unique_id(*parts: Column) -> Column:
    """An id of 32 hexadecimal digits that is the same for the same parts."""
    return F.substring(F.sha2(F.to_json(F.struct(*(p.cast("string").alias(f"p{k}") for k, p in enumerate(parts)))), 256), 1, 32)


def reply_text(line: Column) -> Column:
    """The message text of a batch response line: a string, or the text parts of a list; null if there is none."""
    path = "$.response.body.choices[0].message.content"

    def read(v: Column) -> Column:
        parts = F.try_variant_get(v, path, "array<struct<type:string,text:string>>")
        texts = F.filter(F.transform(parts, lambda p: F.when(p["type"] == "text", F.trim(p["text"]))), lambda t: F.coalesce(t != "", F.lit(False)))
        plain = F.when(F.schema_of_variant(F.try_variant_get(v, path, "variant")) == "STRING", F.try_variant_get(v, path, "string"))
        return F.nullif(F.trim(F.coalesce(plain, F.array_join(texts, "\n"))), F.lit(""))

    return bind(F.try_parse_json(line), read)
