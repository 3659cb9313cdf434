"""Settings of a run: a file of ``key = value`` lines, and defaults."""

from __future__ import annotations

from dataclasses import dataclass, field
from pathlib import Path


def parse_config(path: str | Path) -> dict[str, str]:
    """The file's settings; none if there is no such file. Blank lines, comments and lines without ``=`` are skipped."""
    file = Path(path)
    if not file.exists():
        return {}
    pairs = (line.strip().split("=", 1) for line in file.read_text(encoding="utf-8").splitlines() if "=" in line and not line.strip().startswith("#"))
    return {key.strip(): value.strip() for key, value in pairs}


@dataclass
class Settings:
    """What the stages take; secrets are named by the file, never by the library."""

    values: dict[str, str] = field(default_factory=dict)
    top_k: int = 30
    least_confidence: float = 0.75
    most_links: int = 3
    retries: int = 2
    backoff: float = 2.0
    timeout: float = 60.0
    embed_batch: int = 256
    embedding_model: str = "text-embedding-3-small"
    chat_model: str = "gpt-4o-mini"

    @classmethod
    def load(cls, path: str | Path) -> Settings:
        v = parse_config(path)
        return cls(v, embedding_model=v.get("EMBEDDING_MODEL", cls.embedding_model), chat_model=v.get("LLM_MODEL", cls.chat_model))

    def required(self, key: str) -> str:
        if not self.values.get(key):
            raise ValueError(f"the configuration has no {key}")
        return self.values[key]
