"""Settings of a run; every one can be overridden by a ``FOLIO_...`` environment variable."""

from __future__ import annotations

import os
from dataclasses import dataclass, field, fields, replace

PREFIX = "FOLIO_"


def _from_env(name: str, default):
    raw = os.environ.get(PREFIX + name.upper())
    if raw is None:
        return default
    if isinstance(default, tuple):
        return tuple(x.strip() for x in raw.split(",") if x.strip())
    return type(default)(raw)


def _setting(name: str, default):
    """Read when a ``Settings`` is made, not when this module is imported."""
    return field(default_factory=lambda: _from_env(name, default))


@dataclass(frozen=True)
class Settings:
    # The defaults users of such pipelines rely on.
    input_dir: str = _setting("input_dir", "./data/raw")
    output_path: str = _setting("output_path", "./data/output/train.jsonl")
    max_file_bytes: int = _setting("max_file_bytes", 500 * 1024 * 1024)
    allowed_extensions: tuple[str, ...] = _setting("allowed_extensions", (".txt", ".md", ".pdf", ".docx", ".csv", ".json", ".html", ".htm"))
    encoding_fallback_chain: tuple[str, ...] = _setting("encoding_fallback_chain", ("utf-8", "utf-8-sig", "cp1252", "latin-1"))
    stream_chunk_bytes: int = _setting("stream_chunk_bytes", 8192)
    max_context_tokens: int = _setting("max_context_tokens", 4096)
    prompt_budget_tokens: int = _setting("prompt_budget_tokens", 512)
    chunk_overlap_tokens: int = _setting("chunk_overlap_tokens", 128)
    tokenizer_name: str = _setting("tokenizer_name", "words")
    tokenizer_files: str = _setting("tokenizer_files", "")
    llm_backend: str = _setting("llm_backend", "ollama")
    llm_base_url: str = _setting("llm_base_url", "http://localhost:11434")
    model_name: str = _setting("model_name", "llama3.1:70b")
    system_prompt: str = _setting("system_prompt", "")
    llm_timeout_seconds: float = _setting("llm_timeout_seconds", 120.0)
    llm_max_retries: int = _setting("llm_max_retries", 3)
    llm_retry_backoff_base: float = _setting("llm_retry_backoff_base", 2.0)
    max_concurrent_llm_calls: int = _setting("max_concurrent_llm_calls", 4)
    output_format: str = _setting("output_format", "jsonl")
    jsonl_schema: str = _setting("jsonl_schema", "alpaca")
    checkpoint_dir: str = _setting("checkpoint_dir", "./data/state")
    rows_per_shard: int = _setting("rows_per_shard", 50_000)

    def __post_init__(self) -> None:
        if self.max_context_tokens <= self.prompt_budget_tokens:
            raise ValueError("max_context_tokens must exceed prompt_budget_tokens")
        if self.llm_max_retries < 1:
            raise ValueError("llm_max_retries counts all attempts and must be at least 1")
        if self.jsonl_schema not in ("alpaca", "sharegpt") or self.output_format not in ("jsonl", "parquet", "huggingface"):
            raise ValueError("unknown jsonl_schema or output_format")

    @property
    def chunk_budget(self) -> int:
        return self.max_context_tokens - self.prompt_budget_tokens

    @property
    def resolved_input_dir(self) -> str:
        return self.input_dir if "://" in self.input_dir else os.path.realpath(self.input_dir)

    @property
    def resolved_output_path(self) -> str:
        return self.output_path if "://" in self.output_path else os.path.realpath(self.output_path)

    def with_(self, **changes) -> Settings:
        return replace(self, **changes)

    @classmethod
    def from_rows(cls, rows: dict[str, str | None]) -> Settings:
        """Settings kept as a table of keys and values; unknown keys and null values are left alone."""
        known = {f.name: f for f in fields(cls)}
        base = cls()
        return replace(base, **{k: (tuple(v.split(",")) if isinstance(getattr(base, k), tuple) else type(getattr(base, k))(v)) for k, v in rows.items() if k in known and v is not None})
