"""Settings which change results. Fixed values are the defaults users of the pipeline rely on."""

from __future__ import annotations

from dataclasses import dataclass


@dataclass(frozen=True)
class Settings:
    language: str = "en"
    min_valid_chars: int = 500
    max_pdf_size_mb: float = 10.0
    retry_count: int = 1
    retry_delay_seconds: float = 2.0
    max_token_length: int = 100_000
    k_nearest_tokens: int = 50
    max_bucket_tokens: int = 100_000
    similarity_weight_literal: float = 0.2
    similarity_weight_label: float = 0.3
    similarity_weight_vector: float = 0.5
    scan_batch: int = 80
    embedding_batch: int = 64
    edit_similarity_floor: float = 0.7
    edit_gap: int = 50
    least_cut: int = 100
    crawl_page_limit: int = 50
    max_chat_rounds: int = 5
    json_retries: int = 2


DEFAULTS = Settings()
