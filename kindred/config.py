"""Defaults of the jobs.

Fixed values: these are the documented defaults a user of the jobs relies on.
"""

from __future__ import annotations

from dataclasses import dataclass

# Sources
ALL_ROWS = 0
PARQUET_CHUNK_ROWS = 10_000
PARQUET_TEXT_COLUMN = "keyword"
LINK_TEXT_COLUMN = "product_name"
LINK_ROW_LIMIT = 100_000

# Batches
EMBED_BATCH_ROWS = 64
DOCUMENT_BATCH_ROWS = 500
WORKERS = 4
DOCUMENT_WORKERS = 8

# Search
SEARCH_TOP_K = 5
BATCH_SEARCH_TOP_K = 10
LINK_TOP_K = 30
MATCH_SIZE = 10

# Vectors and documents
VECTOR_DIM = 768
PAYLOAD_KEY = "keyword"
SOURCE_KEY = "keyword"

# Prefixes of the asymmetric text model
QUERY_PREFIX = "検索クエリ: "
DOCUMENT_PREFIX = "検索文書: "
ENCODE_PREFIX = ""

# Token limit of the text model
CLIENT_MAX_TOKENS = 512
SERVER_MAX_TOKENS = 128

# Generated corpora
GENERATED_ROWS = 400_000
GENERATOR_SEED = 42


@dataclass(frozen=True)
class RetryPolicy:
    """How often a batch is tried and how long to wait in between.

    ``max_attempts`` counts every try, so 1 means "no retry". With
    ``exponential`` off the wait stays at ``first_wait``.
    """

    max_attempts: int = 3
    first_wait: float = 1.0
    exponential: bool = True
    max_wait: float = 60.0

    def __post_init__(self) -> None:
        if self.max_attempts < 1:
            raise ValueError("max_attempts must be at least 1")

    def wait_after(self, attempt: int) -> float:
        if not self.exponential:
            return self.first_wait
        return min(self.max_wait, self.first_wait * 2.0 ** (attempt - 1))
