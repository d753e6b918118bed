"""What components have in common, for callers that swap one for another and for new ones.

Every component works on DataFrames of many queries or documents at once; a component of one's own derives from a base
class here, or, for stores with keyword search, just has the method.
"""

from __future__ import annotations

from abc import ABC, abstractmethod
from collections.abc import Mapping
from typing import Any, Protocol, runtime_checkable

from pyspark.sql import DataFrame


class BaseIngestor(ABC):
    """A source of rows; ``with`` closes it."""

    @abstractmethod
    def ingest(self, query: str, params: Mapping[str, Any] | None = None) -> Any: ...

    @abstractmethod
    def a_ingest(self, query: str, params: Mapping[str, Any] | None = None) -> Any:
        """The same without waiting for it."""

    @abstractmethod
    def close(self) -> None:
        """May be called more than once."""

    def __enter__(self):
        return self

    def __exit__(self, *exc) -> None:
        self.close()


class BasePreprocessor(ABC):
    """``doc_key`` and raw fields in, ``doc_key, markdown, text, images`` out."""

    @abstractmethod
    def process(self, docs: DataFrame) -> DataFrame: ...


class BaseChunker(ABC):
    """``doc_id, text`` in, ``id, text, metadata`` out."""

    @abstractmethod
    def chunk(self, docs: DataFrame) -> DataFrame: ...


class BaseKeywordIndex(ABC):
    """Keyword search over ``id, text``: ``query_id, rank, id, score``, a higher score being better."""

    @abstractmethod
    def upsert(self, docs: DataFrame) -> None: ...

    @abstractmethod
    def search(self, queries: DataFrame, k: int = 50) -> DataFrame: ...

    @abstractmethod
    def delete(self, ids: list[str]) -> None: ...

    @abstractmethod
    def close(self) -> None: ...


@runtime_checkable
class SupportsKeywordSearch(Protocol):
    """A store whose own keyword search an index can use."""

    def keyword_search(self, name: str, queries: DataFrame, k: int = 50) -> DataFrame: ...


class BaseFusor(ABC):
    """``query_id, lane, rank, id`` in, ``query_id, rank, id, score`` out."""

    @abstractmethod
    def fuse(self, lanes: DataFrame) -> DataFrame: ...


class BaseReranker(ABC):
    """Hits of queries in, ``query_id, new_rank, old_rank`` out: an order, to be joined with whatever else a caller holds."""

    @abstractmethod
    def rerank(self, hits: DataFrame, top_n: int | None = None) -> DataFrame: ...
