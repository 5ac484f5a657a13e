"""All queries of this subpackage."""

from tidemark.llm import queries_corpus, queries_native, queries_text  # noqa: F401
from tidemark.llm.catalog import ORACLES, QUERIES  # noqa: F401
