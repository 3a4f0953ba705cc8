"""The registered queries of this subpackage; importing the modules fills the catalogue."""

from eqlake.llm import bpe, collocations, exact_dedup, language_id, mixing, near_dedup, quality, repeats, secrets, token_files, toxicity, vector_codes, warc  # noqa: F401
from eqlake.llm.common import ORACLE, QUERIES  # noqa: F401
