"""The entries table: canonical columns and types."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

NAMED = "array<struct<word:string,definition:string>>"
SENSES = "array<struct<pos:string,definitions:array<string>,sense_ids:array<string>,relations:map<string,array<string>>,relation_sources:map<string,array<string>>,extra:string>>"
# Column names and order, the identity of a row, and what enrichment may change.
ENTRIES = {
    "id": "bigint", "word": "string", "normalized_word": "string", "pos": "string", "difficulty": "string", "frequency": "double", "frequency_rank": "int", "us_phonetic": "string", "uk_phonetic": "string",
    "definition": "string", "definition_zh": "string", "synonyms": "array<string>", "antonyms": "array<string>", "examples": "array<string>", "phrases": "array<string>", "phrase_entries": NAMED,
    "related_words": "array<string>", "related_entries": NAMED, "senses": SENSES, "sources": "array<string>", "scope": "string", "enrichment": "string",
}
IDENTITY = ["id", "word", "normalized_word", "frequency_rank"]
CONTRACT_IDENTITY = [*IDENTITY, "sources", "scope"]
PAYLOAD = ["pos", "difficulty", "frequency", "us_phonetic", "uk_phonetic", "definition", "definition_zh", "synonyms", "antonyms", "examples", "phrases", "phrase_entries", "related_words", "related_entries"]
MUTABLE = [*PAYLOAD, "enrichment"]
OPTIONAL = ["phrase_entries", "related_entries"]


def conform(df: DataFrame) -> DataFrame:
    """Entries with exactly the canonical columns: optional ones may be absent, others not."""
    missing = [c for c in ENTRIES if c not in df.columns and c not in OPTIONAL]
    if missing:
        raise ValueError(f"entries lack {', '.join(missing)}")
    cols = [F.col(c).cast(t) if c in df.columns else F.array().cast(t) for c, t in ENTRIES.items()]
    return df.select(*[c.alias(n) for c, n in zip(cols, ENTRIES, strict=True)])
