"""Schemas of the corpus tables; tables are never inferred from text."""

from __future__ import annotations

SOURCES = (
    "document_id string, source_path string, filename string, extension string, size_bytes bigint, file_hash string, ingested_at string, "
    "category string, raw_path string, modified_at string, error string"
)
PAGES = "document_id string, page int, text string, raw_text string, source_file string, method string, ocr_confidence double, warnings array<string>"
STRUCTURE = (
    "node_id string, document_id string, level string, number string, label string, heading string, page int, char_start int, char_end int, "
    "parent_id string, depth int, path array<string>"
)
ARTICLES = "document_id string, article_id string, position int, number string, value double, page int, text string"
METADATA = (
    "document_id string, title string, type string, number string, date string, jurisdiction string, authority string, legal_domain string, "
    "language string, source string, source_url string, retrieved_at string, version string, status string, confidence map<string,double>, "
    "evidence map<string,string>, warnings array<string>"
)
RELATIONS = (
    "document_id string, relation string, target_reference string, kind string, number string, page int, target string, outcome string, "
    "confidence double, needs_review boolean"
)
DUPLICATES = "document_id string, duplicate_of string, kind string, similarity double, details string"
ISSUES = "document_id string, code string, severity string, page int, n bigint"
CHUNKS = "chunk_id string, document_id string, article_id string, position int, text string, strategy string"
VECTORS = "vector_id string, chunk_id string, document_id string, embedding_model string, dimension int, vector array<float>"
CORRECTIONS = "document_id string, before string, after string, confidence double"
EVENTS = "key string, at timestamp, actor string, from_state string, to_state string, detail string"
