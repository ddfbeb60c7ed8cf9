"""The data model: kinds, record schemas and options."""

from __future__ import annotations

from dataclasses import dataclass, field

# Fixed values of the data model.
DOCUMENT_TYPES = ["pdf", "docx", "txt", "html"]
MODALITIES = ["text", "image", "table", "figure", "code"]

DOCUMENT_CHUNK = "chunk_id string, document_id string, modality string, content string, page_number int, chunk_index int, embedding array<float>, metadata struct<source:string,chunk_type:string>, enriched_at timestamp, stored_at timestamp"
PROCESSED_DOCUMENT = "document_id string, path string, file_path string, document_type string, processing_status string, metadata struct<category:string,source:string,title:string,producer:string,page_count:int>, ingested_at timestamp"
IMAGE_RECORD = "document_id string, page_number int, image_index int, width int, height int, colorspace string, size_bytes bigint, extracted_text string, ocr_success boolean"
TABLE_RECORD = "document_id string, page_number int, table_index int, n_rows int, n_cols int, cell_data array<array<string>>, total_cells int, non_empty_cells int"

#: The configuration file; keys that it doesn't name are ignored, those it lacks are null.
CONFIG = """database_type string, model_name string, embedding_model string, temperature double, target_audience string,
difficulty_level string, learning_objectives string, max_context_tokens int, use_memory boolean, use_reflexion boolean,
chroma_db_settings struct<persist_directory:string,collection_name:string,use_existing:boolean,max_retrieval_results:int,similarity_threshold:double,distance_metric:string>,
categories array<struct<name:string,num_questions:int,description:string,doc_paths:array<string>>>,
auto_topic_distribution_settings map<string,string>, cache_settings map<string,string>, output_settings map<string,string>, prompt_settings map<string,string>"""
REQUIRED_SETTINGS = ["model_name", "database_type", "embedding_model"]


@dataclass
class Options:
    """How documents are processed."""

    chunk_size: int = 1000
    overlap: int = 200
    extract_content: bool = True
    generate_embeddings: bool = True
    store_chunks: bool = True
    collection: str = "documents"
    dimension: int = 64
    settings: dict = field(default_factory=dict)
