"""Row types of pages, entities, files and voters."""

from __future__ import annotations

PAGE = "file_id string, page_number int, text string, confidence double, extraction_method string, word_count int, language_detected string"
PDF_METADATA = "filename string, file_path string, total_pages int, file_size bigint, creation_date timestamp, modification_date timestamp, author string, title string, subject string"
ENTITY = "struct<hindi_text string, english_text string, english_lowercase string, entity_type string, confidence double, page_number int, position struct<start int, end int>>"
FILE_RECORD = (
    "file_id string, filename string, file_hash string, file_size bigint, processing_status string, first_seen timestamp_ntz, "
    "last_processed timestamp_ntz, processing_attempts int, error_message string, output_files array<string>, metadata map<string,string>"
)
FILE_EVENT = "file_id string, seq bigint, ts timestamp_ntz, event string, error_message string, output_files array<string>"
STATUSES = ("pending", "in_progress", "completed", "failed", "skipped")

#: Order of the known output columns; all others follow by name.
ENTITY_COLUMNS = ("original_filename", "page_number", "hindi_name", "english_name", "english_name_lowercase", "entity_type", "confidence_score", "position_start", "position_end", "extraction_timestamp")
ENTITY_LABELS = {
    "original_filename": "Original Filename",
    "hindi_name": "Hindi Name",
    "english_name": "English Name",
    "english_name_lowercase": "English Name (Lowercase)",
    "extraction_timestamp": "Extraction Timestamp",
    "page_number": "Page Number",
    "confidence_score": "Confidence Score",
    "entity_type": "Entity Type",
    "position_start": "Position Start",
    "position_end": "Position End",
}
VOTER_COLUMNS = (
    "age", "bodyNumber", "district", "fatherOrHusbandName", "fatherOrHusbandNameHindi", "fatherOrHusbandNameLower", "gender", "houseNo", "locality", "partNumber",
    "pollingCenter", "roomNumber", "sectionNumber", "srNo", "voterName", "voterNameHindi", "voterNameLower", "ward", "sourceFile", "nagarNigam",
)
HEADER_FIELDS = ("district", "bodyNumber", "ward", "pollingCenter", "partNumber", "roomNumber", "sectionNumber", "locality")
