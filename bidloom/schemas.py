"""Document types, field lists, table schemas and declared constraints."""

from __future__ import annotations

# ---- fixed values: document types and the fields expected for each ---------------------------------
INVITATION = "invitation_to_bid"
BID_TABS = "bid_tabs"
AWARD = "award_letter"
ITEM_C = "item_c_report"
SUMMARY = "bid_summary"
AS_READ = "bids_as_read"
UNKNOWN = "unknown"

EXPECTED_FIELDS = {
    INVITATION: [
        "contract_number", "wbs_element", "counties", "description", "date_available", "completion_date",
        "mbe_goal", "wbe_goal", "combined_goal", "bid_opening_date",
    ],
    AWARD: [
        "contract_number", "awarded_to", "awarded_amount", "award_date", "wbs_element", "counties", "description",
    ],
    BID_TABS: ["contract_number", "bidders", "bid_items"],
    ITEM_C: [
        "contract_number", "proposal_length", "type_of_work", "location", "estimated_cost", "date_available",
        "completion_date", "bidders",
    ],
    AS_READ: ["contract_number", "bidders"],
    SUMMARY: ["contract_number", "bidders"],
}
BIDDER_FIELDS = [
    "bidder_name", "bidder_location", "total_bid_amount", "bid_rank", "percentage_diff", "is_winner",
]
ITEM_FIELDS = [
    "item_number", "item_code", "description", "quantity", "unit", "unit_price", "total_price", "bidder_name",
]
#: What the extraction of each type emits before mapping.
EMITTED_FIELDS = {
    **EXPECTED_FIELDS,
    AS_READ: ["contract_number", "bidders", "bid_items"],
    SUMMARY: ["contract_number", "bidders", "bid_items"],
}
EXTRACTION_METHOD = {
    INVITATION: "InvitationToBidExtractor",
    BID_TABS: "BidTabsExtractor",
    AWARD: "AwardLetterExtractor",
    ITEM_C: "ItemCExtractor",
    SUMMARY: "BidSummaryExtractor",
    AS_READ: "BidsAsReadExtractor",
}

# ---- nested result schema --------------------------------------------------------------------------
SCALAR_TYPES = {
    "contract_number": "string",
    "wbs_element": "string",
    "counties": "string",
    "description": "string",
    "date_available": "date",
    "completion_date": "date",
    "mbe_goal": "double",
    "wbe_goal": "double",
    "combined_goal": "double",
    "bid_opening_date": "timestamp_ntz",
    "proposal_length": "double",
    "type_of_work": "string",
    "location": "string",
    "estimated_cost": "decimal(18,2)",
    "awarded_amount": "decimal(18,2)",
    "awarded_to": "string",
    "award_date": "date",
}
BIDDER_TYPE = (
    "struct<bidder_name:string,bidder_location:string,total_bid_amount:decimal(18,2),bid_rank:int,"
    "percentage_diff:double,is_winner:boolean>"
)
ITEM_TYPE = (
    "struct<item_number:string,item_code:string,description:string,quantity:decimal(18,3),unit:string,"
    "unit_price:decimal(18,2),total_price:decimal(18,2),bidder_name:string>"
)
LIST_TYPES = {"bidders": f"array<{BIDDER_TYPE}>", "bid_items": f"array<{ITEM_TYPE}>"}
FIELD_TYPES = {**SCALAR_TYPES, **LIST_TYPES}

# ---- fixed values: relational tables -----------------------------------------------------------------
CONTRACT_COLUMNS = {
    "contract_number": "string",
    "wbs_element": "string",
    "tip_number": "string",
    "federal_aid_number": "string",
    "counties": "string",
    "description": "string",
    "date_available": "date",
    "completion_date": "date",
    "mbe_goal": "decimal(5,2)",
    "wbe_goal": "decimal(5,2)",
    "combined_goal": "decimal(5,2)",
    "bid_opening_date": "timestamp_ntz",
    "proposal_length": "decimal(10,3)",
    "type_of_work": "string",
    "location": "string",
    "estimated_cost": "decimal(15,2)",
    "awarded_amount": "decimal(15,2)",
    "awarded_to": "string",
    "award_date": "date",
    "source_file_path": "string",
    "source_file_hash": "string",
    "source_file_mtime": "timestamp_ntz",
    "extraction_run_id": "string",
}
BIDDER_COLUMNS = {
    "bidder_name": "string",
    "bidder_location": "string",
    "total_bid_amount": "decimal(15,2)",
    "bid_rank": "int",
    "percentage_diff": "decimal(6,2)",
    "is_winner": "boolean",
}
ITEM_COLUMNS = {
    "item_number": "string",
    "item_code": "string",
    "description": "string",
    "quantity": "decimal(15,3)",
    "unit": "string",
    "unit_price": "decimal(12,2)",
    "total_price": "decimal(15,2)",
    "bidder_name": "string",
}
LOG_COLUMNS = {
    "file_path": "string",
    "document_type": "string",
    "extraction_method": "string",
    "status": "string",
    "error_message": "string",
    "confidence_score": "decimal(4,3)",
    "processing_time_seconds": "decimal(8,3)",
    "records_extracted": "int",
    "needs_ocr": "boolean",
    "needs_ocr_reasons": "string",
    "ocr_applied": "boolean",
    "ocr_method": "string",
    "ocr_duration_seconds": "decimal(8,3)",
    "file_hash": "string",
    "file_size_bytes": "bigint",
    "file_mtime": "timestamp_ntz",
    "run_id": "string",
}
LOG_STATUSES = ["success", "partial", "failed"]
MAX_LENGTH = {
    "contracts": {
        "contract_number": 50, "wbs_element": 100, "tip_number": 50, "federal_aid_number": 50,
        "type_of_work": 255, "awarded_to": 255, "source_file_hash": 64, "extraction_run_id": 64,
    },
    "bidders": {"bidder_name": 255, "bidder_location": 255},
    "bid_items": {"item_number": 50, "item_code": 50, "unit": 50, "bidder_name": 255},
    "extraction_logs": {
        "document_type": 50, "extraction_method": 50, "status": 20, "ocr_method": 50, "file_hash": 64, "run_id": 64,
    },
}
NOT_NULL = {
    "contracts": ["contract_number"],
    "bidders": ["bidder_name"],
    "bid_items": [],
    "extraction_logs": ["file_path"],
}
