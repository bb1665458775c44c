"""Lookup tables, patterns, thresholds and text formats.

Results depend on these being exactly as they are, so they are kept together
and in their natural order. Every operator takes them as default arguments.
"""

# --- fixed values: silver ---------------------------------------------------

ID_PREFIX = "CUST_"

SILVER_RENAMES = {
    "customer_id": "property_id",
    "customer_segment": "property_type",
    "sla_plan": "service_tier",
    "initial_message": "complaint_description",
    "agent_first_reply": "service_response",
    "resolution_summary": "resolution_notes",
    "customer_sentiment": "complaint_sentiment",
}

PROPERTY_NAMES = [
    "Sunset Ridge Apartments",
    "Oak Grove Communities",
    "Maple Valley Residences",
    "Riverside Court",
    "Blue Harbor Flats",
    "Pine Creek Complex",
    "Lakewood Terrace",
    "Elmwood Park Apartments",
    "Cedar Springs Housing",
    "Horizon View Communities",
    "Greenfield Manor",
    "Willowbrook Estates",
    "Stonegate Residences",
    "Maplewood Commons",
    "Harbor Point Apartments",
    "The Grandview",
    "Regal Heights",
    "MetroLoft Residences",
    "Silk Road Residences",
    "Emerald Heights",
    "Meridian Heights",
    "The Belvedere",
    "Tiffany Towers",
    "The Kensington",
]

SERVICE_CATEGORY_BY_ISSUE = {
    "billing_problem": "Resident Amenities",
    "account_access": "Resident Amenities",
    "performance": "Doorstep Collection",
    "bug": "Maintenance Support",
    "security_concern": "Maintenance Support",
    "feature_request": "Resident Amenities",
    "how_to": "Pet Services",
    "other": "Turn Services",
}
DEFAULT_SERVICE_CATEGORY = "Doorstep Collection"

CONTRACT_SPAN = 40000
CONTRACT_FLOOR = 10000
MISSED_PICKUP_SPAN = 11
RENEWAL_SPAN_DAYS = 365

RENEWAL_NOTICE_DAYS = 30
TOP_N = 10

# --- fixed values: retrieval text -------------------------------------------

RAG_COLUMNS = [
    "property_id",
    "complaint_description",
    "service_response",
    "resolution_notes",
    "service_category",
    "churn_risk_label",
]

RAG_NULL_DEFAULTS = {
    "complaint_description": "No description provided",
    "service_response": "No response recorded",
    "resolution_notes": "Unresolved",
    "service_category": "General",
    "churn_risk_label": "unknown",
}

# Heading before each column, in document order.
DOCUMENT_PARTS = [
    ("Service Category: ", "service_category"),
    ("\nChurn Risk: ", "churn_risk_label"),
    ("\n\nCustomer Complaint:\n", "complaint_description"),
    ("\n\nAgent Response:\n", "service_response"),
    ("\n\nResolution:\n", "resolution_notes"),
]

# Everything that counts as blank at the ends of a document or question.
WHITESPACE = (
    " \t\n\x0b\x0c\r\x1c\x1d\x1e\x1f\x85\xa0\u1680"
    "\u2000\u2001\u2002\u2003\u2004\u2005\u2006\u2007\u2008\u2009\u200a\u2028\u2029\u202f\u205f\u3000"
)

# Stands in figure texts where there is nothing to average.
NO_FIGURE = "n/a"

CONTEXT_SEPARATOR = "\n\n---\n\n"
PREVIEW_CHARS = 300
RETRIEVAL_K = 5
EMBEDDING_BATCH_ROWS = 500

# --- fixed values: question routing -----------------------------------------

# First match wins, so the order matters.
INTENT_PATTERNS = {
    "high churn risk": ["high churn", "churn risk", "at risk of churn"],
    "low csat": ["worst csat", "low csat", "satisfaction"],
    "missed pickups": ["missed pickup", "missed pickups"],
    "contract value at risk": ["contract", "revenue at risk"],
    "service performance": ["service performance", "service category"],
    "property health": ["property health", "worst property"],
    "renewal timing": ["renewal", "renewing soon"],
}

INTENT_TITLES = {
    "high churn risk": "Top 10 high churn risk properties",
    "low csat": "Top 10 properties with lowest CSAT scores",
    "missed pickups": "Top 10 properties with most missed pickups",
    "contract value at risk": "Top 10 high risk properties by contract value",
    "service performance": "Service performance by category",
    "property health": "Top 10 worst performing properties by health metrics",
    "renewal timing": "Properties renewing within next 30 days",
}

FALLBACK_ANSWER = (
    "I do not have a predefined SQL mapping for that question yet. "
    "Try asking about churn risk, CSAT, missed pickups, contract value, "
    "service performance, property health, or renewal timing."
)

MODE_AUTO = "Auto route"
MODE_FULL = "Full multi-agent workflow"
MODE_SQL = "Structured SQL answer"
MODE_RAG = "RAG context search"

# Column titles of the leaderboard.
LEADERBOARD_TITLES = {
    "property_name": "Property Name",
    "churn_risk_label": "Risk Level",
    "complaint_count": "Complaints",
    "avg_csat": "CSAT Score",
    "missed_pickups_30d": "Missed Pickups",
    "contract_value": "Contract Revenue ($)",
    "renewal_date": "Renewal Date",
}

REPORT_SECTIONS = ["KEY FINDINGS", "ROOT CAUSE", "RISK ASSESSMENT", "RECOMMENDED ACTIONS"]

# --- fixed values: figures derived without the gold tables ------------------

KNOWN_FALLBACK_NAMES = {
    "CUST_00861": "Silk Road Residences",
    "CUST_00770": "Cedar Springs Housing",
    "CUST_02559": "Pine Creek Complex",
    "CUST_03557": "Riverside Court",
    "CUST_09556": "MetroLoft Residences",
    "CUST_03844": "Green Valley Apartments",
    "CUST_01017": "Oakridge Estates",
    "CUST_00065": "Summit Ridge Condos",
    "CUST_05893": "Bella Vista Luxury",
}

FALLBACK_NAME_PREFIXES = [
    "Willow", "Oak", "Maple", "Cedar", "Pine",
    "Sunset", "Highland", "River", "Summit", "Crestview",
]

FALLBACK_NAME_SUFFIXES = [
    "Residences", "Apartments", "Suites", "Estates", "Manor",
    "Heights", "Commons", "Court", "Crossing",
]

FALLBACK_PROPERTY_TYPES = ["Garden Style", "Mid-Rise", "High-Rise", "Townhome Community"]

FALLBACK_LABEL = "medium"
FALLBACK_CATEGORY = "General support"

# Share of all missed pickups by words in the category; first match wins.
PICKUP_SHARES = [
    (0.7, ["doorstep", "collection", "pickups", "valet"]),
    (0.2, ["amenities", "resident"]),
]
OTHER_PICKUP_SHARE = 0.1
