"""Name and content patterns used to recognise columns."""

# Column names that mark the three mandatory columns of an existing log.
CASE_NAMES = ("case_id", "caseid", "process_id", "trace_id", "case")
ACTIVITY_NAMES = ("activity", "event", "action", "step", "activity_name", "event_type", "event_name")
TIMESTAMP_NAMES = ("event_timestamp", "timestamp", "event_time", "time", "ts")

# Fixed values: (role, name pattern), first match wins; matched against the column name without table prefix.
ROLE_PATTERNS = (
    ("sla_date", r"(due|deadline|sla|promised|required)"),
    ("status", r"(status|stage|state|phase)$"),
    ("system", r"(source_system|system|channel)$"),
    ("department", r"(department|dept|org_unit|cost_center|team|business_unit)"),
    ("resource", r"(resource|user|buyer|approver|requestor|receiver|processed_by|owner|agent|assignee|clerk|performer)"),
    ("amount", r"(amount|value|price|cost|total|acctbal|balance)"),
    ("region", r"(region|country|nation|city|territory)"),
    ("partner", r"(supplier|vendor|customer|cust|supp|partner|client)"),
    ("document", r"(priority|category|type|segment|class|document)"),
    ("activity", r"^(activity|event|action|step)(_?(name|type))?$"),
)

ID_PATTERN = r"(^id$|_id$|id$|key$|_no$|number$|_nr$)"
STATUS_PATTERN = r"(status|stage|state|phase)"
OLD_NEW_PATTERNS = ((r"^(old|before|previous|from)_", r"^(new|after|current|to)_"),)
TABLE_PREFIXES = ("raw_", "cleaned_")

# Fixed values: (kind, pattern) for personal data in text.
PII_PATTERNS = (
    ("email", r"[A-Za-z0-9._%+-]+@[A-Za-z0-9.-]+\.[A-Za-z]{2,}"),
    ("phone", r"(\+[0-9]{1,3}[ .-]?)?\(?[0-9]{3}\)?[ .-][0-9]{3}[ .-][0-9]{4}"),
    ("ssn", r"\b[0-9]{3}-[0-9]{2}-[0-9]{4}\b"),
    ("card", r"\b[0-9]{4}[ -][0-9]{4}[ -][0-9]{4}[ -][0-9]{4}\b"),
    ("iban", r"\b[A-Z]{2}[0-9]{2}( ?[A-Z0-9]{4}){2,7}( ?[A-Z0-9]{1,3})?\b"),
    ("ip", r"\b[0-9]{1,3}\.[0-9]{1,3}\.[0-9]{1,3}\.[0-9]{1,3}\b"),
)

# The typical flow of five processes.
TEMPLATES = {
    "procure_to_pay": (
        "PR Created", "PR Approved", "PO Created", "PO Approved", "Goods Receipt", "Invoice Received",
        "Invoice Cleared", "Payment",
    ),
    "order_to_cash": (
        "Order Created", "Credit Check", "Pick", "Pack", "Ship", "Invoice", "Payment Received",
    ),
    "incident_management": ("Created", "Assigned", "Investigation", "Resolved", "Closed"),
    "sales_pipeline": (
        "Lead", "Qualified", "Discovery", "Demo", "Proposal", "Negotiation", "Closed Won", "Closed Lost",
    ),
    "patient_journey": ("Registration", "Triage", "Examination", "Diagnosis", "Treatment", "Discharge"),
}


def bare_name(column: str) -> str:
    """A column name in lower case without a one-letter table prefix (``o_orderkey`` → ``orderkey``)."""
    head, sep, tail = column.lower().partition("_")
    return tail if sep and tail and len(head) == 1 else column.lower()
