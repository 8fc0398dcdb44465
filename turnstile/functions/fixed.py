"""Fixed values. Results are right only when these stay exactly as listed."""

# Business calendar.
ZONE = "America/Los_Angeles"

# Admission categories counted as tickets and visitors.
TICKET_TYPES = (
    "Adult (13-64)",
    "Child (4-12)",
    "Senior (65+)",
    "Student (9-12)",
    "Student (K-8)",
    "Under 3",
)

# Upper-case statuses that do not count as a sale.
DEAD_STATUSES = ("CANCELLED", "VOID", "VOIDED", "RETURNPENDING", "RETURNPROCESSED")

# The monthly ticket-type measure leaves refunds out as well.
DEAD_OR_REFUNDED = DEAD_STATUSES + ("REFUNDED",)

# Statuses the order check accepts (upper case, single spaces).
KNOWN_STATUSES = (
    "OPEN",
    "PENDING",
    "PAID",
    "COMPLETED",
    "CANCELLED",
    "REFUNDED",
    "ACTIVE",
    "ESTIMATE",
    "VOID",
    "WAIT/HOLD",
)

# Statuses the money check does not look at.
UNPRICED_STATUSES = ("CANCELLED", "VOID", "REFUNDED")

# Line-item types of official ticket revenue.
TICKET_LINE_TYPES = (
    "Rate",
    "GeneralAdmission",
    "Package",
    "Charter",
    "PrePaidPass",
    "PrePaidPassTourRate",
    "MultiPass",
    "MultiPassItem",
)

# Sales offices known to the question layer.
SALES_OFFICES = (
    "Front Desk",
    "Online Sales",
    "Plaza Booth",
    "Back Office",
    "Rezdy",
    "Retail",
    "Pier 39 Booth",
    "Redeam",
)

# Words that make a logged query anything but read-only.
BLOCKED_WORDS = (
    "INSERT",
    "UPDATE",
    "DELETE",
    "MERGE",
    "DROP",
    "ALTER",
    "CREATE",
    "TRUNCATE",
    "EXPORT",
    "CALL",
    "GRANT",
    "REVOKE",
)

# Patterns. "\z" is the end of text; Java's "$" would accept a trailing newline.
SPACE_RUN = r"\p{Zs}+"
SPACES = r"[\s\p{Z}]"
OUTER_SPACE = r"^[\s\p{Z}]+|[\s\p{Z}]+\z"
DOLLAR_FORMS = r"^\$|^US\$|^USD\$|^U\.S\.D\.\z"
CURRENCY_CODE = r"^[A-Z]{3}\z"
CURRENCY_TOKEN = r"[A-Z]{3}"
NOT_PHONE = r"[^0-9x]"
EMAIL_FORM = r"^[a-z0-9._%+\-]+@[a-z0-9.\-]+\.[a-z]{2,}\z"
NO_EMAIL = "no email"

# Money tolerances.
TOTAL_TOLERANCE = "0.10"
LINE_TOLERANCE = "0.02"
FEE_RANGE = ("0.01", "50.00")
