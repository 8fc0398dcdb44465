"""Severity and name of each check as they appear in the audit log."""

ORDERS = {
    "nulls": ("INFO", "1. NULL OVERVIEW (informational)"),
    "duplicates": ("INFO", "2. DUPLICATE order_id (should be 0)"),
    "timestamps": ("INFO", "3. BAD TIMESTAMP ORDER (created_date > modified_date) (should be 0)"),
    "currency": ("INFO", "4. BAD CURRENCY FORMAT (should be 0)"),
    "status": ("INFO", "5. BAD STATUS (outside allow-list: Option A) (should be 0)"),
    "financial": ("ERROR", "6. FINANCIAL MISMATCH (explicit-tax models A/B/D/E all failed)"),
    "missing": ("INFO", "7. COMPLETENESS: RAW order missing in orders table (should be 0)"),
    "no_items": ("INFO", "8A. REF: Orders with ZERO line items (should be 0)"),
    "no_contact": ("INFO", "8B. REF: Orders missing primary contact (should be 0)"),
    "multi_contact": ("INFO", "8C. REF: Orders with >1 primary contact (should be 0)"),
    "rollup": ("INFO", "9A. ROLLUP: financial totals (informational)"),
    "web_mix": ("INFO", "9B. ROLLUP: web vs non-web mix (informational)"),
    "status_counts": ("INFO", "9C. ROLLUP: status counts (informational)"),
}

LINE_ITEMS = {
    "duplicates": ("ERROR", "1. TABLE DUPLICATES at (order_id, line_item_id, rate_type) — should be 0"),
    "missing": ("ERROR", "2. RAW → TABLE MISSING keys — should be 0"),
    "keys": ("INFO", "3. SURROGATE KEY UNIQUENESS summary"),
    "nulls": ("INFO", "4. NULL COUNTS for key/critical columns (investigate non-zeros)"),
    "negatives": ("ERROR", "5. NEGATIVE VALUES detected (should be 0 rows unless allowed)"),
    "math": ("INFO", "6. SOFT MATH MISMATCH (summary; rounding tolerance)"),
    "serials": ("ERROR", "7. SERIALS have duplicate tokens within the same row"),
    "fanout": ("ERROR", "8. RAW FAN-OUT duplicates (same business key > 1 in RAW)"),
}

CONTACT = {
    "nulls": ("INFO", "1. NULL OVERVIEW (informational)"),
    "duplicates": ("ERROR", "2. DUPLICATE rows per ORDER (should be 0)"),
    "keys": ("INFO", "3. SURROGATE KEY UNIQUENESS summary"),
    "unknown": ("WARN", "4. UNKNOWN CONTACT SUMMARY (allowed)"),
    "flag": ("WARN", "5A. is_unknown_contact (stored) ≠ derived (should be 0 if column exists)"),
    "email": ("WARN", "6A. BAD EMAIL FORMAT (summary)"),
    "email_case": ("WARN", "6B. EMAIL still has casing/whitespace (should be 0 if normalized on load)"),
    "missing": ("WARN", "7. COMPLETENESS: RAW orders missing a contact row (should be 0)"),
    "dup_ids": ("INFO", "8A. INFO: Duplicate primary_contact_id (summary)"),
    "dup_emails": ("INFO", "8B. INFO: Duplicate email (summary)"),
}

# The event suite writes 'Error'; the stop rule compares with 'ERROR' and so lets
# these pass unless it is asked to be strict.
EVENT = {
    "duplicates": ("Error", "1. DUPLICATE EVENTS (should be 0)"),
    "missing": ("Error", "2. RAW → EVENT MISSING (should be 0)"),
    "attributes": ("Error", "4. ATTRIBUTE INCONSISTENCIES (should be 0)"),
    "keys": ("INFO", "5. SURROGATE KEY UNIQUENESS"),
    "null_identity": ("Error", "6. NULL-IDENTITY ROWS (should be 0)"),
    "guard": ("WARN", "7. OPTION A GUARD — reused event_ids must not merge schedules"),
}
