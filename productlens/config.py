"""Defaults shared by the jobs.

Every literal the pipeline depends on is a keyword parameter of the job that
uses it; this module only holds the defaults.
"""

from __future__ import annotations

# --- fixed values (must equal the analysed pipeline's for identical results) ---
# Allowed device types; anything else (including NULL) becomes "unknown".
DEVICE_TYPES = ("desktop", "mobile", "tablet")
# Allowed country codes; anything else (including NULL) becomes "unknown".
COUNTRY_CODES = ("US", "IN", "CA", "GB", "DE", "AU", "BR", "FR")
# Value used for out-of-domain device/country.
UNKNOWN = "unknown"
# Event names counted per session.
SESSION_EVENT_COUNTS = (
    ("login_events", "login"),
    ("page_views", "page_view"),
    ("projects_created", "project_created"),
    ("messages_sent", "message_sent"),
    ("files_uploaded", "file_uploaded"),
)
# Feature funnel event names.
EXPOSED, VIEWED, USED = "feature_exposed", "feature_viewed", "feature_used"
# Billable invoice statuses (open invoices count as revenue).
BILLABLE_STATUSES = ("paid", "open")
# Engagement tiers on sessions in the first 7 days: (label, low, high); high None = open.
ENGAGEMENT_TIERS = (
    ("0-1 sessions", None, 1),
    ("2-3 sessions", 2, 3),
    ("4-6 sessions", 4, 6),
    ("7-10 sessions", 7, 10),
    ("11+ sessions", 11, None),
)
# Funnel stage labels.
FUNNEL_STAGES = ("Total Users", "Feature Eligible", "Feature Adopted")
# --- end of fixed values ---

FEATURE = "team_collab"
SESSION_GAP_MINUTES = 30
ROLLOUT_DAYS = 42
ROLLOUT_INITIAL_SHARE = 0.20
BUCKET_RESOLUTION = 10000
RETENTION_WEEKS = 8
BASELINE_DAYS = 7
HIST_BINS = 40
KDE_GRID = 200
BOOTSTRAP_REPS = 1000
CI_LEVEL = 95.0
LOGIT_GRID = 100
