"""Table schemas, seed rows and sentinel values.

Everything in the "fixed values" blocks must equal the reference warehouse's
definitions for results to agree; it is stated here once, as plain data.
"""

from __future__ import annotations

import datetime as _dt

from pyspark.sql import types as T

# ---------------------------------------------------------------------------
# Sentinels and defaults of the conformed view and dimensions.
# ---------------------------------------------------------------------------
UNKNOWN_EVENT_TYPE = "UnknownEvent"
UNKNOWN_ACTOR_ID = -1
UNKNOWN_ACTOR_LOGIN = "unknownuser"
UNKNOWN_REPO_ID = -1
UNKNOWN_REPO_NAME = "unknownrepo"
UNKNOWN_REPO_OWNER = "unknownowner"
UNKNOWN_REPO_PROJECT = "unknownproject"
UNKNOWN_REPO_ORG_LOGIN = "Unknown"
DEFAULT_ORG_LOGIN = "independent"
DISCOVERED_CATEGORY = "Unknown"
EPOCH = _dt.datetime(1970, 1, 1, tzinfo=_dt.timezone.utc)

# The generated calendar of dim_date, inclusive.
DIM_DATE_START = _dt.date(2010, 1, 1)
DIM_DATE_END = _dt.date(2028, 12, 31)

# Column length limits declared by the warehouse DDL.
SILVER_LENGTH_LIMITS = {
    "event_id": 50,
    "event_type": 50,
    "actor_id": 50,
    "repo_id": 50,
    "org_id": 50,
}
GOLD_LENGTH_LIMITS = {
    "actor_login": 255,
    "repo_name": 255,
    "org_login": 255,
}

# Curated event types, in the order the reference seeds them.
# (event_type, event_category, event_label, event_description, is_core_metric)
EVENT_TYPE_SEED = [
    ("PushEvent", "Core Activity", "Push", "Code pushed to repository", True),
    ("WatchEvent", "Core Activity", "Star", "Repository starred", True),
    ("ForkEvent", "Core Activity", "Fork", "Repository forked", True),
    ("PullRequestEvent", "Core Activity", "Pull Request", "PR opened/closed/merged", True),
    ("IssuesEvent", "Issue Activity", "Issue", "Issue opened/closed", True),
    ("IssueCommentEvent", "Engagement", "Issue Comment", "Comment on issue", False),
    ("PullRequestReviewEvent", "Engagement", "PR Review", "PR reviewed", False),
    ("PullRequestReviewCommentEvent", "Engagement", "PR Review Comment", "Comment on PR review", False),
    ("CommitCommentEvent", "Engagement", "Commit Comment", "Comment on commit", False),
    ("DiscussionEvent", "Engagement", "Discussion", "Discussion activity", False),
    ("DiscussionCommentEvent", "Engagement", "Discussion Comment", "Comment on discussion", False),
    ("CreateEvent", "Repo Management", "Create", "Branch/tag created", False),
    ("DeleteEvent", "Repo Management", "Delete", "Branch/tag deleted", False),
    ("ReleaseEvent", "Repo Management", "Release", "Release published", False),
    ("MemberEvent", "Repo Management", "Member", "Collaborator added", False),
    ("GollumEvent", "Other", "Wiki Edit", "Wiki page edited", False),
    ("PublicEvent", "Other", "Made Public", "Repository made public", False),
    ("UnknownEvent", "Data Quality Issues", "Unknown Event",
     "Events with missing or invalid event_type from source data", False),
]

# Reasons a raw line is routed to the dead-letter table, checked in order.
REJECT_NOT_JSON = "not_json"
REJECT_NOT_OBJECT = "not_object"
REJECT_MISSING_ID = "missing_id"
REJECT_INVALID_ID = "invalid_id"
REJECT_NUL = "nul_character"
# Reasons a bronze row is kept out of silver (recorded in silver_rejects).
SILVER_REJECT_FALSY_ID = "falsy_id"
SILVER_REJECT_TOO_LONG = "too_long"

# ---------------------------------------------------------------------------
# Table schemas.
# ---------------------------------------------------------------------------
BRONZE_RAW_EVENTS = T.StructType([
    T.StructField("event_id", T.StringType(), False),
    T.StructField("event_type", T.StringType(), True),
    T.StructField("full_json", T.VariantType(), False),
    T.StructField("ingested_at", T.TimestampType(), False),
])

BRONZE_DEAD_LETTER = T.StructType([
    T.StructField("failed_payload", T.StringType(), True),
    T.StructField("error_message", T.StringType(), False),
    T.StructField("created_at", T.TimestampType(), False),
])

SILVER_EVENTS = T.StructType([
    T.StructField("event_id", T.StringType(), False),
    T.StructField("event_type", T.StringType(), True),
    T.StructField("actor_id", T.StringType(), True),
    T.StructField("actor_login", T.StringType(), True),
    T.StructField("repo_id", T.StringType(), True),
    T.StructField("repo_name", T.StringType(), True),
    T.StructField("org_id", T.StringType(), True),
    T.StructField("org_login", T.StringType(), True),
    T.StructField("event_time", T.TimestampType(), True),
    T.StructField("is_public", T.BooleanType(), True),
    T.StructField("payload", T.VariantType(), True),
    T.StructField("processed_at", T.TimestampType(), False),
])

DIM_ACTORS = T.StructType([
    T.StructField("actor_id", T.LongType(), False),
    T.StructField("actor_login", T.StringType(), False),
    T.StructField("updated_at", T.TimestampType(), True),
    T.StructField("last_event_time", T.TimestampType(), True),
])

DIM_REPOS = T.StructType([
    T.StructField("repo_id", T.LongType(), False),
    T.StructField("repo_name", T.StringType(), False),
    T.StructField("repo_owner", T.StringType(), True),
    T.StructField("repo_project", T.StringType(), True),
    T.StructField("org_id", T.LongType(), True),
    T.StructField("org_login", T.StringType(), True),
    T.StructField("updated_at", T.TimestampType(), True),
    T.StructField("last_event_time", T.TimestampType(), True),
])

DIM_EVENT_TYPES = T.StructType([
    T.StructField("event_type", T.StringType(), False),
    T.StructField("event_category", T.StringType(), False),
    T.StructField("event_label", T.StringType(), False),
    T.StructField("event_description", T.StringType(), True),
    T.StructField("is_core_metric", T.BooleanType(), True),
    T.StructField("is_curated", T.BooleanType(), True),
    T.StructField("discovered_at", T.TimestampType(), True),
])

FACT_EVENTS = T.StructType([
    T.StructField("event_id", T.StringType(), False),
    T.StructField("date_id", T.IntegerType(), False),
    T.StructField("repo_id", T.LongType(), False),
    T.StructField("actor_id", T.LongType(), False),
    T.StructField("event_type", T.StringType(), False),
    T.StructField("event_hour", T.IntegerType(), True),
    T.StructField("event_time", T.TimestampType(), False),
    T.StructField("is_public", T.BooleanType(), True),
    T.StructField("silver_processed_at", T.TimestampType(), False),
    T.StructField("gold_loaded_at", T.TimestampType(), True),
])
