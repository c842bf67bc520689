"""Fixed values.

Every literal in this module decides a result (a pattern, a label, a key name
inside a log line, a word list), so they are kept together and stated plainly.
"""

# --- time texts ---------------------------------------------------------------
WEEKDAYS = ("Sun", "Mon", "Tue", "Wed", "Thu", "Fri", "Sat")
MONTHS = ("Jan", "Feb", "Mar", "Apr", "May", "Jun", "Jul", "Aug", "Sep", "Oct", "Nov", "Dec")

# --- message normalization, applied in this order ------------------------------
NORMALIZATION = (
    (r"\d{4}-\d{2}-\d{2}T\d{2}:\d{2}:\d{2}([+-]\d{2}:\d{2}|Z)?", "{timestamp}"),
    (r"[0-9a-fA-F]{8}-[0-9a-fA-F]{4}-[0-9a-fA-F]{4}-[0-9a-fA-F]{4}-[0-9a-fA-F]{12}", "{uuid}"),
    (r"0x[0-9a-fA-F]+", "{hex}"),
    (r"\d+", "{n}"),
)

# Whole messages that carry no operational signal.
NOISE_MESSAGES = ("HTTP REQUEST",)

# --- failure signatures: first match wins, case-insensitive ---------------------
SIGNATURES = (
    (r"ffprobe exited", "FFPROBE_INVALID_MEDIA"),
    (r"moov atom not found", "INVALID_MP4_CONTAINER"),
    (r"Max FPS", "VIDEO_MAX_FPS_TOO_LOW"),
    (r"Couldn't find a single max width or height", "IMAGE_DIMENSIONS_NOT_FOUND"),
    (r"Twitter token (validation|refresh) failed", "TWITTER_TOKEN_INVALID"),
    (r"Cobrand is still in progress", "COBRAND_PENDING"),
    (r"Scheduled post media is not ready yet", "MEDIA_NOT_READY"),
)

# --- event prefixes ---------------------------------------------------------------
NESTED_PREFIX = "content.cobrand"

# --- labels -------------------------------------------------------------------------
API = "API"
COBRAND = "Cobrand"
UNINSTRUMENTED = "Uninstrumented Error"
UNKNOWN_EVENT = "Unknown Event"
ERROR_MARK = "[ERROR]"
NO_ERROR_MARK = "—"
PENDING = "Pending"
POSTING_PATTERN = "posting_job%"
DEFAULT_COBRAND_SERVICE = "cobrand"

# --- API log line: (column, key in the line, type) ------------------------------------
API_FIELDS = (
    ("event_time", "timestamp", "string"),
    ("event_action", "event.action", "string"),
    ("message", "message", "string"),
    ("level", "level", "string"),
    ("method_name", "method.name", "string"),
    ("route_name", "route.name", "string"),
    ("request_id", "request.id", "string"),
    ("platform_name", "platform.name", "string"),
    ("planner_id", "scheduled_post_planner.id", "bigint"),
    ("planner_platform_id", "scheduled_post_planner_platform.id", "bigint"),
    ("user_id", "user.id", "bigint"),
    ("playlist_id", "playlist.id", "bigint"),
    ("duration_ms", "event.duration_ms", "double"),
    ("error_message", "error.message", "string"),
    ("error_stack", "error.stack", "string"),
    ("job_name", "job.name", "string"),
    ("job_attempt", "job.attempt", "int"),
    ("job_max_attempts", "job.max_attempts", "int"),
    ("http_method", "http.request.method", "string"),
    ("url_path", "url.path", "string"),
    ("service_name", "service.name", "string"),
)

# --- standalone Cobrand line: (column, key); every column is text ------------------------
COBRAND_EVENT_FIELDS = (
    ("event_time", "timestamp"),
    ("level", "level"),
    ("event_action", "event.action"),
    ("method_name", "method.name"),
    ("message", "message"),
    ("result_status", "result.status"),
    ("error_message", "error.message"),
    ("error_stack", "error.stack"),
    ("request_id", "request.id"),
    ("user_id", "user.id"),
    ("user_tracking_id", "user_tracking.id"),
    ("content_id", "content.id"),
)

TRACE_KEY = "trace.method"
CHILDREN_KEY = "children"

# --- span columns read from `details` only: (column, key, type) ------------------------------
DETAIL_FIELDS = (
    ("user_uuid", "user.uuid", "string"),
    ("content_uuid", "content.uuid", "string"),
    ("content_variation_id", "content_variation.id", "bigint"),
    ("content_variation_uuid", "content_variation.uuid", "string"),
    ("content_type", "content_type.code", "string"),
    ("cobrand_job_type", "cobrand.job.type", "string"),
    ("cobrand_status", "cobrand.status", "string"),
    ("cobrand_branch", "cobrand.branch", "string"),
    ("queue_pending_before", "queue.pending_count_before_push", "bigint"),
    ("queue_pending_after", "queue.pending_count_after_push", "bigint"),
    ("queue_remaining", "queue.remaining_count", "bigint"),
    ("callback_completed", "callback.completed", "boolean"),
    ("callback_attempt", "callback.attempt", "int"),
    ("callback_max_attempts", "callback.max_attempts", "int"),
    ("generated_file_exists", "cobrand.generated_file_exists", "boolean"),
    ("generated_file_size", "cobrand.generated_file_size_bytes", "bigint"),
    ("file_extension", "file.extension", "string"),
)

# --- span columns read from `details`, then from `attributes` ---------------------------------
IDENTITY_FIELDS = (
    ("request_id", "request.id", "string"),
    ("user_id", "user.id", "bigint"),
    ("user_tracking_id", "user_tracking.id", "bigint"),
    ("content_id", "content.id", "bigint"),
)

# Tables a report reader needs (the raw tables stay behind).
EXPORTED_TABLES = (
    "event_fact_api",
    "span_fact",
    "cobrand_event_fact",
    "capability_catalog",
    "instrumentation_gap_catalog",
    "archive_manifest",
)

# Manifest statuses.
ARCHIVED = "ARCHIVED"
VALIDATED = "VALIDATED"
FAILED = "FAILED"
DELETED = "DELETED"
VALIDATED_KEPT = "VALIDATED_KEPT"
KEPT_NOTE = "kept on purpose: validated files are not removed"

# Characters stripped from both ends of a log line before it is parsed.
LINE_WHITESPACE = (
    " \t\n\r\x0b\x0c\x1c\x1d\x1e\x1f\x85\xa0\u1680\u2000\u2001\u2002\u2003\u2004\u2005"
    "\u2006\u2007\u2008\u2009\u200a\u2028\u2029\u202f\u205f\u3000"
)
