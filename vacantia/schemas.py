"""Explicit schemas of all tables and their constraints. Nothing is inferred."""

from __future__ import annotations

from pyspark.sql import types as T


_PLAIN = {
    "bigint": T.LongType(),
    "int": T.IntegerType(),
    "double": T.DoubleType(),
    "string": T.StringType(),
    "boolean": T.BooleanType(),
    "timestamp_ntz": T.TimestampNTZType(),
}


def _record(**fields: T.DataType | str) -> T.StructType:
    """Nested record; plain types by name."""
    return T.StructType([T.StructField(n, _PLAIN[k] if isinstance(k, str) else k) for n, k in fields.items()])


def _list(kind: T.DataType | str) -> T.ArrayType:
    return T.ArrayType(_PLAIN[kind] if isinstance(kind, str) else kind)


def _struct(text: str, **nested: T.DataType) -> T.StructType:
    """Table schema from ``name type`` lines; ``?`` after the name allows null.

    Types that are not plain are named by keyword.
    """
    fields = []
    for line in text.strip().splitlines():
        name, kind = line.split()
        plain = _PLAIN[kind] if kind in _PLAIN else nested[kind]
        fields.append(T.StructField(name.rstrip("?"), plain, name.endswith("?")))
    return T.StructType(fields)


_STRINGS = _list("string")
_FILES = _list(_record(file="string", url="string"))
_QUALIFICATIONS = _list(_record(text="string", kind="string", evidence=_STRINGS))

JOB_STATUSES = (
    "new",
    "in_progress",
    "retry",
    "ready_for_extraction",
    "completed_eligible",
    "completed_ineligible",
    "unknown",
    "unavailable",
    "failed",
    "merged",
)
PHASES = ("fetch", "eligibility", "extraction")
STAGE_PHASES = {"eligibility": ("fetch", "eligibility"), "extraction": ("extraction",)}
RUN_STAGES = ("eligibility", "extraction")
TRIGGERS = ("scheduled", "reprocess")
DECISIONS = ("eligible", "ineligible", "unknown")
EFFORTS = ("minimal", "low", "medium", "high")
ATTEMPT_OUTCOMES = (
    "ready_for_extraction",
    "completed_eligible",
    "completed_ineligible",
    "unknown",
    "unavailable",
    "retry",
    "failed",
    "merged",
    "interrupted",
    "skipped",
)
TERMINAL_CATEGORIES = ("not_found", "closed", "malformed", "off_site_redirect")
RETRYABLE_CATEGORIES = ("blocked", "timeout", "transport", "server_error", "empty_content")
ERROR_CATEGORIES = (
    *TERMINAL_CATEGORIES,
    *RETRYABLE_CATEGORIES,
    "model_call",
    "validation_failed",
    "ungrounded_evidence",
    "missing_checkpoint",
    "internal",
    "interrupted",
)
RUN_STATUSES = ("in_progress", "success", "failed")

PAGES = _struct(
    """page_id bigint
    url string
    html string"""
)
FRAMES = _struct(
    """page_id bigint
    index int
    origin string
    outcome string
    html? string"""
)
COMPANIES = _struct(
    """slug string
    name string
    job_board_url string
    strategy string
    synced_at? timestamp_ntz"""
)
CATALOG = _struct(
    """name string
    job_board_url string
    strategy string
    aliases? strings
    pre_filter_urls? strings
    link_rule? link_rule
    phenom? phenom
    talentbrew? talentbrew
    coveo? coveo
    hooks? hooks""",
    strings=_STRINGS,
    link_rule=_record(
        sample_job_url="string",
        path_prefix="string",
        min_depth="int",
        suppress_ancestor_selector="string",
    ),
    phenom=_record(path_prefix="string", page_id="string", locale="string"),
    talentbrew=_record(results_path="string", records_per_page="int"),
    coveo=_record(search_url="string", browser_token_key="string"),
    hooks=_record(
        next_control_selector="string", pre_extract_css="string", expand_selector="string"
    ),
)
COMPANY_RUNS = _struct(
    """id bigint
    company_slug string
    batch_id string
    status string
    started_at timestamp_ntz
    finished_at? timestamp_ntz
    url_count? bigint
    error_message? string"""
)
JOB_URLS = _struct(
    """id bigint
    company_slug string
    url string
    captured_at timestamp_ntz"""
)
JOBS = _struct(
    """id bigint
    company_slug string
    url_key string
    status string
    next_phase string
    attempt_count bigint
    next_attempt_after? timestamp_ntz
    current_attempt_id? bigint
    current_content_id? bigint
    reprocess_requested boolean
    merged_into_id? bigint
    first_seen_at timestamp_ntz
    last_seen_at timestamp_ntz
    updated_at timestamp_ntz"""
)
JOB_SOURCES = _struct(
    """id bigint
    job_id bigint
    url string
    first_seen_at timestamp_ntz
    last_seen_at timestamp_ntz"""
)
JOB_CONTENTS = _struct(
    """id bigint
    job_id bigint
    content_hash string
    fingerprint string
    requisition_id? string
    resolved_url string
    http_status? bigint
    method string
    title? string
    text string
    jsonld_json? string
    retrieved_at timestamp_ntz"""
)
PIPELINE_RUNS = _struct(
    """id string
    stage string
    trigger string
    started_at timestamp_ntz
    finished_at? timestamp_ntz
    selection string
    counts_json? string
    model string
    reasoning_effort? string"""
)
JOB_ATTEMPTS = _struct(
    """id bigint
    job_id bigint
    run_id string
    trigger string
    reason? string
    phase_reached? string
    outcome? string
    error_category? string
    error_message? string
    model string
    reasoning_effort? string
    prompt_tokens? bigint
    completion_tokens? bigint
    started_at timestamp_ntz
    finished_at? timestamp_ntz"""
)
JOB_DECISIONS = _struct(
    """id bigint
    job_id bigint
    attempt_id bigint
    content_id bigint
    decision string
    reason string
    supporting_evidence_json string
    conflicting_evidence_json string
    prompt_hash string
    is_current boolean
    decided_at timestamp_ntz"""
)
JOB_RESULTS = _struct(
    """id bigint
    job_id bigint
    attempt_id bigint
    content_id bigint
    schema_version bigint
    result_json string
    is_current boolean
    accepted_at timestamp_ntz"""
)
BOARD_SNAPSHOTS = _struct(
    """schema_version? int
    company_name string
    job_board_url string
    sample_job_url string
    notes? string
    expected_unfiltered_count bigint
    captured_at? string
    captured_with_filters? boolean
    path_prefix? string
    pre_filter_urls? strings
    top_url? string
    pages? files
    min_depth? int
    suppress_ancestor_selector? string
    frames? files
    states? states
    pre_extract_css? string
    next_control_selector? string
    render_wait_sec? double
    render_scroll_count? int
    expand_selector? string""",
    strings=_STRINGS,
    files=_FILES,
    states=_list(_record(file="string", url="string", frames=_FILES)),
)
ANSWER = _struct(
    """decision? string
    reason? string
    supporting_evidence? strings
    conflicting_evidence? strings""",
    strings=_STRINGS,
)
RECORDING = _struct(
    """recording_version? int
    key? string
    requested_model? string
    eligibility_prompt_hash? string
    case_id? string
    source_content_sha256? string
    replay? int
    reasoning_effort? string
    status? string
    raw_json? string
    response_model? string
    prompt_tokens? bigint
    completion_tokens? bigint
    latency_ms? bigint"""
)
EXPECTED_DECISION = _struct(
    """schema_version? int
    case_id? string
    reviewed? boolean
    decision? string
    must_cite? strings
    rationale? string
    partition? string
    source_content_sha256? string
    provenance? provenance""",
    strings=_STRINGS,
    provenance=_record(
        company="string", title="string", source_url="string", captured_at_utc="string"
    ),
)
EXPECTED_EVIDENCE = _struct(
    """schema_version? int
    case_id? string
    reviewed? boolean
    review_status? string
    partition? string
    source_content_sha256? string
    decision? string
    prompt_example? string
    missing_information? boolean
    obligations? obligations
    conflict_pairs? pairs""",
    obligations=_list(
        _record(
            obligation_id="string",
            role="string",
            critical="boolean",
            excerpt_alternatives=_STRINGS,
        )
    ),
    pairs=_list(_STRINGS),
)

# Facts of an extracted posting, in order, with the type of their value.
FACT_VALUES = {
    "title": _PLAIN["string"],
    "location_text": _PLAIN["string"],
    "location": _record(country="string", region="string", city="string"),
    "work_mode": _PLAIN["string"],
    "employment_type": _PLAIN["string"],
    "experience_level": _PLAIN["string"],
    "job_functions": _STRINGS,
    "summary": _PLAIN["string"],
    "source_language": _PLAIN["string"],
    "responsibilities": _STRINGS,
    "required_qualifications": _QUALIFICATIONS,
    "preferred_qualifications": _QUALIFICATIONS,
    "benefits": _STRINGS,
    "compensation_text": _PLAIN["string"],
    "technologies": _list(_record(mention="string", status="string", evidence=_STRINGS)),
    "posting_date": _PLAIN["string"],
    "requisition_id": _PLAIN["string"],
}
FACTS = T.StructType(
    [
        T.StructField(name, _record(state="string", value=kind, evidence=_STRINGS))
        for name, kind in FACT_VALUES.items()
    ]
)
# Allowed values of coded facts.
WORK_MODES = ("remote", "hybrid", "onsite")
EMPLOYMENT_TYPES = (
    "full_time",
    "part_time",
    "contract",
    "freelance",
    "temporary",
    "internship",
)
EXPERIENCE_LEVELS = ("entry", "junior", "mid", "senior", "lead", "principal", "executive")
JOB_FUNCTIONS = (
    "technology_and_engineering",
    "sales_and_business_development",
    "marketing_and_communications",
    "operations_and_logistics",
    "finance_and_accounting",
    "human_resources",
    "customer_success_and_support",
    "product_management",
    "data_and_analytics",
    "healthcare_and_medical",
    "legal_and_compliance",
    "design_and_creative",
    "administrative_and_office",
    "consulting_and_strategy",
    "general_management",
    "other",
)
QUALIFICATION_KINDS = (
    "skill",
    "experience",
    "education",
    "certification",
    "language",
    "behavioral",
    "other",
)
TECHNOLOGY_STATUSES = ("mentioned", "preferred", "required")
MODEL_STATES = ("extracted", "not_stated", "uncertain")
SCHEMA_VERSION = 1
