"""Label taxonomy, recoding, confidence gate, field acceptance, tags and
update payloads (J11, J12, J16-J20).

Everything is a Column expression over the parsed VARIANT response, so the
gate and the payloads are computed for all issues in one projection.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from .jsonx import json_number, json_type, json_value

# ---------------------------------------------------------------------------
# Fixed values (must equal the reference's for identical results).
# Resolution labels: key, description, examples.
RESOLUTIONS = [
    ("bug_fix", "LangChain Bug fixes or version releases we make", "we release new version, fixed customer issue"),
    ("feature_request", "New functionality added or requested", "acknowledged feature request, included in release"),
    ("referred_to_public_resource", "Answered using existing docs", "pointed to KB article, existing documentation"),
    ("referred_with_internal_knowledge", "Answered but needs new docs", "internal knowledge shared, should create/update article"),
    ("customer_love", "Customer management activities", "meetings with DE, sales interactions"),
    ("no_action", "No actionable work required", "spam, simple questions, no follow-up needed"),
]
# Category labels: key, description, examples.
CATEGORIES = [
    ("admin_authentication_access", "Login/access issues", "password resets, SSO, MFA problems"),
    ("admin_billing_refunds", "Billing and payment issues", "subscription changes, refunds, payment problems"),
    ("admin_data_deletion", "Data deletion requests", "GDPR removal, account closure, DSAR"),
    ("admin_general_account_management", "Account administration", "adding users, project migration, settings"),
    ("admin_security_privacy_and_compliance", "Security/compliance requests", "SOC 2, HIPAA, GDPR docs"),
    ("langchain_oss_python", "LangChain Python library", "bugs, imports, GitHub issues"),
    ("anggraph_platform", "LangGraph cloud platform", "deployment, agents, scaling issues"),
    ("langgraph_studio", "LangGraph Studio app", "desktop app, visualization tools"),
    ("langsmith_administration", "LangSmith org settings", "permissions, admin controls"),
    ("langsmith_annotations", "Annotation workflows", "annotation queues, feedback"),
    ("langsmith_automation_rules", "Automation features", "triggers, webhooks, rules"),
    ("langsmith_dashboards", "LangSmith UI issues", "web UI, search, navigation"),
    ("langsmith_datasets_experiments", "Datasets and experiments", "evaluations, test runs"),
    ("langsmith_evaluation", "Model evaluation", "scoring outputs, feedback collection"),
    ("langsmith_observability", "Monitoring and traces", "trace analysis, metrics, alerts"),
    ("langsmith_playground", "LangSmith Playground", "prompt testing, model issues"),
    ("langsmith_pricing", "Pricing questions", "plan details, cost optimization"),
    ("langsmith_prompt_hub", "Prompt management", "versioning, collaboration"),
    ("langsmith_sdk", "SDK and integrations", "tracing setup, API usage"),
    ("langsmith_insights", "Automated insights (CLIO)", "insights features"),
    ("langgraph_oss_js", "LangGraph JS library", "JS bugs, GitHub issues"),
    ("langchain_oss_js", "LangChain JS library", "JS installation, usage"),
    ("other_partnerships", "Business partnerships", "integrations, collaborations"),
    ("other_sales", "Sales inquiries", "enterprise demo, self-hosting"),
    ("other_spam", "Spam/irrelevant", "marketing, mass outreach"),
    ("other_marketing_promotional", "Marketing content", "promotional messages, link sharing"),
]
# Label recoding applied before write-back (unknown labels pass unchanged).
RESOLUTION_RECODE = {"bug_fix": "big_fix"}
CATEGORY_RECODE = {"langgraph_platform": "langgraph_langgraph_platform"}
# Confidence threshold and the tags added on write-back.
CONFIDENCE_THRESHOLD = 0.8
TAG_CLASSIFIED = "auto-classified"
TAG_CLOSED = "auto-closed"
# End of fixed values.
# ---------------------------------------------------------------------------

FIELDS = ("resolution", "category")


def taxonomy(spark: SparkSession) -> DataFrame:
    """The label taxonomy as a small table ``(field, label, description, examples)``.
    Its size is fixed (32 rows), so it is safe to broadcast."""
    rows = [("resolution", *r) for r in RESOLUTIONS] + [("category", *c) for c in CATEGORIES]
    return spark.createDataFrame(rows, "field string, label string, description string, examples string")


def _recode(c: Column, mapping: dict) -> Column:
    m = F.create_map(*[F.lit(x) for kv in mapping.items() for x in kv])
    return F.coalesce(F.element_at(m, c), c)


def recode_resolution(c: Column) -> Column:
    return _recode(c, RESOLUTION_RECODE)


def recode_category(c: Column) -> Column:
    return _recode(c, CATEGORY_RECODE)


CONF_KEYS = ("resolution_confidence", "confidence", "category_confidence")


def response_features(r: Column) -> list:
    """Stage the response members the gate needs as plain columns (one
    extraction per member): ``_t_<key>`` type name (NULL = absent, VOID =
    JSON null), ``_n_<key>`` numeric value, ``_l_<field>`` label text."""
    cols = []
    for k in CONF_KEYS:
        cols += [json_type(r, f"$.{k}").alias(f"_t_{k}"), json_number(r, f"$.{k}").alias(f"_n_{k}")]
    for f in FIELDS:
        cols += [json_type(r, f"$.{f}").alias(f"_t_{f}"), json_value(r, f"$.{f}").alias(f"_l_{f}")]
    return cols


FEATURE_COLS = [f"_t_{k}" for k in CONF_KEYS] + [f"_n_{k}" for k in CONF_KEYS] + \
               [f"_t_{f}" for f in FIELDS] + [f"_l_{f}" for f in FIELDS]


def _present(key: str) -> Column:
    """Key present in the response object (a JSON null counts as present)."""
    return F.col(f"_t_{key}").isNotNull()


def _cmp_state(key: str) -> Column:
    """'low' / 'ok' / 'error' for a present confidence: a non-number (JSON
    null, text, object) cannot be compared, which the reference raises on."""
    return (F.when(F.col(f"_n_{key}").isNull(), F.lit("error"))
             .when(F.col(f"_n_{key}") < F.lit(CONFIDENCE_THRESHOLD), F.lit("low"))
             .otherwise(F.lit("ok")))


def gate_staged() -> Column:
    """Confidence gate (J16) over staged features: 'pass', 'low' or 'error'.

    The resolution check uses ``resolution_confidence`` or else ``confidence``;
    the category check uses ``category_confidence``. An absent confidence
    passes; the first failing check decides.
    """
    res = (F.when(_present("resolution_confidence"), _cmp_state("resolution_confidence"))
            .when(_present("confidence"), _cmp_state("confidence")))
    cat = F.when(_present("category_confidence"), _cmp_state("category_confidence"))
    return (F.when(res.isin("low", "error"), res)
             .when(cat.isin("low", "error"), cat)
             .otherwise(F.lit("pass")))


def _own_state(field: str) -> Column:
    """State of ``{field}_confidence``, else ``confidence``, else 0 (-> 'low')."""
    own = f"{field}_confidence"
    return (F.when(_present(own), _cmp_state(own))
             .when(_present("confidence"), _cmp_state("confidence"))
             .otherwise(F.lit("low")))


def accepted_staged() -> Column:
    """Fields to write (J17): ``array<struct<slug,value>>``, possibly empty.
    A label is taken when present and its confidence is >= 0.8."""
    recode = {"resolution": recode_resolution, "category": recode_category}
    parts = [F.when(_present(f) & (_own_state(f) == "ok"),
                    F.struct(F.lit(f).alias("slug"), recode[f](F.col(f"_l_{f}")).alias("value")))
             for f in FIELDS]
    return F.array_compact(F.array(*parts))


def accept_error_staged() -> Column:
    """True when choosing the fields would compare a non-number confidence."""
    bad = F.lit(False)
    for f in FIELDS:
        bad = bad | (_present(f) & (_own_state(f) == "error"))
    return bad


def _with_features(df: DataFrame, r: Column) -> DataFrame:
    return df.select("*", *response_features(r))


def gate(df: DataFrame, r: Column, name: str = "gate") -> DataFrame:
    """Add the gate column for response VARIANT ``r`` (features staged)."""
    return _with_features(df, r).withColumn(name, gate_staged()).drop(*FEATURE_COLS)


def accepted_fields(df: DataFrame, r: Column, name: str = "custom_fields") -> DataFrame:
    """Add the accepted-fields column for response VARIANT ``r``."""
    return _with_features(df, r).withColumn(name, accepted_staged()).drop(*FEATURE_COLS)


def append_tag(tags: Column, tag: str) -> Column:
    """Append ``tag`` unless present; existing order and duplicates are kept;
    NULL tags count as empty (J18)."""
    t = F.coalesce(tags, F.array().cast("array<string>"))
    return F.when(F.array_contains(t, F.lit(tag)), t).otherwise(F.array_append(t, F.lit(tag)))


def update_payload(custom_fields: Column, tags: Column) -> Column:
    """``{"custom_fields": [...], "tags": [...]}`` as JSON text."""
    return F.to_json(F.struct(custom_fields.alias("custom_fields"),
                              append_tag(tags, TAG_CLASSIFIED).alias("tags")))


def close_payload(tags: Column) -> Column:
    """``{"state": "closed", "tags": [...]}`` as JSON text."""
    return F.to_json(F.struct(F.lit("closed").alias("state"),
                              append_tag(tags, TAG_CLOSED).alias("tags")))
