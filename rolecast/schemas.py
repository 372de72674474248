"""Schemas of the tables that operators exchange, and the closed vocabularies in them."""

from __future__ import annotations

CANONICAL = "url string, title string, description string, company_name string, source string, published_at string, location_raw string, salary_min string, salary_max string, currency string, original_language string, external_id string, source_hints map<string,string>"
RAW_JOB = "arrival_idx long, url string, title string, description string, company_name string, source string, posted_at timestamp, location_raw string, salary_min long, salary_max long, currency string, original_language string, external_id string, source_hints map<string,string>"
URL_OBSERVATION = "url string, status_code int, final_url string, n_redirects int, error_kind string"
PROBE_OBSERVATION = "url string, source string, head_status int, location string, body string, error_kind string"
AI_RESULT = "cache_key string, content string, model string, tier string, confidence double"
AI_OUTPUT = "skills array<string>, category string, seniority string, role_family string, employment_type string, remote_mode string, salary_min double, salary_max double, currency string, languages_required array<string>, quality_flags array<string>, cv_drop_score double, confidence double, field_confidence map<string,double>"
SCRAPE_METRICS = ("total_jobs_seen", "total_jobs_passed", "sum_quality_scores", "jobs_with_salary", "jobs_with_skills", "premium_count", "jobs_with_seniority", "sum_description_length")

# The vocabularies of the model's output and of a posting's life.
SUPPORTED_LANGUAGES = ("en", "it", "es", "de", "fr", "pt")
LIVE_STATUSES = ("active", "valid", "premium")
VOCABULARY = {
    "seniority": (("junior", "mid", "senior", "lead", "principal", "unknown"), "unknown"),
    "employment_type": (("full_time", "part_time", "contract", "freelance", "internship", "unknown"), "unknown"),
    "remote_mode": (("onsite", "hybrid", "remote", "unknown"), "unknown"),
    "role_family": (("frontend", "backend", "fullstack", "devops", "data", "ml", "mobile", "qa", "security", "design", "pm", "other"), "other"),
    "category": (("software-engineering", "devops-sysadmin", "data-ml", "design", "product-management", "engineering-management", "security", "qa-testing", "mobile", "other-it"), None),
}
FIELD_CONFIDENCE_KEYS = ("salary", "remote_mode", "seniority", "company_quality", "technologies")
