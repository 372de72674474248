"""Verdicts on urls from recorded probes, and the expiry sweep."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..schemas import LIVE_STATUSES

# Paths and phrases that tell of a dead listing.
DEAD_PATHS = ("", "/", "/jobs", "/careers", "/search", "/home")
REDIRECTS = (r"/expired", r"/job-not-found", r"/offre-expiree", r"/annuncio-scaduto", r"/oferta-cerrada", r"/stelle-nicht-mehr-verfuegbar", r"/(job|position|stelle|oferta|offre|annuncio)/(expired|closed|filled|scaduto|chiusa|abgelaufen)")
PHRASES = {
    "it": (
        "annuncio scaduto", "posizione non più disponibile", "offerta chiusa", "annuncio rimosso", "candidature chiuse", "selezione chiusa",
        "posizione coperta", "annuncio non più attivo", "ricerca terminata", "offerta non disponibile", "ricerca conclusa",
    ),
    "en": (
        "this position is no longer available", "job has been filled", "no longer accepting applications", "this vacancy is closed",
        "posting has expired", "role has been filled", "we are no longer hiring for this role", "application window closed",
        "this listing has been removed", "opportunity is closed", "position has been closed",
    ),
    "es": (
        "oferta cerrada", "oferta expirada", "puesto cubierto", "oferta no disponible", "vacante cerrada", "proceso de selección cerrado",
        "ya no aceptamos candidaturas", "oferta eliminada", "anuncio caducado", "posición ya no disponible", "vacante ya no disponible",
    ),
    "de": (
        "stelle nicht mehr verfügbar", "stellenanzeige abgelaufen", "position besetzt", "bewerbungen geschlossen", "anzeige wurde entfernt",
        "stelle ist geschlossen", "vakanz beendet", "auswahlverfahren abgeschlossen", "anzeige nicht mehr aktiv", "stellenausschreibung gelöscht",
        "stelle wurde besetzt",
    ),
    "fr": (
        "offre expirée", "poste pourvu", "annonce supprimée", "candidatures clôturées", "offre fermée", "recrutement terminé", "poste non disponible",
        "annonce non publiée", "offre clôturée", "ce poste n'est plus disponible", "offre non disponible",
    ),
}
SHORT_BODY, BATCH, PROBE_HOURS, MOST_DAYS = 500, 500, 24, 60


def url_verdict() -> Column:
    """Struct of is_valid and reason from a row of ``schemas.URL_OBSERVATION``; what is not known counts as valid."""
    path = F.coalesce(F.nullif(F.regexp_replace(F.regexp_extract(F.coalesce("final_url", F.lit("")), r"^[A-Za-z][\w+.-]*://[^/?#]*([^?#]*)", 1), "/+$", ""), F.lit("")), F.lit("/"))
    code = F.col("status_code")
    reason = (
        F.when(F.col("error_kind") == "dns", "dns_error").when(F.col("error_kind") == "timeout", "timeout").when(F.col("error_kind").isNotNull(), "transient")
        .when(code == 404, "http_404").when(code == 410, "http_410").when((F.coalesce("n_redirects", F.lit(0)) > 0) & path.isin(*DEAD_PATHS), "redirect_to_root")
        .when(code.between(200, 399), "ok").otherwise("transient")
    )
    return F.struct((~reason.isin("http_404", "http_410", "redirect_to_root", "dns_error")).alias("is_valid"), reason.alias("reason"))


def dns_error(message: Column) -> Column:
    return F.coalesce(F.lower(message).rlike("name or service|nodename nor servname|getaddrinfo"), F.lit(False))


def retryable(status: Column) -> Column:
    """Whether a call may be tried again: too many calls, or an error of the server."""
    return F.coalesce((status == 429) | status.between(500, 599), F.lit(False))


def redirect_expired(location: Column) -> Column:
    return F.coalesce(location.rlike("(?i)" + "|".join(REDIRECTS)), F.lit(False))


def quoted(phrases: list[str]) -> str:
    return "(?iu)" + "|".join(rf"\Q{p}\E" for p in phrases)


def soft_404(body: Column, source: Column | None = None, by_source: dict[str, list[str]] | None = None) -> Column:
    """Whether a body says that the listing is gone: by its source's phrases, else by those of all languages if it is short."""
    generic = (F.length(body) < SHORT_BODY) & body.rlike(quoted([p for ps in PHRASES.values() for p in ps]))
    own = [F.when(source == s, body.rlike(quoted(ps))) for s, ps in (by_source or {}).items()]
    return F.coalesce(*own, generic, F.lit(False))


def expiry_verdict(by_source: dict[str, list[str]] | None = None) -> Column:
    """Struct of expired (null: not known) and reason from a row of ``schemas.PROBE_OBSERVATION``."""
    code, yes, no, unknown = F.col("head_status"), F.lit(True), F.lit(False), F.lit(None).cast("boolean")
    pick = lambda e, r: F.struct(e.alias("expired"), r.alias("reason"))
    none = F.lit(None).cast("string")
    known = F.col("source").isin(*by_source) if by_source else no
    return (
        F.when(F.col("error_kind") == "redirect_loop", pick(yes, F.lit("EXPIRED_REDIRECT_LOOP"))).when(F.col("error_kind").isNotNull(), pick(unknown, F.lit("PROBE_ERROR")))
        .when(code.isin(404, 410, 451), pick(yes, F.concat(F.lit("EXPIRED_"), code.cast("string"))))
        .when(code.isin(301, 302, 303, 307, 308) & redirect_expired(F.col("location")), pick(yes, F.lit("EXPIRED_REDIRECT")))
        .when(code.between(500, 599), pick(unknown, F.concat(F.lit("TRANSIENT_"), code.cast("string"))))
        .when((code == 200) & known & soft_404(F.col("body"), F.col("source"), by_source), pick(yes, F.lit("EXPIRED_PATTERN")))
        .otherwise(pick(no, none))
    )


def max_age_expired(as_of: Column, days: int = MOST_DAYS) -> Column:
    return F.coalesce(F.col("status").isin(*LIVE_STATUSES) & (F.col("posted_at") < as_of - F.expr(f"INTERVAL {days} DAYS")) & F.col("last_probed_at").isNull(), F.lit(False))


def expire_by_age(jobs: DataFrame, as_of: Column, days: int = MOST_DAYS) -> DataFrame:
    old = max_age_expired(as_of, days)
    if "reject_reason" not in jobs.columns:
        jobs = jobs.withColumn("reject_reason", F.lit(None).cast("string"))
    return jobs.withColumn("_old", old).withColumns({"status": F.when(F.col("_old"), "expired").otherwise(F.col("status")), "reject_reason": F.when(F.col("_old"), "EXPIRED_MAX_AGE").otherwise(F.col("reject_reason")), "last_probed_at": F.when(F.col("_old"), as_of).otherwise(F.col("last_probed_at"))} | ({"expires_at": F.when(F.col("_old"), as_of).otherwise(F.col("expires_at"))} if "expires_at" in jobs.columns else {})).drop("_old")


def probe_candidates(jobs: DataFrame, as_of: Column, key: str, limit: int = BATCH, hours: int = PROBE_HOURS) -> DataFrame:
    """Live jobs not probed of late, those never probed first; ``limit`` is the batch of a sweep."""
    due = F.col("status").isin(*LIVE_STATUSES) & (F.col("last_probed_at").isNull() | (F.col("last_probed_at") < as_of - F.expr(f"INTERVAL {hours} HOURS")))
    return jobs.filter(due).orderBy(F.asc_nulls_first("last_probed_at"), key).limit(limit)


def apply_verdicts(jobs: DataFrame, verdicts: DataFrame, as_of: Column) -> DataFrame:
    """Jobs after a sweep: the expired change their status, and all that were probed carry the time."""
    v = verdicts.select("url", F.col("verdict.expired").alias("_expired"), F.col("verdict.reason").alias("_reason"), F.lit(True).alias("_probed"))
    out = jobs.join(v, "url", "left")
    return out.withColumns({"status": F.when(F.col("_expired"), "expired").otherwise(F.col("status")), "reject_reason": F.when(F.col("_expired"), F.col("_reason")).otherwise(F.col("reject_reason")), "last_probed_at": F.when(F.col("_probed"), as_of).otherwise(F.col("last_probed_at"))}).drop("_expired", "_reason", "_probed")


def expiry_counters(probed: DataFrame, max_age_expired: int = 0, dry_run: bool = False) -> DataFrame:
    """The eight counters of a sweep over ``url`` and ``verdict``: postings without a url are errors and not probed; a probe
    that failed counts as an error and as transient."""
    e, r, there = F.col("verdict.expired"), F.col("verdict.reason"), F.coalesce(F.col("url") != "", F.lit(False))
    counts = {
        "total": F.lit(True), "probed": there, "expired": there & F.coalesce(e, F.lit(False)), "transient": there & e.isNull(), "alive": there & F.coalesce(~e, F.lit(False)),
        "error": ~there | F.coalesce(r == "PROBE_ERROR", F.lit(False)), "dry_run_skipped": there & F.lit(dry_run),
    }
    return probed.agg(*(F.count_if(c).alias(n) for n, c in counts.items())).withColumn("max_age_expired", F.lit(max_age_expired).cast("long"))


def sweep_counters(verdicts: DataFrame) -> DataFrame:
    e, r = F.col("verdict.expired"), F.col("verdict.reason")
    return verdicts.agg(F.count("*").alias("total"), F.count_if(e).alias("expired"), F.count_if(~e).alias("alive"), F.count_if(e.isNull()).alias("transient"), F.count_if(r == "PROBE_ERROR").alias("errors"))
