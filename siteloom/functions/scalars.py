"""Scalar rules as Column -> Column; all stay inside whole-stage code generation."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

from siteloom.config import DEFAULT, Config


def is_true(c: Column) -> Column:
    """Never null: a null is not true."""
    return c.eqNullSafe(F.lit(True))


def is_false(c: Column) -> Column:
    return c.eqNullSafe(F.lit(False))


def clean(c: Column) -> Column:
    """Trimmed text; a blank is null."""
    return F.nullif(F.trim(c), F.lit(""))


def trust(c: Column) -> Column:
    """high, medium or low; anything else is medium."""
    t = F.lower(F.trim(c))
    return F.when(t.isin("high", "medium", "low"), t).otherwise("medium")


def confidence(c: Column, default: Column | None = None) -> Column:
    """0..1 from a number or text on a scale of 1, 10 or 100; null, NaN and other text give ``default``."""
    v = c.try_cast("double")
    scaled = F.when(v > 100, F.lit(1.0)).when(v > 10, v / 100).when(v > 1, v / 10).otherwise(v)
    return F.when(v.isNull() | F.isnan(v), F.lit(None).cast("double") if default is None else default).otherwise(
        F.greatest(F.lit(0.0), F.least(F.lit(1.0), scaled))
    )


def band(c: Column, config: Config = DEFAULT) -> Column:
    v = confidence(c)
    return F.when(v >= config.high, "high").when(v >= config.medium, "medium").otherwise("low")


def is_asset(site_type: Column) -> Column:
    return F.coalesce(site_type.isin("tower", "rooftop"), F.lit(False))


def confident_stop(site_type: Column, conf: Column, cell: Column, config: Config = DEFAULT) -> Column:
    """A tier that needs no further imagery."""
    return is_asset(site_type) & (band(conf, config) != "low") & cell.isNotNull()


def escalation_reason(site_type: Column, conf: Column, config: Config = DEFAULT) -> Column:
    return F.when(site_type == "other", "other_type").when(site_type == "unclear", "unclear_type").when(band(conf, config) == "low", "low_confidence")


def trust_mismatch(input_confidence: Column, cell: Column) -> Column:
    return (trust(input_confidence) == "high") & is_false(cell)


def has_coordinates(lat: Column, lon: Column) -> Column:
    return lat.isNotNull() & ~F.isnan(lat) & lon.isNotNull() & ~F.isnan(lon)


def asset_label(site: Column, label: Column) -> Column:
    name = clean(label)
    return F.when(name.isNotNull(), F.concat(site, F.lit(" ("), name, F.lit(")"))).otherwise(site)


def metres(offset: Column) -> Column:
    return F.concat(F.bround(offset, 0).cast("long").cast("string"), F.lit(" m off"))


def located(offset: Column, view: Column) -> Column:
    return F.when(offset.isNotNull() & ~F.isnan(offset), metres(offset)).when(clean(view).isNotNull(), F.concat(F.lit("on "), view)).otherwise("—")


def equipment(cell: Column, evidence: Column) -> Column:
    tail = F.coalesce(F.concat(F.lit(" — "), clean(evidence)), F.lit(""))
    return F.when(cell.isNull(), "unknown").otherwise(F.concat(cell.cast("string"), tail))


def cut(c: Column, n: int) -> Column:
    """At most n characters, an ellipsis marking what was cut."""
    return F.when(F.length(c) > n, F.concat(F.substring(c, 1, n), F.lit("…"))).otherwise(c)


def crop_label(reason: Column) -> Column:
    return F.substring(F.regexp_replace(F.coalesce(F.nullif(reason, F.lit("")), F.lit("candidate")), "\n", " "), 1, 80)


def prompt(base: str, stealth: str, by_trust: dict[str, str], label: Column, input_confidence: Column) -> Column:
    """Prompt of a site: the base text, a note for stealth sites, and the text of its trust level."""
    level = trust(input_confidence)
    suffix = F.lit("")
    for name, text in by_trust.items():
        suffix = F.when(level == name, F.lit(text)).otherwise(suffix)
    note = F.when(F.lower(F.trim(label)) == "stealth", F.lit(stealth)).otherwise(F.lit(""))
    return F.concat(F.lit(base), note, suffix)


def imagery_tier(views: Column, naip: Column) -> Column:
    """Extension: full, nearmap_vert_only, naip_only or none."""
    oblique = F.exists(views, lambda v: v != "Vert")
    return F.when(F.coalesce(oblique, F.lit(False)), "full").when(F.coalesce(F.array_contains(views, "Vert"), F.lit(False)), "nearmap_vert_only").when(is_true(naip), "naip_only").otherwise("none")


def manual_review(tier: Column, conf: Column, error: Column, config: Config = DEFAULT) -> Column:
    """Extension: naip only, low confidence or an error."""
    return (tier == "naip_only") | F.coalesce(confidence(conf) < config.medium, F.lit(True)) | clean(error).isNotNull()
