"""Registered queries: name -> callable(spark, sf_dir) -> DataFrame.

Each reads the driver tables (or the messy view, a projection of ``orders``) in
full; nothing is sampled or capped.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from veridq import spec
from veridq.operators import validate as V
from veridq.plans.oracle import VALIDATE_GROUPS
from veridq.sources.messy import messy

AS_OF = spec.GOLDEN_AS_OF
Query = Callable[[SparkSession, str], DataFrame]


def _validate_group(cols):
    return lambda spark, sf: V.failures(messy(spark, sf), AS_OF, columns=cols)


def validation_queries() -> dict[str, Query]:
    out: dict[str, Query] = {name: _validate_group(cols) for name, cols in VALIDATE_GROUPS.items()}
    out["validate_all_failures"] = lambda spark, sf: V.failures(messy(spark, sf), AS_OF)
    out["validate_column_summary"] = lambda spark, sf: V.column_summary(messy(spark, sf), AS_OF)
    out["validate_row_status"] = lambda spark, sf: V.row_status(messy(spark, sf), AS_OF)
    out["validate_overall"] = lambda spark, sf: V.overall(messy(spark, sf), AS_OF)
    return out


def all_queries() -> dict[str, Query]:
    out: dict[str, Query] = {}
    out.update(validation_queries())
    out.update(profile_queries())
    out.update(pii_queries())
    out.update(clean_mask_queries())
    out.update(extension_queries())
    out.update(streaming_queries())
    out.update(pipeline_queries())
    return out


def profile_queries() -> dict[str, Query]:
    from veridq.operators import profile as P
    from veridq.sources.tables import spread, table

    ms = messy
    iss = lambda spark, sf: P.issues(ms(spark, sf), AS_OF)
    return {
        "profile_completeness": lambda spark, sf: P.completeness(ms(spark, sf)),
        "profile_completeness_orders": lambda spark, sf: P.completeness(table(spark, sf, "orders")),
        "profile_type_conformance": lambda spark, sf: P.type_conformance(ms(spark, sf)),
        "profile_phone_formats": lambda spark, sf: P.phone_formats(ms(spark, sf)),
        "profile_date_formats": lambda spark, sf: P.date_formats(ms(spark, sf)),
        "profile_key_uniqueness": lambda spark, sf: P.key_duplicates(ms(spark, sf), ["customer_id"]),
        "profile_key_uniqueness_lineitem": lambda spark, sf: P.key_duplicates(
            spread(spark, sf, "lineitem", ["l_orderkey", "l_linenumber"], "l_orderkey", "l_linenumber"),
            ["l_orderkey", "l_linenumber"], order_col=None),
        "profile_key_summary": lambda spark, sf: P.key_uniqueness(ms(spark, sf), ["customer_id"]),
        "issues_invalid_values": lambda spark, sf: P.local_issues(ms(spark, sf), AS_OF, kinds=("invalid",)),
        "issues_status": lambda spark, sf: P.local_issues(ms(spark, sf), AS_OF, kinds=("status",)),
        "issues_name_casing": lambda spark, sf: P.local_issues(ms(spark, sf), AS_OF, kinds=("names",)),
        "issues_phone_format": lambda spark, sf: P.phone_issues(ms(spark, sf)),
        "issues_all": iss,
        "issues_by_severity": lambda spark, sf: P.issues_by_severity(ms(spark, sf), AS_OF),
        "issues_totals": lambda spark, sf: P.issue_totals(ms(spark, sf), AS_OF),
        "profile_row_health": lambda spark, sf: P.row_health(ms(spark, sf), AS_OF),
    }


def pii_queries() -> dict[str, Query]:
    from veridq.operators import pii as D
    from veridq.sources.tables import TABLES, spread, table

    return {
        "pii_column_classification": lambda spark, sf: D.classification(messy(spark, sf)),
        "pii_coverage": lambda spark, sf: D.coverage(messy(spark, sf)),
        "pii_row_inventory": lambda spark, sf: D.inventory_text(messy(spark, sf)),
        "pii_at_risk": lambda spark, sf: D.at_risk(messy(spark, sf)),
        "pii_every_cell": lambda spark, sf: D.scan_tables({t: table(spark, sf, t) for t in TABLES}),
        "pii_text_scan_documents": lambda spark, sf: D.text_hits(spread(spark, sf, "documents", ["doc_id", "text"]), "doc_id", ["text"]),
        "pii_text_scan_pages": lambda spark, sf: D.text_hits(
            spread(spark, sf, "pages", ["page_id", "url", "html"]), "page_id", ["url", "html"]),
        "pii_text_scan_conversations": lambda spark, sf: D.text_hits(
            table(spark, sf, "conversations").withColumn("msg_id", F.concat_ws(":", "conv_id", "turn")),
            "msg_id", ["text"]),
        "pii_text_matches_documents": lambda spark, sf: D.text_matches(spread(spark, sf, "documents", ["doc_id", "text"]), "doc_id", ["text"]),
        "pii_text_summary_documents": lambda spark, sf: D.text_summary(spread(spark, sf, "documents", ["doc_id", "text"]), "doc_id", ["text"]),
    }


def clean_mask_queries() -> dict[str, Query]:
    from veridq.operators import clean as C
    from veridq.operators import mask as MK
    from veridq.sources.tables import table

    def aud(cond):
        return lambda spark, sf: C.audit(messy(spark, sf), AS_OF).where(cond)

    def cleaned(spark, sf):
        return C.clean(messy(spark, sf, deal=False), AS_OF)  # its first step is an exchange

    def masked_cols(*cols):
        return lambda spark, sf: MK.mask(cleaned(spark, sf)).select("row_num", *cols)

    return {
        "clean_phone": aud("step = 'phone_format'"),
        "clean_dates": aud("step = 'date_format'"),
        "clean_names": aud("step = 'name_case'"),
        "clean_fill": aud("step = 'fill_missing'"),
        "clean_dedupe": aud("step = 'dedupe'"),
        "clean_negative_income": aud("step = 'negative_income'"),
        "clean_extreme_age": aud("step = 'extreme_age'"),
        "clean_flags": aud("action = 'flag'"),
        "clean_full": cleaned,
        "clean_row_numbers": lambda spark, sf: C.dense_renumber(cleaned(spark, sf)).select("row_num", "clean_row_num"),
        "clean_audit_counts": lambda spark, sf: C.audit_counts(C.audit(messy(spark, sf), AS_OF)),
        "clean_summary": lambda spark, sf: C.summary(messy(spark, sf), AS_OF),
        "clean_before_after": lambda spark, sf: C.before_after(messy(spark, sf), AS_OF),
        "clean_negative_balance": lambda spark, sf: C.fix_negative_numeric(
            table(spark, sf, "customer"), "c_custkey", "c_acctbal"),
        "mask_names": masked_cols("first_name", "last_name"),
        "mask_email": masked_cols("email"),
        "mask_phone": masked_cols("phone"),
        "mask_address": masked_cols("address"),
        "mask_dob": masked_cols("date_of_birth"),
        "mask_full": lambda spark, sf: MK.mask(cleaned(spark, sf)),
        "mask_sample": lambda spark, sf: MK.sample(cleaned(spark, sf), MK.mask(cleaned(spark, sf))),
        "mask_summary": lambda spark, sf: MK.mask_summary(cleaned(spark, sf)),
    }


def strict_phone() -> V.Rule:
    """The phone rule with another limit: what the re-scan query changes."""
    pre, post = spec.MSG_PHONE_DIGITS.split("{}")
    n = F.col("__nd_phone")
    message = F.concat(F.lit(pre), n.cast("string"), F.lit(post))
    bad = F.col("phone").isNotNull() & (F.col("__s_phone") != "") & ~n.between(11, spec.PHONE_MAX_DIGITS)
    return V.rule(bad, "phone", "digits", message, F.col("phone"))


def extension_queries() -> dict[str, Query]:
    from veridq.operators import clean as C
    from veridq.operators import extend as XT
    from veridq.operators import gate as G
    from veridq.operators import lineage as L
    from veridq.operators import rescan as R
    from veridq.operators import sketches as K
    from veridq.session import new_path
    from veridq.sources.tables import table

    def rescan(spark, sf):
        """Scan, then change one rule, drop one, and scan again."""
        df, store, rules = messy(spark, sf), new_path(spark, "rescan"), R.RuleSet.default(AS_OF)
        R.scan(df, store, rules)
        R.scan(df, store, rules.change(strict_phone(), drop=("first_name.charset",)))
        return R.stored(spark, store)

    def sketch_weeks(spark, sf):
        """Daily sketches of the events, stored, merged by week and held against exact counts."""
        events, path = table(spark, sf, "events"), new_path(spark, "daily")
        K.daily(events, F.to_date("ts"), ["user_id"], ["value"]).write.parquet(path)
        return K.weekly_check(events, spark.read.parquet(path), "2024-01-01")

    def gate(spark, sf):
        """A batch that passes on its email rules and one that is held on all rules."""
        df, store = messy(spark, sf), new_path(spark, "gate")
        G.stage(df, store, "email", AS_OF, columns=["email"])
        G.stage(df, store, "all", AS_OF)
        views = {"published": G.published(spark, store), "quarantined": G.quarantined(spark, store)}
        parts = [v.select(F.lit(k).alias("view"), "batch", "row_num", "n_failures") for k, v in views.items()]
        return parts[0].unionByName(parts[1])

    return {
        "ext_cross_column": lambda spark, sf: XT.cross_column_failures(messy(spark, sf), AS_OF),
        "ext_soft_duplicates": lambda spark, sf: XT.soft_duplicates(messy(spark, sf)),
        "ext_fuzzy_duplicates": lambda spark, sf: XT.fuzzy_duplicates(messy(spark, sf)),
        "ext_zscore_outliers": lambda spark, sf: XT.totalprice_outliers(table(spark, sf, "orders")),
        "ext_zscore_income": lambda spark, sf: XT.income_outliers(messy(spark, sf)),
        "ext_referential_orphans": lambda spark, sf: XT.referential_report(lambda n: table(spark, sf, n)),
        "ext_quarantine_split": lambda spark, sf: XT.quarantine_split(messy(spark, sf), AS_OF),
        "ext_lineage_replay": lambda spark, sf: L.replay(messy(spark, sf), C.audit(messy(spark, sf), AS_OF)),
        "ext_lineage_restore": lambda spark, sf: L.restore(C.clean(messy(spark, sf), AS_OF), C.audit(messy(spark, sf), AS_OF)),
        "ext_lineage_report": lambda spark, sf: L.report(
            messy(spark, sf), C.clean(messy(spark, sf), AS_OF), C.audit(messy(spark, sf), AS_OF)),
        "ext_sketch_weeks": sketch_weeks,
        "ext_rescan": rescan,
        "ext_gate": gate,
        "ext_failure_drift": lambda spark, sf: XT.failure_drift(table(spark, sf, "events")),
        "ext_review_queue": lambda spark, sf: XT.review_queue(messy(spark, sf), AS_OF),
        "ext_income_brackets": lambda spark, sf: C.clean(messy(spark, sf), AS_OF).select(
            "row_num", XT.income_bracket("income").alias("income_bracket")),
    }


def streaming_queries() -> dict[str, Query]:
    from veridq.streaming import stream as S

    return {
        "stream_validate": lambda spark, sf: S.validate_stream(spark, sf, AS_OF),
        "stream_mask": S.mask_stream,
        "stream_dedupe": S.dedupe_stream,
        "stream_event_quality": S.event_quality_stream,
        "stream_duplicate_ids": S.duplicate_ids_stream,
        "stream_pii_conversations": S.pii_conversations_stream,
        "stream_pii_windows": S.pii_windows_stream,
    }


def pipeline_queries() -> dict[str, Query]:
    from veridq.plans.pipeline import published_table, run_pipeline
    from veridq.session import new_path

    def summary(spark, sf):
        res = run_pipeline(spark, messy(spark, sf), as_of=AS_OF)
        return res.run_log.select("stage", "status", "detail", "rows_in", "rows_out")

    def manifest(spark, sf):
        res = run_pipeline(spark, messy(spark, sf), as_of=AS_OF)
        return res.manifest.select("table", "rows", "status")

    def gated(spark, sf):
        """A run that is published, then one that the gate holds: the first one's masked rows
        stay visible."""
        store = new_path(spark, "published")
        first = run_pipeline(spark, messy(spark, sf), as_of=AS_OF, publish_dir=store, max_failure_rate=1.0)
        second = run_pipeline(spark, messy(spark, sf), as_of=AS_OF, publish_dir=store)
        rows = published_table(spark, store)
        return rows.withColumns({"first_run": F.lit(first.status), "second_run": F.lit(second.status)})

    return {"pipeline_summary": summary, "manifest": manifest, "pipeline_gate": gated}
