"""Plan hygiene: no pair-forming joins and no row-at-a-time Python in the core queries."""

from conftest import SF_SMALL

CORE = ["score_weekly", "score_articles", "flag_duplicates", "eligible_articles", "adaptive_brief",
        "adaptive_brief_fallback", "briefs_by_domain", "brief_markdown", "top_articles", "link_health_summary",
        "parse_feed", "valid_items", "unscored_articles", "keyword_score"]
FORBIDDEN = ("CartesianProduct", "BroadcastNestedLoopJoin", "BatchEvalPython")


def test_core_plans_have_no_pair_joins_or_row_udfs(spark):
    import __spark_entry__ as E
    qs = E.queries()
    for key in CORE:
        plan = qs[key](spark, SF_SMALL)._jdf.queryExecution().executedPlan().toString()
        bad = [w for w in FORBIDDEN if w in plan]
        assert not bad, (key, bad)


def test_scoring_scan_reads_only_needed_columns(spark):
    import __spark_entry__ as E
    plan = E.queries()["score_weekly"](spark, SF_SMALL)._jdf.queryExecution().executedPlan().toString()
    # documents are read for (doc_id, text, source) only; no lang / n_chars
    assert "n_chars" not in plan and "lang" not in plan


def test_adaptive_brief_evaluates_its_input_once(spark):
    from newsloom.operators.brief import adaptive_briefs
    from newsloom.plans.queries import eligible

    def relations(df):
        return df._jdf.queryExecution().optimizedPlan().toString().count("Relation [doc_id")
    el = eligible(spark, SF_SMALL)
    for group_cols in ([], ["source"]):
        assert 0 < relations(adaptive_briefs(el, "2024-01-31", group_cols)) <= relations(el)
