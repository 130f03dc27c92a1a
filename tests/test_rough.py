"""Rough rows: what each rule finds there is not nothing."""

from filmdw.plans.rough_queries import ROUGH_QUERIES, _cleaned, _spoiled
from filmdw.sources.bindings import rough_from_orders

SMALL = "/root/testdata/sf0.001"


def found(spark, name):
    return [row.asDict() for row in ROUGH_QUERIES[name](spark, SMALL).collect()]


def test_rough_rows_are_text(spark):
    assert {kind for _, kind in rough_from_orders(spark, SMALL).dtypes} == {"string"}


def test_every_filter_removes_rows(spark):
    steps = {r["step"]: r["rows"] for r in found(spark, "rough_step_counts")}
    assert len(steps) == 5 and all(steps.values())
    assert sum(steps.values()) == rough_from_orders(spark, SMALL, ()).count()


def test_studios_have_all_sizes(spark):
    sizes = {r["studio_name"]: r["studio_size"] for r in found(spark, "rough_studios")}
    assert sizes["Columbia Pictures"] == "Large"
    assert sizes["Independent Film Makers of Region 3"] == "Medium"
    assert "Small" in sizes.values()


def test_checks_fail_on_spoiled_rows(spark):
    match = found(spark, "rough_formula_match")[0]
    assert 0 < match["profit_matches"] < match["profit_rows"] and 0 < match["roi_matches"] < match["roi_rows"]
    checks = {r["check_name"]: r for r in found(spark, "rough_cleaned_checks")}
    for name in ("title", "release_date", "budget", "revenue", "genres"):
        assert checks[f"null {name}"]["value"] > 0 and not checks[f"null {name}"]["passed"]


def test_gaps_are_filled_and_titles_without_revenue_left_out(spark):
    spoiled = _spoiled(spark, SMALL)
    rows = found(spark, "rough_features")
    assert spoiled.where("runtime IS NULL").count() > 0 and all(r["runtime"] is not None for r in rows)
    assert 0 < len(rows) < spoiled.count() and all(r["revenue"] > 0 for r in rows)


def test_long_titles_are_cut_for_display_only(spark):
    rows = found(spark, "rough_top_grossing")
    assert all(len(r["shown_title"]) == 45 < len(r["title"]) for r in rows)
    assert _cleaned(spark, SMALL).where("length(title) <= 45").count() == 0
