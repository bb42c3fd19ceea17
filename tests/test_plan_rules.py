"""Names, windows and modes: decided before any job runs."""

from datetime import datetime, timedelta

import pytest

from logweir.operators import breakdown, bundles, paging
from logweir.operators.views import VIEWS
from logweir.plans import fixed_values as fv
from logweir.plans import timewindow as tw
from logweir.plans.errors import NoExactView, PlanError, UnknownField, WrongPopulation
from logweir.plans.vocabulary import dimensions, vocabulary
from logweir.sources.logs import log_type

NOON = datetime(2026, 7, 8, 12, 0, 0)


@pytest.mark.parametrize(("name", "minutes"), [("now", 5), ("1-day", 1440), ("24-hour", 1440), ("90-day", 129600)])
def test_preset_ends_at_anchor(name, minutes):
    window = tw.preset_window(name, NOON)
    assert (window.start, window.end) == (NOON - timedelta(minutes=minutes), NOON)


def test_unknown_preset_is_an_error():
    with pytest.raises(PlanError, match="unknown window"):
        tw.preset_window("1-hours", NOON)


def test_custom_precisions():
    window = tw.custom_window("2026-01-01 10:30 | 2026-01-02")
    assert window.start == datetime(2026, 1, 1, 10, 30)
    assert window.end == datetime(2026, 1, 2, 23, 59, 59)


@pytest.mark.parametrize("text", ["2026-01-02|2026-01-01", "|2026-01-01", "2026-01-01|", "x|y", "2026-13-01|2026-13-02"])
def test_bad_custom_windows(text):
    with pytest.raises(PlanError):
        tw.custom_window(text)


def test_anchor_is_the_first_plausible_candidate():
    stale, ahead, good = NOON - timedelta(days=401), NOON + timedelta(days=3), NOON - timedelta(hours=2)
    chosen = tw.choose_anchor([("a", stale), ("b", ahead), ("c", None), ("d", good)], NOON)
    assert (chosen.source, chosen.clock_skew_seconds) == ("d", -7200)
    assert tw.choose_anchor([("a", stale)], NOON) == tw.Anchor(NOON, "clock", 0)


@pytest.mark.parametrize(
    ("text", "capped", "floored"),
    [("30-day", "7-day", "90-day"), ("1-hour", "1-hour", "90-day"), ("90-day", "7-day", "90-day"), ("a|b", "a|b", "a|b"), ("odd", "odd", "odd")],
)
def test_cap_and_floor(text, capped, floored):
    assert tw.cap_window(text) == (capped, capped != text)
    assert tw.floor_window(text) == floored


@pytest.mark.parametrize(
    ("text", "period"),
    [("7-day", "last-7-days"), ("1-hour", "last-1-hours"), ("last-3-months", "last-3-months"), ("a|b", "other")],
)
def test_report_period(text, period):
    assert tw.report_period(text) == period


def test_report_period_refuses_others():
    with pytest.raises(PlanError):
        tw.report_period("5-min")


@pytest.mark.parametrize(("hours", "policies", "count"), [(24, 1, 1), (25, 1, 4), (25, 6, 4), (25, 8, 3), (25, 24, 1), (25, 100, 1)])
def test_slice_count(hours, policies, count):
    window = tw.TimeWindow(NOON, NOON + timedelta(hours=hours))
    assert tw.slice_count(window, policies) == count


@pytest.mark.parametrize("count", [1, 2, 3, 4, 7])
def test_slices_tile_the_window(count):
    window = tw.TimeWindow(NOON, NOON + timedelta(seconds=1000))
    parts = tw.slices(window, count)
    assert (parts[0].start, parts[-1].end) == (window.start, window.end)
    assert all(b.start - a.end == timedelta(seconds=1) for a, b in zip(parts, parts[1:], strict=False))
    assert sum(p.seconds for p in parts) == window.seconds
    assert max(p.seconds for p in parts) - min(p.seconds for p in parts) <= 1


def test_more_slices_than_seconds():
    assert len(tw.slices(tw.TimeWindow(NOON, NOON + timedelta(seconds=1)), 5)) == 2


def test_fields_resolve_by_alias_and_case():
    traffic = vocabulary("Traffic")
    assert traffic.resolve(" Source_IP ") == ("srcip", None)
    assert traffic.resolve("srcip") == ("srcip", None)
    name, warning = traffic.resolve("tunnelid")
    assert name == "tunnelid" and "not a known traffic field" in warning
    with pytest.raises(PlanError, match="shaped"):
        traffic.resolve("srcip == 1")


def test_closed_tables_refuse_strangers_in_filters_only():
    with pytest.raises(UnknownField):
        vocabulary("device").resolve("oid")
    assert vocabulary("device").resolve("oid", strict=False)[0] == "oid"


def test_codes():
    assert vocabulary("device").code("conn_status", " UP ") == 1
    assert vocabulary("task").code("state", 7) == 7
    with pytest.raises(PlanError, match="not a state value"):
        vocabulary("task").code("state", "finished")


def test_unknown_members_only_warn():
    traffic = vocabulary("traffic")
    assert traffic.member_warning("action", "Deny") is None
    assert "not a known traffic action" in traffic.member_warning("action", "denied")
    assert vocabulary("voip").member_warning("action", "x") is None


def test_default_columns_are_fields():
    for name in fv.DEFAULT_COLUMNS:
        vocab = vocabulary(name)
        assert set(vocab.default_columns) <= set(vocab.fields) | {"date", "time"}


def test_default_columns_keep_join_keys():
    for name, key in (("traffic", "sessionid"), ("attack", "sessionid"), ("alert", "alertid"), ("incident", "incid"), ("endpoint", "epid")):
        assert key in vocabulary(name).default_columns


def test_log_types():
    assert log_type(" Anomaly ") == "attack"
    assert len(fv.LOG_TYPES) == 29
    for wrong in ("utm", "", "traffics"):
        with pytest.raises(PlanError):
            log_type(wrong)


def test_exact_dimensions():
    assert breakdown.exact_dimensions("traffic") == ["dstcountry", "dstip", "policyid", "srcip"]
    assert breakdown.exact_dimensions("dns") == []
    assert breakdown.check_exact(vocabulary("traffic"), "source_ip") == ("srcip", "top-sources")
    assert breakdown.check_exact(vocabulary("incident"), "category") == ("category", None)
    with pytest.raises(WrongPopulation, match="reads traffic logs"):
        breakdown.check_exact(vocabulary("attack"), "srcip")
    with pytest.raises(NoExactView) as caught:
        breakdown.check_exact(vocabulary("traffic"), "app")
    assert not isinstance(caught.value, WrongPopulation)
    with pytest.raises(NoExactView):
        breakdown.check_exact(vocabulary("alert"), "epid")


def test_view_filters():
    breakdown.check_exact(vocabulary("traffic"), "srcip", ["srcip"])
    with pytest.raises(PlanError, match="does not filter"):
        breakdown.check_exact(vocabulary("traffic"), "srcip", ["dstip"])


def test_one_mode_at_most():
    assert breakdown.check_mode("srcip", None, False, ["a"]) == ["fields are ignored with group_by"]
    assert breakdown.check_mode(None, None, False, ["a"]) == []
    with pytest.raises(PlanError):
        breakdown.check_mode("srcip", ["app"], False, None)


def test_dimensions_dedupe_by_first_spelling():
    names, warnings = dimensions(vocabulary("traffic"), ["Application", "port", "app", "odd"], ["port"])
    assert names == ["app", "port", "odd"] and len(warnings) == 1


def test_views_have_their_sort_column():
    assert set(fv.VIEW_SORT) <= set(VIEWS) and len(VIEWS) == 10


@pytest.mark.parametrize(
    ("offset", "count", "limit", "known", "more"),
    [(0, 10, 10, None, True), (0, 9, 10, None, False), (0, 10, 10, 10, False), (0, 10, 10, 11, True), (10, 0, 10, 99, False)],
)
def test_has_more(offset, count, limit, known, more):
    assert paging.has_more(offset, count, limit, known) is more


def test_drift_labels():
    assert paging.drift(230071, 230741) == paging.Drift(230071, 230741, "drifted", 670, 230741)
    assert paging.drift(5, 5).stability == "stable"
    assert paging.drift(5, None).stability == "unknown"
    assert paging.drift(None, 7).paging_total == 7


def test_entity_text():
    assert bundles.entity_of("EPID: 12") == ("epid", 12)
    assert bundles.entity_of("euid:3") == ("euid", 3)
    assert bundles.entity_of("10.0.0.1") == ("ip", "10.0.0.1")
    assert bundles.entity_of("fe80::1") == ("ip", "fe80::1")
    for wrong in ("epid:x", "host", "10.0 .1"):
        with pytest.raises(PlanError):
            bundles.entity_of(wrong)
