"""Profiles, growth, churn, A/B and level changes on tiny frames."""

import datetime as dt

from eventide.operators import growth, sessions


def _ev(spark, rows):
    return spark.createDataFrame(
        [(u, i, dt.datetime.fromisoformat(t), p, a, tag) for i, (u, t, p, a, tag) in enumerate(rows)],
        "user_id long, event_id long, ts timestamp, page string, auth string, tag string")


ROWS = [
    (1, "2024-01-01T10:00:00", "Home", "Logged In", "control"),        # holiday (Jan 1)
    (1, "2024-01-06T10:00:00", "Submit Upgrade", "Logged In", "control"),   # Saturday
    (2, "2024-01-08T11:30:00", "Home", "Logged In", "test"),           # Monday
    (2, "2024-01-08T11:40:00", "Submit Downgrade", "Cancelled", "test"),
    (3, "2024-01-08T23:59:00", "Home", "Logged In", "test"),
]


def test_day_class_and_hours(spark):
    df = _ev(spark, ROWS)
    got = {r.day_class: (r.n_events, r.n_days) for r in growth.weekday_profile(df).collect()}
    assert got == {"holiday": (1, 1), "weekend": (1, 1), "workday": (3, 1)}
    hours = {r.hour: r.n_events for r in growth.hourly_profile(df).collect()}
    assert hours == {10: 2, 11: 2, 23: 1}


def test_growth_churn_levels_tags(spark):
    df = _ev(spark, ROWS)
    g = [(str(r.date), r.new_users, r.total_users)
         for r in growth.user_growth(df).orderBy("date").collect()]
    assert g == [("2024-01-01", 1, 1), ("2024-01-08", 2, 3)]
    churned = [r.user_id for r in growth.churned_users(df, order=["ts", "event_id"]).collect()]
    assert churned == [2]
    lv = {str(r.date): (r.upgrades, r.downgrades) for r in growth.level_changes(df).collect()}
    assert lv == {"2024-01-06": (1, 0), "2024-01-08": (0, 1)}
    s = sessions.sessionize(df)
    tags = {r.tag: (r.users, r.events, r.sessions) for r in growth.tag_comparison(s).collect()}
    assert tags == {"control": (1, 2, 2), "test": (2, 3, 2)}


def test_summary_transitions_gaps(spark):
    df = _ev(spark, ROWS)
    pv = sessions.session_pass(df, page_col="page", want=("prev_ts", "next_page", "next_ts"))
    summ = {r.user_id: (r.n_events, r.last_page, r.duration_s) for r in
            sessions.session_summary(pv, order=["ts", "event_id"], level_col="auth").collect()
            if r.user_id == 2}
    assert summ == {2: (2, "Submit Downgrade", 600.0)}
    t = {(r.source, r.dest): r.n for r in sessions.transition_matrix(pv).collect()}
    assert t[("Home", "Submit Downgrade")] == 1 and t[("Home", "(end)")] == 2
    gaps = {r.user_id: r.mean_event_gap_s for r in sessions.event_gaps(pv).collect()}
    assert gaps == {2: 600.0}
