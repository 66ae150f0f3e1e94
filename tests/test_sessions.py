import random
from datetime import datetime, timedelta

import pytest
from pyspark.sql import functions as F

from clicklake.operators.sessions import session_outcomes, user_sessions

T0 = datetime(2026, 5, 11, 10)


def at(seconds):
    return str(T0 + timedelta(seconds=seconds))


def test_a_pause_of_exactly_the_gap_does_not_split(clicks, rows):
    events = clicks(("a", "p", "view", at(0)), ("a", "p", "view", at(299)), ("b", "p", "view", at(0)), ("b", "p", "view", at(300)),
                    ("c", "p", "view", at(0)), ("c", "p", "view", at(301)))
    found = {}
    for s in user_sessions(events).collect():
        found.setdefault(s.user_id, []).append((s.events, s.duration_seconds))
    assert {u: sorted(s) for u, s in found.items()} == {"a": [(2, 299.0)], "b": [(2, 300.0)], "c": [(1, 0.0), (1, 0.0)]}


def test_events_without_time_belong_to_no_session(clicks):
    assert user_sessions(clicks(("a", "p", "view", None))).collect() == []


def test_outcomes(clicks):
    events = clicks(
        ("a", "p", "view", at(0)), ("a", "p", "add_to_cart", at(60)), ("a", "p", "purchase", at(120)),
        ("b", "p", "view", at(0)), ("b", "p", "purchase", at(10)), ("b", "p", "view", at(20)), ("c", "p", None, at(0)),
    )
    got = {s.user_id: (s.events, s.last_event_type, s.has_cart, s.ends_in_purchase) for s in session_outcomes(events).collect()}
    assert got == {"a": (3, "purchase", True, True), "b": (3, "view", False, False), "c": (1, None, False, False)}


def brute_force(events, gap):
    sessions = []
    by_user = {}
    for arrived, (user, kind, second) in enumerate(events):
        by_user.setdefault(user, []).append((second, arrived, kind))
    for user, own in by_user.items():
        own.sort()
        run = [own[0]]
        for event in own[1:]:
            if event[0] - run[-1][0] > gap:
                sessions.append((user, run))
                run = []
            run.append(event)
        sessions.append((user, run))
    return sessions


@pytest.fixture(params=[1, 2, 3])
def skewed(request):
    """A third of all events belong to one user, another part to no user."""
    draw = random.Random(request.param)
    events = []
    for _ in range(1500):
        user = draw.choices(["hot", None, f"u{draw.randrange(40)}"], [34, 10, 56])[0]
        events.append((user, draw.choice(["view", "add_to_cart", "purchase"]), draw.randrange(200_000)))
    return events


@pytest.mark.parametrize("gap", [1, 60, 300, 7200])
def test_equals_brute_force_under_skew(clicks, skewed, gap):
    frame = clicks(*[(u, "p", k, at(s)) for u, k, s in skewed])
    expected = brute_force(skewed, gap)
    got = sorted(
        ((s.user_id, s.session_start, s.last_event, s.events) for s in user_sessions(frame, gap).collect()), key=repr
    )
    assert got == sorted(
        ((u, T0 + timedelta(seconds=r[0][0]), T0 + timedelta(seconds=r[-1][0]), len(r)) for u, r in expected), key=repr
    )
    outcomes = sorted(
        ((s.user_id, s.session_start, s.events, s.last_event_type, s.has_cart) for s in session_outcomes(frame, gap).collect()), key=repr
    )
    assert outcomes == sorted(
        ((u, T0 + timedelta(seconds=r[0][0]), len(r), r[-1][2], any(k == "add_to_cart" for *_, k in r)) for u, r in expected), key=repr
    )


def test_equals_the_built_in_session_window(clicks, skewed, rows):
    frame = clicks(*[(u, "p", k, at(s)) for u, k, s in skewed]).where("user_id is not null")
    built_in = frame.groupBy("user_id", F.session_window("event_time", "300 seconds")).agg(
        F.min("event_time").alias("session_start"), F.count("*").alias("events")
    )
    ours = user_sessions(frame).select("user_id", "session_start", "events")
    assert rows(ours) == rows(built_in.select("user_id", "session_start", "events"))


def test_of_events_at_one_instant_the_last_to_arrive_ends_the_session(clicks):
    frame = clicks(("u", "p", "view", at(0)), ("u", "p", "purchase", at(0)), ("w", "p", "purchase", at(0)), ("w", "p", "view", at(0)))
    found = {s.user_id: (s.last_event_type, s.ends_in_purchase) for s in session_outcomes(frame, 60).collect()}
    assert found == {"u": ("purchase", True), "w": ("view", False)}
