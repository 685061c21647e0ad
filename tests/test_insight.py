from collections import Counter, defaultdict
from datetime import datetime, timedelta

import pytest
from hypothesis import HealthCheck, given, settings
from hypothesis import strategies as st
from pyspark.sql import functions as F

from hoptrail.operators import chains, detect, graph, load, sessions

T0 = datetime(2024, 1, 1)
MANY = settings(max_examples=8, deadline=None, suppress_health_check=list(HealthCheck))
SCHEMA = (
    "id_consumer string, event_timestamp timestamp, endpoint string, status_response int, "
    "time_transaction bigint, zona string, id_recurso string, id_transaccion string, "
    "consumer_type string, source_zone string, source_service string"
)


def make(spark, rows):
    names = [f.split()[0] for f in SCHEMA.split(", ")]
    return spark.createDataFrame([tuple(r.get(n) for n in names) for r in rows], SCHEMA)


def after(**shift):
    return T0 + timedelta(**shift)


def cycle(count, every, minute=0, **fields):
    """`count` traces over the seconds of a minute; callables get the number."""
    return [
        {
            "zona": "z",
            "event_timestamp": after(minutes=minute, seconds=i * every % 60),
            **{k: v(i) if callable(v) else v for k, v in fields.items()},
        }
        for i in range(count)
    ]


moments = st.integers(0, 7200).map(lambda s: T0 + timedelta(seconds=s))


@MANY
@given(
    st.lists(st.tuples(st.sampled_from(["a", "-", None]), moments), min_size=1, max_size=50),
    st.sampled_from([60, 300, 1800]),
)
def test_sessions_against_brute_force(spark, hits, gap):
    expected = Counter()
    by_consumer = defaultdict(list)
    for consumer, moment in hits:
        by_consumer[consumer].append(moment)
    for consumer, times in by_consumer.items():
        times.sort()
        run = [times[0]]
        for moment in times[1:] + [None]:
            if moment is None or (moment - run[-1]).total_seconds() > gap:
                expected[(consumer, run[0], run[-1], len(run))] += 1
                run = []
            run.append(moment)
    df = make(spark, [{"id_consumer": c, "event_timestamp": t} for c, t in hits])
    got = Counter(
        (r.id_consumer, r.session_start, r.session_end, r.requests)
        for r in sessions.sessions(df, gap_seconds=gap).collect()
    )
    assert got == expected


def test_funnel(spark):
    b, c, v = sessions.FUNNEL_STEPS.values()
    visits = {
        "external/user-casual-1x": [b, b, c],
        "external/user-casual-2x": [b],
        "user-power-3": [b, c, v],
        "external/user-power-4": [c, v],
        "zone1/orders-api-1": [v],
    }
    rows = [
        {"id_consumer": person, "endpoint": url, "event_timestamp": after(seconds=i)}
        for person, path in visits.items()
        for i, url in enumerate(path)
    ]
    got = {r.kind: r for r in sessions.funnel(make(spark, rows)).collect()}
    assert set(got) == {"casual", "power", "other"}
    casual, power = got["casual"], got["power"]
    assert (casual.sessions, casual.browsing_sessions, casual.checkout_sessions) == (2, 2, 1)
    assert (casual.browsing_to_checkout, casual.browsing_requests) == (0.5, 3)
    assert (power.browsing_sessions, power.validating_sessions) == (1, 1)
    assert power.validating_requests == 2
    assert got["other"].browsing_to_checkout is None


def test_expected_load_and_phases(spark):
    hours = [0, 4.99, 5, 6.5, 8, 10, 12, 12.5, 15, 17, 18.5, 20, 22, 23.99]
    hour = F.col("h")
    rows = (
        spark.createDataFrame([(float(h),) for h in hours], "h double")
        .select(load.expected_load(hour).alias("e"), load.day_phase(hour).alias("p"))
        .collect()
    )
    expected = [0.1, 0.1, 0.1, 0.4, 0.7, 0.85, 1.0, 1.0, 0.9, 0.8, 0.55, 0.3, 0.2, 0.1005]
    assert [r.e for r in rows] == pytest.approx(expected)
    assert [r.p for r in rows] == [
        *["night"] * 2,
        *["morning_ramp"] * 2,
        *["morning_peak"] * 2,
        *["midday_peak"] * 2,
        "afternoon",
        *["evening_decline"] * 2,
        *["night"] * 3,
    ]


def test_overlay_events_are_half_open_and_first_wins(spark):
    events = [load.OverlayEvent("a", 1, 1), load.OverlayEvent("b", 1.5, 1)]
    at = [0.99, 1, 1.5, 1.99, 2, 2.49, 2.5]
    df = make(spark, [{"event_timestamp": T0 + timedelta(hours=h)} for h in at])
    got = {r.event_timestamp: r.event for r in load.tag_events(df, events).collect()}
    assert list(got.values()) == [None, "a", "a", "a", "b", "b", None]
    assert [r.event for r in load.tag_events(df, []).collect()] == [None] * len(at)


@MANY
@given(
    st.lists(st.tuples(st.sampled_from(["z1", "z2"]), st.integers(0, 60)), min_size=1, max_size=80)
)
def test_rising_zones_against_brute_force(spark, hits):
    df = make(spark, [{"zona": z, "event_timestamp": after(seconds=s)} for z, s in hits])
    counts = Counter((z, s // 5) for z, s in hits)
    expected = {
        (z, after(seconds=5 * k), n, counts[z, k - 2])
        for (z, k), n in counts.items()
        if n > counts[z, k - 1] > counts[z, k - 2]
    }
    got = {tuple(r) for r in load.rising_zones(df, steps=2).collect()}
    assert got == expected


def test_scanner_and_flood(spark):
    scan = cycle(
        60, 1, id_consumer="external/scan",
        endpoint=lambda i: f"/p{i % 12}", status_response=lambda i: 404 if i % 10 else 200,
    )
    flood = cycle(300, 1, 20, id_consumer="external/flood", endpoint="/validate", status_response=200)
    calm = [
        trace
        for minute in range(30)
        for trace in cycle(20, 3, minute, id_consumer="c", endpoint="/validate", status_response=200)
    ]
    df = make(spark, scan + flood + calm)
    found = detect.scanners(df).collect()
    assert [(r.id_consumer, r.window_start, r.requests, r.not_found, r.paths) for r in found] == [
        ("external/scan", T0, 60, 54, 12)
    ]
    floods = detect.floods(df).collect()
    assert [(r.id_consumer, r.requests, r.trailing_mean) for r in floods] == [
        ("external/flood", 300, 0.0)
    ]


def test_idle_windows_count_in_the_trailing_mean(spark):
    rows = [trace for m in (0, 3, 3) for trace in cycle(1, 1, m, id_consumer="c", endpoint="/")]
    found = detect.floods(make(spark, rows), trailing=4, min_requests=1, factor=0.0)
    means = {r.window_start.minute: r.trailing_mean for r in found.collect()}
    assert means == {0: 0.0, 3: 0.25}


def test_cascade_with_declared_edges(spark):
    def hit(service, status, minute=0):
        return cycle(1, 1, minute, id_recurso=f"{service}-1", status_response=status)[0]

    df = make(
        spark,
        [
            hit("orders-api", 500), hit("orders-api", 200), hit("auth-api", 503),
            hit("orders-api", 500, 1), hit("X", 500),
        ],
    )
    edges = spark.createDataFrame([("z/orders-api", "z/auth-api")] * 2, "source string, target string")
    got = {
        (r.minute.minute, r.service): (
            r.failure_share, r.callee, r.callee_requests, r.callee_failure_share,
        )
        for r in detect.cascades(df, edges).collect()
    }
    assert got == {
        (0, "z/orders-api"): (0.5, "z/auth-api", 1, 1.0),
        (0, "z/auth-api"): (1.0, None, 0, None),
        (1, "z/orders-api"): (1.0, "z/auth-api", 0, None),
    }


def test_rolling_statistics_use_their_own_status_classes(spark):
    rows = [
        {"status_response": status, "event_timestamp": after(seconds=29)}
        for status in (100, 200, 302, 404, 500, None)
    ]
    row = detect.rolling_stats(make(spark, rows)).first()
    assert (row.n_2xx, row.n_4xx, row.n_5xx, row.n_err, row.requests) == (2, 2, 1, 1, 6)
    assert row.window_start == T0 and row.pct_2xx == pytest.approx(100 / 3)


def test_chain_hops(spark):
    def hop(caller, callee, moment, duration=None):
        zone, service = caller.split("/")
        return {
            "id_transaccion": "t", "zona": "z1", "id_recurso": f"{callee}-1",
            "consumer_type": "external" if zone == "external" else "internal",
            "source_zone": zone, "source_service": service,
            "event_timestamp": moment, "time_transaction": duration,
        }

    rows = [
        hop("z1/orders-api", "auth-api", after(seconds=59), 10),
        hop("external/user", "orders-api", after(seconds=59), 90),
        hop("z1/orders-api", "auth-api", after(seconds=121), 1),
        hop("z1/auth-api", "late-api", None),
        *[{"id_transaccion": missing, "zona": "z1"} for missing in ("-", None, "")],
    ]
    hops = chains.call_chain(make(spark, rows), "t").collect()
    assert [(r.hop, r.caller, r.callee) for r in hops] == [
        (1, "external", "z1/orders-api"),
        (2, "z1/orders-api", "z1/auth-api"),
        (3, "z1/orders-api", "z1/auth-api"),
        (4, "z1/auth-api", "z1/late-api"),
    ]
    assert chains.call_chains(make(spark, rows)).count() == 4


@MANY
@given(
    st.lists(
        st.tuples(st.sampled_from(["hot", "hot", "x"]), st.integers(0, 600)),
        min_size=1,
        max_size=60,
    )
)
def test_chain_numbers_against_brute_force(spark, hits):
    df = make(
        spark,
        [{"id_transaccion": t, "zona": "z", "event_timestamp": after(seconds=s)} for t, s in hits],
    )
    got = defaultdict(list)
    for r in chains.call_chains(df, segment_seconds=30).collect():
        got[r.id_transaccion].append((r.hop, r.event_timestamp))
    for txn, found in got.items():
        times = sorted(T0 + timedelta(seconds=s) for t, s in hits if t == txn)
        assert sorted(found) == list(zip(range(1, len(times) + 1), times))


def test_service_catalogue(spark):
    rows = [{"zona": "z1", "id_recurso": r} for r in ("b-api-1", "a-api-1", "a-api-2", "X", None)]
    assert graph.service_catalogue(make(spark, rows)).collect() == [("z1", ["a-api", "b-api"])]


def test_funnel_steps_must_follow_each_other(spark):
    b, c, v = sessions.FUNNEL_STEPS.values()
    visits = {
        "external/user-casual-a": [(0, v), (1, b), (2, c)],
        "external/user-casual-b": [(0, c), (1, b), (2, v)],
        "external/user-casual-c": [(0, b), (5, v), (9, c), (1700, v)],
        # Across time cells, and within one second.
        "external/user-power-d": [(0, b), (1795, b), (3590, c), (5300, v)],
        "external/user-power-e": [(7, v), (7, c), (7, b)],
        "user-power-f": [(0, b), (2000, c), (2001, v)],
    }
    rows = [
        {"id_consumer": person, "endpoint": url, "event_timestamp": after(seconds=s)}
        for person, path in visits.items()
        for s, url in path
    ]
    df = make(spark, rows)
    got = {r.kind: r for r in sessions.ordered_funnel(df).collect()}
    casual, power = got["casual"], got["power"]
    assert (casual.sessions, casual.browsing_sessions, casual.checkout_sessions, casual.validating_sessions) == (3, 3, 2, 1)
    # The pause of f splits its visit: one session browses, the other doesn't begin at the beginning.
    assert (power.sessions, power.browsing_sessions, power.checkout_sessions, power.validating_sessions) == (4, 3, 2, 2)
    assert (casual.checkout_requests, casual.checkout_to_validating) == (3, 0.5)
    anyhow = {r.kind: r for r in sessions.funnel(df).collect()}
    assert anyhow["casual"].validating_sessions == 3


@MANY
@given(st.lists(st.tuples(st.sampled_from(["a", "z"]), st.integers(0, 40), st.integers(0, 3)), min_size=1, max_size=60))
def test_ordered_funnel_against_brute_force(spark, hits):
    urls = [*sessions.FUNNEL_STEPS.values(), "/else"]
    df = make(spark, [{"id_consumer": c, "event_timestamp": after(seconds=s), "endpoint": urls[u]} for c, s, u in hits])
    expected = [0, 0, 0, 0]
    for person in {c for c, _, _ in hits}:
        visit = sorted((s, u) for c, s, u in hits if c == person)
        cuts = [0, *[i for i in range(1, len(visit)) if visit[i][0] - visit[i - 1][0] > 5], len(visit)]
        for first, end in zip(cuts, cuts[1:]):
            expected[0] += 1
            state = 0
            for _, u in visit[first:end]:
                if u == state and state < 3:
                    state += 1
                    expected[state] += 1
    row = sessions.ordered_funnel(df, gap_seconds=5).first()
    assert [row.sessions, row.browsing_sessions, row.checkout_sessions, row.validating_sessions] == expected


SERVICES = ["a-api", "b-api", "c-api"]


@MANY
@given(
    st.lists(
        st.tuples(st.sampled_from("ht"), st.sampled_from(SERVICES), st.sampled_from(SERVICES), st.integers(0, 30), st.sampled_from([None, 0, 900, 3000, 9000, 40000])),
        min_size=1, max_size=40,
    ),
    st.sampled_from([1, 7]),
)
def test_call_tree_against_brute_force(spark, calls, cell):
    rows = [
        {
            "id_transaccion": t, "zona": "z", "id_recurso": f"{callee}-1", "consumer_type": "internal", "source_zone": "z",
            "source_service": caller, "event_timestamp": after(seconds=s), "time_transaction": ms, "endpoint": str(i),
        }
        for i, (t, caller, callee, s, ms) in enumerate(calls)
    ]
    tree = chains.call_tree(make(spark, rows), cell_seconds=cell).collect()
    assert sorted((r.id_transaccion, r.hop) for r in tree) == sorted(
        (r.id_transaccion, r.hop) for r in chains.call_chains(make(spark, rows)).collect()
    )
    for r in tree:
        end = lambda x: x.event_timestamp + timedelta(milliseconds=x.time_transaction or 0)
        around = [
            ((p.time_transaction or 0), -p.hop)
            for p in tree
            if p.id_transaccion == r.id_transaccion and p.hop < r.hop and p.callee == r.caller and end(p) >= end(r)
        ]
        assert r.parent_hop == (-min(around)[1] if around else None)


def test_call_tree_of_hops_without_time_or_caller(spark):
    base = {"id_transaccion": "t", "zona": "z", "consumer_type": "internal", "source_zone": "z", "source_service": "a-api"}
    rows = [
        {**base, "id_recurso": "a-api-1", "consumer_type": "external", "event_timestamp": after(seconds=1), "time_transaction": 100_000},
        {**base, "id_recurso": "b-api-1", "event_timestamp": after(seconds=2)},
        {**base, "id_recurso": "c-api-1"},
        {**base, "id_recurso": "X", "event_timestamp": after(seconds=3)},
    ]
    got = {r.callee: r.parent_hop for r in chains.call_tree(make(spark, rows)).collect()}
    assert got == {"z/a-api": None, "z/b-api": 1, "z/c-api": None, None: 1}


def test_one_hot_transaction_is_spread_over_cells(spark):
    rows = [
        {"id_transaccion": "hot", "zona": "z", "id_recurso": "a-api-1", "consumer_type": "internal", "source_zone": "z", "source_service": "a-api",
         "event_timestamp": after(seconds=i), "time_transaction": 500}
        for i in range(300)
    ]
    df = make(spark, rows)
    assert chains.call_tree(df).where("parent_hop IS NOT NULL").count() == 0
    plan = chains.call_tree(df)._jdf.queryExecution().optimizedPlan().toString()
    assert "_cell" in plan.split("Join LeftOuter")[1].split("\n")[0]


def test_call_tree_compares_few_pairs_in_a_dense_cell(spark, monkeypatch):
    """One service calls itself 3000 times in one cell: a hop meets few of the hops around it."""
    rows = [
        {"id_transaccion": "hot", "zona": "z", "id_recurso": "a-api-1", "consumer_type": "internal", "source_zone": "z", "source_service": "a-api",
         "event_timestamp": after(seconds=i // 3), "time_transaction": 1 + i * 7919 % 3001, "endpoint": str(i)}
        for i in range(3000)
    ]
    df = make(spark, rows)
    monkeypatch.setattr(chains, "LEVELS", 2)  # so that ranges hold several parents

    def joined(node) -> int:
        plan = node.getClass().getSimpleName()
        if plan == "AdaptiveSparkPlanExec":
            return joined(node.executedPlan())
        if plan.endswith("QueryStageExec"):
            return joined(node.plan())
        if "Join" in plan and "_cell" in node.simpleString(1000):
            return node.metrics().apply("numOutputRows").value()
        return max((joined(node.children().apply(i)) for i in range(node.children().size())), default=0)

    tree = chains.call_tree(df, cell_seconds=3600)
    got = {r.hop: r for r in tree.collect()}
    assert len(got) == 3000
    hops = [got[i] for i in range(1, 3001)]
    ends = [h.event_timestamp + timedelta(milliseconds=h.time_transaction) for h in hops]
    # None lasts longer than the four seconds of 12 hops.
    for i, h in enumerate(hops):
        around = [(hops[j].time_transaction, -hops[j].hop) for j in range(max(0, i - 12), i) if ends[j] >= ends[i]]
        assert h.parent_hop == (-min(around)[1] if around else None)
    assert sum(h.parent_hop is not None for h in hops) > 1000
    frame = chains.call_tree(df, cell_seconds=3600)
    execution = frame._jdf.queryExecution()
    frame._jdf.collectToPython()
    assert 3000 <= joined(execution.executedPlan()) < 5 * 3000


@MANY
@given(
    st.lists(st.tuples(st.sampled_from(SERVICES), st.sampled_from(SERVICES), st.integers(0, 9), st.integers(0, 9)), min_size=1, max_size=50),
    st.sampled_from([(2, 1), (2, 3), (3, 2)]),
)
def test_call_tree_of_any_ranges_against_brute_force(spark, calls, shape):
    rows = [
        {"id_transaccion": "t", "zona": "z", "id_recurso": f"{callee}-1", "consumer_type": "internal", "source_zone": "z",
         "source_service": caller, "event_timestamp": after(seconds=s), "time_transaction": d * 1000, "endpoint": str(i)}
        for i, (caller, callee, s, d) in enumerate(calls)
    ]
    with pytest.MonkeyPatch.context() as patch:
        patch.setattr(chains, "FANOUT", shape[0])
        patch.setattr(chains, "LEVELS", shape[1])
        tree = chains.call_tree(make(spark, rows), cell_seconds=5).collect()
    assert len(tree) == len(rows)
    end = lambda x: x.event_timestamp + timedelta(milliseconds=x.time_transaction)
    for r in tree:
        around = [(p.time_transaction, -p.hop) for p in tree if p.hop < r.hop and p.callee == r.caller and end(p) >= end(r)]
        assert r.parent_hop == (-min(around)[1] if around else None)


def test_edge_significance_against_plain_formulas(spark):
    import math

    edges = [("a", 0.5, 48, 100), ("b", 0.5, 20, 100), ("c", 0.1, 0, 40), ("d", 1.0, 90, 100), ("e", None, 1, 50), ("f", 0.3, 500, 100), ("g", 0.2, 8, 100), ("h", 0.2, 0, None), ("i", 0.4, 55, 100), ("j", 0.0, 0, 9)]
    declared = spark.createDataFrame([("z", f"s{n}-api", "t-api", p) for n, p, _, _ in edges if p is not None], "zone string, app string, target string, probability double")
    calls = spark.createDataFrame([(f"z/s{n}-api", "z/t-api", k) for n, _, k, _ in edges if k], "source string, target string, requests long")
    served = spark.createDataFrame([(f"z/s{n}-api", m) for n, _, _, m in edges if m], "node string, served long")
    got = {r.source[3]: r for r in graph.edge_drift_significance(declared, calls, served).collect()}
    p_values = {}
    for name, p, k, n in edges:
        r = got[name]
        if not n:
            assert r.p_value is None and r.share_low is None and not r.drifted
            continue
        share, p, z = min(k / n, 1), min(p or 0, 1), 1.959964
        roots = [(share + z * z / 2 / n + sign * z * math.sqrt(share * (1 - share) / n + (z / 2 / n) ** 2)) / (1 + z * z / n) for sign in (-1, 1)]
        assert [r.share_low, r.share_high] == pytest.approx([max(0, roots[0]), min(1, roots[1])])
        if share == p:
            p_values[name] = 1.0
        elif p in (0, 1):
            p_values[name] = 0.0
        else:
            p_values[name] = math.erfc(abs(share - p) / math.sqrt(p * (1 - p) / n) / math.sqrt(2))
        assert r.p_value == pytest.approx(p_values[name], abs=2e-7)
    ranked = sorted(p_values, key=p_values.get)
    most = max(i for i, name in enumerate(ranked, 1) if p_values[name] <= 0.05 * i / len(ranked))
    assert {n for n in got if got[n].drifted} == set(ranked[:most])
    assert 0 < most < len(ranked)
