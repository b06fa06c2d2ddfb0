"""Property tests: the skew-safe formulations equal direct simulations."""
import random

from hypothesis import HealthCheck, given, settings
from hypothesis import strategies as st
from pyspark.sql import functions as F

from clickscope.operators import ads
from clickscope.operators.sequence import consecutive_pairs

DAY = 86400000

events = st.lists(
    st.tuples(st.integers(0, 5),        # batch
              st.integers(0, 2),        # day offset
              st.integers(1, 3),        # uid
              st.integers(1, 3)),       # ad
    min_size=1, max_size=60)


def simulate(rows, threshold):
    """Batch by batch: read the blacklist at the batch start, drop its users,
    add 1 per surviving event to its (user, ad, day) count, and ban a user
    whose count reaches the threshold (the rest of the batch still counts)."""
    blacklist, counts, bans, kept = set(), {}, {}, []
    for b in sorted({r[1] for r in rows}):
        start = set(blacklist)
        for eid, batch, day, uid, ad in rows:
            if batch != b or uid in start:
                continue
            kept.append(eid)
            counts[(uid, ad, day)] = counts.get((uid, ad, day), 0) + 1
            if counts[(uid, ad, day)] >= threshold and uid not in blacklist:
                blacklist.add(uid)
                bans[uid] = b
    return bans, sorted(kept)


@settings(max_examples=25, deadline=None, suppress_health_check=[HealthCheck.function_scoped_fixture])
@given(events, st.integers(1, 4))
def test_blacklist_closed_form_equals_simulation(spark, evs, threshold):
    rows = [(i, b, d, u, a) for i, (b, d, u, a) in enumerate(evs)]
    df = spark.createDataFrame(
        [(eid, d * DAY + b * 5000, u, a, b, f"day{d}") for eid, b, d, u, a in rows],
        "event_id long, ts long, uid long, ads_id long, batch long, dt string")
    bans = ads.ban_batches(df, threshold)
    got_bans = {r.uid: r.banned_batch for r in bans.collect()}
    got_kept = sorted(r.event_id for r in ads.blacklist_filter(df, bans).collect())
    want_bans, want_kept = simulate([(eid, b, f"day{d}", u, a) for eid, b, d, u, a in rows], threshold)
    assert got_bans == want_bans
    assert got_kept == want_kept


@settings(max_examples=15, deadline=None, suppress_health_check=[HealthCheck.function_scoped_fixture])
@given(st.lists(st.tuples(st.sampled_from("abcd"), st.integers(0, 5), st.integers(0, 9)),
                min_size=0, max_size=80),
       st.integers(1, 9), st.booleans())
def test_pairs_equal_lead(spark, rows, width, keep_last):
    data = [(g, t, i, v) for i, (g, t, v) in enumerate(rows)]
    df = spark.createDataFrame(data, "g string, t long, id long, v long")
    piece = F.floor(F.col("t") / width)  # does not decrease along the order
    got = sorted(map(tuple, consecutive_pairs(df, "g", ["t", "id"], "v", piece, keep_last=keep_last).collect()), key=str)
    by = {}
    for g, t, i, v in data:
        by.setdefault(g, []).append((t, i, v))
    want = []
    for g, xs in by.items():
        xs.sort()
        want += [(g, a[2], b[2]) for a, b in zip(xs, xs[1:])]
        want += [(g, xs[-1][2], None)] if keep_last else []
    assert got == sorted(want, key=str)


def remark_text(cities):
    """The remark straight from its definition: two cities with most clicks
    (ties: name), each share truncated to 0.1 %, the rest as "other"."""
    counts = {}
    for c in cities:
        counts[c] = counts.get(c, 0) + 1
    total = sum(counts.values())
    top = sorted(counts.items(), key=lambda kv: (-kv[1], kv[0]))[:2]
    tenths = [(c, n * 1000 // total) for c, n in top]
    parts = [f"{c}:{t / 10.0}%" for c, t in tenths]
    parts.append(f"其他:{(1000 - sum(t for _, t in tenths)) / 10.0}%")
    return total, ",".join(parts)


@settings(max_examples=20, deadline=None, suppress_health_check=[HealthCheck.function_scoped_fixture])
@given(st.lists(st.tuples(st.integers(0, 2), st.sampled_from(["北京", "上海", "A", "B", "C"])),
                min_size=1, max_size=50))
def test_city_remark_equals_definition(spark, clicks):
    from clickscope.functions.city_remark import city_remark_by_group
    df = spark.createDataFrame([("x", p, c) for p, c in clicks], "area string, pid long, city_name string")
    got = {r.pid: (r.clicount, r.remark) for r in city_remark_by_group(df, ["area", "pid"], "city_name").collect()}
    want = {}
    for p in {p for p, _ in clicks}:
        want[p] = remark_text([c for q, c in clicks if q == p])
    assert got == want


def java_style_parse(line):
    """The original parse: split on single spaces, trailing empty strings
    dropped; five fields needed; ts, uid and ad must be longs. One deviation:
    a ts outside the timestamp range (years 1-9999) is rejected."""
    parts = line.split(" ")
    while parts and parts[-1] == "":
        parts.pop()
    if len(parts) < 5:
        return None

    def long_(s):
        body = s[1:] if s[:1] in "+-" else s
        if not body or not body.isascii() or not body.isdigit():
            return None
        v = int(s)
        return v if -2**63 <= v < 2**63 else None

    ts, uid, ad = long_(parts[0]), long_(parts[3]), long_(parts[4])
    if ts is None or uid is None or ad is None:
        return None
    if not -62135596800000 <= ts <= 253402300799999:  # outside years 1-9999: rejected
        return None
    return (ts, parts[1], parts[2], uid, ad)


tokens = st.sampled_from(["1704067200000", "42", "-3", "+7", "x", "", "EUROPE", "NATION_3",
                          "99999999999999999999", "9223372036854775807", "0.5"])


@settings(max_examples=25, deadline=None, suppress_health_check=[HealthCheck.function_scoped_fixture])
@given(st.lists(st.lists(tokens, min_size=0, max_size=7).map(" ".join), min_size=1, max_size=30))
def test_parser_equals_java_style_split(spark, lines):
    from clickscope.sources.adslog import parse_ads_lines
    df = spark.createDataFrame([(i, s) for i, s in enumerate(lines)], "id long, value string")
    got = {r.id: (r.ts, r.area, r.city, r.uid, r.ads_id) for r in parse_ads_lines(df, keep=["id"]).collect()}
    want = {i: p for i, p in ((i, java_style_parse(s)) for i, s in enumerate(lines)) if p is not None}
    assert got == want
