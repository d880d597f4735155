"""Operators against brute-force Python models on random small inputs."""

from hypothesis import HealthCheck, given, settings
from hypothesis import strategies as st

from tablepipe.operators.reshape import measure_pivot
from tablepipe.operators.sinks import dedup_first, rows_to_append

SETTINGS = settings(max_examples=6, deadline=None, suppress_health_check=list(HealthCheck))
key = st.one_of(st.none(), st.integers(0, 3))
rows = st.lists(st.tuples(key, key, st.integers(0, 9)), max_size=14)


def _model_append(batch, target):
    """INSERT ... ON CONFLICT DO NOTHING, row by row, on a unique (a, b)."""
    taken = {(a, b) for a, b, _ in target if a is not None and b is not None}
    out = []
    for a, b, v in batch:
        if a is None or b is None:
            out.append((a, b, v))
        elif (a, b) not in taken:
            taken.add((a, b))
            out.append((a, b, v))
    return out


@SETTINGS
@given(rows, rows)
def test_append_matches_model(spark, batch, target):
    schema = "a int, b int, v int, o int"
    b = spark.createDataFrame([(x, y, v, i) for i, (x, y, v) in enumerate(batch)], schema)
    t = spark.createDataFrame([(x, y, v, 0) for x, y, v in target], schema)
    got = rows_to_append(b, t, ["a", "b"], "o").select("a", "b", "v").collect()
    key = lambda r: tuple((x is None, x or 0) for x in r)
    assert sorted(map(tuple, got), key=key) == sorted(_model_append(batch, target), key=key)


@SETTINGS
@given(rows)
def test_dedup_first_matches_model(spark, batch):
    df = spark.createDataFrame([(x, y, v, i) for i, (x, y, v) in enumerate(batch)], "a int, b int, v int, o int")
    got = dedup_first(df, ["a", "b"], "o").select("a", "b", "v").collect()
    key = lambda r: tuple((x is None, x or 0) for x in r)
    assert sorted(map(tuple, got), key=key) == sorted(_model_append(batch, []), key=key)


@SETTINGS
@given(st.lists(st.tuples(st.integers(0, 4), st.sampled_from(["x", "y", "z"]), st.integers(0, 99)), max_size=12))
def test_pivot_matches_model(spark, long):
    df = spark.createDataFrame([(k, m, v, i) for i, (k, m, v) in enumerate(long)], "k int, m string, v int, o int")
    pairs = {}
    for k, m, v in long:
        pairs.setdefault((k, m), []).append(v)
    if any(len(vs) > 1 for vs in pairs.values()):
        first = measure_pivot(df, "k", "m", "v", ["x", "y", "z"], order_by="o", on_duplicate="first").collect()
        want = {k: {m: pairs[(k, m)][0] if (k, m) in pairs else None for m in "xyz"} for k, _, _ in long}
        assert {r.k: {m: r[m] for m in "xyz"} for r in first} == want
        try:
            measure_pivot(df, "k", "m", "v", ["x", "y", "z"]).collect()
        except Exception as e:  # noqa: BLE001
            assert "duplicate" in str(e)
        else:
            raise AssertionError("a repeated (key, measure) must fail")
    else:
        got = measure_pivot(df, "k", "m", "v", ["x", "y", "z"]).collect()
        want = {k: {m: pairs.get((k, m), [None])[0] for m in "xyz"} for k, _, _ in long}
        assert {r.k: {m: r[m] for m in "xyz"} for r in got} == want


@SETTINGS
@given(st.integers(0, 40), st.integers(1, 12), st.one_of(st.none(), st.integers(1, 30)))
def test_paged_extract_matches_model(spark, n, page, limit):
    """Pages at 0, P, 2P, ...; stop on a short or empty page, or after the
    first page whose offset reached the size limit."""
    import math

    from tablepipe.sources.paged import read_paged

    df = read_paged(spark, "tests.test_sources:ListFetcher", ["id"], page_size=page, size_limit=limit,
                    fetcher_args={"n": n})
    expect = n if limit is None else min(n, (math.ceil(limit / page) + 1) * page)
    ids = sorted(int(r.id) for r in df.collect())
    assert ids == list(range(expect))


@settings(max_examples=200, deadline=None)
@given(st.text(alphabet=st.sampled_from(list("<>/ab=\"' &;litrdh#!-")), max_size=80))
def test_html_parsers_never_crash(text):
    from tablepipe.sources.html import parse_options, parse_rows

    parse_rows(text, None, "li", ())
    parse_rows(text, None)
    parse_options(text, None, "a", "href")


@settings(max_examples=100, deadline=None)
@given(st.dates(min_value=__import__("datetime").date(1990, 1, 1), max_value=__import__("datetime").date(2030, 12, 31)),
       st.sampled_from(["-08:00", "+05:30", "America/Los_Angeles", "America/Sao_Paulo", "Europe/London", "UTC"]))
def test_day_bounds_cover_one_local_day(day, zone):
    import datetime as dt

    from tablepipe.functions.timeops import day_bounds_utc, zone_info

    lo, hi = day_bounds_utc(day, zone)
    tz = zone_info(zone)
    utc = dt.timezone.utc
    assert lo < hi and dt.timedelta(hours=22) <= hi - lo <= dt.timedelta(hours=26)
    assert lo.replace(tzinfo=utc).astimezone(tz).date() == day
    assert (hi - dt.timedelta(microseconds=1)).replace(tzinfo=utc).astimezone(tz).date() == day


@SETTINGS
@given(st.lists(st.integers(1990, 2030), min_size=1, max_size=5), st.dates(
    min_value=__import__("datetime").date(1995, 1, 1), max_value=__import__("datetime").date(2030, 12, 31)))
def test_worklist_matches_model(spark, years, as_of):
    from tablepipe.operators.combine import period_worklist

    ydf = spark.createDataFrame([(str(y),) for y in years] + [("All",)], "year string")
    ldf = spark.createDataFrame([("801",), ("802",), ("801",)], "line string")
    got = sorted(tuple(r) for r in period_worklist(ydf, ldf, as_of=as_of).collect())
    want = sorted((str(y), str(m), ln) for y in set(years) for m in range(1, 13) for ln in ("801", "802")
                  if y < as_of.year or (y == as_of.year and m < as_of.month))
    assert got == want


@SETTINGS
@given(st.lists(st.tuples(st.integers(0, 3), st.sampled_from(["csv", "geojson", "shapefile", "kml"]),
                          st.integers(0, 50)), max_size=15))
def test_priority_matches_model(spark, dists):
    from tablepipe.operators.combine import choose_by_priority

    ranks = ["shapefile", "geojson", "csv"]
    df = spark.createDataFrame(dists, "item int, fmt string, t int")
    got = {r.item: (r.fmt, r.t) for r in choose_by_priority(df, "item", "fmt", ranks, ["t"]).collect()}
    want = {}
    for item, fmt, t in dists:
        if fmt in ranks:
            cand = (ranks.index(fmt), t)
            if item not in want or cand < want[item][0]:
                want[item] = (cand, (fmt, t))
    assert got == {k: v[1] for k, v in want.items()}


def _months_back(d, months):
    import calendar
    import datetime as dt

    y, m = divmod(d.year * 12 + d.month - 1 - months, 12)
    day = min(d.day, calendar.monthrange(y, m + 1)[1])
    return dt.datetime(y, m + 1, day, d.hour, d.minute, d.second)


@SETTINGS
@given(st.datetimes(min_value=__import__("datetime").datetime(2000, 1, 1),
                    max_value=__import__("datetime").datetime(2030, 1, 1)).map(lambda x: x.replace(microsecond=0)),
       st.lists(st.datetimes(min_value=__import__("datetime").datetime(1999, 1, 1),
                             max_value=__import__("datetime").datetime(2030, 1, 1)).map(lambda x: x.replace(microsecond=0)),
                max_size=10),
       st.integers(1, 14))
def test_recent_window_matches_model(spark, as_of, stamps, months):
    from pyspark.sql import functions as F

    from tablepipe.operators.filters import recent_exclude

    df = spark.createDataFrame([(str(t),) for t in stamps], "t string").select(F.col("t").cast("timestamp_ntz").alias("t"))
    got = sorted(r.t for r in recent_exclude(df, "t", months, as_of).collect())
    cut = _months_back(as_of, months)
    assert got == sorted(t for t in stamps if t > cut)
