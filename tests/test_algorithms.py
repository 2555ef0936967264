"""Custom distributed algorithms checked against brute force on small
fixtures (the histogram paths are forced with tiny bin counts)."""

import math
import random
from collections import defaultdict

import numpy as np
import pytest
from pyspark.sql import functions as F

from quarry.functions import special
from quarry.functions.geo import haversine
from quarry.operators import aggregates as agg
from quarry.operators import geo, graph, neighbors, quantiles
from quarry.operators.joins import interval_point_join
from quarry.operators.relational import with_row_index


def _skewed(spark):
    rnd = random.Random(7)
    rows = []
    for i in range(3000):  # hot key: a third of the rows, many duplicates
        rows.append(("hot", float(rnd.choice([1.0, 2.0, 2.0, 3.5])) if i % 3 else rnd.gauss(0, 1)))
    for g in ("a", "b", None):
        for _ in range(1500):
            rows.append((g, rnd.expovariate(1.0) * (10 if g == "b" else 1)))
    rows += [("a", None)] * 10
    return spark.createDataFrame(rows, "g string, x double")


def test_quantiles_fast_path_matches_numpy(spark):
    df = _skewed(spark)
    long = quantiles.quantiles(df, "x", [0.1, 0.5, 0.9], ["g"]).collect()
    data = defaultdict(list)
    for r in df.collect():
        if r["x"] is not None:
            data[r["g"]].append(r["x"])
    for r in long:
        assert r["q"] == pytest.approx(float(np.percentile(data[r["g"]], r["p"] * 100)), rel=1e-12, abs=1e-12)


def test_quantiles_histogram_path(spark):
    df = _skewed(spark)
    probs = [0.0, 0.1, 0.25, 0.5, 0.9, 0.99, 1.0]
    long = quantiles.quantiles(df, "x", probs, ["g"]).collect()
    data = defaultdict(list)
    for r in df.collect():
        if r["x"] is not None:
            data[r["g"]].append(r["x"])
    got = {(r["g"], r["p"]): r["q"] for r in long}
    assert len(got) == len(data) * len(probs)
    for g, xs in data.items():
        for p in probs:
            assert got[(g, p)] == pytest.approx(float(np.percentile(xs, p * 100)), rel=1e-12, abs=1e-12)


def test_global_quantile_histogram_path(spark):
    df = _skewed(spark)
    q = quantiles.quantile_wide(df, "x", [0.5, 0.75], ["m", "q3"]).first()
    xs = [r["x"] for r in df.collect() if r["x"] is not None]
    assert q["m"] == pytest.approx(float(np.percentile(xs, 50)))
    assert q["q3"] == pytest.approx(float(np.percentile(xs, 75)))


def test_row_index_matches_sort(spark):
    df = spark.range(0, 5000).select((F.col("id") * 7919 % 5003).alias("k"))
    ix = with_row_index(df, ["k"], "pos").collect()
    assert sorted(r["pos"] for r in ix) == list(range(1, 5001))
    assert all(a["k"] < b["k"] for a, b in zip(sorted(ix, key=lambda r: r["pos"]), sorted(ix, key=lambda r: r["pos"])[1:]))


def _brandes(nodes, adj):
    bc = dict.fromkeys(nodes, 0.0)
    for s in nodes:
        stack, pred, sigma, dist = [], defaultdict(list), defaultdict(float), {s: 0}
        sigma[s] = 1.0
        queue = [s]
        while queue:
            v = queue.pop(0)
            stack.append(v)
            for w in adj[v]:
                if w not in dist:
                    dist[w] = dist[v] + 1
                    queue.append(w)
                if dist[w] == dist[v] + 1:
                    sigma[w] += sigma[v]
                    pred[w].append(v)
        delta = defaultdict(float)
        while stack:
            w = stack.pop()
            for v in pred[w]:
                delta[v] += sigma[v] / sigma[w] * (1 + delta[w])
            if w != s:
                bc[w] += delta[w]
    return {k: v / 2 for k, v in bc.items()}


def test_betweenness_matches_brandes(spark):
    rnd = random.Random(3)
    edges = {(min(a, b), max(a, b)) for a, b in ((rnd.randrange(30), rnd.randrange(30)) for _ in range(60)) if a != b}
    e = spark.createDataFrame(sorted(edges), "src long, dst long")
    got = {r["v"]: r["betweenness"] for r in graph.betweenness(e).collect()}
    adj = defaultdict(list)
    for a, b in edges:
        adj[a].append(b)
        adj[b].append(a)
    want = _brandes(sorted(adj), adj)
    for v, x in want.items():
        assert got[v] == pytest.approx(x, abs=1e-9)


def test_connected_components_union_find(spark):
    rnd = random.Random(5)
    edges = [(rnd.randrange(200), rnd.randrange(200)) for _ in range(150)]
    parent = list(range(200))

    def find(x):
        while parent[x] != x:
            parent[x] = parent[parent[x]]
            x = parent[x]
        return x
    for a, b in edges:
        ra, rb = find(a), find(b)
        parent[max(ra, rb)] = min(ra, rb)
    comp = defaultdict(list)
    for v in range(200):
        comp[find(v)].append(v)
    want = {v: min(c) for c in comp.values() for v in c}
    e = spark.createDataFrame(edges, "src long, dst long")
    v = spark.range(200).select(F.col("id").alias("v"))
    got = {r["v"]: r["component"] for r in neighbors.connected_components(e, v).collect()}
    assert got == want


def test_knn_1d_brute_force(spark):
    rnd = random.Random(11)
    train = [(i, float(rnd.randint(0, 40)), rnd.randint(0, 1)) for i in range(300)]  # many ties
    test = [(1000 + i, float(rnd.randint(-5, 45))) for i in range(80)]
    tr = spark.createDataFrame(train, "id long, x double, y int")
    te = spark.createDataFrame(test, "id long, x double")
    k = 9
    got = neighbors.knn_1d(tr, te, "id", "x", "y", k).collect()
    got_map = defaultdict(dict)
    for r in got:
        got_map[r["te_id"]][r["nn_rank"]] = r["tr_id"]
    for tid, tx in test:
        order = sorted(train, key=lambda t: (abs(t[1] - tx), t[1], -t[0] if t[1] < tx else t[0]))[:k]
        assert [got_map[tid][i + 1] for i in range(k)] == [t[0] for t in order]


def test_radius_join_brute_force(spark):
    rnd = random.Random(2)
    pts = [(i, rnd.uniform(-89, 89), rnd.uniform(-180, 180)) for i in range(400)]
    pts += [(400, 0.0, 179.9), (401, 0.0, -179.9), (402, 89.5, 10.0), (403, 89.5, -170.0)]  # wrap and pole
    sites = [(j, rnd.uniform(-89, 89), rnd.uniform(-180, 180)) for j in range(60)] + [(60, 0.0, -179.95), (61, 89.6, 100.0)]
    p = spark.createDataFrame(pts, "pid long, plat double, plon double")
    s = spark.createDataFrame(sites, "sid long, slat double, slon double")
    r = 500_000.0
    got = {(x["pid"], x["sid"]) for x in geo.radius_join(p, "plat", "plon", s, "slat", "slon", r).collect()}
    chk = p.join(s, how="cross").withColumn("d", haversine("plat", "plon", "slat", "slon")).where(F.col("d") <= r)
    want = {(x["pid"], x["sid"]) for x in chk.collect()}
    assert got == want and len(want) > 0


def test_nearest_site_compares_places_not_rows(spark, monkeypatch):
    """5,000 points and 3,000 sites at few places, most sites in one town: few pairs."""
    p = spark.range(5000).select(F.col("id").alias("pid"), (F.col("id") % 7 + 0.5).alias("plat"), (F.col("id") % 11 + 0.25).alias("plon"))
    s = spark.range(3000).select((9000 - F.col("id")).alias("sid"), (F.col("id") % 50 / 1000).alias("slat"), (F.col("id") % 60 / 1000 * (F.col("id") % 3)).alias("slon"))
    counts, join = [], geo.radius_join

    def counted(*args):
        out = join(*args)
        counts.append(out.count())
        return out

    monkeypatch.setattr(geo, "radius_join", counted)
    got = {r["pid"]: (r["sid"], r["dist_m"]) for r in geo.nearest_site(p, "pid", "plat", "plon", s, "sid", "slat", "slon").collect()}
    assert sum(counts) <= 77 * 300 and len(got) == 5000
    places = p.groupBy("plat", "plon").agg(F.min("pid").alias("pid"))
    d = places.join(s, how="cross").select("pid", F.struct(haversine("plat", "plon", "slat", "slon").alias("d"), "sid").alias("b")).groupBy("pid").agg(F.min("b").alias("b"))
    assert all(got[r["pid"]] == (r["b"]["sid"], r["b"]["d"]) for r in d.collect())


def test_survey_mean_brings_sums_to_the_domain_means(spark):
    """Rows of a domain do not meet in one task, and the sums lose nothing beside the rows."""
    from quarry.operators import stats

    rnd = random.Random(12)
    rows = [(rnd.choice("ab"), 1e3 + rnd.gauss(0, 1), float(rnd.randint(1, 50)), rnd.choice("xyz"), rnd.randrange(20)) for _ in range(3000)]
    df = spark.createDataFrame(rows, "g string, x double, w double, h string, j long")
    out = stats.survey_mean(df, "x", "w", "h", "j", "g")
    for r in out.collect():
        mine = [t for t in rows if t[0] == r["domain"]]
        ww = sum(t[2] for t in mine)
        mean = sum(t[1] * t[2] for t in mine) / ww
        var = 0.0
        for h in "xyz":
            n = len({t[4] for t in rows if t[3] == h})
            z = defaultdict(float)
            for t in mine:
                if t[3] == h:
                    z[t[4]] += t[2] * (t[1] - mean) / ww
            var += n / (n - 1) * (sum(v * v for v in z.values()) - sum(z.values()) ** 2 / n)
        assert r["mean"] == pytest.approx(mean, rel=1e-12) and r["se"] == pytest.approx(var ** 0.5, rel=1e-9)
    plan = out._jdf.queryExecution().optimizedPlan().toString()
    assert all("Aggregate [domain" in part for part in plan.split("Join Inner, (domain")[1:])


def test_nearest_site_brute_force(spark):
    rnd = random.Random(4)
    pts = [(i, rnd.uniform(-80, 80), rnd.uniform(-180, 180)) for i in range(200)]
    sites = [(j, rnd.uniform(-80, 80), rnd.uniform(-180, 180)) for j in range(25)]
    p = spark.createDataFrame(pts, "pid long, plat double, plon double")
    s = spark.createDataFrame(sites, "sid long, slat double, slon double")
    got = {r["pid"]: r["sid"] for r in geo.nearest_site(p, "pid", "plat", "plon", s, "sid", "slat", "slon").collect()}
    d = p.join(s, how="cross").withColumn("d", haversine("plat", "plon", "slat", "slon")).collect()
    best = {}
    for r in d:
        if r["pid"] not in best or (r["d"], r["sid"]) < best[r["pid"]]:
            best[r["pid"]] = (r["d"], r["sid"])
    assert got == {k: v[1] for k, v in best.items()}


def test_interval_join_brute_force(spark):
    import datetime as dt
    base = dt.datetime(2024, 1, 1)
    rnd = random.Random(9)
    pts = [(i, base + dt.timedelta(minutes=rnd.randint(0, 5000))) for i in range(300)]
    ivs = []
    for j in range(40):
        a = base + dt.timedelta(minutes=rnd.randint(0, 5000))
        ivs.append((j, a, a + dt.timedelta(minutes=rnd.randint(0, 400))))
    p = spark.createDataFrame(pts, "pid long, ts timestamp_ntz")
    iv = spark.createDataFrame(ivs, "iid long, s timestamp_ntz, e timestamp_ntz")
    got = {(r["pid"], r["iid"]) for r in interval_point_join(p, "ts", iv, "s", "e", how="inner").collect()}
    want = {(a, j) for a, t in pts for j, s, e in ivs if s <= t <= e}
    assert got == want


def test_special_functions_goldens():
    assert special.t_sf2_np(2.228138851986, 10) == pytest.approx(0.05, abs=1e-10)
    assert special.chi2_sf_np(3.841458820694124, 1) == pytest.approx(0.05, abs=1e-10)
    assert special.f_sf_np(4.9646027437307145, 1, 10) == pytest.approx(0.05, abs=1e-10)
    assert special.t_ppf_np(0.975, 10) == pytest.approx(2.228138852, abs=1e-8)
    assert special.chi2_sf_np(18.307038053275146, 10) == pytest.approx(0.05, abs=1e-10)


def test_normal_functions(spark):
    from quarry.functions.distributions import norm_cdf, norm_ppf
    r = spark.range(1).select(norm_cdf(F.lit(1.959963984540054)).alias("c"), norm_ppf(F.lit(0.975)).alias("q"),
                              norm_ppf(F.lit(0.001)).alias("lo")).first()
    assert r["c"] == pytest.approx(0.975, abs=1e-7)
    assert r["q"] == pytest.approx(1.959963984540054, abs=1e-8)
    assert r["lo"] == pytest.approx(-3.090232306167813, abs=1e-8)


def test_simpson_kidney_stone_golden(spark):
    # FIXTURES.md section D: success / total per treatment and stone size
    cells = {("A", "small"): (81, 87), ("A", "large"): (192, 263), ("B", "small"): (234, 270), ("B", "large"): (55, 80)}
    rows = [(t, s, int(i < ok)) for (t, s), (ok, n) in cells.items() for i in range(n)]
    df = spark.createDataFrame(rows, "treatment string, stone_size string, success int")
    got = {(r["treatment"], r["stone_size"]): r["rate"] for r in agg.simpson_rates(df, "treatment", "stone_size",
                                                                                      F.col("success") == 1).collect()}
    assert got[("A", "ALL")] == pytest.approx(273 / 350) and got[("B", "ALL")] == pytest.approx(289 / 350)
    assert got[("B", "ALL")] > got[("A", "ALL")]
    assert got[("A", "small")] > got[("B", "small")] and got[("A", "large")] > got[("B", "large")]


def test_welch_t_known_values(spark):
    from quarry.operators.stats import t_test_welch
    a = [19.1, 20.3, 21.5, 18.9, 22.0, 20.7]
    b = [17.2, 18.4, 16.9, 19.0, 17.7]
    df = spark.createDataFrame([("a", x) for x in a] + [("b", x) for x in b], "g string, x double")
    r = t_test_welch(df, "x", "g", "a", "b").first()
    va, vb = np.var(a, ddof=1) / len(a), np.var(b, ddof=1) / len(b)
    t = (np.mean(a) - np.mean(b)) / math.sqrt(va + vb)
    assert r["t"] == pytest.approx(t)
    assert 0 < r["p_value"] < 0.01


def test_skew_safe_windows_match_plain(spark):
    from pyspark.sql import Window
    from quarry.operators import windows as win
    rnd = random.Random(13)
    rows = [(0 if i % 3 == 0 else rnd.randrange(1, 50), i, rnd.uniform(1, 10)) for i in range(6000)]  # key 0: a third
    df = spark.createDataFrame(rows, "g long, t long, x double")
    tagged = win.range_tagged(df, ["g"], ["t"], partitions=8)
    spread = tagged.where("g = 0").select("_pid").distinct().count()
    assert spread >= 3  # the hot key is split across partitions
    w = Window.partitionBy("g").orderBy("t")
    plain = df.withColumns({"rn": F.row_number().over(w), "cs": F.sum("x").over(w.rowsBetween(Window.unboundedPreceding, 0)),
                            "lg": F.lag("x").over(w)})
    safe = win.running_sums(df, ["g"], ["t"], {"rn": F.lit(1), "cs": F.col("x")}, partitions=8)
    safe = win.shifted(safe, ["g"], ["t"], "x", 1, "lg").drop("_pos")
    a = {r["t"]: (r["rn"], round(r["cs"], 6), r["lg"]) for r in plain.collect()}
    b = {r["t"]: (r["rn"], round(r["cs"], 6), r["lg"]) for r in safe.collect()}
    assert a == b
    ranks = win.rank_average_ties(df.withColumn("v", F.floor("x")), ["g"], "v", skew_safe=True)
    plain_r = win.rank_average_ties(df.withColumn("v", F.floor("x")), ["g"], "v", skew_safe=False)
    assert {r["t"]: r["rank"] for r in ranks.collect()} == {r["t"]: r["rank"] for r in plain_r.collect()}


def test_portable_uniform_is_uniform(spark):
    from quarry.functions.columns import mix_uniform
    d = spark.range(20000).select(mix_uniform(F.col("id"), seed=42).alias("u"),
                                  mix_uniform(F.lit(3), F.col("id"), seed=42).alias("v"))
    r = d.agg(F.avg("u").alias("m"), F.avg((F.col("u") < 0.8).cast("double")).alias("s"), F.corr("u", "v").alias("c"),
              *[F.avg(((F.col("u") >= b / 10) & (F.col("u") < (b + 1) / 10)).cast("double")).alias(f"b{b}") for b in range(10)]
              ).first()
    assert abs(r["m"] - 0.5) < 0.01 and abs(r["s"] - 0.8) < 0.01 and abs(r["c"]) < 0.03
    assert all(abs(r[f"b{b}"] - 0.1) < 0.01 for b in range(10))


def test_approx_quantiles_close(spark):
    df = _skewed(spark)
    ex = quantiles.quantile_wide(df, "x", [0.25, 0.5, 0.9], ["a", "b", "c"], ["g"]).collect()
    ap = {r["g"]: r for r in quantiles.approx_quantiles(df, "x", [0.25, 0.5, 0.9], ["a", "b", "c"], ["g"]).collect()}
    data = defaultdict(list)
    for r in df.collect():
        if r["x"] is not None:
            data[r["g"]].append(r["x"])
    for r in ex:
        xs = np.sort(data[r["g"]])
        for c, p in (("a", 0.25), ("b", 0.5), ("c", 0.9)):
            # the sketch returns an observed value whose rank is within n/accuracy of the target
            rank = np.searchsorted(xs, ap[r["g"]][c], side="right") / len(xs)
            assert abs(rank - p) <= 0.01 or ap[r["g"]][c] == pytest.approx(r[c], rel=1e-9)


def test_connected_components_long_path(spark):
    n = 1500  # diameter 1499: one round per hop would not finish; star contraction does
    perm = list(range(n))
    random.Random(1).shuffle(perm)
    edges = spark.createDataFrame([(perm[i], perm[i + 1]) for i in range(n - 1)], "src long, dst long")
    v = spark.range(n + 5).select(F.col("id").alias("v"))
    got = {r["v"]: r["component"] for r in neighbors.connected_components(edges, v).collect()}
    assert all(got[i] == 0 for i in range(n)) and all(got[i] == i for i in range(n, n + 5))


def test_pivot_unpivot_round_trip(spark):
    from quarry.operators import reshape
    li = spark.read.parquet("/root/testdata/sf0.001/lineitem.parquet").select("l_orderkey", "l_linenumber", "l_quantity", "l_tax") \
        .withColumn("rid", F.monotonically_increasing_id())  # (orderkey, linenumber) repeats in the harness data
    li = li.checkpoint()
    long = reshape.unpivot(li, ["rid", "l_orderkey", "l_linenumber"], ["l_quantity", "l_tax"])
    wide = reshape.pivot(long, ["rid", "l_orderkey", "l_linenumber"], "key", F.first("value"), ["l_quantity", "l_tax"], fill=None)
    assert wide.select(*li.columns).exceptAll(li).count() == 0 and li.exceptAll(wide.select(*li.columns)).count() == 0


def test_nest_unnest_round_trip(spark):
    from quarry.operators import reshape
    o = spark.read.parquet("/root/testdata/sf0.001/orders.parquet").select("o_custkey", "o_orderkey", "o_totalprice")
    back = reshape.unnest_rows(reshape.nest_rows(o, ["o_custkey"], ["o_orderkey", "o_totalprice"]), "data", ["o_custkey"])
    assert back.exceptAll(o).count() == 0 and o.exceptAll(back).count() == 0


def test_betweenness_by_batches_of_sources(spark):
    """Few state rows a batch: the sum over batches is the whole."""
    rnd = random.Random(21)
    e = spark.createDataFrame([(i, rnd.randrange(i)) for i in range(1, 30)] + [(0, 29), (3, 17)], "src long, dst long")
    whole = {r["v"]: r["betweenness"] for r in graph.betweenness(e).collect()}
    parts = {r["v"]: r["betweenness"] for r in graph.betweenness(e, state_rows=30 * 10).collect()}
    assert whole.keys() == parts.keys() and all(abs(whole[v] - parts[v]) < 1e-9 for v in whole) and max(whole.values()) > 0


def test_betweenness_in_tasks_and_by_joins_agree(spark):
    """Components in tasks, by joins and mixed; a task steps its sources in pieces and a hub's edges in one."""
    rnd = random.Random(5)
    rows = [(i, rnd.randrange(max(0, i - 9), i)) for i in range(1, 60)] + [(rnd.randrange(60), rnd.randrange(60)) for _ in range(40)]
    rows += [(100, 100 + i) for i in range(1, 25)] + [(500, 501)] + [(i, i + 1) for i in range(700, 704)]
    rows = sorted({(min(a, b), max(a, b)) for a, b in rows if a != b})
    adj = defaultdict(list)
    for a, b in rows:
        adj[a].append(b)
        adj[b].append(a)
    want = _brandes(sorted(adj), adj)
    e = spark.createDataFrame(rows, "src long, dst long")
    for most in (10 ** 6, 30):
        got = {r["v"]: r["betweenness"] for r in graph.betweenness(e, task_edges=most).collect()}
        assert got.keys() == want.keys() and all(got[v] == pytest.approx(want[v], abs=1e-9) for v in want)


def test_betweenness_of_many_sources_in_a_task(monkeypatch):
    import numpy as np

    rnd = random.Random(6)
    adj = defaultdict(set)
    for _ in range(300):
        a, b = rnd.randrange(120), rnd.randrange(120)
        if a != b:
            adj[a].add(b)
            adj[b].add(a)
    vs = sorted(adj)
    first = np.cumsum([0, *(len(adj[v]) for v in vs)])
    to = np.array([vs.index(w) for v in vs for w in sorted(adj[v])])
    want = _brandes(vs, adj)
    for states, steps in ((1 << 20, 1 << 20), (500, 7)):
        monkeypatch.setattr(graph, "TASK_STATES", states)
        monkeypatch.setattr(graph, "TASK_STEPS", steps)
        got = graph.source_dependencies(first, to, np.arange(len(vs))) / 2
        assert np.allclose(got, [want[v] for v in vs], atol=1e-9)


def _arrays(rows):
    """(neighbours by vertex, first, to) of undirected edges over whole numbers from 0 on, in which no vertex is missing."""
    import numpy as np

    adj = defaultdict(set)
    for a, b in rows:
        adj[a].add(b)
        adj[b].add(a)
    vs = sorted(adj)
    assert vs == list(range(len(vs)))
    return adj, np.cumsum([0, *(len(adj[v]) for v in vs)]), np.array([w for v in vs for w in sorted(adj[v])])


def _trade(rnd, customers, suppliers, more=()):
    """Customers (first) that buy from one to three suppliers, each supplier with some."""
    rows = {(i, customers + (i if i < suppliers else rnd.randrange(suppliers))) for i in range(customers)}
    rows |= {(i, customers + rnd.randrange(suppliers)) for i in range(0, customers, 2)} | {(i, customers + rnd.randrange(suppliers)) for i in range(0, customers, 5)}
    return sorted(rows | set(more))


@pytest.mark.parametrize("levels,hub", [(32, 64), (32, 2), (2, 64)])
def test_betweenness_of_vertices_with_the_same_neighbours(monkeypatch, levels, hub):
    """Copies of a vertex, all or some of them sources; hubs in one piece; too many levels for matrices."""
    import numpy as np

    monkeypatch.setattr(graph, "MATRIX_LEVELS", levels)
    monkeypatch.setattr(graph, "HUB", hub)
    monkeypatch.setattr(graph, "CELLS", 100)
    rnd = random.Random(9)
    for rows in (_trade(rnd, 60, 7), _trade(rnd, 40, 9, [(48, 49), (49, 50)]), [(0, i) for i in range(1, 30)], [(i, i + 1) for i in range(40)],
                 [(a, b) for a in range(4) for b in range(4, 9)] + [(8, 9)]):
        adj, first, to = _arrays(rows)
        want = _brandes(sorted(adj), adj)
        got = graph.source_dependencies(first, to, np.arange(len(adj))) / 2
        assert np.allclose(got, [want[v] for v in sorted(adj)], atol=1e-9)
        some = rnd.sample(sorted(adj), len(adj) // 2)
        assert np.allclose(graph.source_dependencies(first, to, np.array(some)), graph._frontier_dependencies(first, to, np.array(some)), atol=1e-9)


def test_loops_are_on_no_shortest_path():
    import numpy as np

    first, to = np.array([0, 2, 5, 7, 8]), np.array([0, 1, 0, 1, 2, 1, 3, 2])  # 0-0, 0-1, 1-1, 1-2, 2-3
    assert graph.source_dependencies(first, to, np.arange(4)).tolist() == [0, 4, 4, 0]


def test_customers_of_one_supplier_are_stepped_once(monkeypatch):
    import numpy as np

    asked = []
    columns = graph._columns
    monkeypatch.setattr(graph, "_columns", lambda near, copies, some: asked.extend(some) or columns(near, copies, some))
    adj, first, to = _arrays(_trade(random.Random(10), 300, 10))
    graph.source_dependencies(first, to, np.arange(len(adj)))
    assert len(asked) == len({frozenset(x) for x in adj.values()}) < len(adj) / 2


def test_betweenness_sampled_sources_is_opt_in_estimate(spark):
    rnd = random.Random(8)
    edges = {(min(a, b), max(a, b)) for a, b in ((rnd.randrange(40), rnd.randrange(40)) for _ in range(120)) if a != b}
    e = spark.createDataFrame(sorted(edges), "src long, dst long")
    exact = {r["v"]: r["betweenness"] for r in graph.betweenness(e).collect()}
    est = {r["v"]: r["betweenness"] for r in graph.betweenness(e, source_fraction=0.5).collect()}
    assert sum(est.values()) == pytest.approx(sum(exact.values()), rel=0.35)


def test_row_index_prefix_counts(spark):
    df = spark.range(0, 3000).select((F.col("id") * 7919 % 3001).alias("k"), (F.col("id") % 3 == 0).alias("f"))
    rows = sorted(with_row_index(df, ["k"], "pos", partitions=7, prefix_counts={"nf": F.col("f")}).collect(),
                  key=lambda r: r["pos"])
    running = 0
    for i, r in enumerate(rows, start=1):
        running += int(r["f"])
        assert r["pos"] == i and r["nf"] == running


def test_nest_rows_chunks_hot_key(spark):
    from quarry.operators import reshape
    rows = [(0 if i % 3 == 0 else 1 + i % 50, i, float(i)) for i in range(9000)]  # key 0 holds a third
    df = spark.createDataFrame(rows, "k long, id long, v double")
    n = reshape.nest_rows(df, ["k"], ["id", "v"], chunk_size=1000)
    sizes = {(r["k"], r["chunk"]): r["n"] for r in n.select("k", "chunk", F.size("data").alias("n")).collect()}
    assert max(sizes.values()) <= 1000 and sum(1 for k, _ in sizes if k == 0) == 3
    back = reshape.unnest_rows(n, "data", ["k"])
    assert back.exceptAll(df).count() == 0 and df.exceptAll(back).count() == 0
