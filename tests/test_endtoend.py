"""E1-E3 from text files, checked against brute force in plain Python."""

import hashlib
from decimal import ROUND_HALF_UP, Decimal
import os
import random

import pytest

from strata.checks import DataCheckError
from strata.operators.cluster import KMeansParams
from strata.plans import endtoend
from strata.plans.endtoend import score_clusters, term_popularity, time_use_by_life_period
from strata.sinks import report_text
from strata.sources.postings import read_postings


def write(folder, name, lines):
    with open(os.path.join(folder, name), "w") as f:
        f.write("\n".join(lines) + "\n")


def test_term_popularity(spark, scratch):
    rnd = random.Random(2)
    words = ["basil", "Basil", "mace", "mace,", "dill", "of", "leaf"]
    texts = [" ".join(rnd.choice(words) for _ in range(rnd.randint(1, 6))) for _ in range(60)]
    write(scratch, "a.dat", ["<page><title>x" + str(i) + "</title><text>" + t + "</text></page>xx"
                             for i, t in enumerate(texts)])
    terms = ["dill", "mace", "basil", "yarrow"]
    n = {t: sum(t in x.split(" ") for x in texts) for t in terms}
    want = sorted(((t, c) for t, c in n.items() if c), key=lambda p: (-p[1], p[0]))
    res = term_popularity(spark, scratch, terms)
    as_list = lambda df: [(r["term"], r["n"]) for r in df.collect()]
    assert as_list(res.ranked) == want + [("yarrow", 0)]
    assert as_list(res.ranked_from_index) == want == as_list(res.ranked_by_reduction)


# --- E2 brute force ----------------------------------------------------------

def trunc_div(a, b):
    q = abs(a) // abs(b)
    return q if (a >= 0) == (b > 0) else -q


def brute_clusters(lines, p: KMeansParams):
    qs, ans = set(), {}
    for line in lines:
        f = line.split(",")
        while f and f[-1] == "":          # the reference's split drops trailing empties
            f.pop()
        kind, pid = int(f[0]), int(f[1])
        if kind == 1:
            qs.add((pid, f[5] if len(f) >= 6 else None))
        elif f[3] != "":
            ans.setdefault(int(f[3]), []).append(int(f[4]))
    vectors = []
    for qid, tag in sorted(qs, key=str):
        if qid in ans and tag in p.categories:
            vectors.append((qid, p.categories.index(tag) * p.spread, max(0, max(ans[qid]))))
    per = p.kernels // len(p.categories)
    seeds = []
    for c in range(len(p.categories)):
        pts = [v for v in vectors if v[1] == c * p.spread]
        pts.sort(key=lambda v: (hashlib.md5(f"{v[0]}#{p.seed}".encode()).hexdigest(), v[0], v[2]))
        seeds += [(v[1], v[2]) for v in pts[:per]]

    def closest(x, y, cs):
        return min(range(len(cs)), key=lambda i: (float(x - cs[i][0]) ** 2 + float(y - cs[i][1]) ** 2, i))

    means, it = list(seeds), 0
    while True:
        it += 1
        groups = {}
        for _, x, y in vectors:
            groups.setdefault(closest(x, y, means), []).append((x, y))
        new = list(means)
        for c, g in groups.items():
            new[c] = (trunc_div(sum(x for x, _ in g), len(g)), trunc_div(sum(y for _, y in g), len(g)))
        dist = sum(float(a[0] - b[0]) ** 2 + float(a[1] - b[1]) ** 2 for a, b in zip(means, new))
        means = new
        if dist < p.eta or it >= p.max_iterations:
            break
    groups = {}
    for _, x, y in vectors:
        groups.setdefault(closest(x, y, means), []).append((x, y))
    report = []
    for g in groups.values():
        xs = sorted({x for x, _ in g}, key=lambda x: (-sum(1 for a, _ in g if a == x), x))
        mode = xs[0]
        ys = sorted(y for _, y in g)
        n = len(ys)
        median = ys[n // 2] if n % 2 else trunc_div(ys[n // 2 - 1] + ys[n // 2], 2)
        report.append((p.categories[mode // p.spread],
                       sum(1 for a, _ in g if a == mode) * 100.0 / n, n, median))
    return means, it, sorted(report, key=lambda r: (r[3], r[0], r[2]))


def counting(df, spark, reads):
    """``df`` that adds up the rows read from it."""
    reads.append(spark.sparkContext.accumulator(0))
    seen = reads[-1]

    def run(batches):
        for batch in batches:
            seen.add(batch.num_rows)
            yield batch
    return df.mapInArrow(run, df.schema)


def test_score_clusters_matches_brute_force(spark, scratch, monkeypatch):
    rnd = random.Random(5)
    tags = ["A", "B", "C", "D"]
    lines, aid = [], 100000
    for q in range(600):
        tag = rnd.choice(tags + [None])
        lines.append(f"1,{q},,,{rnd.randint(0, 9)}" + (f",{tag}" if tag else ""))
        for _ in range(rnd.randint(0, 4)):
            aid += 1
            lines.append(f"2,{aid},,{q},{rnd.randint(-40, 300) * (1 + q % 3)}")
    write(scratch, "p.csv", lines)
    p = KMeansParams(categories=("A", "B", "C"), spread=50000, kernels=6, eta=20.0,
                     max_iterations=120, seed=42)
    means, iters, want = brute_clusters(lines, p)
    reads = []
    monkeypatch.setattr(endtoend, "read_postings",
                        lambda *a: counting(read_postings(*a), spark, reads))
    vectors = sum(r[2] for r in want)
    report, fitted = score_clusters(spark, scratch, p, expected_vectors=vectors)
    assert reads[0].value == len(lines)         # check and fit share one evaluation
    with pytest.raises(DataCheckError):
        score_clusters(spark, scratch, p, expected_vectors=vectors + 1)
    assert fitted.result.centers == means and fitted.result.iterations == iters
    got = [(r["label"], r["percent"], r["size"], r["median_score"]) for r in report.collect()]
    assert got == want
    text = report_text(report)
    assert len(text) == 3 + len(want)


# --- E3 brute force ----------------------------------------------------------

def half_up(v):
    """Spark's round(v, 1) on doubles: HALF_UP on the shortest decimal form."""
    return float(Decimal(repr(v)).quantize(Decimal("0.1"), rounding=ROUND_HALF_UP))


def test_time_use_matches_brute_force(spark, scratch):
    header = ["id", "telfs", "tesex", "teage", "t010101", "t050101", "t120101", "t180101",
              "t180501", "t170101"]
    rnd = random.Random(9)
    rows = []
    for i in range(400):
        vals = [rnd.randint(1, 5), rnd.randint(1, 2), rnd.randint(15, 85)] + \
               [rnd.randint(0, 900) for _ in range(6)]
        rows.append([f"r{i}"] + vals)
    write(scratch, "s.csv", [",".join(header)] + [",".join(map(str, r)) for r in rows])
    got = [tuple(r) for r in time_use_by_life_period(spark, scratch).collect()]
    groups = {}
    for r in rows:
        d = dict(zip(header, r))
        if d["telfs"] > 4:
            continue
        key = ("working" if d["telfs"] < 3 else "not working",
               "male" if d["tesex"] == 1 else "female",
               "young" if 15 <= d["teage"] <= 22 else "active" if 23 <= d["teage"] <= 55 else "elder")
        prim = ((0.0 + d["t180101"]) + d["t010101"]) / 60.0
        work = ((0.0 + d["t180501"]) + d["t050101"]) / 60.0
        other = (0.0 + d["t120101"]) / 60.0
        groups.setdefault(key, []).append((prim, work, other))
    want = []
    for key in sorted(groups):
        g = groups[key]
        want.append(key + tuple(half_up(sum(v[i] for v in g) / len(g)) for i in range(3)))
    assert [k[:3] for k in got] == [k[:3] for k in want]
    for a, b in zip(got, want):
        assert all(abs(x - y) < 1e-9 for x, y in zip(a[3:], b[3:]))


def test_checked_time_use_counts_on_its_own_job(spark, scratch):
    header = "id,telfs,tesex,teage,t010101,t050101"
    lines = [f"k{i},{i % 5 + 1},{i % 2 + 1},{i % 60 + 15},{i}.5,{i * 2}" for i in range(50)]
    write(scratch, "a.csv", [header] + lines[:30])
    write(scratch, "b.csv", [header] + lines[30:])
    plain = time_use_by_life_period(spark, scratch).collect()
    assert endtoend.checked_time_use(spark, scratch, 50).collect() == plain
    with pytest.raises(DataCheckError, match="51 respondents expected, 50 found"):
        endtoend.checked_time_use(spark, scratch, 51)

    def jobs(action):
        sc = spark.sparkContext
        sc.setJobGroup("checked-time-use", "count the jobs")
        before = len(sc.statusTracker().getJobIdsForGroup("checked-time-use"))
        action()
        after = len(sc.statusTracker().getJobIdsForGroup("checked-time-use"))
        sc.setLocalProperty("spark.jobGroup.id", None)
        return after - before

    once = jobs(lambda: time_use_by_life_period(spark, scratch).collect())
    assert jobs(lambda: endtoend.checked_time_use(spark, scratch, 50)) == once
