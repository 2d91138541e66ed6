import itertools
import random

from assaymill.operators import graph


def order(spark, edges, nodes):
    e = spark.createDataFrame(edges, "src long, dst long") if edges else spark.createDataFrame([], "src long, dst long")
    n = spark.createDataFrame([(x,) for x in nodes], "id long")
    return {r["id"]: r["processing_priority"] for r in graph.processing_order(e, n).collect()}


def test_chain_and_isolated(spark):
    pos = order(spark, [(1, 2), (2, 3)], [1, 2, 3, 9])
    assert pos[1] < pos[2] < pos[3] and sorted(pos.values()) == [0, 1, 2, 3]


def test_only_isolated(spark):
    assert order(spark, [], [5, 4]) == {4: 0, 5: 1}


def test_cycle_is_broken_and_rest_keeps_its_order(spark):
    # 1 <-> 2 is a cycle; 7 -> 5 is not on one, although its ids descend.
    pos = order(spark, [(1, 2), (2, 1), (2, 7), (7, 5)], [1, 2, 5, 7])
    assert sorted(pos.values()) == [0, 1, 2, 3]
    assert pos[1] < pos[2] < pos[7] < pos[5]


def test_edges_between_cycles_stay(spark):
    # Two cycles {8, 9} and {3, 4}, joined by 9 -> 3.
    pos = order(spark, [(8, 9), (9, 8), (9, 3), (3, 4), (4, 3)], [3, 4, 8, 9])
    assert pos[8] < pos[9] < pos[3] < pos[4]


def test_components_against_brute_force(spark):
    rng = random.Random(3)
    edges = sorted({(rng.randrange(14), rng.randrange(14)) for _ in range(26)})
    edges = [(a, b) for a, b in edges if a != b]
    reach = {(a, b) for a, b in edges}
    for k, a, b in itertools.product(range(14), repeat=3):
        if (a, k) in reach and (k, b) in reach:
            reach.add((a, b))
    kept = graph.break_cycles(spark.createDataFrame(edges, "src long, dst long"))
    got = {(r["src"], r["dst"]) for r in kept.collect()}
    assert got == {(a, b) for a, b in edges if not ((b, a) in reach and a > b)}


def longest(edges, ids):
    level = dict.fromkeys(ids, 0)
    for _ in ids:
        for a, b in edges:
            level[b] = max(level[b], level[a] + 1)
    return level


def levels(spark, edges):
    e = spark.createDataFrame(edges, "src long, dst long")
    return {r["id"]: r["level"] for r in graph.topological_levels(e).collect()}


def test_levels_against_brute_force(spark):
    rng = random.Random(5)
    for n, m in ((12, 14), (20, 50)):
        edges = sorted({tuple(sorted(rng.sample(range(n), 2))) for _ in range(m)})
        assert levels(spark, edges) == longest(edges, sorted({x for e in edges for x in e}))
    ladder = [e for i in range(0, 12, 2) for e in ((i, i + 1), (i, i + 2), (i + 1, i + 2), (i + 1, i + 3))]
    assert levels(spark, ladder) == longest(ladder, sorted({x for e in ladder for x in e}))


def test_a_deep_chain_takes_few_jobs(spark):
    n, sc = 10_000, spark.sparkContext
    sc.setJobGroup("deep", "deep")
    # A chain, a diamond half-way, and a branch that hangs from the chain.
    edges = [(i, i + 1) for i in range(n)] + [(5000, 20_001), (20_001, 20_002), (20_002, 5001), (17, 30_000)]
    got = levels(spark, edges)
    jobs = len(sc.statusTracker().getJobIdsForGroup("deep"))
    sc.setLocalProperty("spark.jobGroup.id", None)
    assert got[5000] == 5000 and got[5001] == 5003 and got[n] == n + 2 and got[30_000] == 18
    assert jobs < 250, jobs


def test_a_ring_and_what_hangs_from_it(spark):
    edges = [(i, (i + 1) % 6) for i in range(6)] + [(3, 10), (10, 11), (20, 4)]
    kept = {(r["src"], r["dst"]) for r in graph.break_cycles(spark.createDataFrame(edges, "src long, dst long")).collect()}
    assert kept == set(edges) - {(5, 0)}
    assert levels(spark, edges) == {0: 0, 1: 1, 2: 2, 3: 3, 4: 4, 5: 5, 10: 4, 11: 5, 20: 0}


def test_resolution_order_and_duplicates(spark):
    papers = spark.createDataFrame(
        [(1, "PMC1", "d1", "p1"), (2, "PMC2", "d2", "p2"), (3, "PMC3", "d2", None)], "id long, pmc_id string, doi string, pmid string")
    refs = spark.createDataFrame([(9, "d2", "p1", None), (9, "zz", "p1", "PMC2"), (9, None, None, "PMC2"), (9, "zz", None, None)],
                                 "paper_id long, doi string, pmid string, pmc_id string")
    got = [r["referenced_id"] for r in graph.resolve_references(refs, papers).orderBy("doi", "pmid", "pmc_id").collect()]
    assert sorted(got, key=str) == sorted([3, 1, 2, None], key=str)
    twice = graph.stored_references(refs.union(refs), papers)
    assert twice.count() == 4
