from cohortloom.llm.variants import average_linkage, parse, same_entity, spelling_clusters, sponsor_pairs

ORG = ["Chajuslivri Biosciences GmbH", "CHAJUSLIVRI BIOSCIENCES GMBH", "Chajuslvri Biosci., G.m.b.H.", "Chajuslivri", "Chajuslivri Biosciences GmbH (CBGHAI)", "CBGHAI", "Chaju Biosci."]
UNI = ["University of Klotheshiga", "Universität Klotheshiga", "Klotheshiga, University of", "Dept. of Medicine, University of Klotheshiga", "U. Klotheshiga", "University  of Klothshiega"]
HOSP = ["Klotheshiga University Hospital", "CHU de Klotheshiga", "Universitätsklinikum Klotheshiga", "Univ Hosp Klotheshiga"]
PERSON = ["Katherine Weklipruzwe", "Kate Waeklipruzwe", "K. Weklipruzwe", "Weklipruzwe, Katherine", "Weklipruzwe KB", "Dr. Katherine Weklipruzwe", "WEKLIPRUZWE, K. B.", "Katherine B. Weklipruzwe, MD"]
OTHER = ["Margaret Weklipruzwe", "Zokimego Cooperative Oncology Group", "Zokimego Biosciences Ltd."]


def clusters(spark, names):
    got = {}
    for r in spelling_clusters(spark.createDataFrame([(n, "x") for n in names], "name string, spelling string")).collect():
        got.setdefault(r.cluster, set()).add(r.spelling)
    return sorted(map(sorted, got.values()))


def test_spellings_of_one_entity(spark):
    want = [ORG, UNI, HOSP, PERSON, *[[x] for x in OTHER]]
    assert clusters(spark, [x for g in want for x in g] * 2) == sorted(map(sorted, want))


def test_nobody_null_blank_and_empty(spark):
    names = ["Not specified", "not specified ", None, "", "  ", "Alpha Labs"]
    assert all(len(c) == 1 for c in clusters(spark, names))
    assert clusters(spark, []) == []
    t = spark.createDataFrame([(n, 1) for n in names + ORG], "sponsor string, cluster int")
    pairs = {tuple(r) for r in sponsor_pairs(t).collect()}
    assert pairs == {(a, b) for a in ORG for b in ORG if a < b}


def test_parts_of_names():
    assert parse("Natl. Lung Inst. Thotrikliche")["kinds"] == "institute lung national"
    assert parse("Skudestile, Robert")["name"] == "skudestile" and parse("Bob Skudestile")["given"] == "robert"
    assert not same_entity(parse("University of Abcdefg"), parse("Abcdefg Laboratories GmbH"))
    assert same_entity(parse("Abcdefg Oncology Group"), parse("The Abcdefg Co-operative Oncology Group"))


def test_very_long_and_odd_names(spark):
    assert len(clusters(spark, ["x" * 3000, "???", "Labs", "of the"])) == 4


def test_average_linkage_against_brute_force():
    import itertools
    import random

    rng = random.Random(2)
    for _ in range(10):
        ids = list(range(8))
        sim = {(a, b): round(rng.random(), 6) for a, b in itertools.combinations(ids, 2) if rng.random() < 0.6}
        got = average_linkage([(a, b, s) for (a, b), s in sim.items()], 0.3)
        groups = [{i} for i in {x for p in sim for x in p}]
        while True:
            avg = lambda g, h: sum(sim.get((min(a, b), max(a, b)), 0) for a in g for b in h) / (len(g) * len(h))
            best = max(((avg(g, h), i, j) for (i, g), (j, h) in itertools.combinations(enumerate(groups), 2)), default=(0, 0, 0))
            if best[0] < 0.3:
                break
            groups[best[1]] |= groups[best[2]]
            del groups[best[2]]
        assert {frozenset(g) for g in groups} == {frozenset(i for i in got if got[i] == r) for r in set(got.values())}


def test_linkage_over_tables_equals_that_in_one_task(spark, monkeypatch):
    import random

    import cohortloom.llm.variants as m

    rng = random.Random(7)
    edges = [(a, b, round(rng.random(), 9)) for a in range(14) for b in range(a + 1, 14) if rng.random() < 0.5]
    groups = lambda pairs: {frozenset(i for i, c in pairs if c == r) for r in {c for _, c in pairs}}
    want = groups(list(average_linkage(edges, 0.4).items()))
    got = m.linkage_rounds(spark.createDataFrame(edges, "a long, b long, sim double"), 0.4).collect()
    assert groups([(r.id, r.cluster) for r in got]) == want
    monkeypatch.setattr(m, "TASK_EDGES", 1)
    assert clusters(spark, ORG + PERSON) == sorted(map(sorted, [ORG, PERSON]))


def test_an_acronym_that_two_organisations_define_belongs_to_neither(spark):
    names = ["Alphazuri Labs (ABCDE)", "Betakomo Therapeutics (ABCDE)", "ABCDE"]
    assert clusters(spark, names) == sorted([n] for n in names)
