import random

import pytest

from cohortloom.llm.canonical import Trie, allowed, key_of, match_values, reach, swaps

REF = [("quuskegliptin", "1", '["Quathixiq", "quuskegliptin citrate"]'), ("skegruhokinra", "2", '["Blithesiq", "ZK-5084"]'), ("brodobril", None, None), (None, "3", "[]"), ("statrodeciclib", "4", "broken")]


def run(spark, values, ref=REF):
    v = spark.createDataFrame([(x, 1) for x in values], "value string, VALUE2 int")
    out = match_values(v, spark.createDataFrame(ref, "canonical_name string, rxcui string, aliases string")).collect()
    got = {}
    for r in out:
        got.setdefault(r.entered_value, []).append(r.canonical_name)
    return {k: sorted(x) for k, x in got.items()}


def test_typed_forms(spark):
    cases = {
        "Drug: QUUSKEGLIPTIN 10 mg/mL": ["quuskegliptin"], "quathixiq™ tablets": ["quuskegliptin"], "Quathixiq (R) 5 % w/v": ["quuskegliptin"], "Quuske-gliptin cit. BID": ["quuskegliptin"], "quuske gliptin": ["quuskegliptin"],
        "zk5084": ["skegruhokinra"], "ZK_05084 IV": ["skegruhokinra"], "ZK‑5084": ["skegruhokinra"], "ZK-5085": [""], "skergruhokinra": ["skegruhokinra"], "Skégruhokinra": ["skegruhokinra"], "skegruhokinra (Blithesiq)": ["skegruhokinra"],
        "Placebo": [""], "Sham quuskegliptin": [""], "quuskegliptin-matched dummy": [""], "usual care": [""], "browamistat": [""], "Quuskegliptin + Blithesiq 5 mg": ["quuskegliptin", "skegruhokinra"],
        "brodobril/ZK-5084": ["brodobril", "skegruhokinra"], "quuskegliptin and placebo to brodobril": ["quuskegliptin"], '"Drug: brodobril"': ["brodobril"], "statrodeciclib": ["statrodeciclib"],
    }
    assert run(spark, cases) == cases


def test_blank_null_repeated_long_and_empty(spark):
    assert run(spark, [None, "", "  ", " "]) == {}
    assert run(spark, ["brodobril"] * 50) == {"brodobril": ["brodobril"]}
    assert run(spark, ["x" * 5000 + " brodobril " + "word " * 2000]) == {"x" * 5000 + " brodobril " + "word " * 2000: ["brodobril"]}
    assert run(spark, ["brodobril"], ref=[]) == {"brodobril": [""]}
    assert run(spark, []) == {}


def test_a_list_beyond_one_trie_is_searched_in_shards(spark, monkeypatch):
    import cohortloom.llm.canonical as m

    values = ["quuske gliptin", "skergruhokinra", "brodobril/ZK-5084", "placebo", "nothing of it", "Quathixiq"]
    whole = run(spark, values)
    monkeypatch.setattr(m, "MAX_ENTRIES", 2)
    monkeypatch.setattr(m, "WORDS_A_GROUP", 3)
    assert run(spark, values) == whole and whole["brodobril/ZK-5084"] == ["brodobril", "skegruhokinra"]


def test_names_in_many_pieces_long_names_and_shared_aliases(spark):
    long = "ab" * 40
    ref = [("alpha beta gamma delta", "1", "[]"), (long, "2", "[]"), ("brodobril", "3", '["Chasnuxa"]'), ("skegruhokinra", "4", '["Chasnuxa"]')]
    assert run(spark, ["alpha beta gamma delta", "al pha be ta gam ma del ta", long, long[:30] + " " + long[30:-1] + "x", "chasnuxa"], ref) == {
        "alpha beta gamma delta": ["alpha beta gamma delta"], "al pha be ta gam ma del ta": ["alpha beta gamma delta"], long: [long], long[:30] + " " + long[30:-1] + "x": [long], "chasnuxa": ["brodobril", "skegruhokinra"],
    }


def test_every_entry_within_the_distance(spark):
    v = spark.createDataFrame([("brodobrol",), ("nothing",)], "value string")
    ref = spark.createDataFrame([("brodobril", "[]"), ("brodobrel", "[]"), ("other", "[]")], "canonical_name string, aliases string")
    assert {(r.canonical_name, r.distance) for r in match_values(v, ref, every=True).collect()} == {("brodobril", 1), ("brodobrel", 1)}


def _distance(a, b):
    row = list(range(len(b) + 1))
    for i, x in enumerate(a, 1):
        row, prev = [i], row
        for j, y in enumerate(b, 1):
            row.append(min(prev[j] + 1, row[-1] + 1, prev[j - 1] + (x != y)))
    return row[-1]


def test_trie_finds_exactly_what_brute_force_finds():
    rng = random.Random(5)
    word = lambda n: "".join(rng.choice("abcd") for _ in range(n))
    entries = {word(rng.randint(1, 14)): ("p",) for _ in range(150)} | {"ab1234": ("code",), "abcd" * 17: ("long",)}
    words = sorted({word(rng.randint(1, 14)) for _ in range(300)} | {"ab1234", "ab1235", "abcd" * 17, "abcd" * 16 + "acd", "abcd" * 16})
    found = Trie(entries).search(words)
    for w in words:
        want = {(d, k) for k in entries if (d := _distance(w, k)) <= min(reach(w), allowed(k))}
        assert set(found[w]) == want, w
    assert swaps("abcd", "abdc") == 1 and key_of("zk-05084") == "zk5084" and key_of("quuske gliptin") == "quuskegliptin"
