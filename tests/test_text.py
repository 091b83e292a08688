"""Normalization and similarity on cases written out by hand, and ratios against plain loops."""

import random

from pyspark.sql import functions as F

from tessera.functions import similarity as S
from tessera.functions import text as X
from tessera.operators import aliases as A
from tessera.operators import features
from tessera.operators import records as R

SCHEMA = "entity_id string, business_name string, business_address string, country string"
ALIASES = [("state", "US", "az", "arizona", 2634), ("state", "India", "తెలంగాణ", "telangana", 900), ("city", "US", "phx", "phoenix", 5), ("state", "_generic", "be", "berlin", 3)]


def aliases(spark):
    return spark.createDataFrame(ALIASES, A.SCHEMA)


def several(spark, rows, names=None):
    return R.normalized(spark.createDataFrame([(f"S1-{i}", *r) for i, r in enumerate(rows)], SCHEMA), names)


def test_records(spark):
    rows = {
        "typo": ("5LV Marketing Private", "", "India"), "legal": ("SLV Private Marketing (Limited)", "", "India"), "accents": ("SLV Marketing Prívate Límited", "", "India"),
        "order1": ("Prospect Limited Private Brothers", "", "India"), "order2": ("Prospect Brothers Private Limited", "", "India"),
        "inc": ("Vaughn Tailwind Inc", "", "US"), "domain": ("vaughntailwind.com", "", "US"), "uk": ("bar.co.uk", "", "US"),
        "rue": ("Ets Test SAS", "63 R. DE DIEPPE, LILLE", "France"), "number": ("Azaé Transports SA", "N°237 R. DES BOIS BLANCS", "France"),
        "zeros": ("Test Co", "001122 MARSHALL ST", "US"), "plain": ("Test Co", "1122 Marshall Street", "US"),
        "dashes": ("Anand Food Private Limited", "18 2 279, Jangammet, Hyderabad, Telangana", "India"), "dashes2": ("Anand Food Pirvre Limited", "Hyderabad, No G-18 2 279, Hyderabad, TG, Jangammet", "India"),
        "telugu": ("ఆనంద్ ఫుడ్ ప్రైవేట్ లిమిటెడ్", "", "India"), "unseen": ("Schmidt GmbH", "12 Hauptstrasse, Berlin", "Germany"), "joiner": ("अच‌ल", "", "India"),
        "state": ("Some Co", "100 Main St, PHX, AZ", "US"), "script": ("Some Co", "100 MG Road, Hyderabad, తెలంగాణ", "India"), "generic": ("x", "1 y, BE", "Germany"), "own": ("x", "1 y, BE", "US"),
        "gaps": ("Some Co", "a, NULL, N/A, nil, -, b", "US"), "null": (None, None, "US"), "nocountry": ("Foo plc", "5 x", None), "wide": ("ＡＣＭＥ ﬁne Ｉｎｃ", "1 a，b, c", "US"),
        "india": ("Acme Inc", "nr market, opp temple, Fl 2", "India"), "france": ("Acme Corp SARL", "5 bd x, all y", "France"), "case": ("Acme Pvt Ltd", "", "india"),
    }
    got = dict(zip(rows, sorted(several(spark, rows.values(), aliases(spark)).collect(), key=lambda r: int(r.entity_id[3:])), strict=True))
    cores = {"typo": "5lv marketing", "legal": "slv marketing", "accents": "slv marketing", "uk": "bar", "india": "acme", "france": "acme", "nocountry": "foo", "wide": "acme fine", "case": "acme pvt", "null": "", "unseen": "schmidt gmbh"}
    assert {k: got[k].name_core for k in cores} == cores
    assert S.indel(got["typo"].name_core, got["legal"].name_core) >= 0.9
    assert got["order1"].name_sorted == got["order2"].name_sorted == "brothers prospect" and got["order1"].legal_form == "pvt_ltd" and got["legal"].legal_form == "pvt_ltd"
    assert got["inc"].name_compact == got["domain"].name_compact == "vaughntailwind" and got["domain"].is_domain and not got["inc"].is_domain
    assert got["rue"].addr_norm == "63 rue de dieppe lille" and got["number"].addr_numbers == ["237"] and got["zeros"].addr_numbers == got["plain"].addr_numbers == ["1122"]
    assert set(got["dashes"].addr_numbers) & set(got["dashes2"].addr_numbers)
    t = got["telugu"]
    assert (t.legal_form, t.script, t.name_translit) == ("pvt_ltd", "telugu", "anand fud") and t.name_norm.startswith("ఆనంద్") and S.indel(t.name_translit, "anand food") >= 0.8
    assert got["joiner"].name_norm == "अचल"
    assert [got[k].state_canon for k in ("state", "script", "generic", "own")] == ["arizona", "telangana", "berlin", "be"]
    assert (got["state"].city_canon, got["state"].city_count) == ("phoenix", 5)
    assert got["gaps"].addr_components == ["a", "nil", "b"] and got["gaps"].addr_norm == "a null n a nil b"
    assert got["null"].addr_components == [] and got["null"].state_canon == "" == got["null"].city_canon and got["null"].script == "other"
    assert got["wide"].addr_components == ["1 a b", "c"]
    assert got["india"].addr_components == ["near market", "opposite temple", "fl 2"] and got["france"].addr_components == ["5 boulevard x", "allee y"]


def test_readings_of_indic_names(spark):
    assert X.read_indic("आनंद") == "anand" and X.read_indic("शर्मा फल") == "sarma fal" and X.read_indic("ఆనంద్ ఫుడ్") == "anand fud"
    assert X.read_indic("") == "" and X.read_indic("क १२") == "k 12" and X.read_indic("അവൻ") == "avan" and X.read_indic("എൽ") == "el"
    cases = {"": "other", "12 -": "other", "abc": "latin", "Привет": "latin", "आनंद foo": "devanagari", "आन foo": "latin", "आन fo": "devanagari", "ఆనంద్": "telugu", "అ आ": "telugu", "ක": "latin"}
    assert {k: X.script_of(k) for k in cases} == cases


def test_postcodes(spark):
    cases = [
        ("12 MG Road, Pune 411 001", "India", "411001"), ("Pune 411001", "India", "411001"), ("No 0123456", "India", None), ("1234567", "India", None),
        ("1 Main St, Reno, NV 89501-1234", "US", "89501"), ("12345 Main St", "US", None), ("1 Main St, 12345, US", "US", "12345"),
        ("5 rue X, 75001 Paris", "France", "75001"), ("12345 rue de Lille, Paris", "France", None), ("75001", "Germany", None), (None, "US", None), ("", "France", None),
    ]
    d = spark.createDataFrame([(i, a, c) for i, (a, c, _) in enumerate(cases)], "i int, a string, c string")
    got = {r.i: r.p for r in d.select("i", X.postcode(F.col("a"), F.col("c")).alias("p")).collect()}
    assert [got[i] for i in range(len(cases))] == [x for _, _, x in cases]


def lcs(a, b):
    t = [[0] * (len(b) + 1) for _ in range(len(a) + 1)]
    for i, x in enumerate(a):
        for j, y in enumerate(b):
            t[i + 1][j + 1] = t[i][j] + 1 if x == y else max(t[i][j + 1], t[i + 1][j])
    return t[-1][-1]


def ratio(a, b):
    return 2 * lcs(a, b) / (len(a) + len(b)) if a or b else 1.0


def plain_partial(a, b):
    def best(s, t):
        return max(ratio(s, w) for i in range(1 - len(s), len(t)) if (w := t[max(0, i) : i + len(s)]))

    if not a or not b:
        return 0.0
    s, t = sorted((a, b), key=len)
    return max(best(s, t), best(t, s)) if len(s) == len(t) else best(s, t)


def test_ratios():
    rng = random.Random(4)
    for _ in range(400):
        a, b = ("".join(rng.choices("abcd ", k=rng.randint(0, 11))) for _ in range(2))
        assert S.lcs(a, b) == lcs(a, b) and abs(S.indel(a, b) - ratio(a, b)) < 1e-12
        assert abs(S.partial(a, b) - plain_partial(a, b)) < 1e-12, (a, b)
    assert round(S.indel("5lv marketing", "slv marketing"), 3) == 0.923
    assert S.indel("", "") == 1.0 and S.indel("", "a") == 0.0 and S.partial("", "") == 0.0 and S.token_set("a b", "b a c") == 1.0 and S.token_sort("", "a") == 0.0


def test_features_by_brute_force(spark):
    """All 21 columns of every pair of some records, against plain Python."""
    rows = [
        ("Sun Light Foods Inc", "12 Main St, PHX, AZ", "US"), ("Foods SunLight", "12 main street, Phoenix, Arizona", "US"), ("", "", "US"), ("आनंद फूड", "MG Road", "India"), ("Anand Food Pvt Ltd", "", "India"),
        ("Light Foods Sun", "7 a, b", "us"), ("sunlight.com", "0012 x, Phoenix, AZ", "US"),
    ]
    n = several(spark, rows, aliases(spark))
    r = {x.entity_id: x for x in n.collect()}
    pairs = spark.createDataFrame([(a, b) for a in r for b in r if a < b], "s1_id string, target_id string")
    sim = lambda x, y: 1.0 if not x and not y else 0.0 if not x or not y else ratio(x, y)
    same = lambda x, y: int(bool(x) and x == y)
    some = lambda f, x, y: f(x, y) if x and y else 0.0

    def city(x):
        if len(x.addr_components) >= 2 and (len(x.addr_components[-2]) < 3 or (x.city_count is not None and x.city_count < 20)):
            return ""
        return x.city_canon

    got = features.features(pairs, n)
    assert got.columns == ["s1_id", "target_id", *features.FEATURES, "name_jaccard"] and len(features.FEATURES) == 21
    for g in got.collect():
        a, b = r[g.s1_id], r[g.target_id]
        best = sim(a.name_core, b.name_core)
        if a.script != "latin" or b.script != "latin":
            best = max(best, sim(a.name_translit, b.name_translit))
        ca, cb = set(a.addr_components), set(b.addr_components)
        want = {
            "name_core_exact": same(a.name_core, b.name_core), "name_core_ratio": sim(a.name_core, b.name_core), "name_core_partial": some(plain_partial, a.name_core, b.name_core),
            "name_core_token_set": some(S.token_set, a.name_core, b.name_core), "name_core_token_sort": some(lambda x, y: ratio(" ".join(sorted(x.split())), " ".join(sorted(y.split()))), a.name_core, b.name_core),
            "name_sorted_ratio": sim(a.name_sorted, b.name_sorted), "name_compact_exact": same(a.name_compact, b.name_compact), "name_compact_ratio": sim(a.name_compact, b.name_compact), "name_best_ratio": best,
            "address_exact": same(a.addr_norm, b.addr_norm), "address_ratio": sim(a.addr_norm, b.addr_norm), "address_partial": some(plain_partial, a.addr_norm, b.addr_norm),
            "address_component_jaccard": len(ca & cb) / len(ca | cb) if ca | cb else 0.0, "addr_number_overlap": len(set(a.addr_numbers) & set(b.addr_numbers)),
            "state_match": same(a.state_canon, b.state_canon), "city_match": same(city(a), city(b)), "legal_form_match": same(a.legal_form, b.legal_form), "country_match": int(a.country.strip().lower() == b.country.strip().lower()),
            "name_len_diff": abs(len(a.name_core) - len(b.name_core)), "address_len_diff": abs(len(a.addr_norm) - len(b.addr_norm)),
            "combined_ratio": sim(f"{a.name_core} {a.addr_norm}".strip(), f"{b.name_core} {b.addr_norm}".strip()),
        }
        assert {k: round(g[k], 9) for k in want} == {k: round(v, 9) for k, v in want.items()}


def test_ratios_of_many_pairs():
    """All at once as one by one: short, long and empty strings, characters beyond 16 bits, few and many of a size."""
    rng = random.Random(4)
    text = lambda n: "".join(rng.choices("ab cdé अ𝒳 12", k=rng.randint(0, n)))
    pairs = []
    for n, times in ((3, 60), (12, 200), (64, 60), (70, 40), (150, 30), (400, 3)):
        for _ in range(times):
            a = text(n)
            pairs.append((a, rng.choice([text(n), a, a[: len(a) // 2] + text(4), text(n // 3), "".join(rng.sample(a, len(a)))])))
    for one, many in S._MANY.items():
        assert many(pairs).tolist() == [one(a, b) for a, b in pairs]
    assert many([]).tolist() == []


def test_ratios_of_a_batch_take_no_loop_a_pair(monkeypatch):
    import pandas as pd

    monkeypatch.setattr(S, "lcs", None)  # the plain ratios' loop
    name = lambda s: pd.Series([f"{s} {i:03} road" for i in range(60)])
    got = S.ratios.func(*[name(s) for _ in range(6) for s in ("alpha", "omega")])
    assert len(got) == 60 and got["address_ratio"].between(0.5, 0.9).all()


def test_token_sets_compare_only_the_rests(monkeypatch):
    """the common tokens are in both sides, so a pair is one comparison of what is left."""
    asked = []
    monkeypatch.setattr(S, "indels", lambda pairs, old=S.indels: asked.extend(pairs) or old(pairs))
    pairs = [("anand barela foods", "anand fadaro motors"), ("a b", "c d"), ("x y z", "z y w w"), ("a b", "a b c"), ("", "a")]
    got = S.token_sets(pairs)
    assert asked == [("barela foods", "fadaro motors"), ("a b", "c d"), ("x", "w")] and got.tolist() == [S.token_set(*p) for p in pairs]
