import random

from hypothesis import given, settings
from hypothesis import strategies as st

from inkwell.llm import personal as P

GIVEN = ["Alma", "Bruno", "Celia", "Dario", "Elena"]
LAST = ["Vorlund", "Keshart", "Tambrow", "Oldervik", "Pelmont", "Grivens"]
PLACES = ["Dunvale", "Northam", "Kelwick"]
HAN = ["笪", "阚"]


def corpus(rng, n=400):
    rows, want = [], set()
    for k in range(n):
        lines = []
        for _ in range(rng.randint(1, 4)):
            name = f"{rng.choice(GIVEN)} {rng.choice(LAST)}"
            kind = rng.randint(0, 9)
            no = len(lines) + 1
            if kind == 0:
                lines.append(f"{name}, {name.split()[0].lower()}{rng.randint(1, 99)}@{rng.choice(PLACES).lower()}.example, +44 20 7946 0{rng.randint(100, 999)}")
                want |= {(k, no, t) for t in ("person_name", "email", "phone")}
            elif kind == 1:
                lines.append(f"Questions go to {name}, who led the visits.")
                want.add((k, no, "person_name"))
            elif kind == 2:
                lines.append(f"The draft was prepared by {rng.choice(LAST).upper()}, {name.split()[0]} and circulated in spring.")
                want.add((k, no, "person_name"))
            elif kind == 3:
                lines.append(f"Verified against SSN 9{rng.randint(10, 99)}-{rng.randint(10, 99)}-{rng.randint(1000, 9999)} at the counter.")
                want.add((k, no, "identity_number"))
            elif kind == 4:
                lines.append(f"Postal address: {rng.randint(1, 99)} {rng.choice(PLACES)} Road, {rng.choice(PLACES)} 00123")
                want.add((k, no, "street_address"))
            elif kind == 5:
                lines.append(f"Tel.: 0{rng.randint(20, 99)} 7946 0{rng.randint(100, 999)}")
                want.add((k, no, "phone"))
            elif kind == 6:
                lines.append(f"联系人：{rng.choice(HAN)}{rng.choice('梧岚溪')}{rng.choice('芷砚澜')}。2013年，溪朔关镇发布了规范。")
                want.add((k, no, "person_name"))
            elif kind == 7:
                lines.append(f"{rng.choice(HAN)}{rng.choice('梧岚溪')}{rng.choice('芷砚澜')} (a{rng.randint(1, 9)}@x{rng.randint(1, 9)}.example)")
                want |= {(k, no, "person_name"), (k, no, "email")}
            else:
                lines.append(f"The council of {rng.choice(PLACES)} reviewed {rng.randint(1, 9)} 270 712 units @ 4.50 each, catalogue 978-0-00-{rng.randint(100000, 999999)}-1, in East {rng.choice(PLACES)}.")
        rows.append((k, "\n".join(lines)))
    return rows, want


def test_found_and_redacted(spark):
    rows, want = corpus(random.Random(1))
    extra = [(9001, None), (9002, ""), (9003, " \n "), (9004, "word " * 30_000), (9005, "Deliver copies to P.O.\nBox 521, Dunvale.")]
    docs = spark.createDataFrame([(k, t, "c", 1) for k, t in rows + extra], "doc_id long, text string, kind string, n int").repartition(3)
    got = {tuple(r) for r in P.found(docs).collect()}
    want |= {(9005, 1, "street_address")}
    assert len(got & want) / len(want) > 0.98 and len(got & want) / len(got) > 0.98
    out = {r.doc_id: r for r in P.redacted(docs).collect()}
    assert out[9001].text is None and out[9002].text == "" and out[9004].text == "word " * 30_000
    for k, t in rows:
        assert "@" not in out[k].text.replace("@ 4.50", "") and out[k].text.count("\n") == t.count("\n")


def test_bootstrapping_finds_unseen_names(spark):
    rows, _ = corpus(random.Random(2))
    docs = spark.createDataFrame(rows + [(5000, "Questions go to Zelmira Quonn, who led the visits.")], "doc_id long, text string")
    assert (5000, 1, "person_name") in {tuple(r) for r in P.found(docs).collect()}


def test_names_in_addresses_and_places_are_no_case(spark):
    rows, _ = corpus(random.Random(3))
    docs = spark.createDataFrame(rows + [(5000, "The council of East Dunvale met near Upper Northam. Write to alma.vorlund@kelwick.example today.")], "doc_id long, text string")
    assert {r[2] for r in P.found(docs).collect() if r[0] == 5000} == {"email"}


def test_empty(spark):
    docs = spark.createDataFrame([], "doc_id long, text string")
    assert P.found(docs).count() == 0 and P.redacted(docs).count() == 0


GAP = st.sampled_from(["", "", " ", "\n", "\n\n", " or "])


@settings(max_examples=1000, deadline=None)
@given(st.lists(st.tuples(st.sampled_from(["anna", "mailto:x.y", "é", "."]), GAP, st.sampled_from(["@", "(at)", "[AT]"]), GAP, st.sampled_from(["example", "a.b", "-"]), GAP, st.sampled_from([".", "[dot]", "(dot)"]), GAP, st.sampled_from(["org", "co.uk", "1"]), GAP), max_size=4))
def test_addresses_equal_a_search_of_the_whole_text(parts):
    text = "".join("".join(p) for p in parts)
    assert P.Finder.mails(text) == [m.span() for m in P.EMAIL.finditer(text)]


def test_a_wrapped_address_counts_for_its_first_line(spark):
    wrapped = ["anna@example\n.org", "anna@example.\norg", "anna\n@example.org", "anna@\nexample.org", "x@example.com or anna\n@example.\nco.\norg"]
    docs = spark.createDataFrame([(k, f"First.\nWrite to {t} soon.") for k, t in enumerate(wrapped)], "doc_id long, text string")
    assert {tuple(r) for r in P.found(docs).collect() if r.pii_type == "email"} == {(k, 2, "email") for k in range(len(wrapped))}
    assert all("anna" not in r.text and "example" not in r.text for r in P.redacted(docs).collect())


def test_rounds_learn_number_contexts_no_seed_stood_in(spark):
    """Kennziffer is no seed word: its context is learned from the shapes it shares with seeded numbers, and then finds a
    number of another shape."""
    rng = random.Random(5)
    no = lambda: f"{rng.randint(10, 99)}-{rng.randint(10000, 99999)}-{rng.choice('XYZ')}"
    rows = [(k, f"The clerk checked DNI {no()} at the counter.") for k in range(12)]
    rows += [(100 + k, f"Er nannte die Kennziffer {no()} am Schalter.") for k in range(12)]
    rows += [(200, "Er nannte die Kennziffer 4711 2233 90 am Schalter."), (201, "Der Bestand umfasst 4711 2233 90 Posten.")]
    df = spark.createDataFrame(rows, "doc_id long, text string")
    got = {r.doc_id for r in P.found(df).collect() if r.pii_type == "identity_number"}
    assert got == set(range(12)) | set(range(100, 112)) | {200}


def test_without_rounds_those_contexts_are_unknown(spark, monkeypatch):
    rows = [(k, f"The clerk checked DNI {10 + k}-{23456 + k}-X at the counter.") for k in range(12)] + [(100 + k, f"Er nannte die Kennziffer {30 + k}-{83456 + k}-Y am Schalter.") for k in range(12)]
    df = spark.createDataFrame(rows, "doc_id long, text string")
    monkeypatch.setattr(P, "ROUNDS", 1)
    assert {r.doc_id for r in P.found(df).collect()} == set(range(12))
