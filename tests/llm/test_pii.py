import hashlib
import re

from hypothesis import given, settings
from hypothesis import strategies as st

from clickscope.llm import pii as P

from .conftest import SF_MID

EMAIL = r"[A-Za-z0-9._%+-]+@[A-Za-z0-9-]+(\.[A-Za-z0-9-]+)+"
IP = r"[0-9]+(\.[0-9]+)(\.[0-9]+)(\.[0-9]+)"
CARD = r"[0-9]([\x20-]?[0-9])+"
PHONE = r"\+[0-9][\x20().0-9-]+[0-9]"


def brute(text):
    def luhn(d):
        odd, even = d[::-1][::2], d[::-1][1::2]
        return (sum(map(int, odd)) + sum(sum(divmod(2 * int(x), 10)) for x in even)) % 10 == 0

    def count(s):
        return re.sub("[^0-9]", "", s)
    out = {"email": [m.span() for m in re.finditer(EMAIL, text)]}
    out["ip"] = [m.span() for m in re.finditer(IP, text) if all(int(x) <= 255 for x in m.group().split("."))]
    out["card"] = [m.span() for m in re.finditer(CARD, text)
                   if 16 <= len(count(m.group())) <= 19 and luhn(count(m.group()))]
    out["phone"] = [m.span() for m in re.finditer(PHONE, text) if 8 <= len(count(m.group())) <= 15]
    return out


@settings(max_examples=600, deadline=None)
@given(st.text(st.sampled_from("a.Z@-0123456789+() é%_1145"), max_size=60))
def test_base_rules_equal_the_patterns(text):
    assert P.base_spans(text) == brute(text)


@settings(max_examples=200, deadline=None)
@given(st.lists(st.sampled_from(["a@b.c", "1.2.3.4", "4111111111111111", "4111 1111-1111 1111", "+1 (222) 333-4444",
                                 ".", " ", "5", "+", "@", "x", "256.1.1.1", "00012.0.0.9.1", "mail "]), max_size=14))
def test_base_rules_on_joined_parts(parts):
    assert P.base_spans("".join(parts)) == brute("".join(parts))


def test_table(spark):
    rows = {r.doc_id: r for r in P.op5_personal_data(spark, SF_MID).collect()}
    for d in spark.read.parquet(f"{SF_MID}/documents.parquet").collect():
        r, want = rows[d.doc_id], brute(d.text or "")
        joined = ",".join(f"{k}:{a}:{b}" for k in P.KINDS for a, b in want[k])
        assert (r.n_email, r.n_ip, r.n_card, r.n_phone) == tuple(len(want[k]) for k in P.KINDS)
        assert r.base_sha256 == hashlib.sha256(joined.encode()).hexdigest()
        assert set(filter(None, joined.split(","))) <= set(r.spans.split(","))
        spans = [s.split(":") for s in filter(None, r.spans.split(","))]
        assert spans == sorted(spans, key=lambda s: (P.KINDS.index(s[0]), int(s[1]), int(s[2])))


def test_trees_add_what_looks_like_the_rules_spans(spark, make_docs):
    rows = []
    for i in range(300):
        rows.append((i, f"call me on +1 (202) 555-{1000 + i} today or write to user{i}@mail.example.com please, "
                        f"release {i}.2.{i % 7} was built from commit {i * 7919 % 9973}{i * 104729 % 99991} here"))
    trees, cuts = P.fit(make_docs(rows))
    base, spans = P.find(rows[5][1], trees, cuts)
    assert [k for k, _, _ in spans] == ["email", "phone"]
    good = P.features("call me on +1 (202) 555-1234 now", "phone", 11, 28)
    bad = P.features("commit 791910472 here", "phone", 7, 16)
    assert trees.score(good) > 0.8 > 0.2 > trees.score(bad)
    assert P.redacted(rows[5][1], spans).startswith("call me on [phone] today or write to [email] please")


def card(i):
    """A number of 16 digits that passes the checksum, in groups of four."""
    body = f"4111{i * 7919 % 10**6:06d}{i:05d}"
    last = next(d for d in "0123456789" if P.luhn(body + d))
    return " ".join((body + last)[j:j + 4] for j in range(0, 16, 4))


def test_odd_spellings_are_found_and_clean_text_is_left(make_docs):
    rows = [(i, f"please call me on +44 20 {i:04d} {7000 + i} today or write to user{i}@mail.example.com now, my card "
                f"{card(i)} is on host 10.{i % 250}.3.4 as ever; order {i * 7919 + 100000}, built {i}.2.{i % 7} from commit "
                f"{i * 7919 % 9973}{i * 104729 % 99991}77 and part {1000 + i}-{i * 31:05d}-{i:05d} at 12:30:45:{i % 60:02d}")
            for i in range(400)]
    trees, cuts = P.fit(make_docs(rows))
    odd = {"email": "write to bob [at] example [dot] com today", "card": "my card 4111.1111.1111.1111 is on host",
           "phone": "please call me on 0044 20 7946 0958 today", "ip": "is on host 10[.]20[.]30[.]40 as ever"}
    for kind, text in odd.items():
        base, spans = P.find(text, trees, cuts)
        assert not any(base.values()) and [k for k, _, _ in spans] == [kind], (kind, spans, cuts)
    assert P.redacted(odd["email"], P.find(odd["email"], trees, cuts)[1]) == "write to [email] today"
    for text in ("order 7919123, built 3.2.1 from commit 79191047299 here", "part 1000-00310-00010 of the series",
                 "at 12:30:45:59 we met", "look at the dot com boom", "version 300.1.2.999 of it"):
        assert P.find(text, trees, cuts)[1] == [], text


def test_checks_do_not_ask_the_base_rules():
    def verdict(kind, span, head=""):
        return P.judged(head + span + " x", kind, len(head), len(head) + len(span))
    assert verdict("email", "a.b [at] c [dot] org") and verdict("email", "a at b dot org")
    assert not verdict("email", "look at b.org")
    assert verdict("card", "4111/1111/1111/1111") and not verdict("card", "4111/1111/1111/1112")
    assert verdict("phone", "0044 20 7946 0958") and verdict("phone", "020 7946 0958", "call ")
    assert verdict("phone", "020 7946 0958") is None and verdict("phone", "02079460958") is False
    assert verdict("ip", "1[.]2[.]3[.]4") and verdict("ip", "fe80::1:2:a") and not verdict("ip", "12:30:45:10")


def test_sample_does_not_depend_on_the_order(make_docs, monkeypatch):
    monkeypatch.setattr(P, "TRAIN_CANDIDATES", 40)
    rows = [(i, f"call +44 20 {i:04d} {7000 + i} or {i * 7919 + 10**9}") for i in range(60)]
    one, two = (sorted(map(str, P.training_candidates(make_docs(r).repartition(n)).collect()))
                for r, n in ((rows, 1), (rows[::-1], 5)))
    assert len(one) == 40 and one == two


def test_all_documents_teach(make_docs):
    rows = [(i, f"write to user{i}@mail.example.com or call +44 20 {i % 90:04d} 7000 today") for i in range(20_500)]
    found = P.training_rows(make_docs(rows).repartition(8))
    want = sum(len(list(P.lessons(text))) for _, text in rows[:500]) * 41  # each text has as many
    assert found.agg({"n": "sum"}).first()[0] == want
    assert found.count() < 2000  # equal lessons are one row


def test_cut_by_all_held_out_rows(spark):
    class Same:
        def score(self, x):
            return x[0]
    kind = "kind string, x array<double>, label double, n long"
    rows = [("ip", [0.9], 1.0, 60_000), ("ip", [0.8], 1.0, 10), ("ip", [0.8], None, 10), ("ip", [0.7], 0.0, 700),
            ("ip", [0.6], 1.0, 9), ("card", [0.9], 1.0, 19), ("phone", [0.5], 1.0, 50), ("phone", [0.6], 0.0, 50)]
    assert P.calibrated(spark.createDataFrame(rows, kind), Same()) == {"ip": 0.8}


def test_odd_rows(make_docs):
    rows = [(1, None), (2, ""), (None, "x a@b.co"), (3, "a@b.co"), (3, "a@b.co"), (4, "9" * 50000), (5, "a" * 50000 + "@"),
            (6, "+1" + "(" * 50000), (7, "1." * 20000), (8, "a@b." * 10000), (9, ":" * 9 + "a:" * 20000)]
    docs = make_docs(rows).selectExpr("*", "1 as spans", "2 as n_email")
    got = sorted(((r.doc_id, r.n_email) for r in P.personal_data(docs).collect()), key=str)
    assert got == sorted([(i, len(brute(t or "")["email"])) for i, t in rows if i not in (5,)] + [(5, 0)], key=str)
    assert P.personal_data(make_docs([])).count() == 0
