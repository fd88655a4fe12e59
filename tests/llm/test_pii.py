import hashlib
import re

from dqloom.llm.pii import KINDS, find_spans, op1

from tests.llm.conftest import ROWS

PLAIN = {
    "email": r"[A-Za-z0-9._%+-]+@[A-Za-z0-9-]+(\.[A-Za-z0-9-]+)+",
    "ip": r"[0-9]+(\.[0-9]+)(\.[0-9]+)(\.[0-9]+)",
    "card": r"[0-9]([\x20-]?[0-9])+",
    "phone": r"\+[0-9][\x20().0-9-]+[0-9]",
}


def luhn(d):
    return sum(int(x) if i % 2 == 0 else sum(divmod(2 * int(x), 10)) for i, x in enumerate(reversed(d))) % 10 == 0


def brute(text):
    out = []
    for no, (kind, p) in enumerate(PLAIN.items()):
        if kind == "email" and len(text) > 50000:  # the plain pattern takes too long here
            continue
        for m in re.finditer(p, text):
            d = re.sub("[^0-9]", "", m[0])
            ok = {"email": True, "ip": kind == "ip" and all(int(x) <= 255 for x in m[0].split(".")), "card": 12 <= len(d) <= 19 and luhn(d), "phone": 9 <= len(d) <= 15}[kind]
            if ok:
                out.append((m.start(), no, m.end()))
    return ",".join(f"{list(PLAIN)[no]}:{s}:{e}" for s, no, e in sorted(out))


def test_base_spans(spark, sf, sf_empty):
    for r in op1(spark, sf).collect():
        text = next(x[1] or "" for x in ROWS if x[0] == r.doc_id)
        want = brute(text)
        assert r.base_sha256 == hashlib.sha256(want.encode()).hexdigest(), (r, want)
        kinds = [x.split(":")[0] for x in want.split(",") if x]
        assert [r.n_email, r.n_ip, r.n_card, r.n_phone] == [kinds.count(k) for k in PLAIN]
        assert set(filter(None, want.split(","))) <= set(filter(None, r.spans.split(",")))
    assert op1(spark, sf_empty).count() == 0


def test_awkward_texts(spark):
    texts = [
        "a@b.c_d@e.f.g", "x@y x@y.z@w.v", ".@a.b", "1.2.3.4.5.6.7.8", "0001.02.3.255 1.2.3.256 1.2.3", "é 4539 1488 0343 6467é",
        "4539-1488-0343-6467 4539148803436467", "4539 1488 0343 6467 1", "4539  1488 0343 6467", "1 4539148803436467", "+1+1 (202) 555-0143) +", "+12", "+1234567890123456", "𝒳 +44 20 7946 0958",
        "a+1-202-555-0143@x.y", "--a@b.c--", "%@-.-", "a@b..c", "1.1.1.1@1.1.1.1",
    ]
    rows = spark.createDataFrame(list(enumerate(texts)), "doc_id long, text string")
    for r in find_spans(rows).collect():
        got = ",".join(f"{KINDS[x.no]}:{x.s}:{x.e}" for x in r.spans if x.no < 4)
        assert got == brute(texts[r.row.doc_id]), texts[r.row.doc_id]


def test_checksums_and_context_confirm_further_kinds(spark):
    texts = ["iban DE89 3704 0044 0532 0130 00", "iban DE89 3704 0044 0532 0130 01", "token = " + "0af1" * 10, "order " + "0af1" * 10, "ssn 078-05-1120", "part 078-05-1120"]
    rows = spark.createDataFrame(list(enumerate(texts)), "doc_id long, text string")
    got = {r.row.doc_id: [KINDS[x.no] for x in r.spans if x.no >= 4] for r in find_spans(rows).collect()}
    assert got == {0: ["iban"], 1: [], 2: ["secret"], 3: [], 4: ["ssn"], 5: []}


def test_very_many_matches_in_one_text(spark):
    """The offsets of 60,000 matches take seconds, not the square of their number."""
    import time

    text = " ".join(f"a{i}@b.c" for i in range(60_000))
    began = time.monotonic()
    spans = find_spans(spark.createDataFrame([(1, text)], "doc_id long, text string")).select("spans").first()[0]
    assert len(spans) == 60_000 and all(text[x.s : x.e] == f"a{i}@b.c" for i, x in enumerate(spans))
    assert time.monotonic() - began < 60
