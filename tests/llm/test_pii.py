"""Personal data: base spans against plain searches, the method's own spans, odd texts."""

import hashlib
import re

import pytest

from hirelake.llm.pii import KINDS, MORE_KINDS, PiiPlan, candidates, find, fit, meets_base

PLAIN = {
    "email": r"[A-Za-z0-9._%+-]+@[A-Za-z0-9-]+(\.[A-Za-z0-9-]+)+", "ip": r"[0-9]+(\.[0-9]+)(\.[0-9]+)(\.[0-9]+)",
    "card": r"[0-9]([\x20-]?[0-9])+", "phone": r"\+[0-9][\x20().0-9-]+[0-9]",
}


def valid(kind, m):
    d = re.sub("[^0-9]", "", m)
    if kind == "ip":
        return all(int(x) <= 255 for x in m.split("."))
    if kind == "card":
        s = sum((x if i % 2 == 0 else x * 2 - 9 * (x > 4)) for i, x in enumerate(map(int, reversed(d))))
        return 12 <= len(d) <= 19 and s % 10 == 0
    return 9 <= len(d) <= 15 if kind == "phone" else True


def brute(text):
    out = []
    for k, kind in enumerate(KINDS):
        for m in re.finditer(PLAIN[kind], text or ""):
            if valid(kind, m.group()):
                out.append((m.start(), k, m.end()))
    return [f"{KINDS[k]}:{a}:{b}" for a, k, b in sorted(out)]


ODD = [
    "", None, "mail a@b.com_x@y.org.z@q.de, a..b@c-d.e.f g@h i@.j @k.l", "ip 1.2.3.4 1.2.3.4.5.6.7.8 999.1.1.1 0255.0.00.1 1.2.3 256.1.1.1 1..2.3.4",
    "card 4111 1111 1111 1111, 4111-1111-1111-1111-; 4111  1111 79927398713 378282246310005 5 12", "call +1 (425) 555-0199 or +49 30 1234567 +1 2 +123456789012345678 ++44 20 7946 0958.",
    "😀 é 4111111111111111 ñ +33 1 23 45 67 89 😀a@b.co", "12a34a" * 800, "7" * 30_000, "1.2.3.4 " * 800, "+1" + " " * 5000, "ab" * 60_000 + "@", "a@" * 4000,
    "+1 (425) 555-0199 4111 1111 1111 1111 10.0.0.1 bob [at] example.com and (212) 555-0187", "\n4111\n1111\n", "1-2 3-4 5-6 7-8 9-0 1-2",
]


@pytest.fixture(scope="module")
def docs(spark):
    base = ["Her mail is kim.lee@example.org today", "call me at +1 (206) 555-01%02d please", "card 4111 1111 1111 1111 was used", "the server 203.0.113.%d answered",
            "token = 0641917ea4e9feb9cda83477b57ac2654884f485", "or phone (206) 555-01%02d after six", "write to jo [at] example.com soon", "version 4.999.3.%d is out", "id 4111 1111 1111 1112"]
    rows = [(i, (base[i % len(base)] % (i % 90) if "%" in base[i % len(base)] else base[i % len(base)]), "x", "y") for i in range(270)]
    rows += [(1000 + i, t, "x", "y") for i, t in enumerate(ODD)] + [(None, "a@b.cd", "", ""), (3, "again a@b.cd", "", "")]
    return spark.createDataFrame(rows, "doc_id long, text string, spans string, n_ip string")


def test_base_spans_equal_plain_searches(docs):
    got = find(docs).collect()
    texts = {}
    for r in docs.collect():
        texts.setdefault(r.doc_id, []).append(brute(r.text))
    assert len(got) == docs.count()
    for r in got:
        want = [w for w in texts[r.doc_id] if hashlib.sha256(",".join(w).encode()).hexdigest() == r.base_sha256]
        assert want, (r.doc_id, r.spans[:200])
        spans = r.spans.split(",") if r.spans else []
        assert set(want[0]) <= set(spans) and len(spans) == len(want[0]) + r.n_added
        assert [r[f"n_{k}"] for k in KINDS] == [sum(s.startswith(k + ":") for s in want[0]) for k in KINDS]


def test_method_adds_loose_forms_and_learns_reliabilities(docs):
    out = {r.doc_id: r for r in find(docs).collect()}
    assert out[5].spans and out[5].n_added == 1 and out[5].n_phone == 0
    assert out[4].spans == "secret:8:48" and out[4].n_secret == 1 and out[4].n_card == 0 and out[7].n_ip == 0
    model = fit(candidates(docs), PiiPlan())
    assert set(model.reliability) <= set(KINDS + MORE_KINDS) and all(0 < y < 1 and 0 < n < 1 for k in model.reliability.values() for y, n in k)
    yes, no = model.reliability["card"][0]
    assert yes > no


def test_empty_and_native(spark, docs):
    assert find(docs.limit(0)).collect() == []
    df = candidates(docs)
    assert "Python" not in df._jdf.queryExecution().toString() and "Arrow" not in df._jdf.queryExecution().toString()
    assert meets_base is not None


def test_loose_email_with_a_plain_dot_is_a_candidate(spark):
    df = spark.createDataFrame([(1, "write to jane at example.com today")], "doc_id long, text string")
    assert [x.kind for r in candidates(df).collect() for x in r.c] == ["email"]


def test_the_model_not_the_pattern_decides_on_secrets(spark):
    import random

    rng = random.Random(5)
    word = lambda n: "".join(rng.choice("0123456789abcdef") for _ in range(n))
    kinds = [
        (True, lambda: f'api_key = "{word(40)}" is set'), (True, lambda: f"password: {word(32)}"), (True, lambda: f'TOKEN="{word(48)}"'),
        (False, lambda: f"see commit {word(40)} for it"), (False, lambda: f"sha256 {word(64)} of the file"), (False, lambda: f"the page chapter-{rng.randrange(10**4, 10**5)}-of-the-book here"),
        (False, lambda: f"id {word(8)}-{word(4)}-{word(4)}-{word(4)}-{word(12)} there"),
    ]
    rows = [(i, kinds[i % len(kinds)][1]()) for i in range(350)]
    docs = spark.createDataFrame(rows, "doc_id long, text string")
    assert sum(x.kind == "secret" for r in candidates(docs).collect() for x in r.c) > 250  # both sides are candidates
    got = {r.doc_id: r.n_secret for r in find(docs).collect()}
    assert all((got[i] == 1) == kinds[i % len(kinds)][0] for i in got), {i % len(kinds) for i in got if (got[i] == 1) != kinds[i % len(kinds)][0]}


def test_long_runs_and_ends_of_secrets(spark):
    rows = [(1, "a1" * 100_000), (2, "x" * 100_000), (3, "\U0001f600 token=" + "ab12" * 10), (4, "-" * 50_000), (5, None)]
    docs = spark.createDataFrame(rows, "doc_id long, text string")
    spans = {r.doc_id: [(x.kind, x.start, x.end) for x in r.c if x.kind == "secret"] for r in candidates(docs).collect()}
    assert spans == {1: [("secret", 0, 200_000)], 2: [], 3: [("secret", 8, 48)], 4: [], 5: []}
