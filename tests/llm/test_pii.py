"""Personal data: base spans against Python's patterns, disclosing terms
against a count by hand, sanitised texts against their spans."""

import hashlib
import math
import random
import re
from collections import Counter

from hypothesis import given, settings
from hypothesis import strategies as st
from llm.conftest import SF, clashing, documents
from pyspark.sql import functions as F

from rowsieve.llm import pii

# the plain patterns, as the contract states them
PLAIN = {
    "email": r"[A-Za-z0-9._%+-]+@[A-Za-z0-9-]+(\.[A-Za-z0-9-]+)+",
    "ip": r"[0-9]+(\.[0-9]+)(\.[0-9]+)(\.[0-9]+)",
    "card": r"[0-9]([\x20-]?[0-9])+",
    "phone": r"\+[0-9][\x20().0-9-]+[0-9]",
}


def luhn(digits):
    total = 0
    for i, d in enumerate(map(int, reversed(digits))):
        total += d if i % 2 == 0 else sum(divmod(2 * d, 10))
    return total % 10 == 0


def passes(kind, value):
    digits = re.sub("[^0-9]", "", value)
    return {
        "email": True,
        "ip": kind != "ip" or all(int(x) <= 255 for x in value.split(".")),
        "card": 16 <= len(digits) <= 19 and luhn(digits),
        "phone": 8 <= len(digits) <= 15,
    }[kind]


def base(text):
    return [(k, m.start(), m.end()) for k in PLAIN for m in re.finditer(PLAIN[k], text or "") if passes(k, m[0])]


def listed(spans):
    return ",".join(f"{k}:{a}:{b}" for k, a, b in spans)


def check_base(rows, texts):
    for r in rows:
        want = base(texts[r.doc_id])
        assert r.base_sha256 == hashlib.sha256(listed(want).encode()).hexdigest(), texts[r.doc_id]
        assert (r.spans + ",").startswith(listed(want) + ",")
        assert [r.n_email, r.n_ip, r.n_card, r.n_phone] == [sum(k == kind for k, _, _ in want) for kind in PLAIN]


ODD = [
    "a@b.c@d.e a@b.c_x@y.z @a.b a@b a@b.c. x@a..b foo@bar@x.yy ..%+-@-.-",
    "1.2.3.4.5.6.7.8 256.1.1.1 0255.000.00001.1 1.2.3 99999999999999999999.1.1.1 1.2.3.4567",
    "4111 1111 1111 1111 4111-1111-1111-1111 41111111111111111111 4111  1111 1111 1111 1 2 3 4 5 6 7 8 9 0 1 2 3 4 5 6",
    "+1 (234) 567-8901 +12345678 +1234567 +1 ( +1 234 567 890 123 456 789 +44 20 7946 0958) ++49 30 901820",
    "ünïcode 😀 mail: é.x@y.co 😀 +1 (234) 567-8901\n\t1.2.3.4",
    "9" * 50_000,
    "1 " * 40_000,
    "a" * 60_000 + "@",
    "x@" + "a." * 30_000 + "b",
    "+1" + "(" * 40_000,
    "1." * 30_001,
]


def test_odd_and_very_long_texts(spark):
    df = documents(spark, ODD)
    check_base(pii.find(df).collect(), dict(enumerate(ODD, 1)))


def test_whole_table(spark):
    df = spark.read.parquet(f"{SF}/documents.parquet")
    check_base(pii.find(df).collect(), {r.doc_id: r.text for r in df.collect()})


@settings(max_examples=6, deadline=None)
@given(st.lists(st.text(alphabet="a1. 9@-+()_é😀\n", max_size=60), min_size=60, max_size=60))
def test_random_texts(spark, texts):
    check_base(pii.find(documents(spark, texts)).collect(), dict(enumerate(texts, 1)))


def test_luhn_in_sql(spark):
    rng = random.Random(1)
    numbers = ["".join(rng.choices("0123456789", k=rng.randint(16, 19))) for _ in range(400)]
    df = spark.createDataFrame([(n,) for n in numbers], "n string").select("n", pii._luhn(F.col("n")).alias("ok"))
    assert {r.n: r.ok for r in df.collect()} == {n: luhn(n) for n in numbers}


def corpus():
    """Texts in which one word stands by one address only, one word half the
    time, and one everywhere; other addresses and texts around them."""
    rng = random.Random(9)
    texts = []
    for i in range(12):
        words = "zorblat" if i % 2 else "zorblat common"
        texts.append(f"note {i} {words} halfway ann@corp.example rest of text {rng.random()}")
    for i in range(12):
        texts.append(f"halfway and common words without any address {i} {rng.random()}")
    for i in range(40):
        texts.append(f"common words mail user{i}@other.example common {i}")
    return texts


def test_disclosing_terms_against_counts_by_hand(spark):
    texts = corpus()
    found = {r.doc_id: r for r in pii.find(documents(spark, texts)).collect()}
    n, n_c, n_tc, n_t = len(texts), 12, 12, sum("zorblat" in t for t in texts)
    assert math.log2(n * n_tc / (n_t * n_c)) >= pii.REMOVE * math.log2(n / n_c)
    for i, text in enumerate(texts, 1):
        extra = [s for s in found[i].spans.split(",") if s and s.split(":")[0] not in PLAIN]
        words = [text[int(s.split(":")[1]) : int(s.split(":")[2])] for s in extra]
        if "ann@corp" in text:
            assert "zorblat" in words and "halfway" not in words and "common" not in words
        elif "@" not in text:
            assert words == []


def brute_terms(texts):
    """{term: action} over distinct texts, every term against every entity."""
    texts = sorted(set(texts))
    gaps, ends = re.compile(f"[{pii._BREAKS}]+"), pii._ENDS
    word = lambda w: len(w) >= 3 and any(map(str.isalpha, w)) and all(x.isalnum() or x in "_'\u2019-" for x in w)
    terms = [{w for w in (p.strip(ends) for p in gaps.split(t.lower())) if word(w)} for t in texts]
    entities = [{f"{k}:{t[a:b].lower()}" for k, a, b in base(t)} for t in texts]
    n, n_t, n_c, n_tc = len(texts), Counter(), Counter(), Counter()
    for ts, cs in zip(terms, entities):
        n_t.update(ts)
        n_c.update(cs)
        n_tc.update((t, c) for t in ts for c in cs)
    told = {}
    for (t, c), both in n_tc.items():
        pmi, ic = math.log2(n * both / (n_t[t] * n_c[c])), math.log2(n / n_c[c])
        if both >= pii.TOGETHER and ic > 0 and pmi >= pii.GENERALISE * ic:
            action = "removed" if pmi >= pii.REMOVE * ic else "term"
            told[t] = min(told.get(t, action), action)
    return told


def brute_spans(text, told):
    out = []
    for m in re.finditer(f"[^{pii._BREAKS}]+", text):
        own = m[0].strip(pii._ENDS)
        if own.lower() in told:
            start = m.start() + len(m[0]) - len(m[0].lstrip(pii._ENDS))
            out.append((told[own.lower()], start, start + len(own)))
    return sorted(out, key=lambda s: (s[1], s[2]))


def far_corpus():
    """Terms far from their address, in every order, in copies, with digits
    and hyphens, in another script, and in texts without the address."""
    rng = random.Random(4)
    filler = lambda n: " ".join(f"w{rng.randint(0, 60)}x" for _ in range(n))
    texts = []
    for i in range(9):
        texts.append(f"{filler(3)} (zorblat), {filler(60)} jdoe_77 K-4471 {filler(8 * i)} ann@corp.example {filler(5)}")
        texts.append(f"bob@corp.example {filler(40)} \u738b\u5c0f\u660e\u3002 {filler(2)} zorblat-b; common")
    texts += texts[:6]  # copies
    texts += [f"{filler(12)} 'ZORBLAT' without any address", "x", ""]
    return texts + [f"common {filler(12)}" for _ in range(120)]


def check_terms(spark, texts):
    told = brute_terms(texts)
    found = {r.doc_id: r for r in pii.find(documents(spark, texts)).collect()}
    for i, text in enumerate(texts, 1):
        assert found[i].spans == listed(base(text) + brute_spans(text, told)), text
    return told


def test_terms_anywhere_in_a_text_against_brute_force(spark):
    told = check_terms(spark, far_corpus())
    assert {"jdoe_77", "k-4471", "zorblat-b", "\u738b\u5c0f\u660e"} <= set(told) and "zorblat" in told and "common" not in told


def test_terms_without_broadcast(spark, monkeypatch):
    monkeypatch.setattr(pii, "MAX_BYTES", -1)
    monkeypatch.setattr(pii, "HOT_SHARE", 100)
    check_terms(spark, far_corpus())


def test_copies_prove_nothing(spark):
    texts = ["secretive words ann@corp.example here"] * 50 + [f"plain text number {i}" for i in range(50)]
    assert all(r.spans.count(":") <= 2 for r in pii.find(documents(spark, texts)).collect())


def test_sanitised_texts(spark):
    texts = [*corpus(), None, "", "call +1 (234) 567-8901 or 4111 1111 1111 1111 now", "1.2.3.4@x.yy é"]
    df = clashing(documents(spark, texts))
    out = pii.sanitise(df)
    assert out.columns == df.columns
    rows = {r.doc_id: r for r in out.collect()}
    assert rows[len(texts) - 3].text is None and rows[len(texts) - 3].n_chars is None
    assert rows[len(texts) - 2].text == ""
    assert rows[len(texts) - 1].text == "call [PHONE] or [CARD] now"
    assert rows[len(texts)].text == "[EMAIL] é"  # overlapping spans are one
    for i, text in enumerate(texts, 1):
        if text and "ann@corp" in text:
            assert "ann@corp" not in rows[i].text and "zorblat" not in rows[i].text and "[EMAIL]" in rows[i].text
            assert rows[i].n_chars == len(rows[i].text)
        elif text and "@" not in text and "+1" not in text:
            assert rows[i].text == text


def test_defined_cases(spark):
    df = clashing(documents(spark, [None, "", "a@b.cc", "a@b.cc"], [1, None, 3, 3]))
    rows = sorted(pii.find(df).collect(), key=str)
    assert [(r.doc_id, r.n_email, r.spans) for r in sorted(rows, key=lambda r: (r.doc_id or 0))] == [
        (None, 0, ""), (1, 0, ""), (3, 1, "email:0:6"), (3, 1, "email:0:6")
    ]
    assert pii.find(documents(spark, [])).count() == 0
    assert pii.sanitise(documents(spark, [])).count() == 0


def test_clashing_helper_names(spark):
    df = documents(spark, ["a@b.cc x", None])
    names = ["row", "base", "terms", "digest", "spans", "salt", "cleaned", "copies", "action"]
    df = df.select("*", *[F.lit(n).alias(n) for n in names])
    out = pii.sanitise(df)
    assert out.columns == df.columns
    assert all(r[n] == n for r in out.collect() for n in names)


def test_no_python_in_the_plan(spark):
    plan = pii.sanitise(documents(spark, ["x"]))._jdf.queryExecution().toString()
    assert "Python" not in plan and "Arrow" not in plan and "Pandas" not in plan
