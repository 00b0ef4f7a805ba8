"""Personal data: base spans against the plain patterns, what the trees add, and odd rows."""
import hashlib
import random
import re

import numpy as np
import pytest

from sitewright.llm import personal_data as pd_
from sitewright.llm.boosted_trees import boost, calibrate
from sitewright.llm.queries import QUERIES

#: The patterns of the contract.
PLAIN = (("email", r"[A-Za-z0-9._%+-]+@[A-Za-z0-9-]+(\.[A-Za-z0-9-]+)+"), ("ip", r"[0-9]+(\.[0-9]+)(\.[0-9]+)(\.[0-9]+)"),
         ("card", r"[0-9]([\x20-]?[0-9])+"), ("phone", r"\+[0-9][\x20().0-9-]+[0-9]"))


def brute(text):
    out = []
    for kind, pattern in PLAIN:
        for m in re.finditer(pattern, text):
            d = re.sub("[^0-9]", "", m.group())
            odd = sum(int(c) for c in d[::-2]) + sum(sum(divmod(2 * int(c), 10)) for c in d[-2::-2])
            ok = {"email": True, "ip": kind == "ip" and all(int(x) <= 255 for x in m.group().split(".")), "card": 16 <= len(d) <= 19 and odd % 10 == 0,
                  "phone": 8 <= len(d) <= 15}[kind]
            if ok:
                out.append((kind, *m.span()))
    return out


def card(rnd):
    d = "4" + "".join(rnd.choices("0123456789", k=14))
    return next(d + c for c in "0123456789" if pd_.luhn(d + c))


def corpus(n=1500):
    rnd = random.Random(3)
    words = "lorem ipsum dolor sit amet look at home order version number of the meeting".split()
    rows = []
    for i in range(n):
        w = rnd.choices(words, k=rnd.randrange(5, 40))
        for k in range(rnd.randrange(0, 4)):
            new = rnd.choice([
                lambda: f"jo.{rnd.randrange(99)}@mail{rnd.randrange(9)}.example.com", lambda: ".".join(str(rnd.randrange(256)) for _ in range(4)),
                lambda: card(rnd), lambda: f"+1 ({rnd.randrange(100, 999)}) 555-{rnd.randrange(1000, 9999)}",
                lambda: "".join(rnd.choices("123456789", k=16)), lambda: f"{rnd.randrange(1900, 2030)}-{rnd.randrange(10, 13)}-{rnd.randrange(10, 29)} 10.30",
                lambda: ".".join(str(rnd.randrange(300, 900)) for _ in range(4)), lambda: hashlib.sha1(str(rnd.random()).encode()).hexdigest()])()
            w.insert(rnd.randrange(len(w)), new)
        rows.append((i, " ".join(w)))
    return rows


def test_base_spans_equal_the_patterns():
    rnd = random.Random(1)
    for alphabet in ("a@.1 2+-(9_b\n5", "0123456789 -", "12.5", "@a.b", "+1 ().-2\x00é"):
        for _ in range(3000):
            t = "".join(rnd.choices(alphabet, k=rnd.randrange(45)))
            assert pd_.base_spans(t) == brute(t), t
    assert all(pd_.base_spans(t) == brute(t) for _, t in corpus(300))


def test_very_long_runs_end_soon():
    for t in ("9" * 300000, "a" * 300000 + "@", "1." * 5000, "1 " * 5000, "+1" * 100000, "a at " * 60000, "a.b-" * 60000 + "@x"):
        list(pd_.examples(t))
        assert isinstance(pd_.base_spans(t), list)


def test_trees_learn_and_margins_are_calibrated():
    rng = np.random.default_rng(0)
    x = rng.integers(0, 10, (4000, 5)).astype(float)
    y = ((x[:, 0] > 4) ^ (x[:, 3] > 6)).astype(float)
    trees = boost(x[:3000], y[:3000], np.ones(3000))
    assert (((trees.margins(x[3000:]) > 0) == (y[3000:] > 0)).mean()) > 0.99
    flat = boost(x, np.ones(len(x)), np.ones(len(x)), rounds=3)
    assert np.all(flat.margins(x) > 5)
    m = rng.normal(0, 3, 20000)
    y = (rng.random(20000) < 1 / (1 + np.exp(-(0.5 * m - 1)))).astype(float)
    assert np.allclose(calibrate(m, y, np.ones(20000)), (0.5, -1), atol=0.06)
    slope, offset = calibrate(np.array([-2., -1, 1, 2]), np.array([0., 0, 1, 1]), np.ones(4))
    assert slope > 0.3 and abs(offset) < 1e-6
    assert calibrate(np.zeros(0), np.zeros(0), np.zeros(0)) == calibrate(np.ones(3), np.ones(3), np.ones(3)) == (0.0, -np.inf)


@pytest.fixture(scope="module")
def finder(spark):
    return pd_.learn(spark.createDataFrame(corpus(), "doc_id long, text string").repartition(4))


def spans(finder, text):
    known = pd_.base_spans(text)
    return [(k, text[a:b]) for k, a, b in known + finder.select(text, known)]


def test_what_the_trees_add(finder):
    rnd = random.Random(9)
    good = [card(rnd) for _ in range(40)]
    swallowed = [f"order of the {''.join(rnd.choices('123456789', k=4))} {c} dolor sit" for c in good]
    assert not any(s[0] == "card" for t in swallowed for s in pd_.base_spans(t))
    assert sum(("card", c) in spans(finder, t) for c, t in zip(good, swallowed)) >= 36
    phones = [f"look at +1 ({rnd.randrange(100, 999)}) 555-{rnd.randrange(1000, 9999)} 170.106.47.{k} lorem" for k in range(30)]
    assert sum(("phone", t[8:25]) in spans(finder, t) for t in phones) >= 27
    # long numbers, dates, hashes and prose stay
    clean = [" ".join(x for x in t.split() if "@" not in x) for _, t in corpus(400)]
    clean = [t for t in clean if not pd_.base_spans(t) and not any(pd_.luhn(m) for m in re.findall(r"[0-9]{16}", t))]
    assert len(clean) > 100 and sum(bool(spans(finder, t)) for t in clean) <= len(clean) // 100


def test_odd_rows(spark, finder):
    texts = [None, "", " \n", "no data", "mail a.b@c.example.org now", "mail a.b@c.example.org now", "é\U0001f600 10.0.0.1, +1 (202) 555-0143",
             "x 4111111111111111 y " * 3000]
    docs = spark.createDataFrame([(i if i % 3 else None, t, "s", 1) for i, t in enumerate(texts)], "doc_id long, text string, spans string, _k int")
    for model in (finder, None):
        got = pd_.find(docs, model, keep=("doc_id", "text", "spans", "_k"), redact=True).collect()
        assert len(got) == len(texts)
        for r in got:
            base = [(s.kind, s.start, s.end) for s in r.spans if s.base]
            assert base == brute(r.text or "") and r._k == 1
            assert "@" not in r.redacted and "4111" not in r.redacted
        assert {r.redacted for r in got} >= {"", "no data", "mail <EMAIL> now", "é\U0001f600 <IP>, <PHONE>"}
    assert pd_.find(docs.limit(0), finder).collect() == [] and pd_.learn(docs.limit(0)) is None
    assert pd_.learn(docs.filter("text is null")) is None


def test_query(spark, sf):
    import pyarrow.parquet as pq

    texts = {r["doc_id"]: r["text"] or "" for r in pq.read_table(f"{sf}/documents.parquet").to_pylist()}
    got = QUERIES["op12_personal_data"](spark, sf).collect()
    assert len(got) == len(texts)
    for r in got:
        base = brute(texts[r.doc_id])
        assert r.base_sha256 == hashlib.sha256(",".join(f"{k}:{a}:{b}" for k, a, b in base).encode()).hexdigest()
        assert [r.n_email, r.n_ip, r.n_card, r.n_phone] == [sum(s[0] == k for s in base) for k in pd_.KINDS]
        assert {f"{k}:{a}:{b}" for k, a, b in base} <= set(r.spans.split(","))
